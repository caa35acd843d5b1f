"""P7 by a digest tree: desired and recorded state compared by sums of hashes
first, so that only what differs is shuffled and joined.

Every row falls into a leaf by a hash of its key, leaves into nodes, level by
level. A node's digest is its row count and the sums of both halves of its rows'
64-bit hashes: sums add up within a task, so a pass over a level shuffles one
small row for each node and task, whatever the rows are. A level is read only
below the nodes that differ on the level above; an unchanged fleet ends at the
first. Rows below equal leaves are unchanged without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ..session import write_table
from .runs import diff_state

#: Nodes of each level, each a multiple of the one before. The nodes that differ
#: are broadcast: at most as many numbers as the last level has nodes, 4 MB here.
LEVELS = (64, 4096, 262144)


def _row_hash(columns: Sequence[str]) -> Column:
    # The hash leaves out NULLs, so which columns are NULL is hashed as well.
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _same_types(desired: DataFrame, actual: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns' common types: equal values, equal hashes."""
    schema = desired.select(*columns).unionByName(actual.select(*columns)).schema
    nested = [f.name for f in schema if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    if nested:
        raise TypeError(f"nested columns have no digest: {', '.join(nested)}")
    one, two = (side.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]) for side in (desired, actual))
    return one, two


def node_digests(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], nodes: int, leaves: int) -> DataFrame:
    """The digest of every node: ``node``, ``n``, ``low``, ``high``. Sums of
    halves stay within a long for 2^31 rows of a node and side."""
    node = F.floor(F.pmod(_row_hash(keys), F.lit(leaves)) / F.lit(leaves // nodes)).cast("bigint")
    hashed = rows.select(node.alias("node"), _row_hash([*keys, *cols]).alias("hash"))
    return hashed.groupBy("node").agg(
        F.count("*").alias("n"),
        F.sum(F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned("hash", 32)).alias("high"),
    )


def _below(rows: DataFrame, keys: Sequence[str], differing: DataFrame, nodes: int, leaves: int, how: str = "left_semi") -> DataFrame:
    """Rows below (or, ``left_anti``, not below) the nodes of a level."""
    node = F.floor(F.pmod(_row_hash(keys), F.lit(leaves)) / F.lit(leaves // nodes)).cast("bigint")
    return rows.withColumn("__node", node).join(F.broadcast(differing), F.col("__node") == F.col("node"), how).drop("__node")


def diff_by_digest(
    desired: DataFrame, actual: DataFrame, keys: Sequence[str], cols: Sequence[str] = (), mode: str = "full", levels: Sequence[int] = LEVELS
) -> DataFrame:
    """The answer of :func:`runs.diff_state` (keys..., action), for stored
    tables of which little differs: each level is one pass over the rows that are
    left. Keys are unique per side; a row with a NULL in its key equals no
    other, as in a join. Columns are scalars. Two states of a node whose hashes
    add up alike count as equal: a chance of about 2^-64 for a changed node."""
    keys, cols = list(keys), list(cols)
    leaves = levels[-1]
    if any(leaves % n for n in levels):
        raise ValueError("the last level must be a multiple of the others")
    compared = [] if mode == "keys_only" else cols
    one, two = _same_types(desired, actual, keys + cols)
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    left, right = one.where(whole), two.where(whole)
    alone = [one.where(~whole).select(*keys, F.lit("create").alias("action"))]
    alone.append(two.where(~whole).select(*keys, F.lit("forget" if mode == "keys_only" else "delete").alias("action")))

    differing, above = None, None
    for nodes in levels:
        sides = [side if differing is None else _below(side, keys, differing, above, leaves) for side in (left, right)]
        d, a = (node_digests(side, keys, compared, nodes, leaves).select("node", F.struct("n", "low", "high").alias(name)) for side, name in zip(sides, "da", strict=True))
        differing, above = write_table(d.join(a, "node", "full_outer").where(~F.col("d").eqNullSafe(F.col("a"))).select("node"), "digests"), nodes
        if differing.isEmpty():
            break
    same = _below(left, keys, differing, above, leaves, "left_anti").select(*keys, F.lit("unchanged").alias("action"))
    changed = [_below(side, keys, differing, above, leaves) for side in (left, right)]
    out = diff_state(*changed, keys, cols, mode).unionByName(same)
    for rows in alone:
        out = out.unionByName(rows)
    return out
