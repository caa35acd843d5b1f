"""Joins against dimension tables (sites, environment, host tools).

A side is broadcast only if the plan's own statistics bound its size in bytes;
no job runs for that. Beyond the bound it is a shuffle join: adaptive execution
splits skewed keys, and where a few keys hold most rows by design (sites), the
big side is salted by a hash of its row key, so that one site holding a third of
the fleet is spread over ``salts`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 32 << 20
SALTS = 32


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the table's size (stored tables: file sizes;
    joins and unions of them: an upper estimate)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def dim_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    row_key: Sequence[str] | str = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join a large table to a dimension table on equal keys.

    ``how`` is one of inner, left, left_semi, left_anti (the big side is the
    left side). ``row_key``: scalar columns of the big side that tell its rows
    apart; with them, a join that is too large to broadcast is salted. The salt
    is a hash of them, so retried tasks send rows to the same place.
    """
    keys = [on] if isinstance(on, str) else list(on)
    rows = [row_key] if isinstance(row_key, str) else list(row_key)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if plan_bytes(small) <= BROADCAST_MAX_BYTES:
        return big.join(F.broadcast(small), keys, how)
    if not rows:
        return big.join(small, keys, how)
    salt = "__salt"
    salted = big.withColumn(salt, F.pmod(F.xxhash64(*rows), F.lit(salts)).cast("int"))
    copies = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, salt], how).drop(salt)
