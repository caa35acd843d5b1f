"""Ordered scans within groups that stay balanced when one group is hot.

``row_number() over (partition by g order by o)`` sends a whole group to one
task. Here each row also gets a chunk id, a non-decreasing function of the
order key (e.g. ``line_no div 4096`` or the hour of a timestamp). The scan
runs per (group, chunk), so a hot group is spread over many tasks, and a
small table of per-chunk totals (one row per group and chunk, built by a
map-side combined aggregate) gives the carry from the group's earlier chunks.
Everything is deterministic, so a retried task recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "__chunk"


def ordinal_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str) -> DataFrame:
    """Add ``name`` = 1-based position of the row within its group by
    ``order`` (unique within a group). ``chunk`` must not decrease along
    ``order``."""
    keys, order = list(keys), list(order)
    c = df.withColumn(_CHUNK, chunk)
    local = c.withColumn("__local", F.row_number().over(Window.partitionBy(*keys, _CHUNK).orderBy(*order)))
    totals = c.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    carry = totals.withColumn(
        "__carry",
        F.coalesce(
            F.sum("__n").over(Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).drop("__n")
    return (
        local.join(carry, [*keys, _CHUNK])
        .withColumn(name, (F.col("__carry") + F.col("__local")).cast("bigint"))
        .drop(_CHUNK, "__local", "__carry")
    )


def running_max_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column, name: str
) -> DataFrame:
    """Add ``name`` = max of ``value`` over the group's rows up to and
    including this one in ``order`` (NULLs ignored)."""
    keys, order = list(keys), list(order)
    c = df.withColumn(_CHUNK, chunk).withColumn("__v", value)
    local = c.withColumn(
        "__local",
        F.max("__v").over(Window.partitionBy(*keys, _CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)),
    )
    totals = c.groupBy(*keys, _CHUNK).agg(F.max("__v").alias("__m"))
    carry = totals.withColumn(
        "__carry",
        F.max("__m").over(Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)),
    ).drop("__m")
    return (
        local.join(carry, [*keys, _CHUNK])
        .withColumn(name, F.greatest(F.col("__carry"), F.col("__local")))
        .drop(_CHUNK, "__local", "__carry", "__v")
    )
