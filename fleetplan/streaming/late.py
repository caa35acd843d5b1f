"""Late polls kept: a stream splits its polls into those in time and late ones.

Spark's stateful operators drop rows behind the watermark without a trace. Here
a first stream routes every poll before they see it: each micro-batch is compared
with the watermark that the batches before it have set (the latest poll time so
far, less the allowed delay); polls behind it go to a side table, the others to
the table that the stateful streams read. Their watermark follows the same polls
and is never ahead of this one, so they drop none.

The state is one row for each micro-batch, written with it: a batch that is
repeated after a failure finds the same watermark and replaces its own files.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, scratch_path


def _behind(watermark: int | None) -> Column:
    """Whether a poll is late. Polls at the watermark are, as in Spark; polls
    without a time never are."""
    if watermark is None:
        return F.lit(False)
    return F.coalesce(F.unix_micros(F.col("polled_at").cast("timestamp")) <= watermark, F.lit(False))


def route_late(spark: SparkSession, polls: DataFrame, delay_seconds: int = 3600, root: str | None = None) -> str:
    """Route the available polls of a stream (column ``polled_at``) into
    ``<root>/polls`` (columns as they are, and ``batch``; partitioned by
    ``late``). A later call with the same root goes on. Returns the root.

    Every poll comes out once, in one of the two; a poll without a time is in
    time. Only the latest time of each micro-batch reaches the driver."""
    root = root or scratch_path(spark, f"streams/late-{uuid.uuid4().hex}")
    out, marks = os.path.join(root, "polls"), os.path.join(root, "marks")

    def route(batch: DataFrame, batch_id: int) -> None:
        # a batch's own session is a clone: its settings don't reach the caller's
        before = None
        if exists(batch.sparkSession, marks):
            table = batch.sparkSession.read.schema("latest long, batch long").parquet(marks)
            before = table.where(F.col("batch") < batch_id).agg(F.max("latest")).first()[0]
        watermark = None if before is None else before - delay_seconds * 1_000_000
        rows = batch.withColumn("late", _behind(watermark))
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{out}/batch={batch_id}")
        # taken from what was written: the input is read once
        written = batch.sparkSession.read.parquet(f"{out}/batch={batch_id}")
        latest = written.agg(F.max(F.unix_micros(F.col("polled_at").cast("timestamp"))).alias("latest"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")

    writer = polls.writeStream.foreachBatch(route).option("checkpointLocation", os.path.join(root, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return root


def routed(spark: SparkSession, root: str, polls: DataFrame) -> DataFrame:
    """What :func:`route_late` has written: the columns of ``polls``, ``batch``
    and ``late``. No batch yet, no rows."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in polls.schema.fields]
    schema = ", ".join([*fields, "batch long", "late boolean"])
    out = os.path.join(root, "polls")
    if not exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def in_time(spark: SparkSession, root: str, polls: DataFrame) -> DataFrame:
    """The polls in time as a stream, for the stateful queries."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in polls.schema.fields]
    stream = spark.readStream.schema(", ".join([*fields, "batch long", "late boolean"])).parquet(os.path.join(root, "polls"))
    return stream.where(~F.col("late")).select(*polls.columns)
