"""Messages of growing logs (S5, P4) over micro-batches.

A message may begin in one micro-batch and go on in the next, and line numbers
run through the whole file. What a file needs for that is one row of state: how
many lines it has had, and the line that began its open message. A micro-batch is
numbered and joined as the batch form does it, in chunks of bytes, so a file that
grew by a third of all lines is spread over many tasks; the state is joined in.

Each micro-batch writes its messages and the state after it into folders of its
own number, so a batch that is repeated after a failure replaces its own.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scans import ordinal_within, running_max_within
from ..operators.runs import parse_logs
from ..session import exists, scratch_path
from ..sources.files import log_stream
from ..sources.logs import LOG_SUFFIX

BYTES_PER_CHUNK = 1 << 20
STATE = "cluster_name string, lines long, head struct<line_no:long,logged_at:timestamp_ntz,level:string>"
MESSAGES = "cluster_name string, start_line long, line_no long, logged_at timestamp_ntz, level string, message string"


def joined(lines: DataFrame, state: DataFrame) -> DataFrame:
    """Lines (cluster_name, at, text) of one micro-batch with their numbers and
    the heads of their messages, ``state`` being what the batches before left."""
    chunk = F.expr(f"at div {BYTES_PER_CHUNK}")
    numbered = ordinal_within(lines, ["cluster_name"], ["at"], chunk, "__place")
    before = state.select("cluster_name", F.col("lines").alias("__before"), F.col("head").alias("__open"))
    numbered = numbered.join(before, "cluster_name", "left")
    numbered = numbered.withColumn("line_no", F.coalesce(F.col("__before"), F.lit(0)) + F.col("__place"))
    head = F.struct("line_no", "logged_at", "level")
    marked = running_max_within(parse_logs(numbered), ["cluster_name"], ["at"], chunk, F.when(F.col("is_start"), head), "__new")
    return marked.withColumn("__head", F.coalesce("__new", "__open"))


def state_after(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The state once ``rows`` (from :func:`joined`) are in: one row per file."""
    new = rows.groupBy("cluster_name").agg(F.max("line_no").alias("__lines"), F.max("__head").alias("__last"))
    both = state.join(new, "cluster_name", "full_outer")
    return both.select("cluster_name", F.coalesce("__lines", "lines").alias("lines"), F.when(F.col("__lines").isNotNull(), F.col("__last")).otherwise(F.col("head")).alias("head"))


def run_log_messages(spark: SparkSession, path: str, root: str | None = None, suffix: str = LOG_SUFFIX) -> str:
    """Join the messages of all lines that the logs under ``path`` have got
    since the last call with this ``root``. Returns the root."""
    root = root or scratch_path(spark, f"streams/logs-{uuid.uuid4().hex}")

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = os.path.join(root, f"state/batch={batch_id - 1}")
        state = session.read.schema(STATE).parquet(before) if exists(session, before) else session.createDataFrame([], STATE)
        new = os.path.join(root, f"new/batch={batch_id}")
        batch.write.mode("overwrite").parquet(new)  # the logs are read once, the scans read this
        rows = joined(session.read.schema(batch.schema).parquet(new), state).select("cluster_name", "line_no", "__head", "message")
        written = os.path.join(root, f"lines/batch={batch_id}")
        rows.write.mode("overwrite").parquet(written)
        stored = session.read.schema(rows.schema).parquet(written)
        state_after(stored, state).write.mode("overwrite").parquet(os.path.join(root, f"state/batch={batch_id}"))

    writer = log_stream(spark, path, suffix).writeStream.foreachBatch(step).option("checkpointLocation", os.path.join(root, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return root


def log_messages(spark: SparkSession, root: str) -> DataFrame:
    """What :func:`run_log_messages` has joined so far, with the columns of the
    batch ``join_multiline``."""
    lines = os.path.join(root, "lines")
    if not exists(spark, lines):
        return spark.createDataFrame([], MESSAGES)
    rows = spark.read.parquet(lines)
    return rows.select(
        "cluster_name", F.col("__head.line_no").alias("start_line"), "line_no",
        F.col("__head.logged_at").alias("logged_at"), F.col("__head.level").alias("level"), "message",
    )
