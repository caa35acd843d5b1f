"""Readiness as Structured Streaming.

Polls arrive as a stream (here: the events table read as a file stream and
turned into poll snapshots by the same projection as the batch view).

* L4: a run is a session of polls: it is over once it hasn't polled for as long
  as its deadline. Per session, the first poll and the first good and available
  one; a session is written once, when the watermark passes its end, and its
  state goes with it. The table only ever gets one row per finished session.
* L5: polls per run per 30-second window, in append mode to a Parquet sink: a
  window is written once the watermark passes it.

The watermark follows the data, so the last windows and sessions stay open while
nothing later arrives; a later call on the same root goes on with them. Only for
an input that has ended for good, ``finish`` lets one closing poll of no run come
in after it, far in the future: all that is open closes. After that every poll
would be late, so a finished root is refused.

Event time is ``polled_at`` cast to TIMESTAMP (the session time zone is UTC),
because a watermark needs a TIMESTAMP column.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.readiness import availability, parse_csr_snapshots
from ..plans.views import polls_from_events
from ..session import exists, mark, scratch_path
from ..sources.fixed_values import POLL_SECONDS, READINESS_TIMEOUT_MINUTES


def poll_stream(spark: SparkSession, events_dir: str, file_glob: str = "events.parquet") -> DataFrame:
    """Streaming poll snapshots from the events files under ``events_dir``."""
    schema = spark.read.parquet(os.path.join(events_dir, file_glob)).schema
    ev = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(events_dir)
    return polls_from_events(ev).withColumn("polled_at", F.col("polled_at").cast("timestamp"))


def _run(spark: SparkSession, polls: DataFrame, shape, root: str, watermark: str, finish: bool) -> str:
    """Run ``shape(polls)`` in append mode to the end of the available input;
    with ``finish``, once more with the closing poll. Returns the output folder.
    A root whose finish has begun can only be finished, a finished one not used."""
    closing, out = os.path.join(root, "closing"), os.path.join(root, "out")
    begun, finished = os.path.join(root, "finish-begun"), os.path.join(root, "finished")
    if exists(spark, finished) or (exists(spark, begun) and not finish):
        raise ValueError(f"the input of {root} was declared to have ended; start a new root")
    none = spark.createDataFrame([], polls.schema)
    none.write.mode("append").parquet(closing)
    both = polls.unionByName(spark.readStream.schema(polls.schema).parquet(closing))

    def to_end() -> None:
        writer = shape(both.withWatermark("polled_at", watermark)).writeStream.outputMode("append").format("parquet")
        query = writer.option("path", out).option("checkpointLocation", os.path.join(root, "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()

    to_end()
    if finish:
        mark(spark, begun)
        values = {f.name: F.lit(None).cast(f.dataType) for f in polls.schema.fields} | {"polled_at": F.lit("9000-01-01").cast("timestamp")}
        spark.range(1).select(*[values[c].alias(c) for c in polls.columns]).write.mode("append").parquet(closing)
        to_end()
        mark(spark, finished)
    return out


def run_time_to_available(
    spark: SparkSession,
    polls: DataFrame,
    timeout_minutes: int = READINESS_TIMEOUT_MINUTES,
    root: str | None = None,
    watermark: str = "1 hour",
    finish: bool = False,
) -> str:
    """L4 as a stream: one row per finished session (run_id, started_at,
    first_available); returns the table's folder."""

    def sessions(rows: DataFrame) -> DataFrame:
        scored = availability(parse_csr_snapshots(rows))
        window = F.session_window("polled_at", f"{int(timeout_minutes)} minutes").alias("session")
        found = scored.groupBy("run_id", window).agg(
            F.min("polled_at").alias("started_at"),
            F.min(F.when(F.col("good") & F.col("available"), F.col("polled_at"))).alias("first_available"),
        )
        return found.select("run_id", "started_at", "first_available")

    return _run(spark, polls, sessions, root or scratch_path(spark, f"streams/readiness-{uuid.uuid4().hex}"), watermark, finish)


def current_time_to_available(spark: SparkSession, table: str, timeout_minutes: int = READINESS_TIMEOUT_MINUTES) -> DataFrame:
    """Each run's first session, evaluated against the deadline: same columns
    and rules as the batch ``time_to_available``. What is available before the
    deadline is in the first session: it ends only after as long a silence."""
    rows = spark.read.parquet(table).where(F.col("run_id").isNotNull())
    per_run = rows.groupBy("run_id").agg(F.min(F.struct("started_at", "first_available")).alias("s"))
    start, first = F.col("s.started_at"), F.col("s.first_available")
    deadline = start + F.expr(f"INTERVAL {int(timeout_minutes)} MINUTES")
    in_time = first.isNotNull() & (first < deadline)
    micros = F.unix_micros(first) - F.unix_micros(start)
    return per_run.select(
        "run_id",
        start.cast("timestamp_ntz").alias("started_at"),
        F.when(in_time, first.cast("timestamp_ntz")).alias("available_at"),
        F.when(in_time, F.floor(micros / 1_000_000)).cast("bigint").alias("seconds"),
        F.when(in_time, F.lit("available")).otherwise(F.lit("timed_out")).alias("status"),
    )


def run_poll_buckets(
    spark: SparkSession, polls: DataFrame, root: str | None = None, seconds: int = POLL_SECONDS, watermark: str = "1 hour", finish: bool = False
) -> str:
    """L5 as a stream: polls per run per window, appended once final."""

    def counts(rows: DataFrame) -> DataFrame:
        window = F.window("polled_at", f"{seconds} seconds").alias("w")
        return rows.groupBy("run_id", window).agg(F.count(F.lit(1)).alias("polls")).select("run_id", F.col("w.start").alias("window_start"), "polls")

    return _run(spark, polls, counts, root or scratch_path(spark, f"streams/poll-buckets-{uuid.uuid4().hex}"), watermark, finish)


def poll_buckets_table(spark: SparkSession, table: str) -> DataFrame:
    """The windows written so far, with the batch form's columns."""
    rows = spark.read.parquet(table).where(F.col("run_id").isNotNull())
    return rows.select("run_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "polls")
