"""Readiness (S3, S4, L1-L7): certificate-request snapshots, availability,
time to available with a deadline, retries.

A poll is one row carrying its whole snapshot, so per-poll results (pending
list, availability) are row-local array expressions. Per-run results are
algebraic aggregates (min, count) that Spark combines map-side, so a run with
a third of all polls is still split across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.fixed_values import POLL_SECONDS, READINESS_TIMEOUT_MINUTES, TOKEN_TRIES

CSR_SCHEMA = (
    "struct<items:array<struct<metadata:struct<name:string>,"
    "status:struct<conditions:array<struct<type:string,status:string>>>>>>"
)
VERSION_SCHEMA = "struct<status:struct<conditions:array<struct<type:string,status:string>>>>"


def _pending(item: Column) -> Column:
    """An item is pending when its conditions are missing, null or empty."""
    return F.coalesce(F.size(item.status.conditions), F.lit(0)) <= 0


# --------------------------------------------------------------------------- S3/S4
def parse_csr_snapshots(polls: DataFrame) -> DataFrame:
    """Add ``good`` (the CSR list parses) and ``items`` (parsed list) to each
    poll. A malformed snapshot is kept with good = false: that poll is skipped,
    availability included."""
    return polls.withColumns(
        {
            "good": F.try_parse_json(F.col("csr_json")).isNotNull(),
            "items": F.from_json(F.col("csr_json"), CSR_SCHEMA).getField("items"),
        }
    )


def csr_items(polls: DataFrame) -> DataFrame:
    """S3: one row per request of every good poll:
    (run_id, poll_id, polled_at, name, n_conditions, pending)."""
    parsed = parse_csr_snapshots(polls).where(F.col("good"))
    rows = parsed.select("run_id", "poll_id", "polled_at", F.explode("items").alias("item"))
    return rows.select(
        "run_id",
        "poll_id",
        "polled_at",
        F.col("item.metadata.name").alias("name"),
        F.coalesce(F.size(F.col("item.status.conditions")), F.lit(0)).cast("int").alias("n_conditions"),
        _pending(F.col("item")).alias("pending"),
    )


def bad_polls(polls: DataFrame) -> DataFrame:
    """Polls whose CSR list does not parse: (run_id, poll_id, polled_at)."""
    return parse_csr_snapshots(polls).where(~F.col("good")).select("run_id", "poll_id", "polled_at")


# --------------------------------------------------------------------------- L1/L2
def pending_requests(polls: DataFrame) -> DataFrame:
    """L1: pending requests (run_id, poll_id, polled_at, name)."""
    return csr_items(polls).where(F.col("pending")).select("run_id", "poll_id", "polled_at", "name")


def pending_per_poll(polls: DataFrame) -> DataFrame:
    """L2: per good poll, the pending count and the sorted, comma-joined names.
    Row-local: the list lives in the poll's own snapshot."""
    parsed = parse_csr_snapshots(polls).where(F.col("good"))
    pend = F.filter(F.coalesce(F.col("items"), F.array()), _pending)
    names = F.transform(pend, lambda i: i.getField("metadata").getField("name"))
    return parsed.select(
        "run_id",
        "poll_id",
        "polled_at",
        F.size(pend).cast("bigint").alias("n_pending"),
        F.array_join(F.array_sort(names), ",").alias("pending"),
    )


# --------------------------------------------------------------------------- L3
def availability(polls: DataFrame) -> DataFrame:
    """L3: a poll sees the cluster available when exactly one ``Available``
    condition exists and its status, trimmed, is ``True``. Adds ``available``."""
    conds = F.from_json(F.col("version_json"), VERSION_SCHEMA).getField("status").getField("conditions")
    hits = F.filter(F.coalesce(conds, F.array()), lambda c: c.type == "Available")
    ok = (F.size(hits) == 1) & (F.trim(F.element_at(hits, 1).status) == "True")
    return polls.withColumn("available", F.coalesce(ok, F.lit(False)))


# --------------------------------------------------------------------------- L4
def time_to_available(polls: DataFrame, timeout_minutes: int = READINESS_TIMEOUT_MINUTES) -> DataFrame:
    """L4: per run, the first good and available poll before the deadline
    (start + timeout, strict ``<``; start = the run's first poll). Whole
    seconds to it, else ``timed_out``. One aggregate (min, min) per run: if the
    first available poll is past the deadline, none is before it.

    Columns: run_id, started_at, available_at, seconds, status."""
    scored = availability(parse_csr_snapshots(polls))
    per_run = scored.groupBy("run_id").agg(
        F.min("polled_at").alias("started_at"),
        F.min(F.when(F.col("good") & F.col("available"), F.col("polled_at"))).alias("__first"),
    )
    deadline = F.col("started_at") + F.expr(f"INTERVAL {int(timeout_minutes)} MINUTES")
    in_time = F.col("__first").isNotNull() & (F.col("__first") < deadline)
    micros = F.unix_micros(F.col("__first").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return per_run.select(
        "run_id",
        "started_at",
        F.when(in_time, F.col("__first")).alias("available_at"),
        F.when(in_time, F.floor(micros / 1_000_000)).cast("bigint").alias("seconds"),
        F.when(in_time, F.lit("available")).otherwise(F.lit("timed_out")).alias("status"),
    )


def silence_alarms(polls: DataFrame, silence_minutes: int = READINESS_TIMEOUT_MINUTES) -> DataFrame:
    """L4, the alarm form: a run that has not been seen available and doesn't
    poll for ``silence_minutes`` raises one alarm at that deadline, none if it
    polls again by then. A poll after the deadline begins a new episode, which
    may raise its own. The stream form (``streaming.alarms``) gives the same.

    Columns: run_id, started_at and last_poll of the episode, polls (good or
    not), alarm_at."""
    scored = availability(parse_csr_snapshots(polls))
    window = F.session_window("polled_at", f"{int(silence_minutes)} minutes").alias("episode")
    episodes = scored.groupBy("run_id", window).agg(
        F.min("polled_at").alias("started_at"),
        F.max("polled_at").alias("last_poll"),
        F.count(F.lit(1)).alias("polls"),
        F.bool_or(F.col("good") & F.col("available")).alias("__available"),
    )
    return episodes.where(~F.col("__available")).select(
        "run_id", "started_at", "last_poll", "polls", F.col("episode.end").alias("alarm_at")
    )


# --------------------------------------------------------------------------- L5
def poll_buckets(polls: DataFrame, seconds: int = POLL_SECONDS) -> DataFrame:
    """L5 (batch form): polls per run per tumbling window of the poll cadence:
    (run_id, window_start, polls)."""
    return (
        polls.groupBy("run_id", F.window("polled_at", f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("polls"))
        .select("run_id", F.col("w.start").alias("window_start"), "polls")
    )


# --------------------------------------------------------------------------- L6
def first_non_empty(attempts: DataFrame, tries: int = TOKEN_TRIES) -> DataFrame:
    """Per run, the first attempt (1-based, among the first ``tries``)
    whose value, trimmed, is not empty; else failed. One aggregate per run.
    Columns: run_id, attempt, status."""
    hit = F.when((F.col("attempt") <= tries) & (F.trim(F.col("value")) != ""), F.col("attempt"))
    per_run = attempts.groupBy("run_id").agg(F.min(hit).alias("attempt"))
    return per_run.select(
        "run_id",
        F.col("attempt").cast("int").alias("attempt"),
        F.when(F.col("attempt").isNotNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
    )


# --------------------------------------------------------------------------- L7
def pending_age(polls: DataFrame) -> DataFrame:
    """A request whose approval failed stays pending and comes back at the
    next poll: per (run, request) the number of polls it was pending in, first
    and last time seen pending."""
    p = pending_requests(polls)
    return p.groupBy("run_id", "name").agg(
        F.count_distinct("poll_id").cast("bigint").alias("polls"),
        F.min("polled_at").alias("first_seen"),
        F.max("polled_at").alias("last_seen"),
    )
