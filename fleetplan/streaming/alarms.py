"""The silence alarm (L4) as a stateful stream.

Nothing arrives when a run falls silent, so the alarm needs a timer: each run
keeps its open episodes (polls without a pause longer than the allowed silence)
until the watermark passes their end. If no poll of an episode saw the cluster
available, one alarm row is written then. A run without open episodes keeps no
state.

A call into the Python worker, a read of the state and a timer cost the same for
one poll as for thousands, so runs are kept in groups by a hash of their number.
A group holds the open episodes of its runs as one array and one event-time timer
at the earliest end of them; when it fires, every episode that the watermark has
passed is over.

An episode is five numbers, whatever the polls in it, so a run with a third of
all polls costs its task time, not memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.readiness import availability, parse_csr_snapshots
from ..session import importable, scratch_path
from ..sources.fixed_values import READINESS_TIMEOUT_MINUTES
from . import readiness

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Groups of runs, many more than tasks. A group's state is written whole with each
#: micro-batch that has polls of it. The number can't change under a root, whose states
#: are by group.
RUN_GROUPS = 4096
#: Polls that wait at least before they are joined with the open episodes.
POLLS_TO_JOIN = 100_000

Episode = tuple[int, int, int, bool]  # first poll, last poll (microseconds), polls, seen available

#: An open episode in the state.
OPEN = np.dtype([("run", "<i8"), ("start", "<i8"), ("last", "<i8"), ("polls", "<i8"), ("seen", "?")])


def joined(episodes: np.ndarray, silence: int) -> np.ndarray:
    """Episodes of any runs (``OPEN``) by run and time, those of one run joined
    where the pause between them is ``silence`` at most."""
    if not (n := len(episodes)):
        return episodes
    rows = episodes[np.lexsort((episodes["start"], episodes["run"]))]
    begins = np.ones(n, bool)
    begins[1:] = rows["run"][1:] != rows["run"][:-1]
    # the latest poll of the run so far: a running maximum over (run, place of the poll among all)
    times, place = np.unique(rows["last"], return_inverse=True)
    reach = times[np.maximum.accumulate(np.cumsum(begins) * len(times) + place) % len(times)]
    begins[1:] |= rows["start"][1:] - reach[:-1] > silence
    first = np.flatnonzero(begins)
    out = rows[first]
    out["last"] = np.maximum.reduceat(rows["last"], first)
    out["polls"] = np.add.reduceat(rows["polls"], first)
    out["seen"] = np.logical_or.reduceat(rows["seen"], first)
    return out


def merged(episodes: list[Episode], silence: int) -> list[Episode]:
    """:func:`joined` for the episodes of one run."""
    return [e[1:] for e in joined(np.array([(0, *e) for e in episodes], OPEN), silence).tolist()]


def episodes_of(polls: pd.DataFrame) -> np.ndarray:
    """Polls (columns run, at, seen) as episodes of one poll each."""
    out = np.ones(len(polls), OPEN)
    out["run"], out["seen"] = polls["run"], polls["seen"]
    out["start"] = out["last"] = polls["at"]
    return out


def with_untimed(episodes: np.ndarray, polls: np.ndarray) -> np.ndarray:
    """Polls without a time counted in the last of their run's ``episodes`` (from
    :func:`joined`); a run without episodes has no place for them."""
    at = np.searchsorted(episodes["run"], polls["run"], side="right") - 1
    has = at >= 0
    has[has] = episodes["run"][at[has]] == polls["run"][has]
    np.add.at(episodes["polls"], at[has], 1)
    np.logical_or.at(episodes["seen"], at[has], polls["seen"][has])
    return episodes


class SilenceProcessor(StatefulProcessor):
    """Open episodes of each group of runs, closed by event-time timers."""

    def __init__(self, silence: int):
        self._silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "episodes binary")

    def _held(self) -> np.ndarray:
        value = self._open.get()
        return np.frombuffer(value[0] if value else b"", OPEN)

    def _deadlines(self, episodes: np.ndarray) -> np.ndarray:
        """Milliseconds, rounded up: a timer has no microseconds."""
        return -(-(episodes["last"] + self._silence) // 1000)

    def _keep(self, episodes: np.ndarray) -> int | None:
        """Store the open episodes; returns the earliest deadline."""
        if not len(episodes):
            self._open.clear()
            return None
        self._open.update((episodes.tobytes(),))
        return int(self._deadlines(episodes).min())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        parts, waiting, untimed = [held], 0, []
        for chunk in rows:
            polls, named, timed = episodes_of(chunk), chunk["named"].to_numpy(), chunk["timed"].to_numpy()
            if watermark > 0:
                # its episode may be closed and reported: late polls are ``streaming.late``'s
                timed = timed & (polls["last"] > watermark)
            else:
                untimed.append(polls[named & ~timed])
            parts.append(polls[named & timed])
            waiting += len(parts[-1])
            if waiting > max(len(parts[0]), POLLS_TO_JOIN):
                parts, waiting = [joined(np.concatenate(parts), self._silence)], 0
        now = joined(np.concatenate(parts), self._silence)
        if untimed:
            now = with_untimed(now, np.concatenate(untimed))
        if not len(now):
            return iter(())
        before = int(self._deadlines(held).min()) if len(held) else None
        after = self._keep(now)
        if before != after:
            if before is not None:
                self._handle.deleteTimer(before)
            self._handle.registerTimer(after)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # a timer fires once the watermark is behind it
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
        held = self._held()
        over = self._deadlines(held) < passed
        following = self._keep(held[~over])
        if following is not None:
            self._handle.registerTimer(following)
        silent = held[over & ~held["seen"]]
        if len(silent):
            yield pd.DataFrame({"run_id": silent["run"], "start": silent["start"], "last": silent["last"], "polls": silent["polls"]})

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """Timers need the RocksDB state store; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def run_silence_alarms(
    spark: SparkSession,
    polls: DataFrame,
    silence_minutes: int = READINESS_TIMEOUT_MINUTES,
    root: str | None = None,
    watermark: str = "1 hour",
    finish: bool = False,
) -> str:
    """Alarms of a stream of polls, to the end of the available input; returns
    the table's folder. A later call with the same ``root`` goes on where this
    one ended. ``finish`` as in ``streaming.readiness``."""
    importable(spark)
    silence = int(silence_minutes) * 60_000_000

    def alarms(rows: DataFrame) -> DataFrame:
        scored = availability(parse_csr_snapshots(rows))
        # Snapshots stay behind: a poll is its time and whether it saw the cluster available. The
        # time goes as a number, since pandas has no year 9000, and NULLs as flags, since its
        # numbers have none.
        run, at = F.col("run_id"), F.unix_micros("polled_at")
        seen = scored.select(
            F.pmod(F.xxhash64(run), F.lit(RUN_GROUPS)).alias("run_group"),
            F.coalesce(run, F.lit(0)).alias("run"),
            F.coalesce(at, F.lit(0)).alias("at"),
            (F.col("good") & F.col("available")).alias("seen"),
            run.isNotNull().alias("named"),
            at.isNotNull().alias("timed"),
        )
        return seen.groupBy("run_group").transformWithStateInPandas(
            SilenceProcessor(silence), "run_id long, start long, last long, polls long", "Append", "EventTime"
        )

    with _rocksdb(spark):
        return readiness._run(spark, polls, alarms, root or scratch_path(spark, f"streams/alarms-{uuid.uuid4().hex}"), watermark, finish)


def alarms_table(spark: SparkSession, table: str, silence_minutes: int = READINESS_TIMEOUT_MINUTES) -> DataFrame:
    """The alarms written so far, with the batch form's columns."""
    rows = spark.read.schema("run_id long, start long, last long, polls long").parquet(table).where(F.col("run_id").isNotNull())
    time = lambda micros: F.timestamp_micros(micros).cast("timestamp_ntz")
    end = F.col("last") + F.lit(int(silence_minutes) * 60_000_000)
    return rows.select("run_id", time("start").alias("started_at"), time("last").alias("last_poll"), "polls", time(end).alias("alarm_at"))
