"""Streams that keep what Spark's own operators drop: silence alarms, late
polls, roots whose input goes on or has ended."""

import datetime as dt
import os
import random
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetplan.operators import readiness
from fleetplan.plans import views
from fleetplan.streaming import alarms, late
from fleetplan.streaming import readiness as stream
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
GOOD, BROKEN = '{"items":[]}', '{"items":['
AV = '{"status":{"conditions":[{"type":"Available","status":"True"}]}}'
NOT = '{"status":{}}'
POLL = "run_id long, poll_id long, polled_at timestamp_ntz, csr_json string, version_json string"


def _folder(name):
    return tempfile.mkdtemp(prefix=f"fleetplan-{name}-")


def _polls(spark, rows):
    """(run, minute, available) as polls."""
    made = [(run, i, T0 + dt.timedelta(minutes=m), GOOD, AV if up else NOT) for i, (run, m, up) in enumerate(rows)]
    return spark.createDataFrame(made, POLL)


def _stream(spark, path):
    polls = spark.readStream.schema(POLL).parquet(path)
    return polls.withColumn("polled_at", F.col("polled_at").cast("timestamp"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merged_episodes():
    assert alarms.merged([(11, 12, 2, False), (0, 5, 3, True)], 5) == [(0, 5, 3, True), (11, 12, 2, False)]
    assert alarms.merged([(11, 12, 2, False), (0, 5, 3, True), (9, 9, 1, False)], 5) == [(0, 12, 6, True)]
    assert alarms.merged([], 5) == []


RULES = [
    (1, 0, False), (1, 20, False),  # falls silent: one alarm at 20 + 45
    (2, 0, False), (2, 44, False), (2, 80, True),  # polls again, then available: none
    (3, 0, False), (3, 45, False), (3, 91, False),  # at the deadline is in time, a minute later is not: two alarms
    (4, 0, True),  # available at once: none
    (5, 0, True), (5, 100, False),  # a second episode has its own
]


def test_alarm_rules(spark):
    path = _folder("rules")
    _polls(spark, RULES).write.mode("append").parquet(path)
    minute = lambda m: T0 + dt.timedelta(minutes=m)
    want = sorted([(1, minute(0), minute(20), 2, minute(65)), (3, minute(0), minute(45), 2, minute(90)), (3, minute(91), minute(91), 1, minute(136)),
                   (5, minute(100), minute(100), 1, minute(145))])
    assert _rows(readiness.silence_alarms(_polls(spark, RULES), 45)) == want
    table = alarms.run_silence_alarms(spark, _stream(spark, path), 45, finish=True)
    assert _rows(alarms.alarms_table(spark, table, 45)) == want


def test_broken_snapshots_are_polls_but_never_available(spark):
    rows = [(1, 1, T0, BROKEN, AV), (1, 2, T0 + dt.timedelta(minutes=1), None, None)]
    (row,) = readiness.silence_alarms(spark.createDataFrame(rows, POLL), 45).collect()
    assert (row.polls, row.alarm_at) == (2, T0 + dt.timedelta(minutes=46))


def test_alarms_over_several_calls(spark):
    """Open episodes wait in the state; an alarm is written once the watermark
    passes its deadline, and only then."""
    path, root = _folder("calls"), _folder("root")
    out = lambda: {(r.run_id, r.polls) for r in alarms.alarms_table(spark, table, 45).collect()}
    _polls(spark, [(1, 0, False), (2, 0, False)]).write.mode("append").parquet(path)
    table = alarms.run_silence_alarms(spark, _stream(spark, path), 45, root, "10 minutes")
    assert out() == set()
    _polls(spark, [(2, 40, False), (3, 40, False)]).write.mode("append").parquet(path)
    alarms.run_silence_alarms(spark, _stream(spark, path), 45, root, "10 minutes")
    assert out() == set()
    _polls(spark, [(3, 70, False)]).write.mode("append").parquet(path)
    alarms.run_silence_alarms(spark, _stream(spark, path), 45, root, "10 minutes")
    assert out() == {(1, 1)}
    alarms.run_silence_alarms(spark, _stream(spark, path), 45, root, "10 minutes", finish=True)
    assert out() == {(1, 1), (2, 2), (3, 2)}


def test_episodes_of_many_runs_at_once():
    rng = random.Random(4)
    made = []
    for _ in range(2000):
        start = rng.randrange(5000)
        made.append((rng.choice([-3, 0, 8, 2**62]), start, start + rng.choice([0, 0, 0, 90]), rng.randrange(1, 4), rng.random() < 0.1))
    want = []
    for run, start, last, polls, seen in sorted(made):
        if want and want[-1][0] == run and start - want[-1][2] <= 10:
            _, first, before, n, had = want.pop()
            want.append((run, first, max(before, last), n + polls, had or seen))
        else:
            want.append((run, start, last, polls, seen))
    assert alarms.joined(np.array(made, alarms.OPEN), 10).tolist() == want
    assert len(want) > 50


class _Group:
    """The state, timers and watermark of one group, as its processor sees them."""

    def __init__(self):
        self.value, self.timers, self.now, self.calls = None, set(), 0, 0
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def getCurrentWatermarkInMs(self):
        return self.now

    def fire(self, processor, watermark):
        """Alarms that come with a watermark; Spark fires the timers before it."""
        self.now, out = watermark, []
        for at in sorted(t for t in self.timers if t < watermark):
            info = type("Info", (), {"getExpiryTimeInMs": lambda _, at=at: at})()
            out += [r for rows in processor.handleExpiredTimer((0,), self, info) for r in rows.itertuples(index=False, name=None)]
            self.timers.discard(at)
        return out


def test_a_group_of_runs_costs_one_timer_and_one_state():
    """Runs with many episodes: one read of the state for their polls, one for all
    alarms of a watermark."""
    ms, runs = 1000, 300
    polls = [(run, (run + 100_000 * k) * ms, False, True, True) for k in range(1, 6) for run in range(runs)]
    chunks = [pd.DataFrame(polls[i : i + 400], columns=["run", "at", "seen", "named", "timed"]) for i in range(0, len(polls), 400)]
    group, processor = _Group(), alarms.SilenceProcessor(50_000 * ms)
    processor.init(group)
    assert list(processor.handleInputRows((0,), iter(chunks), group)) == []
    assert (group.calls, group.timers) == (1, {150_000})
    # at a deadline the episode is still open, behind it closed: all of k = 1, and of k = 2 the runs before 7
    found = group.fire(processor, 250_007)
    assert sorted(found) == sorted((run, at, at, 1) for run, at, *_ in polls if at < 200_007 * ms)
    assert (group.calls, group.timers) == (2, {250_007})
    # late polls stay out, others go on; a run that is seen available raises none
    more = [(0, 250_007 * ms, False, True, True), (20, 250_020 * ms, False, True, True), (0, 320_000 * ms, True, True, True)]
    list(processor.handleInputRows((0,), iter([pd.DataFrame(more, columns=chunks[0].columns)]), group))
    rest = group.fire(processor, 10**9)
    want = {(run, at): (at, 1) for run, at, *_ in polls if at >= 200_007 * ms}
    want.pop((0, 300_000 * ms))
    want.pop((20, 300_020 * ms))
    want[(20, 200_020 * ms)] = (300_020 * ms, 3)  # pauses of just the allowed silence
    assert sorted(rest) == sorted((*k, *v) for k, v in want.items())
    assert group.value is None and group.timers == set()


def test_runs_of_one_group_are_told_apart(spark, monkeypatch):
    """Also runs without a number, polls without a time (counted in the last
    episode of their run) and numbers that a float can't hold."""
    monkeypatch.setattr(alarms, "RUN_GROUPS", 1)
    monkeypatch.setattr(alarms, "POLLS_TO_JOIN", 3)
    path, big = _folder("group"), 2**53
    minute = lambda m: None if m is None else T0 + dt.timedelta(minutes=m)
    polls = [(big, 0, False), (big + 1, 10, False), (big, 30, False), (big + 1, 100, False), (None, 5, False), (0, 7, True), (0, 200, False),
             (big + 1, None, False), (0, None, True), (4, None, False), (None, None, False)]
    made = [(run, i, minute(m), GOOD, AV if up else NOT) for i, (run, m, up) in enumerate(polls)]
    spark.createDataFrame(made, POLL).write.mode("append").parquet(path)
    table = alarms.run_silence_alarms(spark, _stream(spark, path), 45, finish=True)
    want = [(big, minute(0), minute(30), 2, minute(75)), (big + 1, minute(10), minute(10), 1, minute(55)), (big + 1, minute(100), minute(100), 2, minute(145))]
    assert _rows(alarms.alarms_table(spark, table, 45)) == want


def test_alarm_stream_equals_batch(spark):
    table = alarms.run_silence_alarms(spark, stream.poll_stream(spark, SF_SMALL), 720, finish=True)
    want = readiness.silence_alarms(views.polls(spark, SF_SMALL), 720)
    assert _rows(alarms.alarms_table(spark, table, 720)) == _rows(want) != []


def test_a_root_goes_on_until_it_is_finished(spark):
    """Half of the events, then the rest on the same root: nothing is lost."""
    path, root = _folder("halves"), _folder("root")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    half = events.orderBy("ts").limit(events.count() // 2).cache()
    polls = lambda: stream.poll_stream(spark, path, "*.parquet")
    half.coalesce(1).write.mode("append").parquet(path)
    stream.run_poll_buckets(spark, polls(), root)
    events.exceptAll(half).coalesce(1).write.mode("append").parquet(path)
    out = stream.run_poll_buckets(spark, polls(), root, finish=True)
    assert _rows(stream.poll_buckets_table(spark, out)) == _rows(readiness.poll_buckets(views.polls(spark, SF_SMALL)))
    for finish in (False, True):
        with pytest.raises(ValueError, match="ended"):
            stream.run_poll_buckets(spark, polls(), root, finish=finish)
    half.unpersist()


def test_a_begun_finish_can_only_be_finished(spark):
    path, root = _folder("begun"), _folder("root")
    _polls(spark, RULES).write.mode("append").parquet(path)
    stream.run_poll_buckets(spark, _stream(spark, path), root)
    open(os.path.join(root, "finish-begun"), "w").close()
    with pytest.raises(ValueError, match="ended"):
        stream.run_poll_buckets(spark, _stream(spark, path), root)
    out = stream.run_poll_buckets(spark, _stream(spark, path), root, finish=True)
    assert sum(r.polls for r in stream.poll_buckets_table(spark, out).collect()) == len(RULES)


def test_late_and_in_time_polls_are_all_polls(spark):
    path, root = _folder("late"), _folder("root")
    minutes = [[0, 30, 200], [199, 139, 140, 141, 500], [None, 440, 441, 20], [500]]
    routed, n = [], 0
    for arrival in minutes:
        made = [(1, n + i, None if m is None else T0 + dt.timedelta(minutes=m), GOOD, NOT) for i, m in enumerate(arrival)]
        n += len(made)
        spark.createDataFrame(made, POLL).coalesce(1).write.mode("append").parquet(path)
        polls = _stream(spark, path)
        late.route_late(spark, polls, 3600, root)
        routed = {r.poll_id: (r.batch, r.late) for r in late.routed(spark, root, polls).collect()}
    # watermarks: none, 200 - 60, 500 - 60, 500 - 60; at the watermark is late
    assert routed == {0: (0, False), 1: (0, False), 2: (0, False), 3: (1, False), 4: (1, True), 5: (1, True), 6: (1, False), 7: (1, False),
                      8: (2, False), 9: (2, True), 10: (2, False), 11: (2, True), 12: (3, False)}
    rows = late.routed(spark, root, polls).select("run_id", "poll_id", "polled_at", "csr_json", "version_json")
    sent = spark.read.schema(POLL).parquet(path).withColumn("polled_at", F.col("polled_at").cast("timestamp"))
    assert rows.exceptAll(sent).count() == 0 and sent.exceptAll(rows).count() == 0


def test_stateful_streams_lose_no_poll_in_time(spark):
    path, root, out_root = _folder("two"), _folder("root"), _folder("out")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    slot = F.expr("dayofmonth(ts) div 8") + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    for arrival in range(5):
        events.where(slot == arrival).coalesce(2).write.mode("append").parquet(path)
        polls = stream.poll_stream(spark, path, "*.parquet")
        late.route_late(spark, polls, 3600, root)
        stream.run_poll_buckets(spark, late.in_time(spark, root, polls), out_root, watermark="3600 seconds")
    out = stream.run_poll_buckets(spark, late.in_time(spark, root, polls), out_root, watermark="3600 seconds", finish=True)
    routed = late.routed(spark, root, polls)
    assert routed.count() == events.count() and 0 < routed.where("late").count() < events.count()
    counted = stream.poll_buckets_table(spark, out).agg(F.sum("polls")).first()[0]
    assert counted == routed.where("NOT late").count()


def test_nothing_routed_yet(spark):
    path = _folder("none")
    spark.createDataFrame([], POLL).write.mode("append").parquet(path)
    polls = _stream(spark, path)
    assert late.routed(spark, _folder("root"), polls).count() == 0
