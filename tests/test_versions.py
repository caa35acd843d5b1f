"""Cluster tables with versions: writers at the same time, failing writers,
readers of an earlier version."""

import os

import pytest
from pyspark.sql import functions as F

from fleetplan.sources import clusters as C

SCHEMA = "cluster_name string, value long"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(spark, path):
    return sorted((r.cluster_name, r.value) for r in C.read_clusters(spark, path).collect())


@pytest.mark.parametrize("buckets", [1, 64])
def test_interleaved_writers_both_survive(spark, tmp_path, monkeypatch, buckets):
    path = str(tmp_path / "t")
    C.write_clusters(table(spark, [(f"c{i}", i) for i in range(20)]), path, buckets)
    publish, others = C._publish, [lambda: C.remove_clusters(spark, table(spark, [("c5", 0)]), path), lambda: C.replace_clusters(spark, table(spark, [("c4", 400)]), path)]

    def between(*args):
        if others:
            others.pop()()  # another writer is done just before this one publishes
        return publish(*args)

    monkeypatch.setattr(C, "_publish", between)
    C.replace_clusters(spark, table(spark, [("c3", 300), ("new", 1)]), path)
    want = {f"c{i}": i for i in range(20) if i != 5} | {"c3": 300, "c4": 400, "new": 1}
    assert not others and rows(spark, path) == sorted(want.items())


def test_a_failed_writer_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    C.write_clusters(table(spark, [("a", 1), ("b", 2)]), path, 4)
    bad = table(spark, [("a", 5)]).withColumn("value", F.when(F.col("value") == 5, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        C.replace_clusters(spark, bad, path)
    assert rows(spark, path) == [("a", 1), ("b", 2)]


def test_readers_keep_their_version_until_it_is_forgotten(spark, tmp_path):
    path = str(tmp_path / "t")
    C.replace_clusters(spark, table(spark, [("a", 1), ("b", 2)]), path, 4)  # makes the table
    before = C.read_clusters(spark, path)
    C.replace_clusters(spark, table(spark, [("a", 7), ("a", 8)]), path)
    C.remove_clusters(spark, table(spark, [("b", 0), ("nobody", 0)]), path)
    assert sorted(tuple(r) for r in before.collect()) == [("a", 1), ("b", 2)]
    assert rows(spark, path) == [("a", 7), ("a", 8)]
    C.forget_versions(spark, path, keep=1)
    assert rows(spark, path) == [("a", 7), ("a", 8)]
    assert sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names) == 1  # of three versions' rows
    C.remove_clusters(spark, table(spark, [("a", 0)]), path)
    assert rows(spark, path) == [] and C.read_clusters(spark, path).columns == ["cluster_name", "value"]
    C.remove_clusters(spark, table(spark, []), path)
    C.write_clusters(table(spark, [("z", 1)]), path, 2)
    assert rows(spark, path) == [("z", 1)]


def test_a_late_writer_does_not_take_a_forgotten_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    C.write_clusters(table(spark, [("a", 1), ("b", 2)]), path, 1)
    publish, others = C._publish, ["c", "d", "e"]

    def between(*args):
        while others:
            C.replace_clusters(spark, table(spark, [(others.pop(), 9)]), path)
            C.forget_versions(spark, path, keep=1)
        return publish(*args)

    monkeypatch.setattr(C, "_publish", between)
    C.replace_clusters(spark, table(spark, [("b", 3)]), path)
    assert rows(spark, path) == [("a", 1), ("b", 3), ("c", 9), ("d", 9), ("e", 9)]


def test_no_table(spark, tmp_path):
    C.remove_clusters(spark, table(spark, [("a", 0)]), str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no cluster table"):
        C.read_clusters(spark, str(tmp_path / "none"))
