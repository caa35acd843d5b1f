"""P7 by a digest tree equals the plain comparison."""

import pytest
from pyspark.sql import functions as F

from fleetplan.operators import digests, runs

SCHEMA = "k long, name string, a int, b int, c string"
LEVELS = (2, 8, 64)


def state(spark):
    n = spark.range(400)
    return n.select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id") % 7).alias("name"), (F.col("id") % 5).cast("int").alias("a"),
                    F.when(F.col("id") % 3 > 0, F.col("id")).cast("int").alias("b"), F.lit("x").alias("c"))


def equal(desired, actual, **kw):
    want = runs.diff_state(desired, actual, ["k", "name"], ["a", "b", "c"], **kw)
    got = digests.diff_by_digest(desired, actual, ["k", "name"], ["a", "b", "c"], levels=LEVELS, **kw)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    return {r.action: r["count"] for r in got.groupBy("action").count().collect()}


@pytest.mark.parametrize("mode", ["full", "keys_only"])
def test_equals_plain_comparison(spark, mode):
    d = state(spark)
    r = F.col("k")
    a = d.where(r % 90 != 4).withColumn("b", F.when(r % 50 == 1, r + 1).otherwise(F.col("b")))  # b is a long here
    a = a.unionByName(d.where(r % 80 == 7).withColumn("name", F.lit("old")))
    kinds = equal(d, a, mode=mode)
    assert set(kinds) == ({"create", "update", "delete", "unchanged"} if mode == "full" else {"create", "forget", "unchanged"})


def test_values_that_swap_places_differ(spark):
    rows = lambda *r: spark.createDataFrame(r, SCHEMA)
    d = rows((1, "x", None, 3, "c"), (2, "x", 1, 2, "c"), (3, "x", 1, 1, None), (4, "x", 0, None, ""))
    a = rows((1, "x", 3, None, "c"), (2, "x", 2, 1, "c"), (3, "x", 1, 1, ""), (4, "x", None, 0, ""))
    assert equal(d, a) == {"update": 4} and equal(d, d) == {"unchanged": 4}


def test_null_keys_and_empty_states(spark):
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    d = rows((None, "x", 1, 1, "c"), (1, None, 1, 1, "c"), (1, "x", 1, 1, "c"))
    assert equal(d, d) == {"create": 2, "delete": 2, "unchanged": 1}
    assert equal(d, d, mode="keys_only") == {"create": 2, "forget": 2, "unchanged": 1}
    assert equal(rows(), d) == {"delete": 3} and equal(d, rows()) == {"create": 3} and equal(rows(), rows()) == {}


def test_rows_below_equal_leaves_are_not_joined(spark):
    d = state(spark)
    a = d.withColumn("a", F.when(F.col("k") == 17, 9).otherwise(F.col("a")))
    n = digests.node_digests(d, ["k", "name"], ["a", "b", "c"], 64, 64)
    m = digests.node_digests(a, ["k", "name"], ["a", "b", "c"], 64, 64)
    assert n.exceptAll(m).count() == 1 and n.agg(F.sum("n")).first()[0] == 400
    coarse = digests.node_digests(d, ["k", "name"], ["a", "b", "c"], 8, 64)
    sums = n.groupBy(F.floor(F.col("node") / 8).alias("node")).agg(*[F.sum(c).alias(c) for c in ("n", "low", "high")])
    assert coarse.exceptAll(sums).count() == 0  # digests add up


def test_nested_columns_and_uneven_levels_are_refused(spark):
    d = spark.createDataFrame([(1, [1])], "k long, v array<int>")
    with pytest.raises(TypeError, match="v"):
        digests.diff_by_digest(d, d, ["k"], ["v"])
    with pytest.raises(ValueError, match="multiple"):
        digests.diff_by_digest(d, d, ["k"], levels=(3, 8))
