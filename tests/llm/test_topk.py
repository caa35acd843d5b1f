import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetplan.llm import topk as T


def brute(rows, is_query, k):
    out = []
    usable = lambda i, v: i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if usable(i, v)]
    for at, (q, v) in enumerate(whole):
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), i) for n, (i, x) in enumerate(whole) if n != at and len(x) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, every=5, k=5, **sizes):
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, rank string").repartition(3)
    out = T.top_k(T.usable(table), F.col("vec_id") % every == 0, k, **sizes)
    rows = [tuple(r) for r in out.collect()]
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(rows)


def test_rows_that_repeat_an_id_ask_and_answer(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [0.5, 0.5]), (50, [1.0, 0.0]), (3, [0.5, 0.5])]
    got = search(spark, rows)
    assert got == brute(rows, lambda q: q % 5 == 0, 5)
    assert len(got) == 12 and (50, 1, 50, 65536) in got


def test_blocks_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 9)]) for i in rng.permutation(300)]
    want = brute(rows, lambda q: q % 5 == 0, 5)
    assert search(spark, rows, block=37, query_block=11) == want
    assert search(spark, rows) == want


def test_ties_copies_and_unusable_vectors(spark):
    same = [0.5, -0.25, 0.0]
    rows = [(i, same) for i in range(0, 400)]
    rows += [(1000, [0.5, None, 0.0]), (1005, [math.nan, 0.0, 1.0]), (1010, [math.inf, 0.0, 1.0]), (1015, None), (1020, []), (None, same), (1025, [1.0, 2.0])]
    rows += [(1030, [-1.0, -1.0]), (7, [3.0, 3.0, 3.0]), (10, [-9.0, 0.0, 0.0])]
    assert search(spark, rows, block=64, query_block=16) == brute(rows, lambda q: q % 5 == 0, 5)


def test_fewer_rows_than_k_and_none(spark):
    assert search(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert search(spark, [(0, [1.0])]) == [] == search(spark, [])


def test_components_of_any_finite_size(spark):
    rng = np.random.default_rng(9)
    far = lambda: [float(np.float32(rng.normal() * 10.0 ** rng.integers(-3, 38))) for _ in range(4)]
    rows = [(i, far()) for i in range(60)] + [(100 + i, [float(np.float32(x)) for x in rng.normal(0, 1e5, 4)]) for i in range(30)]
    rows += [(200, [65536.0, 0.0, 0.0, 0.0]), (205, [3.4028234663852886e38] * 4), (206, [-3.4028234663852886e38] * 4), (207, [3.4028234663852886e38] * 4), (210, [0.0] * 4)]
    rows += [(300, [70000.0, -1.0]), (301, [65537.0, 2.5]), (305, [-1.0, 1e6])]  # of another length: they meet each other only
    fits = lambda s: s if -(1 << 63) <= s < 1 << 63 else None
    want = [(q, r, i, fits(s)) for q, r, i, s in brute(rows, lambda q: q % 5 == 0, 5)]
    order = lambda t: t[:3]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for sizes in ({}, {"block": 16, "query_block": 7}):
        got = [tuple(r) for r in T.top_k(T.usable(table), F.col("vec_id") % 5 == 0, 5, **sizes).collect()]
        assert sorted(got, key=order) == sorted(want, key=order)
    assert None in {t[3] for t in want} and any(t[3] for t in want)


def test_long_vectors(spark):
    rows = [(0, [1.0] * 20000), (1, [0.5] * 20000), (2, [-1.0] * 20000)]
    assert search(spark, rows) == brute(rows, lambda q: q % 5 == 0, 5)


@pytest.mark.parametrize("reach", [1, 3, 300, 1 << 20])
def test_slices_add_up(reach):
    rng = np.random.default_rng(reach)
    for _ in range(20):
        vectors = rng.integers(-reach, reach + 1, (int(rng.integers(1, 200)), int(rng.integers(1, 8))))
        index, ids = T.BitSlices.build(vectors), np.arange(len(vectors))
        query = rng.integers(-reach, reach + 1, vectors.shape[1])
        rows, value = index.top(query, 4, ids)
        scores = vectors @ query
        best = sorted(ids, key=lambda i: (-scores[i], i))[:4]
        assert rows.tolist() == best and value.tolist() == scores[best].tolist()


def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert sorted(tuple(r) for r in T.nearest(table).collect()) == brute(rows, lambda q: q % 50 == 0, 5)
