from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from fleetplan.llm import quality as Q
from tests.llm import fixtures as X


def test_held_out_ranking(spark):
    docs, labels = (spark.read.parquet(f"{X.SF_LARGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert len(good) > 30 and len(bad) > 5
    assert (good[:, None] > bad[None]).mean() > 0.98 and (rows.predicted == rows.quality).mean() > 0.95
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()


def test_held_out_labels_and_metadata_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{X.SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = Q.scores(docs, labels).collect()
    two = Q.scores(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), other).collect()
    assert sorted(one) == sorted(two)


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    weights, factors, value = rng.normal(size=9), rng.normal(size=(9, 4)), rng.normal(size=9)
    pairs = sum(factors[i] @ factors[j] * value[i] * value[j] for i, j in combinations(range(9), 2))
    assert np.isclose(Q.raw_score(0.3, weights, factors, value)[0], 0.3 + weights @ value + pairs)


def test_awkward_texts(spark):
    docs = X.documents(spark, ["", None, "one", X.prose(30_000), "w" * 200_000, X.prose(300)])
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") != 5, F.col("n_chars")))
    labels = spark.createDataFrame([(5, 1, 0), (3, 0, 0), (3, 1, 0), (99, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = Q.scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in Q.scores(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.scores(X.empty(spark), labels).count() == 0


def test_filter_keeps_columns(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet").withColumn("quality", F.lit("q"))
    machine = Q.train(docs, spark.read.parquet(f"{X.SF}/labels.parquet"), F.lit(True))
    kept = Q.keep_good(docs, machine)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_training_reads_one_row_of_each_id(spark, monkeypatch):
    """However often a sampled id is repeated, one of its rows is read, the same each time."""
    rows = [(1, f"copy {i}", i) for i in range(300)] + [(2, "other", None), (2, "other", None), (3, None, None), (4, "not labelled", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 9)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(Q, "fit", lambda texts, lengths, good, settings: seen.append((texts, lengths, good)))
    for n in (1, 7):
        Q.train(docs.repartition(n), labels, F.lit(True))
    texts, lengths, good = seen[0]
    assert seen[0] == seen[1] and len(texts) == 3 and good == [1, 0, 1]
    assert (1, texts[0], lengths[0]) in rows and texts[1:] == ["other", ""]
