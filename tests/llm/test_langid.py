import math

import numpy as np
from pyspark.sql import functions as F

from fleetplan.llm import langid as L
from tests.llm import fixtures as X


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{X.SF_LARGER}/documents.parquet")
    out = L.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(out) > 150 and (out["lang"] == out["lang_pred"]).mean() > 0.98
    assert not out["rejected"].any() and out["score"].between(0, 1).all()


def test_only_text_of_learning_rows_matters(spark):
    """Changing labels of held-out rows, sources and ids changes no prediction."""
    docs = spark.read.parquet(f"{X.SF}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    one = {r.doc_id: r for r in L.predictions(docs).collect()}
    two = {r.doc_id: r for r in L.predictions(docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))).collect()}
    assert one == two


def test_undefined_texts(spark):
    learn = spark.read.parquet(f"{X.SF}/documents.parquet").select("doc_id", "text", "lang")
    texts = ["", None, "12 34 !!", "\n", "the and of in the on at", "пример текста на другом языке", "a" * 300_000]
    odd = X.documents(spark, texts).select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    docs = learn.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 1_000_000))
    got = {r.doc_id: r for r in L.predictions(docs).where("doc_id >= 1000000 OR doc_id IS NULL").collect()}
    assert [got[1_000_000 + i].lang_pred for i in range(4)] == ["und"] * 4
    assert got[1_000_004].lang_pred == "en" and got[1_000_000].score == 0
    assert got[1_000_005].rejected and got[None].lang_pred == "und"


def test_nothing_to_learn(spark):
    docs = X.documents(spark, ["some text", None])
    assert {r.lang_pred for r in L.predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert L.predictions(X.empty(spark)).count() == 0


def test_filter_keeps_columns(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet").withColumn("language", F.lit(1)).withColumn("_LANGUAGE", F.lit(2))
    model = L.train(docs.select("doc_id", "text", "lang"), F.lit(True))
    kept = L.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_ngrams_do_not_span_words():
    grams = lambda t: L.ngrams(t, (2, 3), 1 << 20)
    assert sorted(grams("ab, cd")) == sorted(np.concatenate([grams("ab"), grams("cd")]))
    assert L.ngrams("", (2,), 16) is None and L.ngrams("1 2", (2,), 16) is None


def test_the_sample_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet")
    few = L.Settings(sample_rows=60)
    one = L.sample(docs.repartition(7), F.lit(True), few)
    two = L.sample(docs.coalesce(1), F.lit(True), few)
    assert len(one) == 60 and one.equals(two)


def test_a_repeated_id_is_sampled_once(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet").select("doc_id", "text", "lang")
    few = L.Settings(sample_rows=60)
    copies = spark.range(2000).select(F.lit(10_000_019).alias("doc_id"), F.concat(F.lit("copy "), "id").alias("text"), F.lit("en").alias("lang"))
    nameless = copies.withColumn("doc_id", F.lit(None).cast("long"))
    got = L.sample(docs.unionByName(copies).unionByName(nameless), F.lit(True), few)
    assert len(got) == 60 and got["text"].str.startswith("copy ").sum() <= 2


def plain_buckets(text, sizes, buckets):
    """The letter n-grams of a text and the bucket of each, one by one."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    marked = [0, *(code for word in words for code in [*map(ord, word), 0])]
    out = []
    for n in sizes:
        for i in range(len(marked) - n + 1):
            gram = marked[i : i + n]
            if 0 in gram[1:-1]:
                continue
            value = n
            for code in gram:
                value = (value * 0x9E3779B97F4A7C15 + code) % 2**64
            value = (value ^ (value >> 29)) * 0xBF58476D1CE4E5B9 % 2**64
            out.append((value >> 40) % buckets)
    return out


def test_predictions_match_plain_means_over_n_grams(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(docs, F.lit(True))
    odd = X.documents(spark, ["the and of a", " le chat, et la 12 souris!", "x", "Das ist gut", "ÀÉÎ ß", "a  b\nc"]).select("doc_id", "text", "lang")
    few = docs.orderBy("doc_id").limit(40).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 10_000_000))
    for row in L.predict(few.where("text IS NOT NULL"), model).collect():
        found = plain_buckets(row.text, model.sizes, len(model.scores))
        total = [math.exp(sum(float(model.scores[b][k]) for b in found) / len(found)) for k in range(len(model.labels))]
        best = max(range(len(total)), key=total.__getitem__)
        assert row.language.lang_pred == model.labels[best]
        assert abs(row.language.score - total[best] / sum(total)) < 1e-6
