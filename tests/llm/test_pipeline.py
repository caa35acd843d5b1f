"""The pipeline against a plain version of its decisions, and every registered
query against DuckDB or its row count."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from fleetplan.llm import langid, quality
from fleetplan.llm.common import remainder
from tests.llm import fixtures as X
from tests.llm.test_neardup import brute as brute_groups
from tests.llm.test_packing import check, ids_of

TABLES = ("documents", "embeddings", "conversations", "labels")
NAMES = [q for q in E.queries() if q.startswith("op")]


def test_eleven_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 11)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(E.LLM_ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{X.SF}/{t}.parquet')")
    want = con.execute(E.LLM_ORACLE[name])
    columns = [d[0] for d in want.description]
    got = E.queries()[name](spark, X.SF)
    assert sorted(got.columns) == sorted(columns)
    digest = lambda rows: hashlib.sha256("\n".join(sorted(map(str, rows))).encode()).hexdigest()
    assert digest(tuple(r) for r in got.select(*columns).collect()) == digest(want.fetchall())


def test_stages_match_a_plain_version(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language_id", "quality_classifier", "near_dedup", "pii", "packing"]
    rows = {r.doc_id: r for r in docs.collect()}
    # Language and quality: the models scored document by document on the driver.
    model = langid.train(docs, F.coalesce(remainder(F.col("doc_id"), 4) != 2, F.lit(True)))
    p = {i: model.probabilities(r.text or "") for i, r in rows.items()}
    known = {i for i in rows if p[i] is not None and p[i].max() >= model.reject_below}
    one = P.language(spark, docs, X.SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == known
    machine = quality.train(one, spark.read.parquet(f"{X.SF}/labels.parquet"), remainder(F.col("doc_id"), 5) != 0)
    good = {i for i in known if machine.score(rows[i].text or "", rows[i].n_chars) >= 0.3}
    two = P.good(spark, one, X.SF)
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == good
    groups = brute_groups([(i, rows[i].text) for i in sorted(good)], 80)
    first = {i for i, _, c in groups if i == c}
    three = P.first_of_near_copies(spark, two, X.SF)
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == first
    four = P.pseudonyms(spark, three, X.SF)
    changed = {r.doc_id: r for r in four.collect()}
    assert four.columns == docs.columns and set(changed) == first and all(r.n_chars == len(r.text) for r in changed.values())
    five = P.sequences(spark, four, X.SF).collect()
    check(five)
    tokens = {}
    for r in five:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {i: len(ids_of(r.text)) for i, r in changed.items()}
    again = P.run(spark, X.SF)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in again.collect()) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in five)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, X.SF)
        assert docs.count() == 0
