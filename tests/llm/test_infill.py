import hashlib
import random

import duckdb

from fleetplan.llm import infill as I
from fleetplan.llm.oracle import OP12
from tests.llm import fixtures as X


def plain(doc_id, text):
    """The contract by slices and concatenation."""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_cutting_splits_descriptors():
    table = I.PieceTable.of("abcdef").cut([0, 2, 2, 6])
    assert [p.length for p in table.pieces] == [0, 2, 0, 4, 0]
    assert table.rendered() == "abcdef"
    again = table.cut([1, 3])
    assert again.rendered() == "abcdef" and [p.length for p in again.pieces if p.length] == [1, 1, 1, 3]


def test_way_there_and_back():
    rng = random.Random(3)
    seen = set()
    for doc_id in range(3000):
        text = "".join(rng.choices("ab<PSM>é\U0001f600\n", k=rng.randint(0, 40)))
        form, parts, table = I.transformed(text, doc_id)
        want = plain(doc_id, text)
        sizes = (None, None) if form == I.PLAIN else (parts.pieces[0].length, parts.pieces[1].length)
        assert (form, *sizes, table.rendered()) == want
        assert table.sha256() == hashed(want[3])
        assert I.restored(want[3], form).rendered() == text
        assert I.restored(want[3], form).sha256() == hashed(text)
        seen.add(form)
    assert seen == {"plain", "psm", "spm"}


def test_sentinels_made_by_the_cut():
    """Half sentinels at the edges of parts never read as one."""
    for text in ("<P", "P>", "<", "<<P", "S><", "<P>"):
        for doc_id in range(200):
            form, _, table = I.transformed(text, doc_id)
            assert I.restored(table.rendered(), form).rendered() == text


def test_very_long_text_is_hashed_in_slices():
    text = "é" * (2 * I.SLICE + 7)
    form, _, table = I.transformed(text, 4)
    assert table.sha256() == hashed(plain(4, text)[3])
    assert max(len(s) for s in table.slices()) <= I.SLICE


def test_documents(spark):
    texts = ["Hello World", "", None, X.prose(400), "has <S> inside", "x", " \n", "straße \U0001f600"]
    docs = X.documents(spark, texts)
    got = I.digests(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        text = "" if r.doc_id is None else texts[r.doc_id] or ""
        form, p, m, output = plain(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (len(text), form, p, m)
        assert (r.output_sha256, r.restored_sha256) == (hashed(output), hashed(text))
    assert I.digests(X.empty(spark)).count() == 0


def test_columns_and_restore(spark):
    texts = ["Hello World", "", None, "a <M> b"]
    docs = X.documents(spark, texts)
    rows = I.transform(docs)
    assert rows.columns == [*docs.columns, "infill"]
    back = I.restore(rows.selectExpr("doc_id", "infill.output AS out", "infill.form AS form"), "out", "form", "back")
    for r in back.collect():
        assert r.back == ("" if r.doc_id is None else texts[r.doc_id] or "")
    one = {r.doc_id: r.infill for r in rows.collect()}[0]
    if one.form != "plain":
        assert [p.buffer for p in one.pieces] == [1, 0] * 3
        assert sum(p.length for p in one.pieces) == len(one.output)
    assert I.restore(spark.sql("SELECT cast(null AS string) AS o, 'psm' AS f"), "o", "f").first().text is None


def test_sql(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet")
    got = {tuple(r) for r in I.digests(docs).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{X.SF}/documents.parquet'")
    assert got == set(con.sql(OP12).fetchall())
