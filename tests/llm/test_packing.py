import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetplan.llm import packing as K
from tests.llm import fixtures as X

LIBRARY = Tokenizer.from_file(public_tokenizers.path(K.VOCAB))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, K.END_ID]


def check(rows, capacity=1024):
    """Gapless sequences within the capacity."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        ends = np.cumsum([n for _, n in spans])
        assert [o for o, _ in spans] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(by)


TEXTS = ["short", "", None, X.prose(700), X.prose(5000), "a<|endoftext|>b", " " * 70_000 + "x", "é" * 3000, X.prose(900, 5), "x" * 40_000]


def test_pieces_are_those_of_the_library(spark):
    docs = X.documents(spark, TEXTS)
    rows = K.packed_documents(docs).collect()
    check(rows)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for d in docs.collect():
        ids = np.array(ids_of(d.text), "<u4")
        start = 0
        sizes = [len(ids) % 1024 or 1024, *[1024] * ((len(ids) - 1) // 1024)] if len(ids) > 1024 else [len(ids)]
        for i, n in enumerate(sizes):
            want.append((d.doc_id is None, d.doc_id or 0, i, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            start += n
        assert start == len(ids)
    assert got == sorted(want)


def test_sequences_hold_the_ids(spark):
    docs = X.documents(spark, TEXTS)
    texts = {d.doc_id: ids_of(d.text) for d in docs.collect()}
    back = {}
    for r in K.sequences(docs).collect():
        assert len(r.ids) <= 1024
        ends = [*[h.offset for h in r.held[1:]], len(r.ids)]
        for h, end in zip(r.held, ends, strict=True):
            back.setdefault((h.doc_id, h.piece), r.ids[h.offset : end])
    for doc, ids in texts.items():
        parts = [back[d, p] for d, p in sorted((k for k in back if k[0] == doc), key=lambda k: k[1])]
        assert [t for p in parts for t in p] == ids


def test_exchange_saves_sequences(spark):
    """Small deals leave gaps; the exchange brings the count near the bound."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(200, 600, 1500).tolist()
    parts = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    alone = check(K.pack(parts, K.Settings(deal=60, rounds=1)).collect())
    rows = K.pack(parts, K.Settings(deal=60)).collect()
    exchanged = check(rows)
    assert sorted(r.length for r in rows) == sorted(lengths) and len({r.doc_id for r in rows}) == 1500
    assert K.lower_bound(lengths, 1024) <= exchanged <= alone
    whole = int(K.best_fit(np.sort(lengths)[::-1], 1024).max()) + 1
    assert exchanged - whole <= 0.02 * whole


def optimum(lengths, capacity):
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for k in range(len(rest) + 1):
        for chosen in combinations(range(len(rest)), k):
            if first + sum(rest[i] for i in chosen) <= capacity:
                best = min(best, 1 + optimum([x for i, x in enumerate(rest) if i not in chosen], capacity))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=7))
def test_bound_is_below_the_optimum(lengths):
    bound, best = K.lower_bound(lengths, 20), optimum(sorted(lengths, reverse=True), 20)
    assert bound <= best
    used = K.best_fit(np.array(sorted(lengths, reverse=True), np.int64), 20)
    assert len(set(used.tolist())) >= best
    assert not lengths or np.bincount(used, weights=sorted(lengths, reverse=True)).max() <= 20


def test_dual_feasible_functions_beat_the_sum():
    assert K.lower_bound([600] * 10, 1024) == 10 and K.lower_bound([350] * 10, 1024) == 5


def test_empty_and_equal_rows(spark):
    assert K.packed_documents(X.empty(spark)).count() == 0
    parts = spark.createDataFrame([(1, 0, 0, 512, 7)] * 8, "doc_id long, piece int, start long, length long, ids_crc32 long")
    assert check(K.pack(parts).collect()) == 4


def test_exchange_goes_on_while_it_gains(spark):
    rng = np.random.default_rng(4)
    lengths = rng.integers(200, 600, 1500).tolist()
    parts = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4)
    limited = check(K.pack(parts, K.Settings(deal=60, rounds=4)).collect())
    rows = K.pack(parts, K.Settings(deal=60)).collect()
    assert check(rows) < limited, (check(rows), limited)
    assert sorted(r.length for r in rows) == sorted(lengths) and len({r.doc_id for r in rows}) == 1500
