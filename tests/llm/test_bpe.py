import hashlib
import random
import sys

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from fleetplan.llm import bpe as B
from tests.llm import fixtures as X

PATH = public_tokenizers.path(B.DEFAULT_VOCAB)
LIBRARY = Tokenizer.from_file(PATH)


def expected(texts):
    return [e.ids for e in LIBRARY.encode_batch(list(texts), add_special_tokens=False)]


def same(texts):
    got = [x.tolist() for x in B.codec(PATH).encode(texts)]
    want = expected(texts)
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []
    for ids in want[:200]:
        assert B.codec(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_code_point():
    points = [chr(i) for i in range(1, 0x30000) if not 0xD800 <= i < 0xE000]
    same([f"x{''.join(points[i : i + 7])}Y {points[i]}" for i in range(0, len(points), 7)])


def test_random_texts():
    rng = random.Random(1)
    letters = "abAB 'sté́\n<|endoftext|>ΣσİK0 9"
    same(["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)])
    same(["", " ", "\n\t", "<|endoftext|>", "a<|startoftext|><|endoftext|>b", "aaaaaaaaaaaaaaaaaaaaaaaaa", "<|ENDOFTEXT|>", "a" * 50_000, "ab" * 30_000])


def test_merges_within_a_word_go_one_by_one():
    """A merge that makes a pair of lower rank must be seen before the next."""
    same(["".join(p) * k for p in (("a", "b"), ("th", "e"), ("in", "g"), ("s", "s", "t")) for k in range(1, 40)])


def test_long_words():
    rng = random.Random(2)
    same(["".join(rng.choices(alphabet, k=200_000)) for alphabet in ("abcdefghijklmnopqrstuvwxyz", "aab", "th", "é")])


def test_merging_one_by_one_gives_the_same():
    """Vocabularies whose new symbols may make lower ranks merge one place of a
    word at a time; here that must make no difference."""
    careful = B.PairIndexBpe(PATH)
    careful._settled[:] = False
    rng = random.Random(3)
    texts = ["".join(rng.choices("aabtheing", k=rng.randint(1, 80))) for _ in range(300)]
    assert [x.tolist() for x in careful.encode(texts)] == expected(texts) == [x.tolist() for x in B.codec(PATH).encode(texts)]


def test_documents(spark):
    texts = ["Hello World", "", None, X.prose(4000), "Ünïcode straße ﬁ 12 <|endoftext|>"]
    got = {r.doc_id: r for r in B.digests(X.documents(spark, texts)).collect()}
    for i, ids in enumerate(expected([t or "" for t in texts])):
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert B.digests(X.empty(spark)).count() == 0
    docs = X.documents(spark, texts)
    rows = B.decode(B.encode(docs, into="ids"), into="back")
    assert rows.columns == [*docs.columns, "ids", "back"]
    assert {r.doc_id: (r.ids, r.back) for r in rows.collect()}[0] == (expected(["Hello World"])[0], "hello</w> world</w>")


def test_byte_symbols_cover_all_bytes():
    assert len(set(B.byte_symbols())) == 256 and sys.maxunicode == 0x10FFFF
