import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from fleetplan.llm import sentencepieces as S
from tests.llm import fixtures as X

PATH = public_tokenizers.path(S.DEFAULT_MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(texts):
    agenda = S.codec(PATH)
    got = [agenda.encode(t).tolist() for t in texts]
    want = LIBRARY.encode(list(texts), add_eos=True)
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []
    assert [t for t, ids in zip(texts, want, strict=True) if agenda.decode(ids) != LIBRARY.decode(ids)] == []


def test_every_code_point():
    points = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    same([f"x{''.join(points[i : i + 7])} {points[i]}Y" for i in range(0, len(points), 7)])


def test_random_texts():
    rng = random.Random(1)
    letters = "abthe in  \n\t▁s<>/éß梦\U0001f600\x000"
    same(["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(5000)])
    same(["", " ", "  ", "▁", "\n", "<s></s><unk><0x41>", "a" * 50_000, "ab" * 100_000, " " * 50_000, "the " * 20_000])


def test_both_agendas_merge_alike():
    rng = random.Random(5)
    agenda = S.codec(PATH)
    for _ in range(3000):
        word = "".join(rng.choices("abthein▁▁▁ro", k=rng.randint(1, 40)))
        assert agenda._merged_short(word) == agenda._merged_long(word), word


def test_words_merged_together_are_those_merged_alone(monkeypatch):
    monkeypatch.setattr(S, "FEW", 1)
    monkeypatch.setattr(S, "ROWS", 64)
    rng = random.Random(6)
    agenda = S.Agenda(PATH)
    words = list({"".join(rng.choices("abthein\n▁é😀\x00ro", k=rng.randint(1, 70))) for _ in range(4000)})
    words += [S.BARE + w for w in words] + ["the", "▁", "▁▁", "x" * 63, "x" * 64]
    agenda.learn([words])
    assert sorted(agenda._known) == sorted(w for w in set(words) if len(w) < S.WORD)
    assert [w for w, ids in agenda._known.items() if ids != agenda.word_ids(agenda._whole(w))] == []


def test_texts_encoded_together_are_those_encoded_alone(monkeypatch):
    rng = random.Random(7)
    texts = ["", *("".join(rng.choices("abthe in  \n▁é", k=rng.randint(0, 90))) for _ in range(3000)), "", "the " * 5000]
    want = LIBRARY.encode(texts, add_eos=True)
    assert [ids.tolist() for ids in S.Agenda(PATH).encode_each(texts)] == want
    monkeypatch.setattr(S, "SLICE", 50)
    monkeypatch.setattr(S, "FEW", 2)
    assert [ids.tolist() for ids in S.Agenda(PATH).encode_each(texts)] == want


def test_only_new_words_are_learned(monkeypatch):
    agenda, learned = S.Agenda(PATH), []
    learn = agenda.learn
    monkeypatch.setattr(agenda, "learn", lambda slices: learn([learned.extend(words) or words for words in map(list, slices)]))
    texts = [" ".join(f"word{i}" for i in range(n, n + 200)) for n in (0, 100)] + ["", "x" * 100]
    want = LIBRARY.encode(texts, add_eos=True)
    assert [ids.tolist() for ids in agenda.encode_each(texts[:1])] == want[:1] and len(learned) == 200
    assert [ids.tolist() for ids in agenda.encode_each(texts)] == want and len(learned) == 200 + 100 + 1
    assert [ids.tolist() for ids in agenda.encode_each(texts[:3])] == want[:3] and len(learned) == 301
    assert [agenda.decode(ids) for ids in agenda.encode_each(texts)] == LIBRARY.decode(want)


def test_equal_scores_merge_from_the_left():
    same([" " * n + "x" for n in range(70)] + ["a" + " " * n for n in range(70)])


def test_decoding_any_ids():
    rng = random.Random(2)
    agenda = S.codec(PATH)
    pool = [0, 1, 2, 259, 260, 262, *range(3, 259)]
    for _ in range(20_000):
        ids = [rng.choice(pool) if rng.random() < 0.7 else rng.randrange(32000) for _ in range(rng.randint(0, 9))]
        assert agenda.decode(ids) == LIBRARY.decode(ids), ids


def test_long_ids_are_hashed_whole():
    agenda = S.codec(PATH)
    ids = [3 + i % 1000 for i in range(2 * S.CHUNK + 5)]
    assert S.ids_digest(ids, agenda.decimal) == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert S.ids_digest([], agenda.decimal) == hashlib.sha256(b"").hexdigest()


def test_words_are_forgotten_at_the_bound(monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 3)
    agenda = S.Agenda(PATH)
    text = " ".join(f"word{i}" for i in range(50))
    assert agenda.encode(text).tolist() == LIBRARY.encode(text, add_eos=True)
    assert len(agenda._known) <= 3 and len(agenda._known._old) <= 3


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(S, "SLICE", 7)
    rng = random.Random(4)
    same(["".join(rng.choices("abthe   \n▁é", k=rng.randint(0, 80))) for _ in range(3000)])


def test_other_files_are_refused(tmp_path):
    other = tmp_path / "unigram.model"
    with open(PATH, "rb") as file:
        other.write_bytes(file.read().replace(b"\x18\x02\x20\x80\xfa\x01", b"\x18\x01\x20\x80\xfa\x01"))  # the type and the size of the vocabulary
    with pytest.raises((ValueError, RuntimeError)):
        S.Agenda(str(other))


def test_documents(spark):
    texts = ["Hello World", "", None, X.prose(4000), "Ünïcode straße ﬁ 12 </s>", " \n"]
    got = {r.doc_id: r for r in S.digests(X.documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        ids = LIBRARY.encode(t or "", add_eos=True)
        assert got[i].n_tokens == len(ids) and got[i].agrees
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert got[None].n_tokens == 1
    assert S.digests(X.empty(spark)).count() == 0


def test_columns(spark):
    texts = ["Hello World", "", None]
    docs = X.documents(spark, texts)
    rows = S.decode(S.encode(docs, into="ids"), into="back")
    assert rows.columns == [*docs.columns, "ids", "back"]
    assert {r.doc_id: (r.ids, r.back) for r in rows.collect()}[0] == (LIBRARY.encode("Hello World", add_eos=True), "Hello World")
    assert {r.doc_id: r.ids for r in S.encode(docs, into="score", end=False).withColumnRenamed("score", "ids").collect()}[1] == []
    assert S.decode(spark.sql("SELECT cast(null AS array<int>) AS ids"), into="t").first().t is None
