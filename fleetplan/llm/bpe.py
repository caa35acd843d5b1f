"""Byte-pair encoding with a pair occurrence index, and decoding.

The distinct words of one batch of a partition become one long array of
symbols with links to the neighbours. An index maps each rank (a mergeable
pair) to the positions where it occurs. Active ranks are applied in ascending
order, each to all of its positions at once (to one in each word, where the new
symbol may make a pair of lower rank); a merge changes at most two neighbouring
pairs, and those positions are added to the lists of their ranks.
Positions that have gone stale are recognised when their rank is applied.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetplan.llm.common import fresh, text_frame

DEFAULT_VOCAB = "word_bpe_49k.json"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself for visible
    Latin-1 characters, else the next free code point from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


def sigma_free_lower(text: str) -> str:
    """Lower case letter by letter, without the rule for a final sigma."""
    return (text.replace("Σ", "σ") if "Σ" in text else text).lower()


@lru_cache(maxsize=1)
def settled_letters() -> frozenset[str]:
    """The code points of Unicode 3.2. Their classes and cases are the same in
    every library; those of later ones are not."""
    old = unicodedata.ucd_3_2_0
    return frozenset(c for i in range(sys.maxunicode + 1) if old.category(c := chr(i)) != "Cn")


class PairIndexBpe:
    """Encoder and decoder for a vocabulary file of the ``tokenizers`` library
    with normaliser (NFC, white space, lower case), split pattern, byte symbols
    and a word-end suffix, as in ``word_bpe_49k.json``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)))
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._split = regex.compile(pattern)
        self._library = Tokenizer.from_file(path)
        self.tokens = {i: t for t, i in [*vocab.items(), *self.specials.items()]}
        symbols = byte_symbols()
        self._to_byte = {s: b for b, s in enumerate(symbols)}
        self._byte = np.array([vocab[s] for s in symbols], np.int64)
        self._last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        self._base = max(vocab.values()) + 1
        pairs = np.array([(vocab[a], vocab[b]) for a, b in model["merges"]], np.int64)
        self._into = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        keys = pairs[:, 0] * self._base + pairs[:, 1]
        self._left, self._right = pairs.T
        self._order = np.argsort(keys, kind="stable")
        self._keys = keys[self._order]
        # Ranks whose new symbol is in no pair of the same or a lower rank: their merges don't depend on each other.
        least = np.full(self._base, len(keys), np.int64)
        np.minimum.at(least, pairs, np.arange(len(pairs))[:, None])
        self._settled = least[self._into] > np.arange(len(pairs))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where the pair never merges."""
        key = left * self._base + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._order[at], -1)

    def words(self, text: str) -> list[str]:
        """Normalised words, and special tokens as they stand, in order."""
        if "<|" not in text or not self._special.search(text):
            return self._plain_words(text)
        out, end = [], 0
        for m in self._special.finditer(text):
            out += [*self._plain_words(text[end : m.start()]), m[0]]
            end = m.end()
        return out + self._plain_words(text[end:])

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self._split.findall(text.lower())
        if settled_letters().issuperset(set(text)):
            return self._split.findall(sigma_free_lower(unicodedata.normalize("NFC", text)))
        # Unicode tables differ between libraries for these: let the vocabulary's own rules split.
        parts = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(map(self._to_byte.__getitem__, p)).decode() for p, _ in parts]

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct, non-empty words end to end, and where each begins
        (one more entry than words)."""
        data = [w.encode() for w in words]
        size = np.fromiter(map(len, data), np.int64, len(data))
        start = np.concatenate([[0], np.cumsum(size)])
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbol = self._byte[raw]
        symbol[start[1:] - 1] = self._last[raw[start[1:] - 1]]
        word = np.repeat(np.arange(len(data)), size)
        n = len(symbol)
        after = np.arange(1, n + 1)
        after[start[1:] - 1] = -1  # the last symbol of a word has no right neighbour
        before = np.arange(-1, n - 1)
        before[start[:-1]] = -1

        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray) -> None:
            """Post positions under the rank of the pair that begins there."""
            positions = positions[positions >= 0]
            positions = positions[after[positions] >= 0]
            rank = self.ranks(symbol[positions], symbol[after[positions]])
            known = rank >= 0
            positions, rank = positions[known], rank[known]
            by = np.argsort(rank, kind="stable")
            positions, rank = positions[by], rank[by]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.concatenate([[0], cuts])].tolist() if len(rank) else (), np.split(positions, cuts), strict=False):
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(active, r)
                lists[r].append(part)

        add(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            found = lists.pop(rank)
            at = np.unique(np.concatenate(found))
            right = after[at]
            valid = (right >= 0) & (symbol[at] == self._left[rank]) & (symbol[right] == self._right[rank])
            at = at[valid]
            if not len(at):
                continue
            if self._settled[rank]:
                # Of pairs that overlap (aaa), every other one from the left.
                fresh_start = np.concatenate([[True], at[1:] != right[valid][:-1]])
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(fresh_start, place, 0))) % 2 == 0]
                later = at[:0]
            else:
                # One merge for each word, the leftmost: a merge may make a pair of lower rank.
                first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                later, at = at[~first], at[first]
            right = after[at]
            symbol[at] = self._into[rank]
            symbol[right] = -1
            beyond = after[right]
            after[at] = beyond
            before[beyond[beyond >= 0]] = at[beyond >= 0]
            after[right] = -1
            if len(later):
                lists[rank] = [later]
                heapq.heappush(active, rank)
            add(np.concatenate([before[at], at]))
        alive = symbol >= 0
        lengths = np.bincount(word[alive], minlength=len(data))
        return symbol[alive], np.concatenate([[0], np.cumsum(lengths)])

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        seen: dict[str, int] = {}
        docs = []
        for text in texts:
            words = self.words(text)
            docs.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
        plain = [w for w in seen if w not in self.specials]
        ids, start = self.encode_words(plain)
        rows = np.fromiter((w not in self.specials for w in seen), bool, len(seen))
        size, begin = np.ones(len(seen), np.int64), np.zeros(len(seen), np.int64)
        size[rows], begin[rows] = np.diff(start), start[:-1]
        begin[~rows] = len(ids) + np.arange((~rows).sum())
        ids = np.concatenate([ids, [self.specials[w] for w in seen if w in self.specials]]).astype("<u4")
        out = []
        for doc in docs:
            n = size[doc]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(ids[np.repeat(begin[doc] - ends + n, n) + np.arange(total)])
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The tokens, joined by spaces: the vocabulary file names no decoder."""
        return " ".join([self.tokens[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])


@lru_cache(maxsize=2)
def codec(path: str) -> PairIndexBpe:
    """The codec of a vocabulary file, loaded once in a worker process."""
    return PairIndexBpe(path)


def _path(vocab: str | None) -> str:
    return vocab or public_tokenizers.path(DEFAULT_VOCAB)


def encode(docs: DataFrame, text: str = "text", into: str = "ids", vocab: str | None = None) -> DataFrame:
    """``docs`` with the token ids of ``text`` as array<long> in ``into``.

    Null and empty texts, and texts of white space, give an empty array.
    Special tokens of the vocabulary are recognised inside texts. Whole texts
    are encoded, repeated rows alike; other columns pass unread. An Arrow batch
    (16 MB in the registered query) bounds the memory of a task.
    """
    path = _path(vocab)
    run = text_frame(lambda texts: {"ids": [x.astype(np.int64) for x in codec(path).encode(texts)]}, "ids array<long>")
    held = fresh([*docs.columns, into], "encoded")
    return docs.withColumn(held, run(F.col(text))).withColumn(into, F.col(f"{held}.ids")).drop(held)


def decode(rows: DataFrame, ids: str = "ids", into: str = "text", vocab: str | None = None) -> DataFrame:
    """``rows`` with the decoded text of the id array ``ids`` in ``into``; a
    null array gives null. An id outside the vocabulary is an error."""
    path = _path(vocab)

    @F.pandas_udf("string")
    def run(batch):
        return batch.map(lambda x: None if x is None else codec(path).decode(x))

    return rows.withColumn(into, run(F.col(ids)))


def digests(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """Each text encoded and decoded again in the same task, as digests."""
    path = _path(vocab)

    def run(texts):
        bpe = codec(path)
        ids = bpe.encode(texts)
        return {
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids],
        }

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    held = docs.select("doc_id", text_frame(run, schema)(F.col("text")).alias("held"))
    return held.select("doc_id", "held.*")
