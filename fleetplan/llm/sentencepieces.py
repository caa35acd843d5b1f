"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes a list of symbols, one for each character, linked to their
neighbours. An agenda holds every pair of neighbours whose joined text is a
piece, the best score first and the leftmost among equals; the best pair is
merged, its new pairs with the neighbours enter the agenda, and pairs that have
gone stale are recognised by their length. Symbols that are no piece become
byte pieces.

Where no piece has the space mark after another character, a merge never
crosses from a word into the mark before the next, so each word has its own
agenda and equal words are merged once. The new words of several texts are merged
together: their agendas are the rows of a matrix, and each round merges the best
pair of every row. In the registered query every Arrow batch is encoded and
decoded by the sentencepiece library too, and compared.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, compress
from operator import not_

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import fresh, text_frame

DEFAULT_MODEL = "piece_bpe_32k.model"

# Fixed values of the model format: the space mark, the piece types, the
# merge type of a vocabulary, and the fields read here.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2
PIECE, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_TYPE = 1, 3
MODEL_TYPE, UNKNOWN_SURFACE = 3, 44
CHARACTER_MAP, DUMMY_PREFIX, EXTRA_SPACES = 2, 3, 4
DEFAULT_SURFACE = " ⁇ "

#: Merged words that a worker process remembers (twice so many at most), and the longest such word.
REMEMBERED, WORD = 1 << 19, 64
#: Characters that are cut into words, and ids that are written as text, at once.
SLICE, CHUNK = 1 << 20, 1 << 16
#: The place of a pair that is no piece.
NEVER = 1 << 30
#: Words that are merged together at once, and the widths of their matrices.
ROWS, WIDTHS = 1 << 13, (6, 9, 12, 16, 24, 40, WORD)
#: Fewer words than these are merged one by one.
FEW = 100
#: A character that is no piece is a symbol by its code point, above every piece. A pair is a key of two symbols.
SINGLE, SYMBOL_BITS = 1 << 21, 22
#: Stands before a word whose marks are written out (a word without its mark holds none).
BARE = MARK


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialized message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, data[at : at + size]
        at += size


class Remembered(dict):
    """Results of a function by word: those of the last ``REMEMBERED`` new words,
    and of the words before them that have come up again."""

    def __init__(self, of: Callable[[str], bytes]):
        super().__init__()
        self._of, self._old = of, {}

    def __missing__(self, word: str) -> bytes:
        found = self._old.get(word)
        if found is None:
            found = self._of(word)
        if len(word) <= WORD:
            self.remember(word, found)
        return found

    def remember(self, word: str, found: bytes) -> None:
        if len(self) >= REMEMBERED:
            self._old = dict(self)
            self.clear()
        self[word] = found

    def remember_each(self, words: Sequence[str], found: Iterable[bytes]) -> None:
        """Remember results of as many words, at once where there is room for them."""
        if len(self) + len(words) <= REMEMBERED:
            self.update(zip(words, found, strict=True))
            return
        for word, each in zip(words, found, strict=True):
            self.remember(word, each)

    def new(self, slices: Iterable[Iterable[str]]) -> set[str]:
        """The words that are remembered neither of late nor from before."""
        return set().union(*slices).difference(self._old).difference(self)


class Agenda:
    """Encoder and decoder for a model file of the merge type with byte pieces.
    Models of another type, or with user-defined or unused pieces, are an error."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            spec = list(_fields(file.read()))
        pieces = [dict(_fields(value)) for number, value in spec if number == PIECE]
        trainer = dict(next(_fields(v) for n, v in spec if n == TRAINER))
        normalizer = dict(next(_fields(v) for n, v in spec if n == NORMALIZER))
        types = [p.get(PIECE_TYPE, NORMAL) for p in pieces]
        texts = [p[PIECE_TEXT].decode() for p in pieces]
        if trainer.get(MODEL_TYPE, 1) != MERGE_TYPE or set(types) - {NORMAL, UNKNOWN, CONTROL, BYTE} or types.count(BYTE) != 256:
            raise ValueError(f"{path}: not a merge-type vocabulary of plain and byte pieces")
        self._plain = not normalizer.get(CHARACTER_MAP) and normalizer.get(EXTRA_SPACES, 1) == 0
        self._prefix = MARK if normalizer.get(DUMMY_PREFIX, 1) else ""
        self.ids = {t: i for i, (t, k) in enumerate(zip(texts, types, strict=True)) if k == NORMAL}
        # The place of a piece's score, best first; equal scores share a place.
        scores = sorted({self.library.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: n for n, score in enumerate(scores)}
        self._place = {t: place[self.library.get_score(i)] for t, i in self.ids.items()}
        byte = {t: i for i, (t, k) in enumerate(zip(texts, types, strict=True)) if k == BYTE}
        self._bytes = [byte[f"<0x{b:02X}>"] for b in range(256)]
        self._crossing = any(MARK in t.lstrip(MARK) for t in self.ids)
        self._word = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self._cut = re.compile(r"(?!)" if self._crossing else f"[^{MARK}](?={MARK})")
        self.end = self.library.eos_id()
        self.decimal = [str(i) for i in range(len(pieces))]
        surface = trainer.get(UNKNOWN_SURFACE, DEFAULT_SURFACE.encode())
        self._surface = [self._shown(t, k, surface) for t, k in zip(texts, types, strict=True)]
        self._silent = {i for i, k in enumerate(types) if k == CONTROL}
        self._is_silent = np.array([k == CONTROL for k in types])
        self._marked = {i for t, i in self.ids.items() if t.startswith(MARK)}
        self._known = Remembered(lambda word: self.word_ids(self._whole(word)))
        self._index_pairs()

    def _index_pairs(self) -> None:
        """Every pair of symbols whose joined text is a piece, as arrays in the
        order of its key: the piece and its place. The symbol of each code point."""
        symbol = lambda text: self.ids.get(text, SINGLE + ord(text) if len(text) == 1 else None)
        pairs = []
        for text, piece in self.ids.items():
            for cut in range(1, len(text)):
                left, right = symbol(text[:cut]), symbol(text[cut:])
                if left is not None and right is not None:
                    pairs.append((left << SYMBOL_BITS | right, piece, self._place[text]))
        pairs.sort()
        pairs.append((1 << 62, 0, NEVER))  # what is beyond the last pair is found here
        self._pair_key, self._pair_piece, self._pair_place = np.array(pairs, dtype=np.int64).T.copy()
        self._single = np.arange(SINGLE, SINGLE + 0x110000, dtype=np.int32)
        for text, piece in self.ids.items():
            if len(text) == 1:
                self._single[ord(text)] = piece

    @staticmethod
    def _whole(word: str) -> str:
        """A word as it is merged, from the form in which it is remembered."""
        return word[1:] if word[:1] == BARE else MARK + word

    @staticmethod
    def _shown(text: str, kind: int, unknown: bytes) -> bytes:
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return {CONTROL: b"", UNKNOWN: unknown}.get(kind, text.replace(MARK, " ").encode())

    def normalised(self, text: str) -> str:
        if not self._plain:
            return self.library.normalize(text)
        return self._prefix + text.replace(" ", MARK) if text else ""

    def merged(self, word: str) -> list[str]:
        """The symbols that are left of a word when no pair can be merged. The
        agenda of a long word is a heap; that of a short one a list with a place
        for each pair of neighbours, from which the least is taken."""
        return self._merged_short(word) if len(word) <= WORD else self._merged_long(word)

    def _merged_short(self, word: str) -> list[str]:
        symbol, place = list(word), self._place.get
        agenda = [place(a + b, NEVER) for a, b in zip(word, word[1:], strict=False)]
        best = min(agenda, default=NEVER)
        while best < NEVER:
            left = agenda.index(best)
            text = symbol[left] + symbol.pop(left + 1)
            symbol[left] = text
            del agenda[left]
            if left < len(agenda):
                agenda[left] = place(text + symbol[left + 1], NEVER)
            if left:
                agenda[left - 1] = place(symbol[left - 1] + text, NEVER)
            best = min(agenda, default=NEVER)
        return symbol

    def _merged_long(self, word: str) -> list[str]:
        n = len(word)
        symbol: list[str] = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        place, push, pop = self._place.get, heapq.heappush, heapq.heappop
        agenda = [(at, i, 2) for i in range(n - 1) if (at := place(word[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, left, size = pop(agenda)
            right, text = after[left], symbol[left]
            if not text or right >= n:
                continue
            text += symbol[right]
            if len(text) != size:
                continue  # one of the two has been merged since
            symbol[left], symbol[right] = text, ""
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                joined = text + symbol[right]
                if (at := place(joined)) is not None:
                    push(agenda, (at, left, len(joined)))
            left = before[left]
            if left >= 0:
                joined = symbol[left] + text
                if (at := place(joined)) is not None:
                    push(agenda, (at, left, len(joined)))
        return [s for s in symbol if s]

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each pair, and the piece that it makes."""
        key = left.astype(np.int64) << SYMBOL_BITS | right
        at = np.searchsorted(self._pair_key, key)
        return np.where(self._pair_key[at] == key, self._pair_place[at], NEVER).astype(np.int32), self._pair_piece[at].astype(np.int32)

    def _merged_together(self, symbol: np.ndarray) -> np.ndarray:
        """The symbols that are left of each row (a word's symbols, then -1).
        In each round the best pair of every row is merged, the leftmost among
        equals; a row without any leaves."""
        out = np.full_like(symbol, -1)
        row = np.arange(len(symbol))
        place, piece = self._looked_up(symbol[:, :-1], symbol[:, 1:])
        while len(row) and place.shape[1]:
            left = place.argmin(1)
            merging = place[np.arange(len(row)), left] < NEVER
            if not merging.all():
                out[row[~merging], : symbol.shape[1]] = symbol[~merging]
                row, left, symbol, place, piece = (x[merging] for x in (row, left, symbol, place, piece))
            n, width = symbol.shape
            at, column = np.arange(n), np.arange(width)
            symbol[at, left] = piece[at, left]
            symbol = symbol[column != left[:, None] + 1].reshape(n, width - 1)
            kept = column[:-1] != left[:, None]
            place, piece = place[kept].reshape(n, width - 2), piece[kept].reshape(n, width - 2)
            for some, first in ((left > 0, left - 1), (left < width - 2, left)):
                r, c = at[some], first[some]
                place[r, c], piece[r, c] = self._looked_up(symbol[r, c], symbol[r, c + 1])
        out[row, : symbol.shape[1]] = symbol
        return out

    def learn(self, slices: Iterable[Iterable[str]]) -> None:
        """Remember the ids of the words (as they are remembered) that are new
        and not too long; a few are left to be merged alone."""
        by_size = sorted(self._known.new(slices), key=len)
        start = 0
        for width in WIDTHS:
            end = bisect_left(by_size, width, start, key=len)  # a word with its mark, or one too many, fits the width
            for at in range(start, end if end - start >= FEW else start, ROWS):
                self._learn_together(by_size[at : min(at + ROWS, end)], width)
            start = end

    def _learn_together(self, words: list[str], width: int) -> None:
        texts = [word[1:] if word[:1] == BARE else MARK + word for word in words]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        symbol = np.full((len(texts), width), -1, dtype=np.int32)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbol[np.arange(width) < size[:, None]] = self._single[points]
        merged = self._merged_together(symbol)
        there = merged >= 0
        data, end = merged[there].astype(np.intc).tobytes(), (there.sum(1).cumsum() * np.intc().itemsize).tolist()
        found = list(map(data.__getitem__, map(slice, [0, *end[:-1]], end)))
        for odd in np.flatnonzero((merged >= SINGLE).any(1)).tolist():
            found[odd] = self._spelled(found[odd])
        self._known.remember_each(words, found)

    def _spelled(self, symbols: bytes) -> bytes:
        """The ids of symbols of which some are no piece."""
        ids = array("i")
        for symbol in array("i", symbols):
            ids.extend([symbol] if symbol < SINGLE else map(self._bytes.__getitem__, chr(symbol - SINGLE).encode()))
        return ids.tobytes()

    def word_ids(self, word: str) -> bytes:
        """The ids of a word, as 32-bit integers."""
        ids = array("i")
        for symbol in self.merged(word):
            known = self.ids.get(symbol)
            ids.extend([known] if known is not None else map(self._bytes.__getitem__, symbol.encode()))
        return ids.tobytes()

    def _slices(self, text: str) -> Iterator[str]:
        """A text in slices of about ``SLICE`` characters, cut before marks
        that follow another character, so that no word is cut."""
        at = 0
        while len(text) - at > SLICE and (cut := self._cut.search(text, at + SLICE)):
            yield text[at : cut.end()]
            at = cut.end()
        yield text[at:]

    def encode(self, text: str, end: bool = True) -> array:
        """The ids of a text, with the end id after them."""
        return next(self.encode_each([text], end))

    def encode_each(self, texts: Iterable[str], end: bool = True) -> Iterator[array]:
        """The ids of each text. The new words of about ``SLICE`` characters are
        merged together: those of several texts, or of a slice of a long one."""
        words: list[str] = []  # the words of the slices held
        held: list[tuple[int, bool]] = []  # the number of words of a slice, and whether its text ends there
        size, out = 0, array("i")

        def joined() -> Iterator[array]:
            nonlocal out
            # Each word is looked up once; those not found are learned and filled in.
            found = list(map(self._known.get, words))
            absent = list(compress(range(len(words)), map(not_, found)))
            if absent:
                self.learn([map(words.__getitem__, absent)])
                for at in absent:
                    found[at] = self._known[words[at]]
            words.clear()
            for start, (n, last) in zip(accumulate((n for n, _ in held), initial=0), held, strict=False):
                out.frombytes(b"".join(found[start : start + n]))
                if last:
                    if end:
                        out.append(self.end)
                    yield out
                    out = array("i")
            held.clear()

        for text in texts:
            parts = list(self._slices(self.normalised(text)))
            for n, part in enumerate(parts, 1):
                some = self._words(part)
                words.extend(some)
                held.append((len(some), n == len(parts)))
                size += len(part)
                if size >= SLICE:
                    yield from joined()
                    size = 0
        yield from joined()

    def _words(self, part: str) -> list[str]:
        """The words that are merged apart. Single marks, by far the commonest
        case, need no pattern; a word then stands without its mark, and a word
        that has other marks, or none, is written with ``BARE`` before it."""
        if self._crossing:
            return [BARE + part] if part else []
        if part[:1] == MARK and part[-1] != MARK and MARK + MARK not in part:
            words = part.split(MARK)
            del words[0]
            return words
        return [BARE + w for w in self._word.findall(part)]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: marks become spaces, the one that encoding puts
        first goes, control pieces show nothing, and byte pieces that are not
        UTF-8 become one replacement character each."""
        if len(ids) and ids[-1] in self._silent:
            ids = ids[:-1]
        if isinstance(ids, array):  # looked at without an object for each id
            silent = bool(self._is_silent[np.frombuffer(ids, np.intc)].any()) if ids else False
        else:
            silent = not self._silent.isdisjoint(ids)
        cuts = [] if not silent else [at for at, i in enumerate(ids) if i in self._silent]
        parts = [ids[a:b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)], strict=True)]
        data = [b"".join(map(self._surface.__getitem__, part)) for part in parts]
        first = next((n for n, part in enumerate(parts) if len(part)), None)
        if self._prefix and first is not None and parts[first][0] in self._marked:
            data[first] = data[first][1:]
        # A control piece ends a run of byte pieces, so each part is decoded apart.
        return "".join(map(self._decoded, data))

    @staticmethod
    def _decoded(data: bytes) -> str:
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="one_each")


def _one_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


@lru_cache(maxsize=2)
def codec(path: str) -> Agenda:
    """The codec of a model file, loaded once in a worker process."""
    import codecs

    codecs.register_error("one_each", _one_each)
    return Agenda(path)


def _path(model: str | None) -> str:
    return model or public_tokenizers.path(DEFAULT_MODEL)


def encode(docs: DataFrame, text: str = "text", into: str = "ids", model: str | None = None, end: bool = True) -> DataFrame:
    """``docs`` with the ids of ``text`` as array<int> in ``into`` (a column of
    that name is replaced).

    A null or empty text has the end id alone (nothing, without ``end``). Whole
    texts are encoded, repeated rows alike; other columns pass unread. A task
    holds one Arrow batch of texts and the words it remembers (a bounded number).
    The model file must lie at ``model`` on every executor.
    """
    path = _path(model)
    run = text_frame(lambda texts: {"ids": [list(ids) for ids in codec(path).encode_each(texts, end)]}, "ids array<int>")
    held = fresh([*docs.columns, into], "pieces")
    return docs.withColumn(held, run(F.col(text))).withColumn(into, F.col(f"{held}.ids")).drop(held)


def decode(rows: DataFrame, ids: str = "ids", into: str = "text", model: str | None = None) -> DataFrame:
    """``rows`` with the text of the id array ``ids`` in ``into`` (a column of
    that name is replaced); a null array gives null, an empty one the empty
    text. An id outside the vocabulary is an error."""
    path = _path(model)

    @F.pandas_udf("string")
    def run(batch):
        return batch.map(lambda x: None if x is None else codec(path).decode([int(i) for i in x]))

    return rows.withColumn(into, run(F.col(ids)))


def ids_digest(ids: Sequence[int], decimal: Sequence[str]) -> str:
    """Hex SHA-256 of the decimal ids joined by one space."""
    out = hashlib.sha256()
    for at in range(0, len(ids), CHUNK):
        part = " ".join(map(decimal.__getitem__, ids[at : at + CHUNK]))
        out.update((" " + part if at else part).encode())
    return out.hexdigest()


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Each text encoded and decoded again in the same task, as digests;
    ``agrees`` is false where the library's ids or text are others. A null text
    counts as empty, a null id stays, no rows give no rows."""
    path = _path(model)

    def run(texts):
        agenda = codec(path)
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "agrees": []}
        for text, ids in zip(texts, agenda.encode_each(texts), strict=True):
            back = agenda.decode(ids)
            expected = agenda.library.encode(text, add_eos=True)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(ids_digest(ids, agenda.decimal))
            out["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
            out["agrees"].append(array("i", expected) == ids and agenda.library.decode(expected) == back)
        return out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"
    held = docs.select("doc_id", text_frame(run, schema)(F.col("text")).alias("held"))
    return held.select("doc_id", "held.*")
