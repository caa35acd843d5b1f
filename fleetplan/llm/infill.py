"""Fill-in-the-middle transformation with a piece table.

A document is a table of descriptors (buffer, start, length) over two buffers
that never change: the text and the sentinels. Cutting splits descriptors, an
arrangement permutes them and puts sentinels between, the inverse permutation
restores the order, and hashes read the descriptors one after the other. No text
is copied until an output is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import fresh, text_frame

# The sentinels and the forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"

TEXT, MARKS = 0, 1  # the two buffers
BUFFER = "".join(SENTINELS)
#: The parts (0 prefix, 1 middle, 2 suffix) of each arranged form in the order of
#: the output, and the sentinel that leads each part.
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
LEADS = {0: PREFIX, 1: MIDDLE, 2: SUFFIX}
#: Characters of a descriptor that are encoded at once for a hash.
SLICE = 1 << 20


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


@dataclass(frozen=True)
class PieceTable:
    """Descriptors over the buffers (text, sentinels), in code points."""

    text: str
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: str) -> PieceTable:
        return cls(text, (Piece(TEXT, 0, len(text)),))

    def cut(self, places: Sequence[int]) -> PieceTable:
        """The table with a boundary at each place (code points from the start,
        in ascending order): one descriptor more for each. Parts may be empty."""
        out, at, left = [], 0, list(places)
        for piece in self.pieces:
            start, end = piece.start, piece.start + piece.length
            while left and left[0] <= at + piece.length:
                split = piece.start + left.pop(0) - at
                out.append(Piece(piece.buffer, start, split - start))
                start = split
            out.append(Piece(piece.buffer, start, end - start))
            at += piece.length
        return PieceTable(self.text, tuple(out))

    def arranged(self, order: Sequence[int]) -> PieceTable:
        """The parts in ``order``, each behind its sentinel."""
        out = []
        for part in order:
            mark = LEADS[part]
            out += [Piece(MARKS, BUFFER.index(mark), len(mark)), self.pieces[part]]
        return PieceTable(self.text, tuple(out))

    def restored(self, order: Sequence[int]) -> PieceTable:
        """The inverse of :meth:`arranged`: the parts alone, in their own order."""
        parts = self.pieces[1::2]
        return PieceTable(self.text, tuple(parts[list(order).index(part)] for part in range(len(order))))

    def slices(self) -> Iterator[str]:
        for piece in self.pieces:
            buffer = self.text if piece.buffer == TEXT else BUFFER
            end = piece.start + piece.length
            for at in range(piece.start, end, SLICE):
                yield buffer[at : min(at + SLICE, end)]

    def rendered(self) -> str:
        return "".join(self.slices())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.slices():
            digest.update(part.encode())
        return digest.hexdigest()


def draws(doc_id: int | None, seed: str = "1") -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a document: the first groups of the
    hash of ``<seed>:<doc_id>`` (nothing after the colon for a null id)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


@dataclass(frozen=True)
class Rates:
    """Out of a hundred documents: how many are transformed, and how many of
    those have the suffix first."""

    transformed: int = 90
    suffix_first: int = 20


def form_of(text: str, h3: int, h4: int, rates: Rates = Rates()) -> str:
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= rates.transformed:
        return PLAIN
    return SPM if h4 % 100 < rates.suffix_first else PSM


def transformed(text: str, doc_id: int | None, rates: Rates = Rates()) -> tuple[str, PieceTable, PieceTable]:
    """(form, the cut table of prefix, middle and suffix, the arranged table);
    both tables are the text's own for the plain form."""
    h1, h2, h3, h4 = draws(doc_id)
    form, whole = form_of(text, h3, h4, rates), PieceTable.of(text)
    if form == PLAIN:
        return form, whole, whole
    n = len(text) + 1
    parts = whole.cut(sorted((h1 % n, h2 % n)))
    return form, parts, parts.arranged(ORDER[form])


def parsed(output: str, form: str) -> PieceTable:
    """The table of an output: parts between sentinels. No part holds one, so the
    first of each is where it was put."""
    whole = PieceTable.of(output)
    if form == PLAIN:
        return whole
    places, at = [], 0
    for part in ORDER[form]:
        at = output.index(LEADS[part], at)
        places += [at, at + len(LEADS[part])]
        at = places[-1]
    return PieceTable(output, whole.cut(places).pieces[1:])


def restored(output: str, form: str) -> PieceTable:
    """The table of the text that became ``output`` in ``form``."""
    table = parsed(output, form)
    return table if form == PLAIN else table.restored(ORDER[form])


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", into: str = "infill", rates: Rates = Rates()) -> DataFrame:
    """``docs`` with a column ``into`` (one of that name is replaced): struct of
    ``form``, ``output`` and ``pieces``, the descriptors (buffer 0 the text, 1
    the sentinels; start and length in code points) that the output reads.

    A null text counts as empty; empty texts and texts that hold a sentinel are
    plain. Rows that repeat an id are cut alike where their texts are alike; a
    null id draws as the empty one. Other columns pass unread.
    """

    @F.pandas_udf("form string, output string, pieces array<struct<buffer:int,start:long,length:long>>")
    def run(ids, texts):
        import pandas as pd

        rows = []
        for i, t in zip(ids, texts, strict=True):
            form, _, table = transformed(t or "", None if i is None else int(i), rates)
            rows.append((form, table.rendered(), [p._asdict() for p in table.pieces]))
        return pd.DataFrame(rows, columns=["form", "output", "pieces"])

    # Nullable numbers would reach pandas as floats and lose digits: ids travel as text.
    return docs.withColumn(into, run(F.col(doc_id).cast("string"), F.col(text)))


def restore(rows: DataFrame, output: str, form: str, into: str = "text") -> DataFrame:
    """``rows`` with the text that ``output`` was made from in ``into``; null
    where output or form is null."""

    @F.pandas_udf("string")
    def run(outputs, forms):
        import pandas as pd

        return pd.Series([None if o is None or f is None else restored(o, f).rendered() for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return rows.withColumn(into, run(F.col(output), F.col(form)))


def digests(docs: DataFrame) -> DataFrame:
    """The transformation of ``documents`` and its way back, as digests. The
    restored text is rebuilt from the output and the form alone."""

    def run(texts):
        out = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")}
        for tagged in texts:
            doc_id, text = tagged.split(":", 1)
            form, parts, table = transformed(text, int(doc_id) if doc_id else None)
            output = table.rendered()
            out["n"].append(len(text))
            out["form"].append(form)
            out["prefix_chars"].append(None if form == PLAIN else parts.pieces[0].length)
            out["middle_chars"].append(None if form == PLAIN else parts.pieces[1].length)
            out["output_sha256"].append(table.sha256())
            out["restored_sha256"].append(restored(output, form).sha256())
        return out

    tagged = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    schema = "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    held = docs.select("doc_id", text_frame(run, schema)(tagged).alias(fresh(["doc_id"], "held")))
    return held.select("doc_id", "held.*")
