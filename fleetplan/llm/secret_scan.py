"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary stores common text in long tokens, so a string that needs
about one token for each character or two is unlike any text it was built from.
Runs of key characters whose characters-per-token ratio is low are reported as
``random`` once known digests and identifiers are excluded. A secret behind a
path or a key name is averaged away in its run, so the parts of a run and its
windows are tested too.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import fresh, rank_encoding, text_frame

# Fixed patterns: the assignment, the access key and the long hexadecimal run.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_VALUE, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")

# Known harmless forms: hexadecimal digests by length, UUIDs, numbers.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9+/_=-]+")
HEX_ANY = re.compile(r"[0-9a-fA-F]+")
KNOWN_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID.pattern}|{'|'.join(f'[0-9A-Fa-f]{{{n}}}' for n in DIGEST_LENGTHS)})(?![A-Za-z0-9])")

# What glues names to a value, the parts between, and the least share of
# min_chars that is left of a window without its inefficient ends.
SEPARATOR = re.compile("[/_=-]")
PART = re.compile("[A-Za-z0-9+]+")
CORE_SHARE = 0.8
MIXED = re.compile("[a-z][A-Z]|[A-Z]{2}[a-z]|[0-9][A-Za-z]|[A-Za-z][0-9]")

DEFAULT_VOCAB = "byte_bpe_50k.tiktoken"


@dataclass(frozen=True)
class Efficiency:
    """When a run counts as random: its least length, and the most characters
    per token for runs that mix letters with digits or cases, for lower-case or
    capitalised letters and for upper-case ones.

    Measured with the rank file: random letters of one case average 1.67 (lower)
    and 1.54 (upper); of the German, Finnish, Dutch, Swedish and Danish words of
    20 letters and more, 1 % lie below 1.83 to 2.15 (lower) and 1.67 to 1.82
    (upper). From ``long_chars`` letters on, where random letters scatter less
    and words are rare, the two limits of one case rise by ``long_more``."""

    min_chars: int = 20
    mixed_ratio: float = 1.8
    lower_ratio: float = 1.85
    upper_ratio: float = 1.72
    long_chars: int = 32
    long_more: float = 0.1

    def limit(self, run: str) -> float:
        if not run.isalpha() or not (run.isupper() or run.islower() or run.istitle()):
            return self.mixed_ratio
        return (self.upper_ratio if run.isupper() else self.lower_ratio) + (self.long_more if len(run) >= self.long_chars else 0)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping
    within a kind, ordered by start and then by kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


def _known(run: str) -> bool:
    return bool(NUMBER.fullmatch(run) or UUID.fullmatch(run) or (len(run) in DIGEST_LENGTHS and HEX_ANY.fullmatch(run)))


def _cover(spans: Sequence[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """The starts and the ends of the disjoint ranges that ``spans``, ordered by
    start, cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b, _ in spans:
        if ends and a <= ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _free(start: int, end: int, text: str, cover: tuple[list[int], list[int]]) -> list[tuple[int, int]]:
    """What the ranges of ``cover``, identifiers and digests leave of a run."""
    inside = [(start + m.start(), start + m.end()) for m in KNOWN_PART.finditer(text[start:end])]
    first, last = bisect.bisect_right(cover[1], start), bisect.bisect_left(cover[0], end)
    out, at = [], start
    for a, b in sorted([*inside, *zip(cover[0][first:last], cover[1][first:last], strict=True)]):
        out.append((at, a))
        at = max(at, b)
    return [*out, (at, end)]


def _stretches(run: str, tokens: Sequence[int], test: Efficiency) -> list[tuple[int, int]]:
    """(start, end) of the parts of a run where windows of ``min_chars`` or more
    have few characters per token.

    Overlapping windows are one stretch, its ends without tokens that raise the
    ratio. Short words between separators
    are no secret: a stretch has to mix classes, with at most one separator in
    eight characters."""
    ends = list(itertools.accumulate(tokens))
    starts = [0, *ends[:-1]]
    wide: list[list[int]] = []
    j = 0
    for i, at in enumerate(starts):
        while j < len(ends) and (j <= i or ends[j - 1] - at < test.min_chars):
            j += 1
        if ends[j - 1] - at < test.min_chars:
            break
        if ends[j - 1] - at <= test.mixed_ratio * (j - i):
            if wide and i <= wide[-1][1]:
                wide[-1][1] = j
            else:
                wide.append([i, j])
    out = []
    for i, j in wide:
        total = best = 0.0
        first, core = i, (i, i)
        for k in range(i, j):
            total += test.mixed_ratio - tokens[k]
            if total > best:
                best, core = total, (first, k + 1)
            if total <= 0:
                total, first = 0.0, k + 1
        a, b = (starts[core[0]], ends[core[1] - 1]) if core[0] < core[1] else (0, 0)
        core_text = run[a:b]
        kinds = sum(map(bool, map(re.search, ("[a-z]", "[A-Z]", "[0-9]"), [core_text] * 3)))
        if b - a < CORE_SHARE * test.min_chars or kinds < 2 or 8 * len(SEPARATOR.findall(core_text)) > b - a or 6 * len(re.findall("[A-Za-z]", core_text)) < b - a:
            continue
        out.append((a, b))
    return out


class _Growth:
    """Moves a stretch of a run out to the next separators, and beyond them over
    parts that mix classes: a secret may hold separators itself. How far that
    goes from each part is worked out once for the run."""

    def __init__(self, run: str):
        parts = [(m.start(), m.end(), bool(MIXED.search(m[0]))) for m in PART.finditer(run)]
        self.starts, self.ends, self.mixed = map(list, zip(*parts, strict=True)) if parts else ([], [], [])
        self.lead, self.tail = list(self.starts), list(self.ends)
        for i in range(1, len(parts)):
            self.lead[i] = self._left(self.starts[i], i - 1)
        for i in range(len(parts) - 2, -1, -1):
            self.tail[i] = self._right(self.ends[i], i + 1)

    def _left(self, a: int, i: int) -> int:
        """Where a stretch from ``a`` begins, part ``i`` being the last before it."""
        return self.lead[i] if i >= 0 and self.ends[i] >= a - 1 and self.mixed[i] else a

    def _right(self, b: int, i: int) -> int:
        return self.tail[i] if i < len(self.starts) and self.starts[i] <= b + 1 and self.mixed[i] else b

    def of(self, a: int, b: int) -> tuple[int, int]:
        i = bisect.bisect_right(self.starts, a) - 1
        begin = self.lead[i] if i >= 0 and a < self.ends[i] else self._left(a, i)
        j = bisect.bisect_left(self.ends, b)
        end = self.tail[j] if j < len(self.ends) and self.starts[j] < b else self._right(b, j)
        return begin, end


def random_spans(text: str, taken: Sequence[tuple[int, int, str]], encoding: tiktoken.Encoding, test: Efficiency) -> list[tuple[int, int, str]]:
    """Spans of low token efficiency that meet no span in ``taken`` (ordered by
    start): whole runs, or else their parts between separators and their stretches."""

    def few(run: str, n_tokens: int) -> bool:
        return len(run) <= test.limit(run) * n_tokens

    found, cover = [], _cover(taken)
    for m in re.finditer(rf"[A-Za-z0-9+/_=-]{{{test.min_chars},}}", text):
        for start, end in _free(m.start(), m.end(), text, cover):
            run = text[start:end]
            if len(run) < test.min_chars or _known(run):
                continue
            ids = encoding.encode_ordinary(run)
            if few(run, len(ids)):
                found.append((start, end, "random"))
                continue
            parts = [(p.start(), p.end()) for p in PART.finditer(run) if test.min_chars <= len(p[0]) < len(run)]
            low = [(a, b) for a, b in parts if not _known(run[a:b]) and few(run[a:b], len(encoding.encode_ordinary(run[a:b])))]
            merged: list[list[int]] = []
            low += _stretches(run, [len(encoding.decode_single_token_bytes(i)) for i in ids], test)
            grown = _Growth(run) if low else None
            for a, b in sorted(grown.of(a, b) for a, b in low):
                if merged and a < merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            found += [(start + a, start + b, "random") for a, b in merged]
    return found


def joined(spans: Sequence[tuple[int, int, str]]) -> str:
    """Spans as ``kind:start:end`` in their order, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan_text(text: str, vocab: str, test: Efficiency = Efficiency()) -> tuple[list, list]:
    """Base spans, and all spans by start and then by kind."""
    base = base_spans(text)
    extra = random_spans(text, base, rank_encoding(vocab), test)
    return base, sorted([*base, *extra], key=lambda s: (s[0], KINDS.index(s[2])))


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets", vocab: str | None = None, test: Efficiency = Efficiency()) -> DataFrame:
    """``docs`` with a column ``into``: struct of ``base`` and ``spans``, each an
    array of (kind, start, end) with code-point offsets, end exclusive.

    A null text counts as empty; null, empty and clean texts get empty arrays.
    Repeated rows are scanned as they come; other columns pass unread, but a
    column named ``into`` is replaced. The vocabulary file must lie at ``vocab``
    on every executor.
    """
    path = vocab or public_tokenizers.path(DEFAULT_VOCAB)

    def scan(texts):
        pairs = [scan_text(t, path, test) for t in texts]
        named = lambda spans: [{"kind": k, "start": a, "end": b} for a, b, k in spans]
        return {"base": [named(b) for b, _ in pairs], "spans": [named(s) for _, s in pairs]}

    span = "array<struct<kind:string,start:int,end:int>>"
    return docs.withColumn(into, text_frame(scan, f"base {span}, spans {span}")(F.col(text)))


def digests(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """The scan of ``documents`` as one digest row for each document row."""
    found = fresh(docs.columns, "secrets")
    rows = find_secrets(docs.select("doc_id", "text"), into=found, vocab=vocab).select("doc_id", F.col(f"{found}.base").alias("base"), F.col(f"{found}.spans").alias("spans"))
    as_text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(as_text("base"), 256).alias("base_sha256"),
        as_text("spans").alias("spans"),
    )


def digest_of(spans: Sequence[tuple[int, int, str]]) -> str:
    """The digest column for given base spans (for tests)."""
    return hashlib.sha256(joined(spans).encode()).hexdigest()
