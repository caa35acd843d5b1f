"""Best-fit packing of token pieces into sequences, with certified counts.

Documents become pieces of at most ``capacity`` tokens; full pieces fill a
sequence of their own, the others are packed. They are dealt to partitions by a
hash, and each partition packs its pieces best-fit decreasing. Dual-feasible
functions bound from below how many sequences any packing of the partition
needs: where the bound is met, the partition is certified and done. Partitions
with a gap keep their full sequences and exchange the pieces of the others:
these are dealt anew, over fewer partitions, and packed again, round by round,
until no gap is left or a round gains nothing (then its result is dropped).
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetplan.llm.common import rank_encoding, stored

END_ID = 2
VOCAB, RANKS, SPECIAL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", (("<|endoftext|>", 50256),)


@dataclass(frozen=True)
class Settings:
    """``deal`` is the number of pieces that a task packs at once. With
    ``rounds``, no more rounds than that are made, whatever they gain."""

    capacity: int = 1024
    deal: int = 20_000
    rounds: int | None = None


# --- tokens ----------------------------------------------------------------


@lru_cache(maxsize=1)
def _library(json_path: str) -> Tokenizer:
    return Tokenizer.from_file(json_path)


def token_ids(text: str, ranks_path: str, json_path: str) -> list[int]:
    """The ids of the ``tokenizers`` file, special tokens in texts recognised.

    The rank file holds the same vocabulary and merges three times as fast; a
    text that its pattern engine refuses (a very long run of white space) goes
    to the ``tokenizers`` library."""
    try:
        return rank_encoding(ranks_path, SPECIAL).encode(text, allowed_special="all")
    except BaseException as error:
        if not isinstance(error, Exception) and type(error).__name__ != "PanicException":
            raise
        return _library(json_path).encode(text, add_special_tokens=False).ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, after one that takes
    what is left over."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, settings: Settings = Settings(), with_ids: bool = False, ranks_path: str | None = None, json_path: str | None = None) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``)
    of every piece of every document row; a null or empty text is one piece of
    the end id alone."""
    ranks, library = ranks_path or public_tokenizers.path(RANKS), json_path or public_tokenizers.path(VOCAB)
    capacity = settings.capacity

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*(token_ids(text, ranks, library) if isinstance(text, str) and text else ()), END_ID], "<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = (doc_id, i, start, length, zlib.crc32(part.tobytes()))
                    out.append((*row, part.astype(np.int64)) if with_ids else row)
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    # Nullable integers would reach pandas as floats and lose digits: ids travel as text.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


# --- packing within a partition --------------------------------------------


def lower_bound(lengths: Sequence[int] | np.ndarray, capacity: int) -> int:
    """A number of sequences that no packing of ``lengths`` can do without.

    The best of two families of dual-feasible functions, summed over the lengths:
    one lifts lengths above capacity - t to the whole and drops those below t;
    the other rounds to multiples of capacity / (k + 1).
    """
    count = np.bincount(np.asarray(lengths, np.int64), minlength=capacity + 1)
    x = np.arange(capacity + 1)
    total = int(count @ x)
    best = -(-total // capacity)
    # t from 0 to half the capacity: prefix sums give all of them at once.
    number, weight = np.cumsum(count), np.cumsum(count * x)
    t = np.arange(capacity // 2 + 1)
    lifted = number[capacity] - number[capacity - t]
    kept = weight[capacity - t] - np.where(t > 0, weight[np.maximum(t - 1, 0)], 0)
    best = max(best, int((lifted + -(-kept // capacity)).max()))
    for k in range(1, 101):
        steps = np.where((k + 1) * x % capacity == 0, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int(count @ steps) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each length; lengths must come in descending order. The
    open sequences are stacked by room left, and a bit mask of the rooms that
    occur finds the tightest one that suffices."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0
    out = np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            into = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            room, into, used = capacity, used, used + 1
        out[i] = into
        stacks[room - n].append(into)
        rooms |= 1 << (room - n)
    return out


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Sequence numbers from 0 for lengths in descending order, and the bound."""
    return best_fit(lengths, capacity), lower_bound(lengths, capacity)


# --- packing over partitions -----------------------------------------------


def _round(rows: DataFrame, number: int, groups: int, settings: Settings) -> DataFrame:
    """Deal ``rows`` to ``groups`` groups and pack each. Adds ``sequence_id``,
    ``offset``, ``fill`` (tokens in the sequence) and the group's ``gap``."""
    capacity = settings.capacity
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", "key"]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        length = group["length"].to_numpy()
        into, bound = pack_group(length, capacity)
        order = np.argsort(into, kind="stable")
        out = group.iloc[order][kept].copy()
        length, into = length[order], into[order]
        before = np.cumsum(length) - length
        first = np.concatenate([[True], into[1:] != into[:-1]])
        out["offset"] = before - before[first][into]
        out["fill"] = np.bincount(into, weights=length).astype(np.int64)[into]
        # The numbers of a round and a group lie apart from all others'.
        out["sequence_id"] = (number << 48) + (int(group["deal"].iloc[0]) << 24) + into
        out["gap"] = int(into.max()) + 1 - bound
        return out

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, key long, offset long, fill long, sequence_id long, gap long"
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("key", F.lit(number)), F.lit(groups)))
    packed = dealt.select(F.col("doc_id").cast("string").alias("doc_id"), *kept[1:], "deal").groupBy("deal").applyInPandas(pack, schema)
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack(parts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``parts`` (columns of :func:`pieces` without ``ids``) with ``sequence_id``
    and ``offset``.

    Sequences are gapless from 0 and hold at most ``capacity`` tokens; pieces are
    never cut further, dropped or repeated. Numbers of sequences are arbitrary.
    Equal lengths go by a hash of the row, and rows equal in every column are
    placed one by one. An empty table gives no rows.
    """
    capacity = settings.capacity
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    numbered = stored(parts.withColumn("key", F.monotonically_increasing_id()), "packing-pieces")
    whole = numbered.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("key")).withColumn("offset", F.lit(0).cast("long"))
    done = whole.select(*columns)
    rest = numbered.where(F.col("length") < capacity)
    deal = lambda n: max(1, round(n / settings.deal))
    left = rest.count()
    if not left:
        return done
    # Uniform by hash: a group holds about ``deal`` pieces, whatever the data.
    packed = stored(_round(rest, 0, deal(left), settings), "packing-round-0")
    # Each round has fewer sequences than the last one, so this ends.
    for number in itertools.count(1) if settings.rounds is None else range(1, settings.rounds):
        open_ = (F.col("gap") > 0) & (F.col("fill") < capacity)
        pool = packed.where(open_)
        was = pool.agg(F.count("*").alias("pieces"), F.countDistinct("sequence_id").alias("sequences")).first()
        room = capacity * was["sequences"] - (pool.agg(F.sum("length")).first()[0] or 0)
        if room < capacity or (deal(left) == 1 and number == 1):
            break  # nothing to save, or nobody to exchange with
        anew = stored(_round(pool.select("doc_id", "piece", "start", "length", "ids_crc32", "key"), number, deal(was["pieces"]), settings), f"packing-round-{number}")
        if anew.select("sequence_id").distinct().count() >= was["sequences"]:
            break
        done = done.unionByName(packed.where(~open_).select(*columns))
        packed = anew
    return done.unionByName(packed.select(*columns))


def packed_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All documents, tokenised, cut and packed: one row for each piece."""
    return pack(pieces(docs.select("doc_id", "text"), settings), settings)


def sequences(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` and the (doc_id, piece,
    offset) that they hold, at most ``capacity`` tokens each."""
    parts = stored(pieces(docs.select("doc_id", "text"), settings, with_ids=True), "packing-tokens")
    # Rows that repeat a document are told apart by their rank; they hold the same ids.
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = pack(parts.drop("ids"), settings)
    ids = parts.groupBy(*key).agg(F.first("ids").alias("ids"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"i.{c}")) for c in key]
    rows = placed.alias("p").join(ids.alias("i"), same[0] & same[1] & same[2] & same[3] & same[4]).select("p.*", "i.ids")
    held = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("held"))
    return held.select("sequence_id", F.flatten("held.ids").alias("ids"), F.transform("held", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"])).alias("held"))


