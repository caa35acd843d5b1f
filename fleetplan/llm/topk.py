"""Exact top-k search by inner product over a bit-sliced index.

A block of vectors is kept as bit slices: for every attribute (component) and
every bit, one bitmap over the rows of the block. The score sum_d q_d * x_d of a
query is added up with bitmap arithmetic alone: each set bit of a weight adds a
shifted slice, three slices of one weight become a sum and a carry slice, until
one slice is left for each bit of the score. The best rows are then selected from
the most significant slice downward, and the rows that tie at the boundary are
resolved exactly (by id).

Signs: components are stored with an offset that makes them non-negative, and a
negative weight reads the complement of the slices. Both change all scores of a
query by the same amount, which is taken off at the end.

A block has as many slices as its largest component needs. Blocks of ordinary
components count in 64-bit integers; one with components that might not fit
counts in Python's, which have no limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetplan.llm.common import stored

LONG = 1 << 63
KEY_BYTES = 288  # twice a double's largest exponent and the scale, with room for long vectors


@dataclass(frozen=True)
class BitSlices:
    """Slices of a block: [attribute * bits + bit, word], complements after them."""

    rows: int
    bits: int
    offset: int
    slices: np.ndarray
    full: np.ndarray

    @classmethod
    def build(cls, vectors: np.ndarray) -> BitSlices:
        """An index of integer rows."""
        n, dims = vectors.shape
        offset = -int(vectors.min(initial=0))
        shifted = (vectors + offset).T
        bits = max(int(shifted.max(initial=0)).bit_length(), 1)
        words = (n + 63) // 64
        planes = np.zeros((dims * bits, words * 64), np.uint8)
        for b in range(bits):
            planes[b::bits, :n] = (shifted >> b) & 1
        slices = _pack(planes)
        full = _pack(np.arange(words * 64)[None] < n)[0]
        return cls(n, bits, offset, np.concatenate([slices, ~slices & full]), full)

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The bits of every row's score, least significant first, and what must
        be added to a score to get the inner product."""
        weight = np.abs(query)
        half = len(self.slices) // 2
        first = np.arange(len(query)) * self.bits + np.where(query < 0, half, 0)
        top = (1 << self.bits) - 1
        # q * x = q * (x + offset) - q * offset, and -w * y = w * (top - y) - w * top
        base = -int(query.sum()) * self.offset - int(weight[query < 0].sum()) * top
        planes = int(weight.max(initial=0)).bit_length() + self.bits - 1
        result, carry = [], np.zeros((0, self.slices.shape[1]), np.uint64)
        column = 0
        while column < planes or len(carry):
            parts = [carry]
            for b in range(min(self.bits, column + 1)):
                shift = column - b
                chosen = (weight >> shift) & 1 if shift < 63 or weight.dtype == object else weight * 0
                parts.append(self.slices[(first + b)[chosen.astype(bool)]])
            level, carries = np.concatenate(parts), []
            while len(level) > 1:
                third = max(len(level) // 3, 1)
                if len(level) == 2:
                    a, b = level
                    carries.append((a & b)[None])
                    level = (a ^ b)[None]
                    break
                a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
                half_sum = a ^ b
                carries.append((a & b) | (half_sum & c))
                level = np.concatenate([half_sum ^ c, level[3 * third :]])
            result.append(level[0] if len(level) else np.zeros_like(self.full))
            carry = np.concatenate(carries) if carries else carry[:0]
            column += 1
        return result, base

    def top(self, query: np.ndarray, k: int, ids: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and inner products of the k best rows, ties to the
        smaller id; ``skip`` is a bitmap of rows that take no part."""
        scores, base = self.score_slices(query)
        sure = np.zeros_like(self.full)
        tied = self.full if skip is None else self.full & ~skip
        have, left = 0, int(np.bitwise_count(tied).sum())
        if left > k:
            for plane in reversed(scores):
                high = tied & plane
                n = int(np.bitwise_count(high).sum())
                if have + n >= k:
                    tied, left = high, n
                else:
                    sure, have = sure | high, have + n
                    tied = tied & ~plane
                    left -= n
                if have + left == k:
                    break
        rows, border = _rows(sure), _rows(tied)
        if len(rows) + len(border) > k:  # all of the border have one score
            border = border[np.argsort(ids[border], kind="stable")][: k - len(rows)]
        rows = np.concatenate([rows, border])
        exact = np.int64 if len(scores) < 62 and abs(base) < LONG // 2 else object
        value = np.full(len(rows), base, exact)
        for b, plane in enumerate(scores):
            value += ((plane[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64).astype(exact) << b
        order = np.array(sorted(range(len(rows)), key=lambda i: (-int(value[i]), ids[rows[i]])), np.int64)
        return rows[order], value[order]


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.astype("<u8").view(np.uint8), bitorder="little"))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, the components as they are stored, of the vectors that take part.

    Left out are null and empty vectors, vectors with a null or non-finite
    component, and rows without an id.
    """
    x = F.col(embedding)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) != float("inf")), F.lit(False)))
    rows = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("v"))


def quantised(components: np.ndarray, dims: int, scale: int = 256) -> np.ndarray:
    """Vectors end to end as integer rows, each component x as floor(scale * x),
    x as double: 64-bit integers, or Python's where a sum of them might not fit."""
    x = np.asarray(components, np.float64).reshape(-1, dims)
    if np.abs(x).max(initial=0) * scale * dims < LONG // 4:
        return np.floor(x * scale).astype(np.int64)
    whole = [math.floor(Fraction(t) * scale) for t in x.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(-1, dims)


def _ranked(value: np.ndarray) -> tuple[list[int], list[int], list[bytes | None]]:
    """Scores as columns that sort alike: whether one is above or below a long's
    range, the long within it, and big-endian bytes of the others."""
    beyond = [(int(v) >= LONG) - (int(v) < -LONG) for v in value]
    within = [0 if far else int(v) for v, far in zip(value, beyond, strict=True)]
    half = 1 << (8 * KEY_BYTES - 1)
    return beyond, within, [(int(v) + half).to_bytes(KEY_BYTES, "big") if far else None for v, far in zip(value, beyond, strict=True)]


def _block_counts(rows: DataFrame, size: int) -> DataFrame:
    """How many blocks each vector length takes, a row for each length that
    occurs. It is written, so that Spark knows its size and broadcasts it only
    where that is small."""
    return stored(rows.groupBy(F.size("v").alias("dims")).agg(F.ceil(F.count("*") / size).cast("long").alias("n")), "topk-blocks")


def _blocks(rows: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """Rows of one length in as many blocks as ``counts`` says: ``dims``, the block's
    number, ids, row numbers and the vectors end to end. Placing is by a hash of the row."""
    placed = rows.withColumn("dims", F.size("v")).join(counts, "dims")
    placed = placed.withColumn(name, F.pmod(F.xxhash64("vec_id", "row"), F.col("n")))
    # A block holds about the size counted with, whatever the data: a bounded group.
    block = placed.groupBy("dims", name).agg(F.sort_array(F.collect_list(F.struct("vec_id", "row", "v"))).alias("members"))
    return block.select("dims", name, F.col("members.vec_id").alias(f"{name}_ids"), F.col("members.row").alias(f"{name}_rows"), F.flatten("members.v").alias(f"{name}_v"))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, block: int = 8192, query_block: int = 512, scale: int = 256) -> DataFrame:
    """For each query row of ``rows`` (``vec_id``, ``v`` from :func:`usable`)
    its ``k`` rows of the highest inner product of quantised components (by
    ``scale``), itself excluded, ties to the smaller id: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score``. Ranks are exact for all finite components; a
    score beyond a long is NULL in its column, which is a long by contract.

    Every query meets every row, block by block: a task indexes one block of
    rows, reads blocks of queries against it, and passes on k rows for each
    query. Blocks hold a bounded number of rows and are spread by hash, so equal
    vectors and hot labels don't gather. Vectors of different lengths never
    meet. Rows that repeat an id are rows of their own: each asks, with its own
    ``k`` result rows, and may answer the others. An empty table gives no rows.
    """
    # The row number is written with the rows, so it stays what it is from here on.
    kept = stored(rows.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    tasks = 2 * (kept.count() // block + 1)
    # Explicit partition counts: merging small partitions would put all blocks into one task.
    counts = _block_counts(kept, block)
    indexed = _blocks(kept, counts, "c").repartition(tasks, "dims", "c")
    asked = kept.where(is_query)
    queries = stored(_blocks(asked, _block_counts(asked, query_block), "q"), "topk-queries").join(counts, "dims")
    copies = queries.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")
    units = indexed.join(copies.repartition(tasks, "dims", "c"), ["dims", "c"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, index = None, None
        for batch in batches:
            for dims, c, c_ids, c_rows, c_v, q_ids, q_rows, q_v in batch[["dims", "c", "c_ids", "c_rows", "c_v", "q_ids", "q_rows", "q_v"]].itertuples(index=False):
                if held != (dims, c):
                    held, index = (dims, c), BitSlices.build(quantised(c_v, dims, scale))
                ids, place = np.asarray(c_ids), {row: at for at, row in enumerate(c_rows)}
                out = []
                for q, row, vector in zip(q_ids, q_rows, quantised(q_v, dims, scale), strict=True):
                    skip = None
                    if row in place:
                        marked = np.zeros((1, len(index.full) * 64), np.uint8)
                        marked[0, place[row]] = 1
                        skip = _pack(marked)[0]
                    at, value = index.top(vector, k, ids, skip)
                    beyond, within, key = _ranked(value)
                    found = {"query_row": row, "query_id": q, "vec_id": ids[at], "beyond": beyond, "score": within, "key": key}
                    out.append(pd.DataFrame(found, index=range(len(at))))
                if out:
                    yield pd.concat(out, ignore_index=True)

    found = units.mapInPandas(search, "query_row long, query_id long, vec_id long, beyond int, score long, key binary")
    # The rank filter keeps k rows for each query before the shuffle as well.
    order = Window.partitionBy("query_row").orderBy(F.desc("beyond"), F.desc("score"), F.desc("key"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", F.when(F.col("beyond") == 0, F.col("score")).alias("score"))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The search of ``embeddings``: queries are the ids divisible by ``every``."""
    return top_k(usable(vectors), F.col("vec_id") % every == 0, k)
