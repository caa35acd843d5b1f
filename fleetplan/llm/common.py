"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import base64
import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetplan.session import scratch_path

#: ASCII white space, the separators of words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Arrow batches of texts hold at most so many bytes, which bounds a Python worker's memory.
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package, whatever the
    driver's working folder is (on a cluster the package is installed or sent
    with ``--py-files``), and keep Arrow batches small."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def fresh(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores added until no column has it (Spark compares
    names without case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table under the shared checkpoint folder and
    read back: lineage ends there, a lost executor costs a second read, and
    nothing upstream is computed twice. The folder is new for each call; tables
    that the result doesn't read are removed with :func:`discard`."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(table: DataFrame) -> None:
    """Remove a table that :func:`stored` wrote, once nothing reads it again."""
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Up to so many ids (16 MB of longs) are sent to every executor.
BROADCAST_IDS = 1 << 21


def join_ids(docs: DataFrame, ids: DataFrame, how: str, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` semi- or anti-joined (``how``) on ``doc_id`` to a stored table of
    ids, its only column. The ids are counted: up to ``BROADCAST_IDS`` they are
    broadcast, so that the texts stay where they are; beyond, both sides are
    shuffled."""
    (name,) = ids.columns
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(side, docs[doc_id] == side[name], how)


@lru_cache(maxsize=4)
def rank_encoding(path: str, special: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once in a worker process."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))


#: White space as the engine's pattern has it (Python's ``\\s`` has more), in runs long enough to matter.
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def ordinary_ids(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The text's ids, without special tokens. The pattern engine refuses a very
    long run of white space; such runs are then merged apart, but for the last
    character before other text, which the pattern leaves to that text."""
    try:
        return encoding.encode_ordinary(text)
    except BaseException as error:
        if not isinstance(error, Exception) and type(error).__name__ != "PanicException":
            raise
    ids, at = [], 0
    for m in _LONG_BLANK.finditer(text):
        end = m.end() - (m.end() < len(text))
        ids += encoding.encode_ordinary(text[at : m.start()])
        ids += encoding._encode_single_piece(text[m.start() : end])
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def evaluated_once(column: Column) -> Column:
    """``column``, marked as non-deterministic: a filter on it stays above the
    projection that computes it, instead of being pushed below with the whole
    expression copied into it (and into each lambda that refers to a part)."""
    return F.when(F.spark_partition_id() >= 0, column)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def sample_order(doc_id: Column) -> Column:
    """A fixed pseudo-random order of ids, independent of partitioning."""
    return F.xxhash64(F.lit("sample"), doc_id)


def bounded_sample(keys: DataFrame, n: int, doc_id: str = "doc_id") -> tuple[Column, Column]:
    """A condition that about ``n`` of the ids in ``keys`` meet (all, where there
    are no more), and the order whose first ``n`` rows are the sample.

    The ids are counted and a hash decides, so that only about ``n`` rows reach
    the sort, not ``n`` from each partition, and the choice does not depend on
    how the table is partitioned.
    """
    total = keys.count()
    order = sample_order(F.col(doc_id))
    share = min(1.0, (1.2 * n + 100) / max(total, 1))
    return F.pmod(order, F.lit(1 << 32)) < F.lit(int(share * (1 << 32))), order


def one_row_each(rows: DataFrame) -> DataFrame:
    """One row of each ``doc_id``: the least by a hash of the others, chosen in
    each task before rows are sent on."""
    names = [c for c in rows.columns if c != "doc_id"]
    first = F.min_by(F.struct(*names), F.xxhash64(*names)).alias("first")
    return rows.groupBy("doc_id").agg(first).select("doc_id", "first.*")


def text_frame(fn: Callable[[Sequence[str]], dict[str, Sequence]], schema: str):
    """A pandas UDF over one text column (null: empty) that gives a struct.

    ``fn`` gets the texts of one Arrow batch and returns the struct's fields.
    Marked non-deterministic so that a filter on its result neither moves below
    it nor evaluates it a second time.
    """

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(fn([t if isinstance(t, str) else "" for t in texts]))

    return run.asNondeterministic()
