"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent, with calibrated rejection.

A text is the average of the embeddings of its letter n-grams (word edges
marked), hashed into a fixed table. As averaging and the output layer are both
linear, a trained model keeps one row of class scores per bucket, and scoring a
text is one gather and one mean.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import bounded_sample, fresh, one_row_each, remainder

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds what training reads; a calibration share of it
    sets the temperature and the rejection limit, the rest is learned from."""

    sample_rows: int = 4000
    buckets: int = 1 << 17
    dim: int = 16
    sizes: tuple[int, ...] = (2, 3, 4)
    epochs: int = 4
    rate: float = 20.0
    calibration_share: float = 0.25
    rejected_share: float = 0.0005
    most_rejection: float = 0.4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Class scores by bucket, with the temperature applied. There is no bias:
    a text whose n-grams are unknown speaks for no language, however frequent."""

    labels: tuple[str, ...]
    scores: np.ndarray
    reject_below: float
    sizes: tuple[int, ...]

    def probabilities(self, text: str) -> np.ndarray | None:
        """Calibrated probabilities, or None for a text without letters."""
        grams = ngrams(text, self.sizes, len(self.scores))
        if grams is None:
            return None
        return softmax(mean_rows(self.scores, grams))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def mean_rows(table: np.ndarray, rows: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """The mean of the given rows, gathered in blocks."""
    total = np.zeros(table.shape[1])
    for i in range(0, len(rows), block):
        total += table[rows[i : i + block]].sum(axis=0, dtype=np.float64)
    return total / len(rows)


def ngrams(text: str, sizes: Sequence[int], buckets: int) -> np.ndarray | None:
    """Buckets of the letter n-grams of a text, None where it has no letter.

    The text is lower-cased and each stretch without letters becomes one edge
    mark; an n-gram may begin or end with a mark, but not span one.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[code]
    if not is_letter.any():
        return None
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # of a stretch without letters, the first stays as the mark
    marked = np.where(is_letter, code, 0)[keep].astype(np.uint64)
    marked = np.concatenate([[0] if marked[0] else [], marked, [0] if marked[-1] else []]).astype(np.uint64)
    edge = marked == 0
    out = []
    for n in sizes:
        count = len(marked) - n + 1
        if count < 1:
            continue
        value = np.full(count, n, np.uint64)
        inside = np.zeros(count, bool)
        for i in range(n):
            value = value * np.uint64(0x9E3779B97F4A7C15) + marked[i : i + count]
            if 0 < i < n - 1:
                inside |= edge[i : i + count]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(((value >> np.uint64(40)) % np.uint64(buckets))[~inside])
    return np.concatenate(out).astype(np.int64)


def fit(texts: Sequence[str], langs: Sequence[str], settings: Settings = Settings()) -> Model:
    """Train on a bounded sample given in a fixed order; without a usable row,
    the model rejects everything."""
    rows = []
    for text, lang in zip(texts, langs, strict=True):
        grams = ngrams(text, settings.sizes, settings.buckets) if text else None
        if grams is not None:  # kept small: the distinct n-grams and their shares
            found, count = np.unique(grams, return_counts=True)
            rows.append((found.astype(np.int32), (count / count.sum()).astype(np.float32), lang))
    names = tuple(sorted({lang for *_, lang in rows}))
    if not names:
        return Model((), np.zeros((settings.buckets, 0)), 1.0, settings.sizes)
    data = [(found, share, names.index(lang)) for found, share, lang in rows]
    rng = np.random.default_rng(settings.seed)
    held = rng.random(len(data)) < settings.calibration_share
    if held.all() or not held.any():
        held[:] = False
    learn = np.flatnonzero(~held)
    table = rng.normal(0, 0.1, (settings.buckets, settings.dim))
    out = np.zeros((settings.dim, len(names)))
    step, steps = 0, settings.epochs * len(learn)
    for _ in range(settings.epochs):
        for i in rng.permutation(learn):
            grams, weight, y = data[i]
            rate = settings.rate * (1 - step / steps)
            step += 1
            vector = weight @ table[grams]
            error = softmax(vector @ out)
            error[y] -= 1
            back = out @ error
            out -= rate * 0.05 * np.outer(vector, error)
            table[grams] -= rate * np.outer(weight, back)
    scores = table @ out
    seen = np.zeros(settings.buckets, bool)
    for grams, _, _ in data:
        seen[grams] = True
    scores[~seen] = 0  # nothing is known of these: they speak for no language
    check = np.flatnonzero(held) if held.any() else learn
    logits = np.array([data[i][1] @ scores[data[i][0]] for i in check])
    truth = np.array([data[i][2] for i in check])
    heat = _temperature(logits, truth)
    sure = np.array([softmax(x / heat).max() for x in logits])
    limit = min(settings.most_rejection, float(np.quantile(sure, settings.rejected_share)))
    return Model(names, (scores / heat).astype(np.float32), limit, settings.sizes)


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss, from a fixed grid; above 0.5, so that
    a sample without errors doesn't make every answer certain."""
    best = (np.inf, 1.0)
    for heat in np.geomspace(0.5, 8, 33):
        p = np.array([softmax(x / heat) for x in logits])
        best = min(best, (-np.log(p[np.arange(len(truth)), truth] + 1e-12).mean(), float(heat)))
    return best[1]


def sample(docs: DataFrame, learn: Column, settings: Settings = Settings()) -> pd.DataFrame:
    """At most ``sample_rows`` labelled rows for which ``learn`` holds, picked by
    a hash of the id, one row of each id: the same rows however the table is
    partitioned. Rows without an id count as one id."""
    rows = docs.where(F.col("lang").isNotNull() & learn).select("doc_id", "text", "lang")
    chosen, order = bounded_sample(rows.select("doc_id").distinct(), settings.sample_rows)
    # About sample_rows ids are left, and one row of each, before anything is sorted.
    picked = one_row_each(rows.where(chosen & F.col("text").isNotNull()))
    return picked.orderBy(order, "doc_id").limit(settings.sample_rows).select("text", "lang").toPandas()


def train(docs: DataFrame, learn: Column, settings: Settings = Settings()) -> Model:
    """A model of ``text`` and ``lang``, from rows for which ``learn`` holds."""
    rows = sample(docs, learn, settings)
    return fit(rows["text"].tolist(), rows["lang"].tolist(), settings)


def predict(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct ``into``: ``lang_pred``, ``score`` (0 to 1) and
    ``rejected``.

    Null texts and texts without a letter get ``und``, score 0, rejected.
    Rejected are also texts whose calibrated confidence is below the model's
    limit; their ``lang_pred`` is still the likeliest language. Whole texts are
    read, and nothing but the text is used.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages, a fixed size

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            out = []
            for t in texts:
                p = known.probabilities(t) if isinstance(t, str) and t and known.labels else None
                if p is None:
                    out.append((UNKNOWN, 0.0, True))
                else:
                    best = int(p.argmax())
                    out.append((known.labels[best], float(p[best]), bool(p[best] < known.reject_below)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])

    return docs.withColumn(into, run.asNondeterministic()(F.col(text)))


def predictions(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every document's language; rows whose crc32(id) mod 4 is 2 are held out."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs.select("doc_id", "text", "lang"), ~held_out, settings)
    out = predict(docs.select("doc_id", "text"), model, into="found")
    return out.select("doc_id", held_out.alias("held_out"), "found.lang_pred", "found.score", "found.rejected")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not rejected, with their columns as they were."""
    found = fresh(docs.columns, "language")
    return predict(docs, model, into=found).where(~F.col(f"{found}.rejected")).drop(found)
