"""Quality classifier: a factorisation machine over hashed words, structure
statistics of the text and its recorded length.

Every feature has a weight and a short factor vector; the score adds all
pairwise interactions <v_i, v_j> x_i x_j. The sum-of-squares identity
    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]
makes that linear in the number of features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import bounded_sample, fresh, one_row_each, remainder

SYMBOLS = "#*$%&|<>"
STATISTICS = (
    "log_words", "word_length", "distinct_words", "repeats_previous", "upper_words", "title_words", "symbol_words",
    "symbols", "punctuated_words", "digits", "line_length", "distinct_lines", "top_word", "bare_symbols", "length_gap",
)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds what training reads. ``bins`` cuts each statistic
    into intervals, each of which is one feature."""

    sample_rows: int = 6000
    buckets: int = 1 << 15
    bins: int = 12
    rank: int = 6
    epochs: int = 6
    rate: float = 0.1
    decay: float = 1e-5
    accept: float = 0.3
    seed: int = 11


@dataclass(frozen=True)
class Machine:
    """Bias, weights and factors; the first features are words, the rest bins
    of statistics, which ``edges`` bound."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    edges: np.ndarray
    buckets: int
    accept: float

    def score(self, text: str, n_chars: int | None) -> float:
        index, value = features(text, n_chars, self.edges, self.buckets)
        return logistic(raw_score(self.bias, self.weights[index], self.factors[index], value)[0])


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


def raw_score(bias: float, weights: np.ndarray, factors: np.ndarray, value: np.ndarray) -> tuple[float, np.ndarray]:
    """The machine's score before the logistic function, and sum_i v_i x_i."""
    scaled = factors * value[:, None]
    total = scaled.sum(axis=0)
    return float(bias + weights @ value + 0.5 * (total @ total - np.einsum("ij,ij->", scaled, scaled))), total


def statistics(text: str, words: Sequence[str], counts: Counter, n_chars: int | None) -> np.ndarray:
    """The structure of a text, each entry between 0 and about 1."""
    n, size = max(len(words), 1), max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return np.array(
        [
            math.log1p(len(words)) / 12,
            min(sum(map(len, words)) / n / 20, 1.0),
            len(counts) / n,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
            sum(map(str.isupper, words)) / n,
            sum(map(str.istitle, words)) / n,
            sum(any(c in w for c in SYMBOLS) for w in counts) / max(len(counts), 1),
            sum(map(text.count, SYMBOLS)) / size,
            sum(not w[-1].isalnum() for w in counts) / max(len(counts), 1),
            sum(map(text.count, "0123456789")) / size,
            min(len(text) / max(len(lines), 1) / 1000, 1.0),
            len(set(lines)) / max(len(lines), 1),
            max(counts.values(), default=0) / n,
            sum(k for w, k in counts.items() if not any(map(str.isalnum, w))) / n,
            min(abs((len(text) if n_chars is None else n_chars) - len(text)) / size, 1.0),
        ]
    )


def features(text: str, n_chars: int | None, edges: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: words of log-damped frequency, scaled to
    length 1, and the bin of each statistic with the value 1/2."""
    words = text.split()
    counts = Counter(words)
    index = np.fromiter((zlib.crc32(w.lower().encode("utf-8", "replace")) % buckets for w in counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    value /= max(np.sqrt(value @ value), 1e-9)
    of = statistics(text, words, counts, n_chars)
    bins = (of[:, None] > edges).sum(axis=1) + np.arange(len(of)) * (edges.shape[1] + 1) + buckets
    return np.concatenate([index, bins]), np.concatenate([value, np.full(len(bins), 0.5)])


def bin_edges(texts: Sequence[str], n_chars: Sequence[int | None], bins: int) -> np.ndarray:
    """For each statistic, limits at the sample's quantiles and tails."""
    rows = np.array([statistics(t, w := t.split(), Counter(w), n) for t, n in zip(texts, n_chars, strict=True)])
    at = np.concatenate([[0.002, 0.02], np.linspace(0.06, 0.94, bins - 5), [0.98, 0.998]])
    return np.quantile(rows, at, axis=0).T


def fit(texts: Sequence[str], n_chars: Sequence[int | None], quality: Sequence[int], settings: Settings = Settings()) -> Machine:
    """Stochastic gradient descent on the log loss; step sizes adapt by feature.
    Without rows, the machine scores everything 0.5."""
    n_features = settings.buckets + len(STATISTICS) * settings.bins
    rng = np.random.default_rng(settings.seed)
    weights = np.zeros(n_features)
    factors = rng.normal(0, 0.05, (n_features, settings.rank))
    if not len(texts):
        return Machine(0.0, weights, factors * 0, np.zeros((len(STATISTICS), settings.bins - 1)), settings.buckets, settings.accept)
    edges = bin_edges(texts, n_chars, settings.bins)
    small = lambda x: (x[0].astype(np.int32), x[1].astype(np.float32))
    rows = [small(features(t, n, edges, settings.buckets)) for t, n in zip(texts, n_chars, strict=True)]
    good = np.array(quality, float)
    share = np.clip(good.mean(), 0.001, 0.999)
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_v = np.full(n_features, 1e-2), np.full(n_features, 1e-2)
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            index, value = rows[i]
            v = factors[index]
            raw, total = raw_score(bias, weights[index], v, value)
            error = logistic(raw) - good[i]
            # Words of one text may share a bucket; the largest value of each then counts for the step.
            step_w = error * value + settings.decay * weights[index]
            step_v = error * value[:, None] * (total - v * value[:, None]) + settings.decay * v
            seen_w[index] += step_w**2
            seen_v[index] += (step_v**2).mean(axis=1)
            weights[index] -= settings.rate * step_w / np.sqrt(seen_w[index])
            factors[index] = v - settings.rate * step_v / np.sqrt(seen_v[index])[:, None]
            bias -= 0.01 * settings.rate * error
    return Machine(bias, weights, factors, edges, settings.buckets, settings.accept)


def train(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> Machine:
    """A machine from at most ``sample_rows`` labelled documents whose id meets
    ``learn``. The labelled ids are sampled first; only their texts are read
    into the model. Of several labels of one id, the lowest counts; of several
    rows, the one of the lowest hash."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen, order = bounded_sample(marked.select("doc_id"), settings.sample_rows)
    ids = marked.where(chosen).orderBy(order, "doc_id").limit(settings.sample_rows)
    # At most sample_rows ids and numbers: a proven bound.
    rows = one_row_each(docs.select("doc_id", "text", "n_chars").join(F.broadcast(ids), "doc_id")).orderBy("doc_id").toPandas()
    texts = rows["text"].fillna("").tolist()
    return fit(texts, _lengths(rows["n_chars"]), rows["quality"].tolist(), settings)


def _lengths(column: pd.Series) -> list[int | None]:
    return [None if pd.isna(n) else int(n) for n in column]


def classify(docs: DataFrame, machine: Machine, into: str = "quality") -> DataFrame:
    """``docs`` with a struct ``into``: ``score`` (0 to 1, higher: better) and
    ``predicted`` (1 from the accepted score on).

    Reads ``text`` (null: empty; whole texts) and ``n_chars`` (null: the length
    of the text). Repeated rows are scored alike; other columns pass unread.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a fixed number of features

    @F.pandas_udf("score double, predicted int")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts, lengths in batches:
            score = [known.score(t if isinstance(t, str) else "", n) for t, n in zip(texts, _lengths(lengths), strict=True)]
            yield pd.DataFrame({"score": score, "predicted": [int(x >= known.accept) for x in score]})

    return docs.withColumn(into, run.asNondeterministic()(F.col("text"), F.col("n_chars")))


def scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every document's score; ids whose crc32 mod 5 is 0 are held out."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    machine = train(docs, labels, ~held_out, settings)
    out = classify(docs.select("doc_id", "text", "n_chars"), machine, into="found")
    return out.select("doc_id", held_out.alias("held_out"), "found.score", "found.predicted")


def keep_good(docs: DataFrame, machine: Machine) -> DataFrame:
    """The documents predicted to be good, with their columns as they were."""
    found = fresh(docs.columns, "quality")
    return classify(docs, machine, into=found).where(F.col(f"{found}.predicted") == 1).drop(found)
