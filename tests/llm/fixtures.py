"""Small tables with the awkward cases that every operator must bear: nulls,
empty and very long texts, repeated rows, extra columns with clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, base string, found string"


def documents(spark: SparkSession, texts: list[str | None]) -> DataFrame:
    """Documents 0, 1, ... with the given texts; the last row is repeated and
    one row has no id and no values at all."""
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.5, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1], (None,) * 8], DOCS).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def prose(n: int, seed: int = 0) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("th", "er", "on", "an", "re", "ing", "st", "en")) for _ in range(rng.randint(1, 4))) for _ in range(n))
