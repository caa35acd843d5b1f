"""The registered queries: each operator over its whole table, with the
parameters of production use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetplan.llm import bpe, chat, infill, langid, neardup, packing, pii, quality, repair, rules, secret_scan, sentencepieces, topk
from fleetplan.llm.common import prepare

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_extra(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts look like the template."""
    text = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    values = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in rows)
    extra = conversations.sparkSession.sql(f"SELECT * FROM VALUES {values} AS extra(conv_id, turn, role, text)")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra.select(*[F.col(c).cast(t) for c, t in conversations.select("conv_id", "turn", "role", "text").dtypes]))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": lambda s, d: secret_scan.digests(table(s, d, "documents")),
    "op2_pii": lambda s, d: pii.masked_documents(table(s, d, "documents")),
    "op3_bpe": lambda s, d: bpe.digests(table(s, d, "documents")),
    "op4_language_id": lambda s, d: langid.predictions(table(s, d, "documents")),
    "op5_chat": lambda s, d: chat.formatted_conversations(_with_extra(table(s, d, "conversations"))),
    "op6_topk": lambda s, d: topk.nearest(table(s, d, "embeddings")),
    "op7_near_dedup": lambda s, d: neardup.grouped(table(s, d, "documents")),
    "op8_packing": lambda s, d: packing.packed_documents(table(s, d, "documents")),
    "op9_quality_rules": lambda s, d: rules.verdicts(table(s, d, "documents")),
    "op10_quality_classifier": lambda s, d: quality.scores(table(s, d, "documents"), table(s, d, "labels")),
    "op11_sentencepiece": lambda s, d: sentencepieces.digests(table(s, d, "documents")),
    "op12_infill": lambda s, d: infill.digests(table(s, d, "documents")),
    "op13_repair": lambda s, d: repair.repairs(table(s, d, "conversations")),
}
