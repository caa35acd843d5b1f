"""Stage file inputs derived from the driver tables, so the file sources are
exercised on data that grows with the tables: cluster documents as JSON or YAML,
run logs as text, artifacts as files, written under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.documents import document_line, write_documents
from ..sources.logs import LOG_SUFFIX
from . import views

#: What a partitioned write calls a folder without a name.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"staged/{name}-{uuid.uuid4().hex}")


def stage_cluster_documents(spark: SparkSession, sf_dir: str, fmt: str = "json") -> str:
    """Write every cluster's document, many to a file; returns the folder. The
    YAML form is flow style, with bare keys. Every 45th has a second document
    line that breaks off, as a cut write would leave it; others have lines under
    an id that doesn't decode, with an impossible date or a value that JSON has
    no form for (YAML), or with a repeated key (JSON)."""
    path = _path(spark, f"cluster-docs-{fmt}")
    seed = views.fleet_seed(spark, sf_dir)
    docs = views.cluster_docs(seed)
    if fmt == "json":
        write_documents(docs, path, "cluster_name")
    else:
        entries = F.transform(F.map_entries("doc"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
        text = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
        docs.select(document_line(F.col("cluster_name"), text).alias("value")).write.text(path)
    line = lambda rest, text: F.when(F.col("k") % 45 == rest, document_line(F.col("cluster_name"), F.lit(text)))
    lines = [line(9, '{"site": ["x",'), F.when(F.col("k") % 45 == 10, F.concat(F.lit('a%zz-'), F.col("k").cast("string"), F.lit('\t{"x": 1}')))]
    if fmt == "yaml":
        lines += [line(11, "{x: 2026-13-45}"), line(12, "{x: .nan}"), line(14, "{x: !!binary aGk=}")]
    else:
        lines.append(F.when(F.col("k") % 45 == 13, document_line(F.concat(F.col("cluster_name"), F.lit("-twice")), F.lit('{"x": 1, "y": "a", "x": 2}'))))
    seed.select(F.explode(F.array_compact(F.array(*lines))).alias("value")).write.mode("append").text(path)
    return path


def stage_logs(spark: SparkSession, sf_dir: str) -> str:
    """Write the run logs as text in the many-logs layout, in the order of
    cluster and line, so that a long log is written by many tasks and the number
    of files doesn't grow with the clusters; returns the folder."""
    path = _path(spark, "logs")
    lines = views.log_lines(spark, sf_dir).withColumn("cluster_name", F.coalesce("cluster_name", F.lit(NO_NAME)))
    sorted_lines = lines.repartitionByRange("cluster_name", "line_no").sortWithinPartitions("cluster_name", "line_no")
    sorted_lines.select(document_line(F.col("cluster_name"), F.col("text")).alias("value")).write.text(path)
    return path


ARRIVALS = 6  # of five days each


def stage_arrival(spark: SparkSession, sf_dir: str, path: str, arrival: int) -> None:
    """Append to ``path`` the events that come in with one arrival: those of its
    five days, without every tenth, and the tenth that the arrival before it left
    out (the last arrival leaves out none, and has what is later)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    slot = F.expr("(dayofmonth(ts) - 1) div 5") + F.when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    events.where(F.least(slot, F.lit(ARRIVALS - 1)) == arrival).write.mode("append").parquet(path)


def _write_files(files: DataFrame, path: str, append: bool = False) -> None:
    """Write rows (name, content BINARY) as files under ``path``; rows of one
    name one after the other, as they come."""

    def write(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        store, root = pafs.FileSystem.from_uri(path)
        store.create_dir(root)
        open_file = store.open_append_stream if append else store.open_output_stream
        name, file, folder = None, None, root
        for batch in batches:
            for n, content in zip(batch["name"], batch["content"], strict=True):
                if n != name:
                    if file:
                        file.close()
                    if (parent := f"{root}/{n}".rpartition("/")[0]) != folder:
                        store.create_dir(folder := parent)
                    name, file = n, open_file(f"{root}/{n}")
                file.write(content)
            yield pd.DataFrame({"n": [len(batch)]})
        if file:
            file.close()

    files.mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()


def stage_cluster_files(spark: SparkSession, sf_dir: str, path: str, half: int) -> None:
    """Write the documents of every other cluster (``half`` 0 or 1) in the
    tool's layout, one YAML file each, block style. Every 45th has a file
    beside it that breaks off, every 45th one that isn't UTF-8."""
    seed = views.fleet_seed(spark, sf_dir).where(F.col("k") % 2 == half)
    lines = F.transform(F.map_entries("doc"), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\n")))
    good = views.cluster_docs(seed).select("cluster_name", F.array_join(lines, "").cast("binary").alias("content"))
    beside = lambda rest, tail, content: seed.where(F.col("k") % 45 == rest).select(
        F.concat("cluster_name", F.lit(tail)).alias("cluster_name"), content.alias("content")
    )
    files = good.unionByName(beside(9, "-cut", F.lit("site: [x").cast("binary"))).unionByName(beside(11, "-bytes", F.unhex(F.lit("783A20FF"))))
    _write_files(files.select(F.concat("cluster_name", F.lit(".yaml")).alias("name"), "content"), path)


LOG_STAGES = 3


def stage_log_files(spark: SparkSession, sf_dir: str, path: str, stage: int) -> None:
    """Append a third of the run logs, by line number, to files in the tool's
    layout, ``<cluster>-bootstrap.log``."""
    lines = views.log_lines(spark, sf_dir)
    last = lines.agg(F.max("line_no")).first()[0] or 0
    part = F.least(F.expr(f"line_no * {LOG_STAGES} div {last + 1}"), F.lit(LOG_STAGES - 1))
    rows = lines.where(part == stage).repartition("cluster_name").sortWithinPartitions("cluster_name", "line_no")
    _write_files(rows.select(F.concat("cluster_name", F.lit(LOG_SUFFIX)).alias("name"), F.concat("text", F.lit("\n")).cast("binary").alias("content")), path, append=True)


FOLDERS = 1024  # work folders in one folder, about


def stage_artifacts(spark: SparkSession, sf_dir: str) -> str:
    """Write the artifacts as files ``<n>/<cluster>/<file>``, the work folders
    dealt over numbered folders so that none gets too large; returns the folder.
    Tasks write their files in place: a commit that moves each of them one after
    the other takes longer than everything else."""
    path = _path(spark, "artifacts")
    seed = views.fleet_seed(spark, sf_dir)
    # readers skip names that begin with a dot or an underscore
    folder = F.regexp_replace(F.url_encode(F.coalesce("cluster_name", F.lit(NO_NAME))), "^_", "%5F")
    folder = F.regexp_replace(folder, r"^\.", "%2E")
    spread = F.pmod(F.xxhash64("cluster_name"), F.lit(max(1, seed.count() // FOLDERS))).cast("string")
    name = F.concat_ws("/", spread, folder, F.url_encode("file"))
    _write_files(views.artifacts(seed).select(name.alias("name"), F.lit(b"x\n").alias("content")), path)
    return path
