"""Cluster tables with versions (S7): rows with a ``cluster_name`` in buckets by a
hash of the name, so that the number of files doesn't grow with the clusters.

A change never touches what is there. It writes the new rows of its buckets to a
folder of their own, then publishes the next version: a small file that names the
folder of every bucket. The file gets its number by a rename that fails where the
number is taken (atomic on HDFS), so of two writers one comes first, and the other
reads the new version and goes on from it. A reader holds the folders of one
version, a writer that fails has published nothing.

``path/v-<id>/bucket=<n>/*.parquet`` are the rows, ``path/_versions/<number>.json``
the versions.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import hadoop

VERSIONS = "_versions"


@dataclass(frozen=True)
class Version:
    """The folder of every bucket that has rows, the columns and the number of buckets."""

    number: int
    buckets: int
    schema: str
    folders: dict[str, str]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, at = hadoop(spark, f"{path}/{VERSIONS}")
    if not files.exists(at):
        return []
    names = [f.getPath().getName() for f in files.listStatus(at)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _file(path: str, number: int) -> str:
    return f"{path}/{VERSIONS}/{number:012d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Version:
    text = spark.read.text(_file(path, number), wholetext=True).first()["value"]
    return Version(number, **json.loads(text))


def _current(spark: SparkSession, path: str) -> Version | None:
    numbers = _numbers(spark, path)
    return _read(spark, path, numbers[-1]) if numbers else None


def _publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Write a version under its number; False where the number is taken."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    files, target = hadoop(spark, _file(path, version.number))
    _, draft = hadoop(spark, f"{path}/{VERSIONS}/{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    text = json.dumps({"buckets": version.buckets, "schema": version.schema, "folders": version.folders})
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = context._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context_of = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), context._jsc.hadoopConfiguration())
    try:
        context_of.rename(files.makeQualified(draft), files.makeQualified(target), how)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("cluster_name"), F.lit(buckets)).cast("int"))


def _write_rows(spark: SparkSession, rows: DataFrame, path: str) -> tuple[str, dict[str, str]]:
    """Write rows with a ``bucket`` to a new folder: its name, and the folder of
    every bucket that has rows. A bucket beyond the advisory partition size is
    written by several tasks."""
    name = f"v-{uuid.uuid4().hex}"
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/{name}")
    files, at = hadoop(spark, f"{path}/{name}")
    found = [f.getPath().getName() for f in files.listStatus(at)]
    return name, {f.removeprefix("bucket="): f"{name}/{f}" for f in found if f.startswith("bucket=")}


def _delete(spark: SparkSession, path: str) -> None:
    files, at = hadoop(spark, path)
    files.delete(at, True)


def _rows_of(spark: SparkSession, path: str, version: Version, buckets: set[str] | None = None) -> DataFrame:
    """The rows of a version, all of them or of some buckets."""
    schema = StructType.fromJson(json.loads(version.schema))
    folders = [f"{path}/{folder}" for bucket, folder in sorted(version.folders.items()) if buckets is None or bucket in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_clusters(df: DataFrame, path: str, buckets: int = 64) -> None:
    """The table's next version is ``df`` alone; its rows need a ``cluster_name``."""
    spark = df.sparkSession
    _, folders = _write_rows(spark, _bucketed(df, buckets), path)
    while not _publish(spark, path, Version(max(_numbers(spark, path), default=-1) + 1, buckets, df.schema.json(), folders)):
        pass  # another writer took the number


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table's last version. Later changes don't show in them."""
    version = _current(spark, path)
    if version is None:
        raise ValueError(f"no cluster table at {path}")
    return _rows_of(spark, path, version)


def _change(spark: SparkSession, path: str, gone: DataFrame, added: DataFrame | None, buckets: int) -> None:
    """Publish a version without the clusters of ``gone`` and with the rows of
    ``added``. Where others changed one of the same buckets meanwhile, the rows
    are put together again from what they left; otherwise the version only gets
    a later number."""
    version = _current(spark, path)
    if version is None and added is None:
        return
    version = version or Version(-1, buckets, added.schema.json(), {})
    while True:
        started = version
        names = _bucketed(gone.select("cluster_name").distinct(), started.buckets)
        touched = {str(r["bucket"]) for r in names.select("bucket").distinct().collect()}  # at most ``buckets`` numbers
        if not touched:
            return
        rows = _rows_of(spark, path, started, touched)
        rows = rows.join(names.drop("bucket"), "cluster_name", "left_anti").select(*rows.columns)
        if added is not None:
            rows = rows.unionByName(added.select(*rows.columns))
        name, written = _write_rows(spark, _bucketed(rows, started.buckets), path)
        theirs = lambda v: (v.buckets, v.schema, [v.folders.get(b) for b in sorted(touched)])
        while theirs(version) == theirs(started):
            others = {b: folder for b, folder in version.folders.items() if b not in touched}
            if _publish(spark, path, replace(version, number=version.number + 1, folders=others | written)):
                return
            version = _current(spark, path)
        _delete(spark, f"{path}/{name}")


def replace_clusters(spark: SparkSession, df: DataFrame, path: str, buckets: int = 64) -> None:
    """Per-cluster state isolation: the rows of the clusters in ``df`` take
    the place of what the table holds of them; other clusters stay, those that
    other writers change at the same time as well. A table that isn't there yet
    is made with ``buckets`` buckets."""
    _change(spark, path, df, df, buckets)


def remove_clusters(spark: SparkSession, clusters: DataFrame, path: str, buckets: int = 64) -> None:
    """Remove the rows of the given clusters; other clusters stay."""
    _change(spark, path, clusters, None, buckets)


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete the rows that none of the last ``keep`` versions holds. Folders that
    no version names yet (of a writer under way) stay, and so do the version
    files: a number that was free again could be taken by a writer that began
    before later versions."""
    versions = [_read(spark, path, number) for number in _numbers(spark, path)]
    needed = {folder for v in versions[-keep:] for folder in v.folders.values()}
    for folder in {folder for v in versions[:-keep] for folder in v.folders.values()} - needed:
        _delete(spark, f"{path}/{folder}")
