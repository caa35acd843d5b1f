"""Configuration documents as rows (S1) and file listings.

Two layouts are read:

* one document per file, ``<root>/<id>.json`` or ``<id>.yaml`` (the file stem is
  the scope id), as people write them;
* many documents per file: lines of ``<scope id> TAB <document>``, the id
  URL-encoded, the document on one line (JSON or flow YAML). This is what
  ``write_documents`` writes, and what a fleet of millions of clusters needs.

Values keep the three states apart: absent key (no row), explicit null (the
text ``null``), and any other JSON text; secret values are replaced here, before
anything else sees them. JSON documents are parsed by Spark
(``map<string,variant>`` keeps ``"1"`` and ``1`` apart); YAML documents are
parsed per partition in ``mapInPandas``. Of a key that a document repeats, the
last value counts (a JSON value that repeats one inside is a bad document). A
document that doesn't parse, is not a mapping, holds a value that JSON has no
form for (``.nan``, binary), or stands under an id that doesn't decode, is not
dropped in silence, and stops nothing: ``bad_documents`` lists it.
"""

from __future__ import annotations

import datetime
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..session import hadoop, importable, write_table
from .files import stored_at

_STEM = r"([^/]+?)\.(json|ya?ml)$"
_GLOB = {"json": "*.json", "yaml": "*.y*ml"}


def _read_raw(spark: SparkSession, path: str, scope: str, fmt: str, many: bool) -> DataFrame:
    """(<scope>, value): the text of every document. The scope is text whatever
    it looks like ('007' stays '007')."""
    if many:
        line = F.split("value", "\t", 2)
        rows = spark.read.text(path).where(F.col("value") != "")
        named = F.try_url_decode(line[0])
        text = F.coalesce(F.get(line, F.lit(1)), F.lit(""))
        # an id that doesn't decode is kept as it stands, without its document
        return rows.select(F.coalesce(named, line[0]).alias(scope), F.when(named.isNotNull(), text).alias("value"))
    files = spark.read.option("pathGlobFilter", _GLOB[fmt]).text(path, wholetext=True)
    stem = F.regexp_extract(F.col("_metadata.file_path"), _STEM, 1)
    # a plus sign stands for itself in a path
    return files.select(F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B"))).alias(scope), "value")


def _parse_json(raw: DataFrame, scope: str) -> DataFrame:
    parsed = F.from_json("value", "map<string,variant>")
    entries = F.map_entries(parsed)
    later = lambda i: F.slice(F.map_keys(parsed), i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0)))
    last = F.filter(entries, lambda e, i: ~F.array_contains(later(i), e["key"]))
    repeated = F.size(F.array_distinct(F.map_keys(parsed))) < F.size(parsed)
    once = F.when(repeated, F.map_from_entries(last)).otherwise(parsed)
    doc = F.transform_values(once, lambda k, v: F.to_json(v))
    blank = F.trim("value") == ""
    return raw.select(scope, F.when(blank, F.create_map().cast("map<string,string>")).otherwise(doc).alias("doc"))


def _parse_yaml(raw: DataFrame, scope: str) -> DataFrame:
    def parse(batches):
        import pandas as pd
        import yaml

        def as_json(value):
            if isinstance(value, datetime.date):  # and times with it
                return str(value)
            raise TypeError(type(value).__name__)

        def document(text):
            if text is None:
                return None
            try:
                doc = yaml.safe_load(text)
                if doc is None:
                    return {}
                if not isinstance(doc, dict):
                    return None
                return {str(k): json.dumps(v, separators=(",", ":"), ensure_ascii=False, allow_nan=False, default=as_json) for k, v in doc.items()}
            except (yaml.YAMLError, ValueError, TypeError, RecursionError):  # an impossible date, a value without a JSON form, deep nesting
                return None

        for batch in batches:
            yield pd.DataFrame({"scope": batch["scope"], "doc": [document(t) for t in batch["value"]]})

    rows = raw.select(F.col(scope).alias("scope"), "value").mapInPandas(parse, "scope string, doc map<string,string>")
    return rows.withColumnRenamed("scope", scope)


def _documents(spark: SparkSession, path: str, scope: str, fmt: str, many: bool) -> DataFrame:
    if fmt not in _GLOB:
        raise ValueError(fmt)
    parse = _parse_json if fmt == "json" else _parse_yaml
    return parse(_read_raw(spark, path, scope, fmt, many), scope)


def scan_documents(spark: SparkSession, path: str, scope: str, fmt: str = "json", many: bool = False) -> DataFrame:
    """Documents under ``path``, one row each: (<scope>, doc MAP key -> JSON
    text), secret values replaced. No shuffle; bad documents are left out (see
    ``bad_documents``)."""
    docs = _documents(spark, path, scope, fmt, many).where(F.col("doc").isNotNull())
    return docs.select(scope, J.redacted_document("doc").alias("doc"))


def bad_documents(spark: SparkSession, path: str, scope: str, fmt: str = "json", many: bool = False) -> DataFrame:
    """Documents under ``path`` that don't parse or are not mappings:
    (<scope>, problem)."""
    bad = _documents(spark, path, scope, fmt, many).where(F.col("doc").isNull())
    return bad.select(scope, F.lit("malformed").alias("problem"))


def scan_layers(spark: SparkSession, path: str, scope: str | None = None, fmt: str = "json", many: bool = False) -> DataFrame:
    """Rows ``(<scope>, key, value)`` for every top-level key of every
    document under ``path``; ``scope=None`` for a single-document layer
    (defaults) gives ``(key, value)``. An empty document gives no rows."""
    docs = scan_documents(spark, path, scope or "__scope", fmt, many)
    return docs.select(*([scope] if scope else []), F.explode("doc").alias("key", "value"))


def document_line(scope: Column, document: Column) -> Column:
    """One line of the many-documents layout."""
    return F.concat(F.url_encode(scope), F.lit("\t"), document)


def write_documents(docs: DataFrame, path: str, scope: str) -> None:
    """Write document rows (<scope>, doc MAP key -> JSON text) in the
    many-documents layout, keys sorted: as many files as partitions."""
    member = F.transform(F.array_sort(F.map_entries("doc")), lambda e: F.concat(J.quote(e["key"]), F.lit(":"), e["value"]))
    text = F.concat(F.lit("{"), F.array_join(member, ","), F.lit("}"))
    docs.select(document_line(F.col(scope), text).alias("value")).write.text(path)


#: Folders that one task lists.
FOLDERS_PER_TASK = 512
_LISTED = "path string, is_file boolean"


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``: its place under it. Folders are listed level by
    level, those of a level by as many tasks as they ask for, and a level is a
    written table, so that no listing passes through the driver. As with Spark's
    readers, names that begin with a dot or an underscore don't show."""
    importable(spark)
    store, root = stored_at(path)
    root = root.rstrip("/")

    def shown(name: str) -> bool:
        return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))

    def below(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        rows = []
        for folder in (folder for batch in batches for folder in batch["path"]):
            found = store.get_file_info(pafs.FileSelector(root + folder))
            rows += [(f.path[len(root) :], f.type == pafs.FileType.File) for f in found if shown(f.base_name)]
            if len(rows) >= 10000:
                yield pd.DataFrame(rows, columns=["path", "is_file"])
                rows = []
        yield pd.DataFrame(rows, columns=["path", "is_file"]).astype({"is_file": bool})

    level, tasks = spark.createDataFrame([("", False)], _LISTED), 1
    files = []
    while tasks:
        folders = level.where(~F.col("is_file")).select("path").repartition(tasks, "path")
        level = write_table(folders.mapInPandas(below, _LISTED), "listed")
        files.append(level.where("is_file").select("path"))
        tasks = -(-level.where(~F.col("is_file")).count() // FOLDERS_PER_TASK)
    return reduce(DataFrame.unionByName, files)


def list_artifacts(spark: SparkSession, path: str, glob: str = "*", folders: bool = False) -> DataFrame:
    """Files below the folder ``path`` with a name that matches ``glob``: (path,
    scope, file, stem), scope being the parent folder (a cluster's work folder).
    With ``folders``, what a partitioned write left:
    ``cluster_name=<scope>/file=<file>/<part>``. Files are listed, never opened."""
    store, at = hadoop(spark, path)
    if not store.exists(at):
        raise FileNotFoundError(path)
    matching = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    base = store.makeQualified(at).toString().rstrip("/")
    named = F.substring_index("path", "/", -1).rlike(rf"(?s)\A(?:{matching})\z")
    files = _listed(spark, path).where(named).select(F.concat(F.lit(base), "path").alias("path"))
    if folders:
        part = lambda name: F.url_decode(F.url_decode(F.regexp_extract("path", f"/{name}=([^/]+)/", 1)))
        scope, file = part("cluster_name"), part("file")
    else:
        scope, file = (F.url_decode(F.regexp_extract("path", p, 1)) for p in (r"([^/]+)/[^/]+$", r"([^/]+)$"))
    return files.select("path", scope.alias("scope"), file.alias("file"), F.regexp_extract(file, r"^(.+?)(\.[^.]*)?$", 1).alias("stem"))
