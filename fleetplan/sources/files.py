"""Python data sources over many small files and growing ones.

``fleet_documents`` reads one configuration document per file, the layout that
people write: ``<root>/<id>.yaml`` or ``.json``. Files are packed into partitions
by bytes, so that a million files of a few hundred bytes are a few hundred tasks,
and a file that doesn't parse, isn't UTF-8 or can't be read costs one row. As a
stream it gives every file once, and again when it has changed.

``fleet_logs`` reads logs while they grow, as a stream: each micro-batch has the
lines that were ended since the last one, whole lines only.

Both list and read through ``pyarrow.fs``, which knows local paths, HDFS and
object stores.
"""

from __future__ import annotations

import datetime
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions import jsonvalue as J
from ..session import importable

SUFFIXES = {"json": (".json",), "yaml": (".yaml", ".yml")}
BYTES_PER_PARTITION = 16 << 20
FILE_COST = 64 << 10  # what opening a file counts as, so that tiny files don't gather without end
BLOCK = 1 << 20


def stored_at(path: str) -> tuple[pafs.FileSystem, str]:
    if not urlsplit(path).scheme:
        path = os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


def _listed(path: str, suffixes: tuple[str, ...]) -> list[pafs.FileInfo]:
    """The files directly under ``path`` with one of the suffixes, by name."""
    store, root = stored_at(path)
    found = store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted((f for f in found if f.type == pafs.FileType.File and f.base_name.endswith(suffixes)), key=lambda f: f.path)


# ------------------------------------------------------------------- documents
def _as_json(value: object) -> str:
    if isinstance(value, datetime.date):  # and times with it
        return str(value)
    raise TypeError(type(value).__name__)


def _no_constant(name: str) -> None:
    raise ValueError(name)


#: A line of a block mapping that means the same wherever it stands: a plain key,
#: then a word, a number, a text in double quotes or a flow list of these, in
#: printable ASCII without anything that YAML reads in more than one way.
_SCALAR = r'(?:"[A-Za-z0-9 _.:/#@<>=+-]*"|[A-Za-z0-9][A-Za-z0-9_.-]{0,99})'
_LINE = re.compile(rf"([a-z][a-z0-9_]{{0,99}}): ({_SCALAR}|\[(?:{_SCALAR}(?:, ?{_SCALAR})*)?\])")
_TEXT = re.compile(r'"[^"]*"')


def _json_text(value: object) -> str:
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False, allow_nan=False, default=_as_json)


@lru_cache(maxsize=1 << 14)
def _simple_value(text: str) -> str:
    import yaml

    return _json_text(yaml.safe_load(text))


@lru_cache(maxsize=1 << 12)
def _simple_key(text: str) -> str:
    import yaml

    return str(yaml.safe_load(text))


def _simple_document(text: str) -> dict[str, str] | None:
    """What the YAML parser makes of a document of simple lines alone, each value
    parsed once; None for any other document, and for one that doesn't parse."""
    found = {}
    for line in text.removesuffix("\n").split("\n"):
        if not (m := _LINE.fullmatch(line)):
            return None
        key, value = m.groups()
        try:
            found[_simple_key(key)] = value if _TEXT.fullmatch(value) else _simple_value(value)
        except Exception:  # the whole document says what is wrong
            return None
    return found


def parsed_document(data: bytes, fmt: str) -> dict[str, str] | None:
    """Top-level keys of a document with their JSON texts; None where it
    doesn't parse, is not a mapping, or holds a value without a JSON form. Of
    repeated keys the last counts; a blank document has no keys."""
    import yaml

    try:
        text = data.decode("utf-8-sig")
        if not text.strip():
            return {}
        if fmt == "yaml" and (simple := _simple_document(text)) is not None:
            return simple
        doc = json.loads(text, parse_constant=_no_constant) if fmt == "json" else yaml.safe_load(text)
        if doc is None and fmt == "yaml":
            return {}
        if not isinstance(doc, dict):
            return None
        return {str(k): _json_text(v) for k, v in doc.items()}
    except (yaml.YAMLError, ValueError, TypeError, RecursionError):
        return None


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def packed(items: Iterable[tuple[object, int]], limit: int) -> list[tuple]:
    """(item, bytes) in order, as groups of about ``limit`` bytes; a larger item
    is a group of its own."""
    out, held, size = [], [], 0
    for item, cost in items:
        if held and size + cost + FILE_COST > limit:
            out.append(tuple(held))
            held, size = [], 0
        held.append(item)
        size += cost + FILE_COST
    return [*out, tuple(held)] if held else out


class _Documents:
    """What batch and stream reader share."""

    def __init__(self, options: dict[str, str]):
        self.path, self.format = options["path"], options.get("format", "yaml")
        if self.format not in SUFFIXES:
            raise ValueError(self.format)
        self.limit = int(options.get("bytesPerPartition", BYTES_PER_PARTITION))

    def listed(self) -> list[pafs.FileInfo]:
        return _listed(self.path, SUFFIXES[self.format])

    def planned(self, files: list[pafs.FileInfo]) -> list[Files]:
        return [Files(paths) for paths in packed(((f.path, f.size or 0) for f in files), self.limit)]

    def read(self, partition: Files | None) -> Iterator[tuple]:
        store, _ = stored_at(self.path)
        for path in partition.paths if partition else ():  # without files Spark asks for one partition of nothing
            scope, problem, doc = os.path.splitext(os.path.basename(path))[0], None, None
            try:
                with store.open_input_stream(path) as file:
                    doc = parsed_document(file.read(), self.format)
                problem = "malformed" if doc is None else None
            except OSError:  # gone since it was listed, or not readable
                problem = "unreadable"
            yield scope, doc, problem


class DocumentReader(_Documents, DataSourceReader):
    def partitions(self) -> list[Files]:
        return self.planned(self.listed())


class DocumentStreamReader(_Documents, DataSourceStreamReader):
    """The offset is the time and path of the newest file given out so far; a
    file that is written or changed later comes after it. (A file moved in with
    an older time than that is not seen: write, don't move.)"""

    @staticmethod
    def _place(file: pafs.FileInfo) -> list:
        return [file.mtime_ns, file.path]

    def initialOffset(self) -> dict:
        return {"after": [0, ""]}

    def latestOffset(self) -> dict:
        return {"after": max(map(self._place, self.listed()), default=[0, ""])}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        new = [f for f in self.listed() if start["after"] < self._place(f) <= end["after"]]
        return self.planned(new)


class DocumentSource(DataSource):
    """One row per file: scope (the file's stem), doc (map of key to JSON text;
    null with a problem), problem (null, 'malformed' or 'unreadable')."""

    @classmethod
    def name(cls) -> str:
        return "fleet_documents"

    def schema(self) -> str:
        return "scope string, doc map<string,string>, problem string"

    def reader(self, schema) -> DocumentReader:
        return DocumentReader(self.options)

    def streamReader(self, schema) -> DocumentStreamReader:
        return DocumentStreamReader(self.options)


def document_files(spark: SparkSession, path: str, scope: str, fmt: str = "yaml", stream: bool = False) -> DataFrame:
    """The documents under ``path``, one file each: (<scope>, doc, problem),
    secret values replaced."""
    importable(spark)
    spark.dataSource.register(DocumentSource)
    reader = spark.readStream if stream else spark.read
    rows = reader.format("fleet_documents").option("path", path).option("format", fmt).load()
    return rows.select(F.col("scope").alias(scope), J.redacted_document("doc").alias("doc"), "problem")


# ------------------------------------------------------------------------ logs
@dataclass
class Stretches(InputPartition):
    parts: tuple[tuple[str, int, int], ...]  # path, first byte, byte after the last


def ended_lines(file, start: int, end: int) -> Iterator[tuple[int, str]]:
    """(start of the line, its text) of every line whose newline lies in the
    bytes from ``start`` to before ``end``. The first may have begun earlier."""
    at = start
    while at > 0:  # back to the newline before
        step = min(BLOCK, at)
        file.seek(at - step)
        found = file.read(step).rfind(b"\n")
        at = at - step + found + 1 if found >= 0 else at - step
        if found >= 0:
            break
    file.seek(at)
    held, left = b"", end - at
    while left > 0 and (block := file.read(min(BLOCK, left))):
        left -= len(block)
        *lines, held = (held + block).split(b"\n")
        for line in lines:
            yield at, line.removesuffix(b"\r").decode(errors="replace")
            at += len(line) + 1


class LogStreamReader(DataSourceStreamReader):
    """The offset holds how many bytes of each file are read. A file that has
    become shorter was replaced and is read from its start again."""

    def __init__(self, options: dict[str, str]):
        self.path, self.suffix = options["path"], options["suffix"]
        self.limit = int(options.get("bytesPerPartition", BYTES_PER_PARTITION))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {f.path: f.size for f in _listed(self.path, (self.suffix,)) if f.size}

    def partitions(self, start: dict, end: dict) -> list[Stretches]:
        """What each file has grown by, cut into stretches, so that a file that
        grew by much is read by many tasks; small ones are packed."""
        begun = {path: start.get(path, 0) if start.get(path, 0) <= size else 0 for path, size in end.items()}
        parts = [(path, at, min(at + self.limit, size)) for path, size in end.items() for at in range(begun[path], size, self.limit)]
        return [Stretches(group) for group in packed(((p, p[2] - p[1]) for p in parts), self.limit)]

    def read(self, partition: Stretches | None) -> Iterator[tuple]:
        store, _ = stored_at(self.path)
        for path, start, end in partition.parts if partition else ():
            cluster = os.path.basename(path).removesuffix(self.suffix)
            with store.open_input_file(path) as file:
                for at, text in ended_lines(file, start, end):
                    yield cluster, at, text


class LogSource(DataSource):
    """One row per ended line: cluster_name, at (its first byte in the file), text."""

    @classmethod
    def name(cls) -> str:
        return "fleet_logs"

    def schema(self) -> str:
        return "cluster_name string, at long, text string"

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)


def log_stream(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Lines of growing logs ``<path>/<cluster><suffix>`` as a stream."""
    importable(spark)
    spark.dataSource.register(LogSource)
    return spark.readStream.format("fleet_logs").option("path", path).option("suffix", suffix).load()
