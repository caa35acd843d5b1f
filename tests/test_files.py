"""Data sources over small and growing files, and messages over micro-batches."""

import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetplan.operators.runs import join_multiline, parse_logs
from fleetplan.sources import files
from fleetplan.sources.logs import scan_logs
from fleetplan.streaming import logs as log_stream


def _folder(name):
    return tempfile.mkdtemp(prefix=f"fleetplan-{name}-")


def _write(path, content, mode="wb"):
    with open(path, mode) as fh:
        fh.write(content)


def test_one_row_for_each_file(spark):
    d = _folder("docs")
    contents = {"007": b"site: a\nvcenter_password: pw\nn: null\n", "a+b %41": b"x: '1'\nx: 2\n", "empty": b"# nothing\n", "blank": b"", "bom": b"\xef\xbb\xbfx: 1\n",
                "cut": b"site: [x", "bytes": b"x: \xff\n", "list": b"- a\n", "nan": b"x: .nan\n", "date": b"x: 2026-13-45\n", "binary": b"x: !!binary aGk=\n"}
    for name, content in contents.items():
        _write(os.path.join(d, f"{name}.yaml"), content)
    _write(os.path.join(d, "other.txt"), b"x: 1\n")
    rows = {r.c: (r.doc, r.problem) for r in files.document_files(spark, d, "c").collect()}
    good = {"007": {"site": '"a"', "vcenter_password": '"<redacted>"', "n": "null"}, "a+b %41": {"x": "2"}, "empty": {}, "blank": {}, "bom": {"x": "1"}}
    assert rows == {n: (good.get(n), None if n in good else "malformed") for n in contents}


def test_simple_documents_are_what_the_parser_makes_of_them(monkeypatch):
    rng = random.Random(3)
    values = ['"a-1"', '""', '"x # y"', "12", "0o7", "017", "1_000", "1.5", "1e3", "yes", "null", "true", "No", "2026-01-02", "2026-13-45", "0x1F", "1.", "a.b", "x-", '"32G"',
              "[]", "[8,9]", "[8, 9]", '["10.1.2.3","b"]', "[a]", "[1.5, yes]", "{}", "[[1]]", "~", ".nan", "'q'", "a: b", "a #c", "x ", '"a\\n"', '"é"', "12:30:00", "- a", "&a", "*a", "!!str x", "|", "", "[x", "9" * 5000, "1:2", "=", "<<"]
    keys = ["site", "x", "yes", "null", "n", "a1", "on", "y", "y_", "e1", '"q"', "A", "1"]
    simple = whole = 0
    for _ in range(6000):
        lines = [f"{rng.choice(keys)}: {rng.choice(values[:25] if rng.random() < 0.8 else values)}" for _ in range(rng.randint(1, 4))]
        text = "\n".join(lines) + rng.choice(("", "\n", "\n", "\n\n"))
        got = files.parsed_document(text.encode(), "yaml")
        simple += files._simple_document(text) is not None
        with monkeypatch.context() as m:
            m.setattr(files, "_simple_document", lambda text: None)
            want = files.parsed_document(text.encode(), "yaml")
        assert got == want and list(got or ()) == list(want or ()), text
        whole += want is not None
    assert 500 < simple <= whole


def test_plain_files_need_no_whole_parse(monkeypatch):
    import yaml

    asked = []
    monkeypatch.setattr(yaml, "safe_load", lambda text, load=yaml.safe_load: asked.append(text) or load(text))
    for k in range(300):
        want = {"cluster_name": f'"machinery-{k}"', "segment": f'"10.0.{k % 256}.77/24"', "offsets": "[8,9]", "vlan_id": "7"}
        assert files.parsed_document(f'cluster_name: "machinery-{k}"\nsegment: "10.0.{k % 256}.77/24"\noffsets: [8,9]\nvlan_id: 7\n'.encode(), "yaml") == want
    assert len(asked) < 20


def test_json_files(spark):
    d = _folder("json")
    for name, content in {"a": '{"x": 1, "y": "1", "x": {"b": 1, "b": 2}}', "b": '{"x": NaN}', "c": "[1]", "d": '{"x": '}.items():
        _write(os.path.join(d, f"{name}.json"), content.encode())
    rows = {r.c: (r.doc, r.problem) for r in files.document_files(spark, d, "c", "json").collect()}
    assert rows == {"a": ({"x": '{"b":2}', "y": '"1"'}, None), **{n: (None, "malformed") for n in "bcd"}}
    assert files.document_files(spark, os.path.join(d, "none"), "c").count() == 0


def test_a_file_that_is_gone_costs_one_row():
    d = _folder("gone")
    reader = files.DocumentReader({"path": d})
    assert list(reader.read(files.Files((os.path.join(d, "x.yaml"),)))) == [("x", None, "unreadable")]


def test_files_are_packed_by_bytes():
    found = [(i, 10) for i in range(1000)] + [("large", 1 << 30), ("last", 0)]
    parts = files.packed(found, files.BYTES_PER_PARTITION)
    assert [name for part in parts for name in part] == [name for name, _ in found]
    assert len(parts) == 6 and parts[-2] == ("large",)
    assert files.packed([], 1) == []


def test_documents_as_a_stream_come_again_when_changed(spark):
    d, root = _folder("stream"), _folder("root")

    def step():
        docs = files.document_files(spark, d, "c", stream=True)
        writer = docs.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.c, r.x) for r in spark.read.parquet(f"{root}/out").select("c", F.col("doc")["x"].alias("x")).collect())

    _write(os.path.join(d, "a.yaml"), b"x: 1\n")
    _write(os.path.join(d, "b.yaml"), b"x: 1\n")
    assert step() == [("a", "1"), ("b", "1")]
    assert step() == [("a", "1"), ("b", "1")]
    _write(os.path.join(d, "a.yaml"), b"x: 2\n")
    _write(os.path.join(d, "c.yaml"), b"x: 1\n")
    assert step() == [("a", "1"), ("a", "2"), ("b", "1"), ("c", "1")]


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_ended_lines_for_any_cut(monkeypatch, block):
    monkeypatch.setattr(files, "BLOCK", block)
    rng = random.Random(1)
    for _ in range(200):
        data = "".join(rng.choices("ab\n\ré", k=rng.randint(0, 30))).encode()
        want, at = [], 0
        for line in data.split(b"\n")[:-1]:
            want.append((at, line.removesuffix(b"\r").decode(errors="replace")))
            at += len(line) + 1
        cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(3))})
        got = [row for a, b in zip(cuts, cuts[1:], strict=False) for row in files.ended_lines(io.BytesIO(data), a, b)]
        assert got == want


def test_grown_files_are_cut_and_packed():
    reader = files.LogStreamReader({"path": "/", "suffix": ".log", "bytesPerPartition": str(200_000)})
    parts = [p.parts for p in reader.partitions({"/a.log": 5, "/c.log": 90}, {"/a.log": 450_005, "/b.log": 10, "/c.log": 50})]
    assert parts == [(("/a.log", 5, 200_005),), (("/a.log", 200_005, 400_005),), (("/a.log", 400_005, 450_005), ("/b.log", 0, 10)), (("/c.log", 0, 50),)]
    assert reader.partitions({"/a.log": 5}, {"/a.log": 5}) == []


def test_messages_of_growing_logs_for_any_cut(spark):
    rng = random.Random(2)
    texts = {}
    for name in ("one", "two", "007"):
        lines = []
        for i in range(120):
            start = f"2024-01-01 00:00:{i % 60:02d} [{rng.choice(('INFO', 'ERROR')):<7}] m{i}"
            lines.append(start if rng.random() < 0.4 else rng.choice((f"more {i}", "", "2026-13-45 00:00:00 [INFO   ] no")))
        texts[name] = ("\n".join(lines) + "\n").encode()
    whole, grown, root = _folder("whole"), _folder("grown"), _folder("root")
    suffix = "-bootstrap.log"
    for name, data in texts.items():
        _write(os.path.join(whole, name + suffix), data)
    want = {tuple(r) for r in join_multiline(parse_logs(scan_logs(spark, whole))).collect()}
    done = dict.fromkeys(texts, 0)
    for step in range(4):
        for name, data in texts.items():
            if name == "two" and step == 1:
                continue  # a batch without this file
            end = len(data) if step == 3 else min(len(data), done[name] + rng.randint(0, len(data) // 2))
            _write(os.path.join(grown, name + suffix), data[done[name] : end], "ab")
            done[name] = end
        log_stream.run_log_messages(spark, grown, root)
        got = [tuple(r) for r in log_stream.log_messages(spark, root).collect()]
        assert set(got) <= want and len(got) == len(set(got))
    assert set(got) == want


def test_no_messages_yet(spark):
    assert log_stream.log_messages(spark, _folder("none")).count() == 0
