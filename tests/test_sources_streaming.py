"""File sources and sinks (S1, S2, S5, S6, S7) and streaming readiness."""

import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetplan.operators import config, readiness
from fleetplan.plans import staging, views
from fleetplan.sources.documents import bad_documents, list_artifacts, scan_layers
from fleetplan.sources.logs import read_clusters, remove_clusters, replace_clusters, scan_logs, write_context
from fleetplan.streaming import readiness as stream
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("fmt", ["json", "yaml"])
def test_documents_round_trip(spark, fmt):
    path = staging.stage_cluster_documents(spark, SF_SMALL, fmt)
    back = scan_layers(spark, path, "cluster_name", fmt, many=True)
    docs = config.redacted_documents(views.cluster_docs(views.fleet_seed(spark, SF_SMALL)))
    orig = docs.select("cluster_name", F.explode("doc").alias("key", "value"))
    back = back.where(~F.col("cluster_name").endswith("-twice"))
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


@pytest.mark.parametrize(
    "fmt,text",
    [("json", '{"site": "a"'), ("json", "[1, 2]"), ("json", '{"x": {"a": 1, "a": 2}}'), ("yaml", "site: [a"), ("yaml", "- a\n- b\n"),
     ("yaml", "x: 2026-13-45\n"), ("yaml", "x: .nan\n"), ("yaml", "x: [1, .inf]\n"), ("yaml", "x: !!binary aGk=\n"), ("yaml", "x: !!set {a}\n"),
     ("yaml", "[" * 5000)],
)
def test_bad_documents_are_listed(spark, fmt, text):
    d = tempfile.mkdtemp(prefix="fleetplan-bad-")
    for name, content in [("007", text), ("good", "{}" if fmt == "json" else "site: a\nvcenter_password: pw\n")]:
        with open(os.path.join(d, f"{name}.{fmt}"), "w") as fh:
            fh.write(content)
    assert [tuple(r) for r in bad_documents(spark, d, "cluster_name", fmt).collect()] == [("007", "malformed")]
    rows = {r.key: r.value for r in scan_layers(spark, d, "cluster_name", fmt).collect()}
    assert rows == ({} if fmt == "json" else {"site": '"a"', "vcenter_password": '"<redacted>"'})


@pytest.mark.parametrize("fmt", ["json", "yaml"])
def test_bad_ids_and_repeated_keys(spark, fmt):
    d = tempfile.mkdtemp(prefix="fleetplan-ids-")
    with open(os.path.join(d, "many.txt"), "w") as fh:
        fh.write('a%zz\t{"x": 1}\n%41+b\t{"x": 1, "y": null, "x": "2"}\nnothing\t\nno tab\n\n')
    assert [tuple(r) for r in bad_documents(spark, d, "c", fmt, many=True).collect()] == [("a%zz", "malformed")]
    rows = [tuple(r) for r in scan_layers(spark, d, "c", fmt, many=True).collect()]
    assert sorted(rows) == [("A b", "x", '"2"'), ("A b", "y", "null")]


def test_file_names_are_ids(spark):
    d = tempfile.mkdtemp(prefix="fleetplan-names-")
    for name in ("a+b", "a%zz", "a b", "é"):
        with open(os.path.join(d, f"{name}.json"), "w") as fh:
            fh.write('{"x": 1}')
    assert sorted(r.c for r in scan_layers(spark, d, "c").collect()) == ["a b", "a%zz", "a+b", "é"]


def test_yaml_dates_are_text(spark):
    d = tempfile.mkdtemp(prefix="fleetplan-dates-")
    with open(os.path.join(d, "c.yaml"), "w") as fh:
        fh.write("x: 2026-01-02\ny: [2026-01-02 03:04:05]\n")
    assert {r.key: r.value for r in scan_layers(spark, d, "c", "yaml").collect()} == {"x": '"2026-01-02"', "y": '["2026-01-02 03:04:05"]'}


def test_yaml_documents_keep_three_states(spark):
    d = tempfile.mkdtemp(prefix="fleetplan-yaml-")
    with open(os.path.join(d, "my-cluster-01.yaml"), "w") as fh:
        fh.write("cluster_name: my-cluster-01\nsite: site-a\nvlan_id: '105'\ncompute_ip_offsets: [8, 9]\nsearch_domain:\n")
    with open(os.path.join(d, "empty.yaml"), "w") as fh:
        fh.write("# no keys\n")
    rows = {(r.cluster_name, r.key): r.value for r in scan_layers(spark, d, "cluster_name", fmt="yaml").collect()}
    assert rows == {
        ("my-cluster-01", "cluster_name"): '"my-cluster-01"',
        ("my-cluster-01", "site"): '"site-a"',
        ("my-cluster-01", "vlan_id"): '"105"',
        ("my-cluster-01", "compute_ip_offsets"): "[8,9]",
        ("my-cluster-01", "search_domain"): "null",
    }


def test_json_documents_by_file_stem(spark):
    d = tempfile.mkdtemp(prefix="fleetplan-json-")
    with open(os.path.join(d, "site-a.json"), "w") as fh:
        fh.write('{"site_name": "site-a", "dns_servers": ["10.100.0.10"], "x": 1, "y": "1", "z": null}')
    rows = {r.key: r.value for r in scan_layers(spark, d, "site").collect()}
    assert rows == {"site_name": '"site-a"', "dns_servers": '["10.100.0.10"]', "x": "1", "y": '"1"', "z": "null"}


def test_list_artifacts(spark):
    d = tempfile.mkdtemp(prefix="fleetplan-art-")
    for c, f in [("c1", "terraform.tfvars"), ("c1", "terraform.tfstate"), ("c2", "terraform.tfvars")]:
        os.makedirs(os.path.join(d, c), exist_ok=True)
        open(os.path.join(d, c, f), "w").write("x")
    got = sorted((r.scope, r.file) for r in list_artifacts(spark, d, "terraform.*").collect())
    assert got == [("c1", "terraform.tfstate"), ("c1", "terraform.tfvars"), ("c2", "terraform.tfvars")]


def test_log_lines_keep_file_order(spark):
    path = staging.stage_logs(spark, SF_SMALL)
    got = scan_logs(spark, path, suffix=None)
    ref = views.log_lines(spark, SF_SMALL).withColumn(
        "line_no", F.row_number().over(Window.partitionBy("cluster_name").orderBy("line_no")).cast("bigint")
    )
    assert got.count() == ref.count() and got.exceptAll(ref).count() == 0


def test_log_file_stem_layout(spark):
    d = tempfile.mkdtemp(prefix="fleetplan-logs-")
    with open(os.path.join(d, "my-cluster-01-bootstrap.log"), "w") as fh:
        fh.write("2024-01-01 00:00:00 [INFO   ] a\nstderr: b\n2024-01-01 00:00:01 [ERROR  ] c\n")
    rows = [(r.cluster_name, r.line_no, r.text) for r in scan_logs(spark, d).orderBy("line_no").collect()]
    assert [r[1] for r in rows] == [1, 2, 3] and rows[1][2] == "stderr: b" and rows[0][0] == "my-cluster-01"


def test_sinks_drop_secrets_and_isolate_clusters(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="fleetplan-sink-"), "ctx")
    ctx = spark.createDataFrame(
        [("a", "k", '"v"'), ("a", "vcenter_password", '"s"'), ("a", "n", "null"), ("b", "k", '"w"')],
        "cluster_name string, key string, value string",
    )
    write_context(ctx, d, 8)
    names = lambda: sorted((r.cluster_name, r.value) for r in read_clusters(spark, d).collect())
    assert names() == [("a", '"v"'), ("b", '"w"')]
    schema = "cluster_name string, key string, value string"
    replace_clusters(spark, spark.createDataFrame([("a", "k", '"new"'), ("c", "k", '"x"')], schema), d, 8)
    assert names() == [("a", '"new"'), ("b", '"w"'), ("c", '"x"')]
    remove_clusters(spark, spark.createDataFrame([("a",), ("zz",)], "cluster_name string"), d, 8)
    assert names() == [("b", '"w"'), ("c", '"x"')]
    assert len([f for f in os.listdir(d) if f.startswith("bucket=")]) <= 2


def test_streaming_equals_batch(spark):
    table = stream.run_time_to_available(spark, stream.poll_stream(spark, SF_SMALL), 2880, finish=True)
    st = stream.current_time_to_available(spark, table, 2880)
    bt = readiness.time_to_available(views.polls(spark, SF_SMALL), 2880)
    assert st.count() == bt.count() and st.exceptAll(bt).count() == 0

    out = stream.run_poll_buckets(spark, stream.poll_stream(spark, SF_SMALL), finish=True)
    sb = stream.poll_buckets_table(spark, out)
    bb = readiness.poll_buckets(views.polls(spark, SF_SMALL))
    assert sb.exceptAll(bb).count() == 0 and bb.exceptAll(sb).count() == 0


def test_unfinished_windows_wait(spark):
    out = stream.run_poll_buckets(spark, stream.poll_stream(spark, SF_SMALL))
    sb, bb = stream.poll_buckets_table(spark, out), readiness.poll_buckets(views.polls(spark, SF_SMALL))
    assert sb.exceptAll(bb).count() == 0 and 0 < sb.count() < bb.count()


def test_artifacts_are_files_in_work_folders(spark):
    path = staging.stage_artifacts(spark, SF_SMALL)
    got = list_artifacts(spark, path).select("scope", "file")
    want = views.artifacts(views.fleet_seed(spark, SF_SMALL))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_artifacts_of_odd_names(spark, monkeypatch):
    names = [(1, None), (2, "_x"), (4, ".y"), (7, "a/b c+%"), (7, "a/b c+%")]
    monkeypatch.setattr(views, "fleet_seed", lambda *_: spark.createDataFrame(names, "k long, cluster_name string"))
    got = {(r.scope, r.file) for r in list_artifacts(spark, staging.stage_artifacts(spark, SF_SMALL)).collect()}
    scopes = ["__HIVE_DEFAULT_PARTITION__", "_x", ".y", "a/b c+%"]
    assert got == {(scope, f"terraform.{x}") for scope in scopes for x in ("tfvars", "tfstate")}


def test_listing_by_levels(spark, monkeypatch):
    from fleetplan.sources import documents

    monkeypatch.setattr(documents, "FOLDERS_PER_TASK", 1)
    d = tempfile.mkdtemp(prefix="fleetplan-art-")
    for place in ("top.x", "a/one.x", "a/b c/two.y", "a/b c/.hidden", "_tmp/gone.x", "p=1/_q=2/three.z"):
        os.makedirs(os.path.dirname(os.path.join(d, place)), exist_ok=True)
        open(os.path.join(d, place), "w").close()
    os.makedirs(os.path.join(d, "empty"))
    got = {r.path: (r.scope, r.file, r.stem) for r in list_artifacts(spark, d, "*.{x,y,z}").collect()}
    assert got == {
        f"file:{d}/top.x": (os.path.basename(d), "top.x", "top"),
        f"file:{d}/a/one.x": ("a", "one.x", "one"),
        f"file:{d}/a/b c/two.y": ("b c", "two.y", "two"),
        f"file:{d}/p=1/_q=2/three.z": ("_q=2", "three.z", "three"),
    }


def test_many_logs_to_a_file(spark):
    path = staging.stage_logs(spark, SF_SMALL)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = tempfile.mkdtemp(prefix="fleetplan-logs-")
    for n, lines in [(100000, ["a%2Fb\tlast"]), (2, ["a%2Fb\tone\ttab", "c\tx", "a%2Fb\ttwo"])]:
        with open(os.path.join(d, f"part-{n:05d}-x.txt"), "w") as file:
            file.write("\n".join(lines) + "\n")
    os.makedirs(os.path.join(d, "cluster_name=p%2520q", "part_no=1"))
    with open(os.path.join(d, "cluster_name=p%2520q", "part_no=1", "part-00000-x.txt"), "w") as file:
        file.write("plain\n")
    rows = {tuple(r) for r in scan_logs(spark, d, suffix=None).collect()}
    assert rows == {("a/b", 1, "one\ttab"), ("a/b", 2, "two"), ("a/b", 3, "last"), ("c", 1, "x"), ("p%20q", 1, "plain")}
