"""Edge goldens and quirks: CIDR forms, name rule, three-state null, merge
precedence, readiness rules, diff properties, chunked scans."""

import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetplan.functions import ipv4, jsonvalue
from fleetplan.functions.scans import ordinal_within
from fleetplan.operators import address, config, readiness, registration, runs, validate
from fleetplan.sources.fixed_values import DEFAULTS_DOCUMENT, VARIABLE_CONTRACT


@pytest.mark.parametrize(
    "cidr,network,prefix,netmask",
    [
        ("10.0.5.77/24", "10.0.5.0", 24, "255.255.255.0"),
        ("10.0.5.130/28", "10.0.5.128", 28, "255.255.255.240"),
        ("10.0.5.7", "10.0.5.7", 32, "255.255.255.255"),
        ("0.0.0.0/0", "0.0.0.0", 0, "0.0.0.0"),
        ("10.0.5.0/255.255.255.0", "10.0.5.0", 24, "255.255.255.0"),
        ("10.0.5.0/0.0.0.255", "10.0.5.0", 24, "255.255.255.0"),
        ("10.0.5.0/024", "10.0.5.0", 24, "255.255.255.0"),
        ("10.0.5.256/24", None, None, None),
        ("010.0.5.0/24", None, None, None),
        ("10.0.5.0/33", None, None, None),
        ("fe80::/64", None, None, None),
    ],
)
def test_normalize_cidr(spark, cidr, network, prefix, netmask):
    df = spark.createDataFrame([(cidr,)], "segment string")
    row = address.normalize_cidr(df).collect()[0]
    assert (row.network, row.prefix_length, row.netmask) == (network, prefix, netmask)


PLAN_ROW = (
    "cluster_name string, name string, site string, site_known boolean, vm_network string, segment string, gateway_offset string, "
    "infra_ip_offsets string, control_plane_ip_offsets string, bootstrap_ip_offset string, compute_ip_offsets string"
)


def _fleet_row(segment, gateway="254", infra="[1]", name="c", known=True, network='"v"'):
    return ("c", name, "s", known, network, segment, gateway, infra, "[4]", "7", "[]")


def test_gateway_outside_small_segment(spark):
    df = spark.createDataFrame([_fleet_row("10.0.5.130/28")], PLAN_ROW)
    row = address.plan_addresses(df).collect()[0]
    assert row.gateway == "10.0.6.126"
    assert row.all_in_segment is False
    addrs = {r.role: r.in_segment for r in address.addresses(address.plan_addresses(df)).collect()}
    assert addrs["gateway"] is False and addrs["infra"] is True


@pytest.mark.parametrize(
    "row,rule",
    [
        (_fleet_row(""), "no_segment"),
        (_fleet_row("fd00::/64"), "ipv6_segment"),
        (_fleet_row("10.300.0.0/24"), "invalid_cidr"),
        (_fleet_row("255.255.255.200/25"), "address_out_of_range"),
        (_fleet_row("10.0.5.0/24", infra="[1,-200000000]"), "address_out_of_range"),
        (_fleet_row("10.0.5.0/24", gateway='"x"'), "address_out_of_range"),
        (_fleet_row("10.0.5.0/00000000024"), None),
        (_fleet_row("10.0.5.0/24", name="-c"), "refused"),
        (_fleet_row("10.0.5.0/24", known=False), "refused"),
        (_fleet_row("10.0.5.0/24", network="null"), "refused"),
    ],
)
def test_no_plan_for_refused_clusters(spark, row, rule):
    plan = address.plan_addresses(spark.createDataFrame([row], PLAN_ROW))
    planned = address.addresses(plan).count()
    assert (planned > 0) == (rule is None)
    assert [r.rule for r in address.check_plan(plan).collect()] == ([] if rule in (None, "refused") else [rule])


def test_quoting_is_json(spark):
    texts = ["plain", 'a"b\\c', "x\ny\t\x01", "é[]", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.q for r in df.select(jsonvalue.quote("t").alias("q")).collect()]
    assert [None if q is None else json.loads(q) for q in got] == texts


def test_messages_keep_their_continuation_lines(spark):
    text = ["before", "2024-01-01 00:00:00 [ERROR  ] a", "stderr: b", "2024-01-01 00:00:01 [DEBUG  ] c", "more", "2024-01-01 00:00:02 [INFO   ] d"]
    lines = spark.createDataFrame([("x", i * 3000, t) for i, t in enumerate(text)], "cluster_name string, line_no long, text string")
    messages = runs.join_multiline(runs.parse_logs(lines))
    rows = messages.orderBy("line_no").collect()
    assert [r.start_line for r in rows] == [None, 3000, 3000, 9000, 9000, 15000]
    assert [r.line_no for r in runs.at_least(messages, "INFO").orderBy("line_no").collect()] == [3000, 6000, 15000]
    assert {r.start_line: r.n_lines for r in runs.message_sizes(messages).collect()} == {3000: 2, 9000: 2, 15000: 1}
    parts = {(r.start_line, r.part): r.message for r in runs.message_texts(messages).collect()}
    assert parts == {(3000, 1): "a", (3000, 4): "stderr: b", (9000, 1): "c", (9000, 4): "more", (15000, 1): "d"}


def test_long_messages_come_in_parts(spark):
    text = ["2024-01-01 00:00:00 [ERROR  ] 0", *map(str, range(1, 2503))]
    lines = spark.createDataFrame([("x", i + 7, t) for i, t in enumerate(text)], "cluster_name string, line_no long, text string")
    parts = runs.message_texts(runs.join_multiline(runs.parse_logs(lines))).orderBy("part").collect()
    assert [r.part for r in parts] == [1, 2, 3]
    assert "\n".join(r.message for r in parts) == "\n".join(map(str, range(2503)))


def test_bad_log_lines_stop_nothing(spark):
    text = ["2024-01-01 00:00:00 [INFO   ] a", "2026-13-45 10:00:00 [INFO   ] x", "2024-02-30 10:00:00 [INFO   ] y", "2024-01-01 25:00:00 [INFO   ] z",
            "2024-01-01 00:00:09 [ERROR  ] failed (rc=99999999999999999999)", "2024-01-01 00:00:10 [ERROR  ] failed (rc=7)", "", None]
    lines = spark.createDataFrame([("x", i, t) for i, t in enumerate(text)], "cluster_name string, line_no long, text string")
    parsed = runs.parse_logs(lines)
    assert [r.is_start for r in parsed.orderBy("line_no").collect()] == [True, False, False, False, True, True, False, False]
    assert {r.line_no: r.start_line for r in runs.join_multiline(parsed).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 5, 6: 5, 7: 5}
    assert {(r.line_no, r.fact): r.value for r in runs.log_facts(parsed).collect()} == {(4, "rc"): None, (5, "rc"): 7}


REFUSED = [("long", "a" * 28, "s", True), ("sign", "a_b", "s", True), ("edge", "-a", "s", True), ("none", None, "s", True), ("empty", "", "s", True),
           ("no-site", "a", None, True), ("unknown", "a", "t", False)]


def test_refused_clusters_do_nothing(spark):
    """A run on a refused cluster ends before its first phase; a missing network
    name ends it later, after the segment is asked for."""
    fleet = spark.createDataFrame(
        [(c, name, site, known, '"v"', *["", '"u"', '"http://x"', '"tok"', None, None, None, None, "null"]) for c, name, site, known in REFUSED]
        + [("good", "good", "s", True, None, "", '"u"', '"http://x"', '"tok"', None, None, None, None, "null")],
        "cluster_name string, name string, site string, site_known boolean, vm_network string, segment string, vlan_manager_vrf string, "
        "argocd_hub_api_url string, argocd_hub_token string, argocd_hub_token_env string, openshift_install_bin string, terraform_bin string, "
        "wildcard_dns_api_url string, vlan_manager_url string",
    )
    flags = ("destroy", "skip_dns", "skip_terraform", "skip_csr", "skip_ignition", "skip_argocd")
    todo = spark.createDataFrame([(i, c, "h", *[False] * 6) for i, c in enumerate([*[r[0] for r in REFUSED], "good"])],
                                 "run_id long, cluster_name string, host string, " + ", ".join(f"{f} boolean" for f in flags))
    env = spark.createDataFrame([], "name string, value string")
    tools = spark.createDataFrame([], "host string, tool string")
    last = len(REFUSED)
    assert [r.cluster_name for r in address.allocation_requests(fleet).collect()] == ["good"]
    assert {r.run_id for r in runs.phase_plan(todo, fleet).collect()} == {last}
    assert {r.cluster_name for r in validate.required_tools(todo, fleet).collect()} == {"good"}
    assert {r.cluster_name for r in validate.missing_tools(todo, fleet, tools).collect()} == {"good"}
    assert {r.cluster_name for r in validate.check_conditional(todo, fleet).collect()} == {"good"}
    assert [r.run_id for r in registration.registration_candidates(todo, fleet, env).collect()] == [last]
    assert address.addresses(address.plan_addresses(fleet.withColumns({k: F.lit("1") for k in ("gateway_offset", "bootstrap_ip_offset")}).withColumns(
        {k: F.lit("[1]") for k in ("infra_ip_offsets", "control_plane_ip_offsets", "compute_ip_offsets")}).withColumn("segment", F.lit("10.0.0.0/24")))).count() == 0


def test_supplied_variables_can_fail(spark):
    good = [(n, '["a"]' if t == "list(string)" else "1") for n, t, _, _ in VARIABLE_CONTRACT]
    bad = [(n, v) for n, v in good if n != "base_domain"] + [("own", "1")]
    bad = [(n, {"infra_memory": "32G", "infra_ips": "x", "compute_count": "7"}.get(n, v)) for n, v in bad]
    rows = [("a", n, v) for n, v in good] + [("b", n, v) for n, v in bad]
    supplied = spark.createDataFrame(rows, "cluster_name string, variable string, value string")
    found = {(r.cluster_name, r.variable, r.rule) for r in validate.check_contract(supplied).collect()}
    rules = {"base_domain": "missing_required", "own": "undeclared", "infra_memory": "not_a_number", "infra_ips": "not_a_list"}
    assert found == {("b", n, r) for n, r in rules.items()}
    assert {(r.cluster_name, r.rule) for r in validate.check_counts(supplied).collect()} == {("b", "compute_count"), ("b", "infra_count")}


def test_address_beyond_range_is_null(spark):
    df = spark.createDataFrame([(4294967290,)], "n bigint")
    row = df.select(ipv4.to_text(ipv4.address_at(F.col("n"), F.lit(10))).alias("a")).collect()[0]
    assert row.a is None


@pytest.mark.parametrize(
    "name,ok",
    [("a" * 27, True), ("a" * 28, False), ("a_b", False), ("-a", False), ("a-", False), ("a\n", False), ("é1", True), ("ab-1", True)],
)
def test_name_rule(spark, name, ok):
    df = spark.createDataFrame([("x", name)], "cluster_name string, name string")
    assert (validate.check_names(df).count() == 0) == ok


def _layers(spark, cluster_rows, site_rows=(), env_rows=()):
    defaults = spark.createDataFrame(DEFAULTS_DOCUMENT, "key string, value string")
    sites = spark.createDataFrame(
        [("s", "site_name", '"s"')] + [("s", k, v) for k, v in site_rows], "site string, key string, value string"
    )
    clusters = spark.createDataFrame(
        [("c", "cluster_name", '"c"'), ("c", "site", '"s"')] + [("c", k, v) for k, v in cluster_rows],
        "cluster_name string, key string, value string",
    )
    env = spark.createDataFrame(list(env_rows), "name string, value string")
    identity = config.fleet_identity(clusters)
    eff = config.merge_layers(clusters, defaults, sites, env)
    return {r.key: (r.value, r.layer) for r in eff.collect()}, identity


def test_explicit_null_wins_and_lists_replace_whole(spark):
    eff, _ = _layers(spark, [("compute_num_cpus", "null")], [("image_mirrors", '[{"source":"a","mirror":"b"}]')])
    assert eff["compute_num_cpus"] == ("null", "cluster")
    assert eff["image_mirrors"] == ('[{"source":"a","mirror":"b"}]', "site")
    assert eff["gateway_offset"] == ("254", "defaults")
    assert "cluster_name" not in eff and "site" not in eff


def test_reference_keys(spark):
    eff, _ = _layers(
        spark,
        [("argocd_hub_token_env", '"CLUSTER_TOKEN"')],
        [("vcenter_password_env", '"PW"'), ("vcenter_password", '"plain"'), ("missing_env", '"NOPE"')],
        [("PW", "pw"), ("CLUSTER_TOKEN", "t")],
    )
    # site-level reference overwrites the site's own base key
    assert eff["vcenter_password"] == ('"<redacted>"', "env")
    # unresolved reference gives empty text
    assert eff["missing"] == ('""', "env")
    # cluster-level references are not resolved
    assert "argocd_hub_token" not in eff


def test_identity_reads_cluster_layer_only(spark):
    _, identity = _layers(spark, [("vlan_id", "105")], [("segment", '"10.9.9.0/24"')])
    row = identity.collect()[0]
    assert (row.segment, row.vlan_id) == ("", "105")


def test_merge_idempotent_and_empty_layer(spark):
    a, _ = _layers(spark, [("x", "1")])
    b, _ = _layers(spark, [("x", "1")], [])
    assert a == b


def _poll(spark, rows):
    return spark.createDataFrame(rows, "run_id long, poll_id long, polled_at timestamp_ntz, csr_json string, version_json string")


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
AV = '{"status":{"conditions":[{"type":"Available","status":"True"}]}}'
NOT = '{"status":{"conditions":[{"type":"Available","status":"False"}]}}'


def test_pending_forms(spark):
    items = [
        '{"metadata":{"name":"a"},"status":{}}',
        '{"metadata":{"name":"b"}}',
        '{"metadata":{"name":"c"},"status":{"conditions":[]}}',
        '{"metadata":{"name":"d"},"status":{"conditions":null}}',
        '{"metadata":{"name":"e"},"status":{"conditions":[{"type":"Denied","status":"True"}]}}',
    ]
    polls = _poll(spark, [(1, 1, T0, '{"items":[' + ",".join(items) + "]}", NOT)])
    row = readiness.pending_per_poll(polls).collect()[0]
    assert (row.n_pending, row.pending) == (4, "a,b,c,d")


def test_time_to_available_rules(spark):
    two = '{"status":{"conditions":[{"type":"Available","status":"True"},{"type":"Available","status":"True"}]}}'
    polls = _poll(spark, [
        (1, 1, T0, '{"items":[]}', NOT),
        (1, 2, T0 + dt.timedelta(seconds=90), '{"items":[', AV),  # malformed list: skipped
        (1, 3, T0 + dt.timedelta(seconds=120), '{"items":[]}', two),  # two matches: not available
        (1, 4, T0 + dt.timedelta(seconds=150.7), '{"items":[]}', AV),
        (2, 5, T0, '{"items":[]}', NOT),
        (2, 6, T0 + dt.timedelta(minutes=45), '{"items":[]}', AV),  # at the deadline: too late
    ])
    got = {r.run_id: (r.status, r.seconds) for r in readiness.time_to_available(polls, 45).collect()}
    assert got == {1: ("available", 150), 2: ("timed_out", None)}
    assert {r.run_id: r.status for r in readiness.time_to_available(polls, 0).collect()} == {1: "timed_out", 2: "timed_out"}


def test_first_non_empty(spark):
    att = spark.createDataFrame(
        [(1, i, "") for i in range(1, 12)] + [(1, 11, "tok"), (2, 3, "  "), (2, 4, "x")], "run_id long, attempt int, value string"
    )
    got = {r.run_id: (r.attempt, r.status) for r in readiness.first_non_empty(att).collect()}
    assert got == {1: (None, "failed"), 2: (4, "ok")}


def test_diff_of_itself_is_unchanged(spark):
    df = spark.createDataFrame([("c", "n1", 1), ("c", "n2", 2)], "cluster_name string, fqdn string, memory int")
    assert {r.action for r in runs.diff_state(df, df, ["cluster_name", "fqdn"], ["memory"]).collect()} == {"unchanged"}
    other = spark.createDataFrame([("c", "n1", 5), ("c", "n3", 2)], "cluster_name string, fqdn string, memory int")
    got = {r.fqdn: r.action for r in runs.diff_state(df, other, ["cluster_name", "fqdn"], ["memory"]).collect()}
    assert got == {"n1": "update", "n2": "create", "n3": "delete"}
    keys = {r.fqdn: r.action for r in runs.diff_state(df, other, ["cluster_name", "fqdn"], mode="keys_only").collect()}
    assert keys == {"n1": "unchanged", "n2": "create", "n3": "forget"}


def test_chunked_ordinal_equals_row_number(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ours = ordinal_within(ev, ["user_id"], ["ts", "event_id"], F.expr("unix_micros(cast(ts AS timestamp)) div 3600000000"), "o")
    ref = ev.withColumn("o", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    a = sorted((r.event_id, r.o) for r in ours.select("event_id", "o").collect())
    b = sorted((r.event_id, r.o) for r in ref.select("event_id", "o").collect())
    assert a == b
