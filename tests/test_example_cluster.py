"""Hand-worked goldens from the tool's one concrete example (FIXTURES.md §2):
the example cluster on site-a with the global defaults, no VLAN id. Its file is
called example-cluster.yaml, its name is my-cluster-01."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetplan.operators import address, config, dns, nodes, runs
from fleetplan.sources.documents import scan_documents
from fleetplan.sources.fixed_values import DEFAULTS_DOCUMENT

SITE_A = [
    ("site_name", '"site-a"'),
    ("vcenter", '"vcenter.site-a.example.local"'),
    ("vcenter_user", '"administrator@vsphere.local"'),
    ("vcenter_password_env", '"VSPHERE_PASSWORD"'),
    ("datacenter", '"DC-SiteA"'),
    ("vsphere_cluster", '"Cluster-Prod-01"'),
    ("vsphere_datastore_cluster", '"DSC-Prod-SiteA"'),
    ("vsphere_dvs_name", '"DVS-Prod-SiteA"'),
    ("vsphere_folder", '"/DC-SiteA/vm/OCP-Clusters"'),
    ("vm_template", '"rhcos-420"'),
    ("base_domain", '"ocp.example.local"'),
    ("search_domain", '"example.local"'),
    ("dns_servers", '["10.100.0.10","10.100.0.11"]'),
]
CLUSTER = [
    ("cluster_name", '"my-cluster-01"'),
    ("site", '"site-a"'),
    ("segment", '"10.0.5.0/24"'),
    ("vm_network", '"VLAN105-OCP"'),
]


def _example(spark):
    defaults = spark.createDataFrame(DEFAULTS_DOCUMENT, "key string, value string")
    sites = spark.createDataFrame([("site-a", k, v) for k, v in SITE_A], "site string, key string, value string")
    folder = tempfile.mkdtemp(prefix="fleetplan-example-")
    with open(os.path.join(folder, "example-cluster.yaml"), "w") as file:
        file.writelines(f"{k}: {v}\n" for k, v in CLUSTER)
    clusters = scan_documents(spark, folder, "cluster_name", "yaml")
    env = spark.createDataFrame([("VSPHERE_PASSWORD", "secret")], "name string, value string")
    settings = config.merge_settings(clusters, defaults, sites, env)
    allocs = spark.createDataFrame([], "cluster_name string, site string, segment string, vlan_id bigint")
    plan = address.plan_addresses(address.apply_allocations(settings, allocs))
    return settings, plan


def test_plan_matches_expectation_table(spark):
    settings, plan = _example(spark)
    row = plan.collect()[0]
    assert (row.cluster_name, row.name) == ("example-cluster", "my-cluster-01")
    assert (row.network, row.prefix_length, row.netmask) == ("10.0.5.0", 24, "255.255.255.0")
    assert (row.gateway, row.bootstrap_ip) == ("10.0.5.254", "10.0.5.7")
    assert row.infra_ips == ["10.0.5.1", "10.0.5.2", "10.0.5.3"]
    assert row.control_plane_ips == ["10.0.5.4", "10.0.5.5", "10.0.5.6"]
    assert row.compute_ips == []
    assert row.vlan_id == "0"
    assert row.vlan_manager_vrf == '"default"'


def test_roster_and_records(spark):
    _, plan = _example(spark)
    roster = nodes.size_nodes(plan).collect()
    names = sorted(r.fqdn for r in roster)
    domain = "my-cluster-01.ocp.example.local"
    expected = [f"my-cluster-01-bootstrap.{domain}"] + [
        f"my-cluster-01-{role}-0{i}.{domain}" for role in ("control-plane", "infra") for i in (1, 2, 3)
    ]
    assert names == sorted(expected)
    sizing = {r.role: (r.num_cpus, r.memory_mb, r.disk_gb) for r in roster}
    assert sizing == {"bootstrap": (2, 8192, 100), "control_plane": (8, 24576, 120), "infra": (8, 32768, 120)}

    records = dns.record_set(plan).collect()
    assert len(records) == 25
    by_type = {}
    for r in records:
        by_type.setdefault(r.type, []).append(r)
    assert len(by_type["PTR"]) == 7
    assert len(by_type["A"]) == 18  # 7 nodes + 8 api/api-int + 3 *.apps
    ptr = [r for r in by_type["PTR"] if r.name == "7.5.0.10.in-addr.arpa."]
    assert ptr[0].value == f"my-cluster-01-bootstrap.{domain}."
    assert all(r.ttl == 86400 for r in records)

    args = {r.host: r.kargs for r in nodes.network_args(plan).collect()}
    assert args["my-cluster-01-bootstrap"] == (
        "ip=10.0.5.7::10.0.5.254:255.255.255.0:my-cluster-01-bootstrap:ens192:none:10.100.0.10"
    )
    summary = runs.summary(plan).collect()[0]
    assert summary.compute == "(none)"
    assert summary.site == "site-a"
    assert summary.control_plane == "10.0.5.4, 10.0.5.5, 10.0.5.6"


def test_password_reference_resolved_but_not_exposed(spark):
    settings, _ = _example(spark)
    row = settings.collect()[0]
    assert row.vcenter_password == '"<redacted>"'  # there, but not its value
    assert '"secret"' not in str(row)
    exposed = nodes.size_nodes(_example(spark)[1]).columns
    assert "vcenter_password" not in exposed


def test_counts_are_list_lengths(spark):
    _, plan = _example(spark)
    counts = {r.role: r.node_count for r in nodes.count_nodes(plan).collect()}
    assert counts == {"bootstrap": 1, "control_plane": 3, "compute": 0, "infra": 3}


def test_api_records_exclude_bootstrap_option(spark):
    _, plan = _example(spark)
    with_boot = dns.api_records(plan).count()
    without = dns.api_records(plan, include_bootstrap=False).count()
    assert (with_boot, without) == (8, 6)
    assert dns.wildcard_records(plan).where(F.col("name") == "*.apps.my-cluster-01.ocp.example.local").count() == 3
