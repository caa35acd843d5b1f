"""Fleet tables derived from the driver tables.

The driver tables hold no cluster configuration, so every fleet input (the
three configuration layers, environment, allocations, inventory, runs, polls,
attempts, log lines, host tools, artifacts) is a plain projection of them.
The rules are spelled out in FIXTURES.md; the oracle SQL derives the same
tables with the same expressions.

``base='customer'`` (one cluster per customer) is the correctness fleet;
``base='orders'`` (one cluster per order, 150,000 at sf0.1) is the benchmark
fleet.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..sources.fixed_values import DEFAULTS_DOCUMENT


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _document(*entries: tuple[str, Column]) -> Column:
    """A document map of the entries whose value is not NULL (key absent). Each
    value is computed once, for one map."""
    return F.map_filter(F.create_map(*[x for key, value in entries for x in (F.lit(key), value)]), lambda _, value: value.isNotNull())


def _kv(key: str, value: Column) -> Column:
    """A document entry; NULL (no entry) when the value is NULL (key absent)."""
    return F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), value.alias("value")))


#: Clusters of one task. A cluster is a few bytes in the tables and hundreds of
#: values in the outputs, so file sizes say nothing about the work.
CLUSTERS_PER_TASK = 4096


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ``key`` over as many tasks as their number asks for (counted
    from the file footers). The number is explicit, so adaptive execution does
    not gather the few bytes in one task again."""
    tasks = -(-rows.count() // CLUSTERS_PER_TASK)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def fleet_seed(spark: SparkSession, sf_dir: str, base: str = "customer") -> DataFrame:
    """One row per cluster: k, cluster_name (the document's file), name (what the
    document says: another one in a tenth of them), site, segment, vlan_id, nation.
    What is made of a cluster is made in its row, so the rows are spread first."""
    if base == "customer":
        src = _read(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("k"),
            F.lower("c_mktsegment").alias("tag"),
            F.col("c_nationkey").alias("nation"),
            F.col("c_name").alias("alt_name"),
        )
    elif base == "orders":
        src = _read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("k"),
            F.concat(F.lit("ord"), F.lower("o_orderstatus")).alias("tag"),
            (F.col("o_custkey") % 25).cast("int").alias("nation"),
            F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")).alias("alt_name"),
        )
    else:
        raise ValueError(base)
    k = F.col("k")
    stem = F.concat(F.col("tag"), F.lit("-"), k.cast("string"))
    file = (
        F.when(k % 50 == 0, F.col("alt_name"))
        .when(k % 50 == 1, F.concat(stem, F.lit("-")))
        .when(k % 50 == 2, F.concat(stem, F.lit("-way-too-long-name-xx")))
        .otherwise(stem)
    )
    return _spread(src, "k").select(
        k,
        file.alias("cluster_name"),
        F.when(k % 10 == 6, F.concat(F.lit("n-"), file)).otherwise(file).alias("name"),
        F.when(k % 50 == 4, F.lit(None).cast("string"))
        .when(k % 40 == 3, F.lit("site-99"))
        .otherwise(F.concat(F.lit("site-"), F.col("nation").cast("string")))
        .alias("site"),
        F.when(k % 90 == 17, F.lit("fd00::/64"))
        .when(k % 90 == 37, F.lit("10.300.0.0/24"))
        .when(k % 90 == 57, F.lit("255.255.255.200/25"))
        .when(
            k % 10 != 0,
            F.concat(
                F.lit("10."),
                (F.expr("k div 256") % 256).cast("string"),
                F.lit("."),
                (k % 256).cast("string"),
                F.lit(".77/"),
                F.when(k % 10 == 5, F.lit("28")).otherwise(F.lit("24")),
            ),
        ).alias("segment"),
        F.when(~(k % 10).isin(0, 3), F.lit(100) + k % 3900).cast("bigint").alias("vlan_id"),
        F.col("nation"),
    )


def cluster_docs(seed: DataFrame) -> DataFrame:
    """Cluster documents, one row per cluster: (cluster_name, doc MAP key ->
    JSON text), built inside the seed row (no shuffle). An absent key has no
    entry; the text ``null`` is an explicit null."""
    k = F.col("k")
    vlan_text = (F.lit(100) + k % 3900).cast("string")
    entries = [
        ("cluster_name", J.quote(F.col("name"))),
        ("site", J.quote(F.col("site"))),
        (
            "segment",
            F.when(F.col("segment").isNotNull(), J.quote(F.col("segment"))).when(k % 20 == 10, F.lit("null")),
        ),
        ("vlan_id", F.col("vlan_id").cast("string")),
        (
            "vm_network",
            F.when(k % 25 != 7, J.quote(F.concat(F.lit("VLAN"), vlan_text, F.lit("-OCP")))),
        ),
        (
            "compute_ip_offsets",
            F.when(k % 8 == 4, F.lit(None).cast("string"))
            .when(k % 4 == 0, F.lit("[]"))
            .when(k % 4 == 1, F.lit("[8]"))
            .when(k % 4 == 2, F.lit("[8,9]"))
            .otherwise(F.lit("[8,9,10]")),
        ),
        ("search_domain", F.when(k % 9 == 0, F.lit("null"))),
        ("control_plane_memory", F.when(k % 6 == 0, F.lit("32768"))),
        ("infra_memory", F.when(k % 23 == 0, F.lit('"32G"'))),
        (
            "argocd_hub_api_url",
            F.when(
                k % 3 == 0,
                J.quote(F.concat(F.lit("https://api.hub-"), (k % 7).cast("string"), F.lit(".example.local:6443"))),
            ),
        ),
        ("argocd_hub_token", F.when(k % 6 == 0, J.quote(F.concat(F.lit("token-"), k.cast("string"))))),
        (
            "argocd_hub_token_env",
            F.when(k % 6 == 3, J.quote(F.concat(F.lit("HUB_TOKEN_"), (k % 4).cast("string")))),
        ),
        ("argocd_namespace", F.when(k % 5 == 0, F.lit('"gitops"'))),
        ("argocd_insecure_skip_tls", F.when(k % 7 == 0, F.lit("true"))),
        ("wildcard_dns_api_url", F.when(k % 31 == 5, F.lit('""'))),
        ("vlan_manager_url", F.when(k % 37 == 10, F.lit("null"))),
    ]
    return seed.select("cluster_name", _document(*entries).alias("doc"))


def cluster_layer(seed: DataFrame) -> DataFrame:
    """The cluster documents as long rows ``(cluster_name, key, value)``."""
    return cluster_docs(seed).select("cluster_name", F.explode("doc").alias("key", "value"))


def site_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site documents as rows ``(site, key, value)``, one site per nation."""
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey)
    n = F.col("n_nationkey")
    r = F.col("n_regionkey").cast("string")
    site = F.concat(F.lit("site-"), n.cast("string"))
    ns = n.cast("string")
    entries = F.array(
        _kv("site_name", J.quote(site)),
        _kv("vcenter", J.quote(F.concat(F.lit("vcenter."), site, F.lit(".example.local")))),
        _kv("vcenter_user", F.lit('"administrator@vsphere.local"')),
        _kv("vcenter_password_env", J.quote(F.concat(F.lit("VC_PW_"), r))),
        _kv("datacenter", J.quote(F.concat(F.lit("DC-"), F.col("n_name")))),
        _kv("vsphere_cluster", J.quote(F.concat(F.lit("Cluster-"), ns))),
        _kv("vsphere_datastore_cluster", J.quote(F.concat(F.lit("DSC-"), ns))),
        _kv("vsphere_dvs_name", J.quote(F.concat(F.lit("DVS-"), ns))),
        _kv("vsphere_folder", J.quote(F.concat(F.lit("/DC-"), F.col("n_name"), F.lit("/vm/OCP-Clusters")))),
        _kv("vm_template", F.lit('"rhcos-420"')),
        _kv("base_domain", J.quote(F.concat(F.regexp_replace(F.lower("r_name"), " ", "-"), F.lit(".ocp.example.local")))),
        _kv("search_domain", F.lit('"example.local"')),
        _kv("dns_servers", F.concat(F.lit('["10.100.'), r, F.lit('.10","10.100.'), r, F.lit('.11"]'))),
        _kv(
            "image_mirrors",
            F.when(
                n % 5 == 0,
                F.concat(
                    F.lit('[{"source":"registry.redhat.io","mirror":"mirror.'), site, F.lit('.example.local:5000"}]')
                ),
            ),
        ),
        _kv("control_plane_num_cpus", F.when(n % 3 == 0, F.lit("16"))),
        _kv("segment", F.when(n % 7 == 1, F.lit('"10.9.9.0/24"'))),
        _kv("argocd_hub_token_env", F.when(n % 4 == 2, F.lit('"HUB_TOKEN_SITE"'))),
        _kv(
            "pull_secret_path",
            F.when(n % 3 == 1, J.quote(F.concat(F.lit("config/pull-secret-"), ns, F.lit(".json")))),
        ),
    )
    return nr.select(site.alias("site"), F.inline(F.array_compact(entries))).select("site", "key", "value")


def defaults_layer(spark: SparkSession) -> DataFrame:
    """The global defaults document as rows ``(key, value)``."""
    return spark.createDataFrame(DEFAULTS_DOCUMENT, "key string, value string")


def env_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process environment as rows ``(name, value)``; placeholder values."""
    region = _read(spark, sf_dir, "region")
    r = F.col("r_regionkey")
    rs = r.cast("string")
    rows = F.array(
        F.struct(
            F.when(r != 4, F.concat(F.lit("VC_PW_"), rs)).alias("name"),
            F.when(r == 3, F.lit("")).otherwise(F.concat(F.lit("pw-"), rs)).alias("value"),
        ),
        F.struct(
            F.when(r.isin(0, 2), F.concat(F.lit("HUB_TOKEN_"), rs)).alias("name"),
            F.concat(F.lit("hub-"), rs).alias("value"),
        ),
        F.struct(F.when(r == 0, F.lit("PULL_SECRET")).alias("name"), F.lit('{"auths":{}}').alias("value")),
        F.struct(F.when(r == 1, F.lit("SSH_PUBLIC_KEY")).alias("name"), F.lit("ssh-ed25519 AAAA").alias("value")),
    )
    return region.select(F.inline(rows)).where(F.col("name").isNotNull())


def host_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files present on the bastion host: ``(path, nonblank)``."""
    nation = _read(spark, sf_dir, "nation")
    n = F.col("n_nationkey")
    rows = F.array(
        F.struct(
            F.when(n % 2 == 1, F.concat(F.lit("config/pull-secret-"), n.cast("string"), F.lit(".json"))).alias("path"),
            (n % 4 != 3).alias("nonblank"),
        ),
        F.struct(
            F.when(n == 0, F.lit("config/additional-trust-bundle.pem")).alias("path"),
            F.lit(True).alias("nonblank"),
        ),
    )
    return nation.select(F.inline(rows)).where(F.col("path").isNotNull())


def allocations(seed: DataFrame) -> DataFrame:
    """VLAN service answers for clusters without a segment:
    ``(cluster_name, site, segment, vlan_id)``."""
    k = F.col("k")
    j = F.expr("k div 10")
    return seed.where((k % 10 == 0) & (k % 30 != 0)).select(
        "cluster_name",
        "site",
        F.concat(
            F.lit("10."),
            (F.lit(200) + F.expr("(k div 10) div 256") % 4).cast("string"),
            F.lit("."),
            (j % 256).cast("string"),
            F.lit(".0/24"),
        ).alias("segment"),
        F.when(k % 70 != 0, F.lit(2000) + j % 1000).cast("bigint").alias("vlan_id"),
    )


def inventory(spark: SparkSession, sf_dir: str, seed: DataFrame) -> DataFrame:
    """vSphere inventory snapshot: ``(kind, datacenter_id, name, id, switch_id,
    guest_id, disks)``. Structural objects per nation, port groups per cluster."""
    nation = _read(spark, sf_dir, "nation")
    n = F.col("n_nationkey")
    ns = n.cast("string")
    dc = F.concat(F.lit("datacenter-"), ns)
    disks_t = "array<struct<thin_provisioned:boolean>>"
    none = F.lit(None).cast("string")

    def obj(kind, dc_id, name, oid, switch=none, guest=none, disks=None):
        return F.struct(
            F.lit(kind).alias("kind"),
            dc_id.alias("datacenter_id"),
            name.alias("name"),
            oid.alias("id"),
            switch.alias("switch_id"),
            guest.alias("guest_id"),
            (disks if disks is not None else F.lit(None).cast(disks_t)).alias("disks"),
        )

    objs = F.array(
        obj("datacenter", none, F.concat(F.lit("DC-"), F.col("n_name")), dc),
        obj("compute_cluster", dc, F.concat(F.lit("Cluster-"), ns), F.concat(F.lit("domain-c"), ns)),
        obj(
            "compute_cluster",
            F.when(n % 12 == 7, dc),
            F.concat(F.lit("Cluster-"), ns),
            F.concat(F.lit("domain-c"), ns, F.lit("-dup")),
        ),
        obj("datastore_cluster", F.when(n % 12 != 11, dc), F.concat(F.lit("DSC-"), ns), F.concat(F.lit("group-p"), ns)),
        obj("dvs", dc, F.concat(F.lit("DVS-"), ns), F.concat(F.lit("dvs-"), ns)),
        obj(
            "template",
            dc,
            F.lit("rhcos-420"),
            F.concat(F.lit("vm-tmpl-"), ns),
            guest=F.lit("rhcos_64Guest"),
            disks=F.array(F.struct((n % 2 == 0).alias("thin_provisioned"))),
        ),
    )
    structural = nation.select(F.inline(objs)).where(
        (F.col("kind") == "datacenter") | F.col("datacenter_id").isNotNull()
    )
    k = F.col("k")
    nat = F.col("nation").cast("string")
    port_groups = seed.where(k % 17 != 0).select(
        F.lit("network").alias("kind"),
        F.concat(F.lit("datacenter-"), nat).alias("datacenter_id"),
        F.concat(F.lit("VLAN"), (F.lit(100) + k % 3900).cast("string"), F.lit("-OCP")).alias("name"),
        F.concat(F.lit("dvportgroup-"), k.cast("string")).alias("id"),
        F.concat(F.lit("dvs-"), nat).alias("switch_id"),
        none.alias("guest_id"),
        F.lit(None).cast(disks_t).alias("disks"),
    )
    return structural.unionByName(port_groups)


def runs(spark: SparkSession, sf_dir: str, seed: DataFrame) -> DataFrame:
    """One provisioning run per order: flags from the order key."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    flagged = orders.select(
        k.alias("run_id"),
        F.col("o_custkey").alias("k"),
        (k % 13 == 0).alias("destroy"),
        (k % 2 == 0).alias("skip_dns"),
        (k % 3 == 0).alias("skip_terraform"),
        (k % 5 == 0).alias("skip_csr"),
        (k % 7 == 0).alias("skip_ignition"),
        (k % 11 == 0).alias("skip_argocd"),
        F.lit(45).alias("csr_timeout"),
        F.concat(F.lit("bastion-"), (k % 10).cast("string")).alias("host"),
    )
    # one row per cluster on both sides of the key but the runs: a plain join
    return flagged.join(seed.select("k", "cluster_name"), "k").drop("k")


def spoke(seed: DataFrame) -> DataFrame:
    """What each provisioned cluster answers: ``(cluster_name, server, ca_data)``;
    every 19th has not answered."""
    return seed.where(F.col("k") % 19 != 0).select(
        "cluster_name",
        F.concat(F.lit("https://api."), F.col("name"), F.lit(".example.local:6443")).alias("server"),
        F.base64(F.encode(F.concat(F.lit("CA of "), F.col("name")), "UTF-8")).alias("ca_data"),
    )


def supplied_variables(variables: DataFrame) -> DataFrame:
    """Variable files as supplied: the rendered ones with what people do to
    them: a required one dropped, an undeclared one added, a count changed, a
    list broken. By the number in the cluster's file name."""
    variables = variables.withColumn("__k", F.regexp_extract("cluster_name", "([0-9]+)", 1).cast("bigint"))
    k = F.col("__k")
    name = F.col("variable")
    value = (
        F.when((k % 37 == 8) & (name == "control_plane_count"), F.lit("5"))
        .when((k % 41 == 9) & (name == "infra_ips"), F.lit("10.0.0.1"))
        .otherwise(F.col("value"))
    )
    dropped = (k % 29 == 3) & (name == "base_domain")
    extra = F.struct(F.lit("ssh_public_key_path").alias("variable"), F.lit("/root/key").alias("value"))
    rows = F.array(
        F.when(~dropped, F.struct(name.alias("variable"), value.alias("value"))),
        F.when((k % 31 == 5) & (name == "cluster_id"), extra),
    )
    return variables.select("cluster_name", F.inline(F.array_compact(rows)))


def artifacts(seed: DataFrame) -> DataFrame:
    k = F.col("k")
    files = F.array(
        F.when(k % 3 != 0, F.lit("terraform.tfvars")),
        F.when(k % 5 != 0, F.lit("terraform.tfstate")),
    )
    return seed.select("cluster_name", F.explode(files).alias("file")).where(F.col("file").isNotNull())


def host_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binaries found on each bastion host: ``(host, tool)``."""
    supplier = _read(spark, sf_dir, "supplier")
    s = F.col("s_suppkey")
    tools = F.array(
        *[
            F.when((s + i) % 4 != 0, F.lit(t))
            for i, t in enumerate(["/usr/local/bin/openshift-install-4.20", "/usr/local/bin/terraform", "oc"])
        ]
    )
    return supplier.select(
        F.concat(F.lit("bastion-"), s.cast("string")).alias("host"), F.explode(tools).alias("tool")
    ).where(F.col("tool").isNotNull())


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events")


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readiness poll snapshots ``(run_id, poll_id, polled_at, csr_json,
    version_json)``, one per event."""
    return polls_from_events(_events(spark, sf_dir))


def polls_from_events(ev: DataFrame) -> DataFrame:
    """The poll derivation on any events frame (batch or stream)."""
    t = F.col("event_type")
    eid = F.col("event_id").cast("string")
    repeat = F.concat(F.lit("csr-"), F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 3).cast("string"))
    name = F.concat(F.lit('{"metadata":{"name":"'), repeat, F.lit('"}'))
    approved = F.lit(',"status":{"conditions":[{"type":"Approved","status":"True"}]}}')
    pending_form = (
        F.when(F.col("event_id") % 4 == 0, F.lit(',"status":{}}'))
        .when(F.col("event_id") % 4 == 1, F.lit("}"))
        .when(F.col("event_id") % 4 == 2, F.lit(',"status":{"conditions":[]}}'))
        .otherwise(F.lit(',"status":{"conditions":null}}'))
    )
    other = F.concat(F.lit(',{"metadata":{"name":"csr-a'), eid, F.lit('"}'), approved)
    csr = (
        F.when(t == "error", F.lit('{"items":[{"metadata":'))
        .when(t == "signup", F.concat(F.lit('{"items":['), name, pending_form, other, F.lit("]}")))
        .when(t == "click", F.concat(F.lit('{"items":['), name, approved, F.lit("]}")))
        .otherwise(F.lit('{"items":[]}'))
    )
    available = F.lit('{"type":"Available","status":"True"}')
    version = (
        F.when(
            (t == "purchase") & (F.col("event_id") % 50 == 7),
            F.concat(F.lit('{"status":{"conditions":['), available, F.lit(","), available, F.lit("]}}")),
        )
        .when(
            t.isin("purchase", "error"),
            F.concat(F.lit('{"status":{"conditions":[{"type":"Progressing","status":"False"},'), available, F.lit("]}}")),
        )
        .when(t == "view", F.lit('{"status":{"conditions":[{"type":"Available","status":"False"}]}}'))
        .otherwise(F.lit('{"status":{}}'))
    )
    return ev.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("poll_id"),
        F.col("ts").alias("polled_at"),
        csr.alias("csr_json"),
        version.alias("version_json"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token fetch attempts ``(run_id, attempt, value)``: attempt = position of
    the event in its user's history; value empty unless a purchase."""
    from ..functions.scans import ordinal_within

    ev = _events(spark, sf_dir).select(
        F.col("user_id").alias("run_id"),
        "ts",
        "event_id",
        F.when(F.col("event_type") == "purchase", F.lit("dG9rZW4="))
        .when((F.col("event_type") == "view") & (F.col("event_id") % 13 == 0), F.lit("  "))
        .otherwise(F.lit(""))
        .alias("value"),
    )
    hour = F.expr("unix_micros(cast(ts AS timestamp)) div 3600000000")
    return ordinal_within(ev, ["run_id"], ["ts", "event_id"], hour, "attempt").select(
        "run_id", F.col("attempt").cast("int").alias("attempt"), "value"
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log lines ``(cluster_name, line_no, text)``, one file per user;
    an error writes a second line without a timestamp. Some exit codes are
    beyond any number, some lines have a time that there is not."""
    ev = _events(spark, sf_dir)
    t = F.col("event_type")
    eid = F.col("event_id")
    warn = (t == "signup") & (eid % 5 == 0)
    level = (
        F.when(t == "error", F.lit("ERROR"))
        .when(warn, F.lit("WARNING"))
        .when(t.isin("view", "click"), F.lit("DEBUG"))
        .otherwise(F.lit("INFO"))
    )
    message = (
        F.when((t == "error") & (eid % 41 == 3), F.lit("Command failed (rc=99999999999999999999): oc get csr -o json"))
        .when(t == "error", F.concat(F.lit("Command failed (rc="), (eid % 5 + 1).cast("string"), F.lit("): oc get csr -o json")))
        .when(warn, F.concat(F.lit("approval of csr-"), eid.cast("string"), F.lit(" did not go through")))
        .when(
            t == "signup",
            F.concat(F.lit("Approving "), (eid % 3 + 1).cast("string"), F.lit(" pending CSR(s): ['csr-"), eid.cast("string"), F.lit("']")),
        )
        .when(t == "click", F.concat(F.lit("  stdout: certificatesigningrequest/csr-"), eid.cast("string"), F.lit(" approved")))
        .when(t == "view", F.lit("waiting for the cluster"))
        .otherwise(F.concat(F.lit("cluster up (took "), F.floor(F.col("value") * 10).cast("bigint").cast("string"), F.lit("s)")))
    )
    time = F.when((t == "view") & (eid % 37 == 5), F.lit("2026-13-45 10:00:00")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    head = F.concat(time, F.lit(" ["), F.rpad(level, 7, " "), F.lit("] "), message)
    lines = F.array(
        F.struct((eid * 2).alias("line_no"), head.alias("text")),
        F.struct((eid * 2 + 1).alias("line_no"), F.when(t == "error", F.lit("stderr: connection refused")).alias("text")),
    )
    return ev.select(
        F.concat(F.lit("cluster-"), F.col("user_id").cast("string")).alias("cluster_name"), F.inline(lines)
    ).where(F.col("text").isNotNull())
