"""Node roster (R1-R8): host names, name/address pairing, sizing, counts,
boot network arguments, inventory lookup, derived names, placement rows.

The roster is computed from the plan row of each cluster (one row per cluster
carrying its settings and address lists), so naming, pairing, sizing and boot
arguments are row-local: an ``inline`` of a per-cluster array, no shuffle.
Only the inventory lookup joins another table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..functions.joins import dim_join
from ..sources.fixed_values import BOOT_INTERFACE, BOOTSTRAP_CPUS, BOOTSTRAP_MEMORY_MB, ROLES, TEMPLATE_DEFAULTS


def text_or_empty(key: str) -> Column:
    """Rendered text of a setting: undefined -> ''."""
    return F.coalesce(J.as_text(key), F.lit(""))


def cluster_domain() -> Column:
    """The cluster's domain. Names come from the document (``name``); the row
    key ``cluster_name`` is the document's file, which may be called otherwise."""
    return F.concat(F.col("name"), F.lit("."), text_or_empty("base_domain"))


ROLE_OFFSETS = [("control_plane", "control_plane_offsets"), ("compute", "compute_offsets"), ("infra", "infra_offsets")]


def node_rows(plan: DataFrame, carry: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row per node from each plan row: cluster_name, role, ordinal,
    offset, ip, fqdn, domain, plus ``carry`` columns of the plan.

    Host names are ``<name>-<label>-NN.<cluster domain>`` (1-based, two
    digits), the bootstrap without ordinal; names come from the positions of
    the offset list, so names and addresses pair one to one. Built with two
    generators (``inline`` of the roles, ``posexplode`` of their offsets) and
    scalar expressions, all inside whole-stage codegen."""
    roles = F.array(
        F.struct(F.lit("bootstrap").alias("role"), F.array(F.col("bootstrap_offset")).alias("__offs")),
        *[F.struct(F.lit(r).alias("role"), F.col(c).alias("__offs")) for r, c in ROLE_OFFSETS],
    )
    keep = ["cluster_name", "name", "net", *[c for c in carry if c not in ("cluster_name", "name", "net")]]
    domain = cluster_domain() if "base_domain" in plan.columns else F.concat(F.col("name"), F.lit("."))
    # rows without a valid network get a NULL array: no nodes, and no filter
    # for Catalyst to push into the plan's projections
    per_role = plan.select(*keep, domain.alias("domain"), F.inline(F.when(F.col("net").isNotNull(), roles)))
    exploded = per_role.select(*keep, "domain", "role", F.posexplode("__offs").alias("__pos", "offset"))
    label = F.create_map(*[x for r, lab, _ in ROLES for x in (F.lit(r), F.lit(lab))])[F.col("role")]
    name = F.col("name")
    host = F.when(F.col("role") == "bootstrap", F.concat(name, F.lit("-bootstrap"))).otherwise(
        F.concat(name, F.lit("-"), label, F.lit("-"), F.format_string("%02d", F.col("__pos") + 1))
    )
    out = [
        *keep,
        "role",
        F.when(F.col("role") == "bootstrap", F.lit(0)).otherwise(F.col("__pos") + 1).cast("int").alias("ordinal"),
        F.col("offset"),
        ip_text(F.col("net"), F.col("offset")).alias("ip"),
        F.concat(host, F.lit("."), F.col("domain")).alias("fqdn"),
        "domain",
    ]
    rows = exploded.select(*out)
    return rows.drop(*[c for c in ("net", "name") if c not in carry])


def ip_text(net: Column, offset: Column) -> Column:
    from ..functions import ipv4

    return ipv4.to_text(ipv4.address_at(net, offset))


# --------------------------------------------------------------------------- R1/R2
def name_nodes(plan: DataFrame) -> DataFrame:
    """One row per node: (cluster_name, role, ordinal, fqdn, ip, domain)."""
    return node_rows(plan).select("cluster_name", "role", "ordinal", "fqdn", "ip", "domain")


# --------------------------------------------------------------------------- R3
def _size_setting(key: str) -> Column:
    v = F.col(key)
    return F.when(v.isNull(), F.lit(TEMPLATE_DEFAULTS[key])).otherwise(J.as_int(key))


def sizing_by_role() -> Column:
    """Map role -> (num_cpus, memory_mb, disk_gb) from a plan row: bootstrap
    fixed 2 CPUs / 8192 MB; others from the role's settings, the template
    default when undefined, NULL when null or not a number."""
    entries = [
        F.lit("bootstrap"),
        F.struct(
            F.lit(BOOTSTRAP_CPUS).alias("num_cpus"),
            F.lit(BOOTSTRAP_MEMORY_MB).alias("memory_mb"),
            _size_setting("bootstrap_disk_size").alias("disk_gb"),
        ),
    ]
    for r in ("control_plane", "compute", "infra"):
        entries += [
            F.lit(r),
            F.struct(
                _size_setting(f"{r}_num_cpus").alias("num_cpus"),
                _size_setting(f"{r}_memory").alias("memory_mb"),
                _size_setting(f"{r}_disk_size").alias("disk_gb"),
            ),
        ]
    return F.create_map(*entries)


def size_nodes(plan: DataFrame) -> DataFrame:
    """Nodes with sizing: (cluster_name, role, ordinal, fqdn, ip, num_cpus,
    memory_mb, disk_gb)."""
    rows = node_rows(plan.withColumn("__size", sizing_by_role()), carry=["__size"])
    s = F.col("__size")[F.col("role")]
    return rows.select(
        "cluster_name", "role", "ordinal", "fqdn", "ip",
        s.num_cpus.cast("int").alias("num_cpus"),
        s.memory_mb.cast("int").alias("memory_mb"),
        s.disk_gb.cast("int").alias("disk_gb"),
    )


# --------------------------------------------------------------------------- R4
def count_nodes(plan: DataFrame) -> DataFrame:
    """(cluster_name, role, node_count) for every role, zero kept. Counts are
    list lengths, as the variables derive them."""
    roles = F.array(
        F.struct(F.lit("bootstrap").alias("role"), F.lit(1).alias("node_count")),
        *[
            F.struct(F.lit(r).alias("role"), F.size(F.col(f"{r}_offsets")).alias("node_count"))
            for r in ("control_plane", "compute", "infra")
        ],
    )
    return plan.select("cluster_name", F.inline(F.when(F.col("net").isNotNull(), roles))).select(
        "cluster_name", "role", F.col("node_count").cast("bigint").alias("node_count")
    )


# --------------------------------------------------------------------------- R5
def network_args(plan: DataFrame) -> DataFrame:
    """Boot network arguments per node:
    ``ip=<ip>::<gateway>:<netmask>:<host>:ens192:none:<first dns>`` and the
    numbered ``DNSn=`` lines. Columns: cluster_name, fqdn, host, kargs,
    dns_lines, prefix. The DNS lines are the same for every node of a
    cluster, so they are built once per plan row."""
    dns = J.as_str_array("dns_servers")
    lines = F.array_join(
        F.transform(
            F.coalesce(dns, F.array().cast("array<string>")),
            lambda d, i: F.concat(F.lit("DNS"), (i + 1).cast("string"), F.lit("="), d),
        ),
        "\n",
    )
    with_cols = plan.withColumns({"__dns1": F.try_element_at(dns, F.lit(1)), "__lines": lines})
    rows = node_rows(with_cols, carry=["gateway", "netmask", "prefix_length", "__dns1", "__lines"])
    host = F.substring_index(F.col("fqdn"), ".", 1)
    kargs = F.concat(
        F.lit("ip="), F.col("ip"), F.lit("::"), F.col("gateway"), F.lit(":"), F.col("netmask"), F.lit(":"),
        host, F.lit(f":{BOOT_INTERFACE}:none:"), F.col("__dns1"),
    )
    return rows.select(
        "cluster_name", "fqdn", host.alias("host"), kargs.alias("kargs"), F.col("__lines").alias("dns_lines"),
        F.col("prefix_length").alias("prefix"),
    )


# --------------------------------------------------------------------------- R6
INVENTORY_LOOKUPS = [
    # kind, setting key, output column
    ("compute_cluster", "vsphere_cluster", "compute_cluster_id"),
    ("datastore_cluster", "vsphere_datastore_cluster", "datastore_cluster_id"),
    ("dvs", "vsphere_dvs_name", "dvs_id"),
    ("network", "vm_network", "network_id"),
    ("template", "vm_template", "template_id"),
]


def inventory_index(inv: DataFrame) -> DataFrame:
    """Objects grouped by (kind, datacenter, switch, name): how many match and
    one id (aggregated before any join, so a duplicated name is one row)."""
    return inv.groupBy("kind", "datacenter_id", "switch_id", "name").agg(
        F.count(F.lit(1)).alias("matches"),
        F.min("id").alias("id"),
        F.first("guest_id", ignorenulls=True).alias("guest_id"),
        F.first(F.element_at("disks", 1).getField("thin_provisioned"), ignorenulls=True).alias("thin_provisioned"),
    )


STRUCTURAL = ("compute_cluster", "datastore_cluster", "dvs", "template")


def datacenters(index: DataFrame) -> DataFrame:
    """One row per datacenter name: how many match (``n_dc``), its id, and a map
    of its structural objects 'kind|name' -> (matches, id, guest_id,
    thin_provisioned). A datacenter's clusters, switches, datastore clusters and
    templates are a few hundred at most; port groups are not in it."""
    named = index.where((F.col("kind") == "datacenter") & F.col("datacenter_id").isNull())
    named = named.groupBy("name").agg(F.sum("matches").alias("n_dc"), F.min("id").alias("datacenter_id"))
    key = F.concat(F.col("kind"), F.lit("|"), F.col("name"))
    # one object name may stand on several switches: the matches add up
    per_name = index.where(F.col("kind").isin(*STRUCTURAL)).groupBy("datacenter_id", key.alias("key")).agg(
        F.sum("matches").alias("n"), F.min("id").alias("id"), F.first("guest_id", ignorenulls=True).alias("guest_id"),
        F.first("thin_provisioned", ignorenulls=True).alias("thin"),
    )
    value = F.struct("n", "id", "guest_id", "thin")
    objects = per_name.groupBy("datacenter_id").agg(F.map_from_entries(F.collect_list(F.struct("key", value.alias("v")))).alias("objects"))
    return named.select(F.col("name").alias("__dc"), "n_dc", F.when(F.col("n_dc") == 1, F.col("datacenter_id")).alias("datacenter_id")).join(
        objects, "datacenter_id", "left"
    )


INVENTORY_IDS = ("datacenter_id", *[out for _, _, out in INVENTORY_LOOKUPS], "guest_id", "thin_provisioned")


def _looked_up(fleet: DataFrame, inv: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``cluster_name``, the ``carry`` columns and ``INVENTORY_IDS`` of each wide
    row, with what each id was looked up by (``__ref_...``) and why it is missing
    (``__problem_...``).

    Structural objects come in one small row per datacenter; all of a cluster's
    lookups in it are map reads. Port groups, as many as clusters, are one plain
    join on (datacenter, switch, name)."""
    keys = ["datacenter"] + [k for _, k, _ in INVENTORY_LOOKUPS]
    index = inventory_index(inv)
    f = fleet.select("cluster_name", *carry, *[J.as_text(k).alias(f"__ref_{k}") for k in keys])
    places = datacenters(index.where(F.col("kind") != "network"))
    f = dim_join(f.withColumn("__dc", F.col("__ref_datacenter")), places, "__dc", "left", row_key="cluster_name")
    problem = lambda ref, n: F.when(F.col(ref).isNull() | n.isNull(), F.lit("missing")).when(n > 1, F.lit("ambiguous"))
    f = f.withColumn("__problem_datacenter_id", problem("__ref_datacenter", F.col("n_dc")))
    for kind, key, out in INVENTORY_LOOKUPS:
        if kind != "network":
            f = f.withColumn(f"__{out}", F.try_element_at("objects", F.concat(F.lit(kind + "|"), F.col(f"__ref_{key}"))))
            n = F.col(f"__{out}.n")
            f = f.withColumns({out: F.when(n == 1, F.col(f"__{out}.id")), f"__problem_{out}": problem(f"__ref_{key}", n)})
    ports = index.where(F.col("kind") == "network").select(
        "datacenter_id", F.col("switch_id").alias("dvs_id"), F.col("name").alias("__ref_vm_network"), F.col("matches").alias("__n"), F.col("id").alias("__id")
    )
    f = f.join(ports, ["datacenter_id", "dvs_id", "__ref_vm_network"], "left")
    f = f.withColumns({"network_id": F.when(F.col("__n") == 1, F.col("__id")), "__problem_network_id": problem("__ref_vm_network", F.col("__n"))})
    found = F.col("template_id").isNotNull()
    return f.withColumns({"guest_id": F.when(found, F.col("__template_id.guest_id")), "thin_provisioned": F.when(found, F.col("__template_id.thin"))})


def resolve_inventory(fleet: DataFrame, inv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Look up inventory ids by name within the cluster's datacenter (the port
    group also on the switch). ``fleet``: wide settings rows. Returns (ids,
    issues):

    ids: cluster_name, datacenter_id, compute_cluster_id, datastore_cluster_id,
    dvs_id, network_id, template_id, guest_id, thin_provisioned (NULL where the
    lookup failed); issues: cluster_name, object, name, problem ('missing' or
    'ambiguous')."""
    f = _looked_up(fleet, inv)
    ids = f.select("cluster_name", *INVENTORY_IDS)
    keys = ["datacenter"] + [k for _, k, _ in INVENTORY_LOOKUPS]
    outs = ["datacenter_id"] + [o for _, _, o in INVENTORY_LOOKUPS]
    objects = ["datacenter"] + [k for k, _, _ in INVENTORY_LOOKUPS]
    issue = lambda obj, key, o: F.struct(F.lit(obj).alias("object"), F.col(f"__ref_{key}").alias("name"), F.col(f"__problem_{o}").alias("problem"))
    rows = F.array(*[issue(obj, key, o) for obj, key, o in zip(objects, keys, outs, strict=True)])
    return ids, f.select("cluster_name", F.inline(rows)).where(F.col("problem").isNotNull())


# --------------------------------------------------------------------------- R7/R8
def node_specs(plan: DataFrame, inv: DataFrame) -> DataFrame:
    """One placement row per VM: VM name (first label), folder
    ``<vsphere_folder>/<name>``, resource pool (the name), sizing, boot
    arguments and inventory ids. The ids are looked up in the plan's own row."""
    wide = plan.withColumns(
        {
            "folder": F.concat(text_or_empty("vsphere_folder"), F.lit("/"), F.col("name")),
            "__size": sizing_by_role(),
            "__dns1": F.try_element_at(J.as_str_array("dns_servers"), F.lit(1)),
        }
    )
    own = ("name", "base_domain", "net", "folder", "__size", "gateway", "netmask", "__dns1", "bootstrap_offset", *[c for _, c in ROLE_OFFSETS])
    withids = _looked_up(wide, inv, own)
    carry = [
        "name", "folder", "__size", "gateway", "netmask", "__dns1", "datacenter_id", "compute_cluster_id",
        "datastore_cluster_id", "network_id", "template_id", "guest_id", "thin_provisioned",
    ]
    rows = node_rows(withids, carry=carry)
    host = F.substring_index(F.col("fqdn"), ".", 1)
    s = F.col("__size")[F.col("role")]
    kargs = F.concat(
        F.lit("ip="), F.col("ip"), F.lit("::"), F.col("gateway"), F.lit(":"), F.col("netmask"), F.lit(":"),
        host, F.lit(f":{BOOT_INTERFACE}:none:"), F.col("__dns1"),
    )
    return rows.select(
        "cluster_name", "role", "ordinal", "fqdn", host.alias("vm_name"), "ip", "folder",
        F.col("name").alias("resource_pool"),
        s.num_cpus.cast("int").alias("num_cpus"),
        s.memory_mb.cast("int").alias("memory_mb"),
        s.disk_gb.cast("int").alias("disk_gb"),
        kargs.alias("kargs"),
        "datacenter_id", "compute_cluster_id", "datastore_cluster_id", "network_id", "template_id",
        "guest_id", "thin_provisioned",
    )
