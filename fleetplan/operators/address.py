"""Address planning (N1-N6): allocation requests and answers, CIDR
normalisation, addresses at offsets, the per-cluster plan.

All arithmetic is BIGINT column expressions (see ``functions.ipv4``); arrays of
offsets are mapped with ``transform`` so a plan is one row per cluster, and
exploded to one row per address only where a table needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ipv4 as ip
from ..functions import jsonvalue as J
from ..sources.fixed_values import ALLOCATION_ENDPOINT
from .validate import planning_allowed, started

# --------------------------------------------------------------------------- N1
def allocation_requests(fleet: DataFrame) -> DataFrame:
    """Requests for clusters without a segment: (cluster_name, site, vrf,
    endpoint). ``fleet`` is the wide settings row (code defaults folded in, so
    an absent vrf is 'default'). Refused clusters ask for nothing; the network
    name is read after the request, so it is not asked for here."""
    url = J.as_text("vlan_manager_url")
    return started(
        fleet.where(F.col("segment") == ""),
        cluster_name=F.col("cluster_name"),
        site=F.col("site"),
        vrf=J.as_text("vlan_manager_vrf"),
        endpoint=F.concat(F.regexp_replace(url, "/+$", ""), F.lit(ALLOCATION_ENDPOINT)),
    )


# --------------------------------------------------------------------------- N2
def apply_allocations(fleet: DataFrame, allocs: DataFrame) -> DataFrame:
    """Segment and VLAN per cluster: its own segment when it has one, else the
    allocation answer for (cluster_name, site). Replaces ``segment`` and
    ``vlan_id`` and adds ``segment_source`` ('own', 'allocated', 'missing').

    Only clusters without a segment are joined (on cluster_name, unique in the
    answers; the site is compared after the join); the wide rows of all others
    stay where they are."""
    a = allocs.select(
        "cluster_name",
        F.col("site").alias("__a_site"),
        F.col("segment").alias("__a_seg"),
        F.col("vlan_id").cast("string").alias("__a_vlan"),
    )
    own = fleet.where(F.col("segment") != "").withColumn("segment_source", F.lit("own"))
    joined = fleet.where(F.col("segment") == "").join(a, "cluster_name", "left")
    got = (F.coalesce(F.col("__a_seg"), F.lit("")) != "") & F.col("site").eqNullSafe(F.col("__a_site"))
    answered = (
        joined.withColumn("segment_source", F.when(got, F.lit("allocated")).otherwise(F.lit("missing")))
        .withColumn("vlan_id", F.when(got, F.col("__a_vlan")))
        .withColumn("segment", F.when(got, F.col("__a_seg")).otherwise(F.lit("")))
        .drop("__a_site", "__a_seg", "__a_vlan")
    )
    return own.unionByName(answered)


# --------------------------------------------------------------------------- N3
def normalize_cidr(df: DataFrame, col: str = "segment") -> DataFrame:
    """Add network (text), prefix_length, netmask (text) and valid for the
    CIDR in ``col`` (host bits allowed, no '/' means /32, dotted masks ok)."""
    return (
        ip.with_cidr(df, col, "__n")
        .withColumns(
            {
                "network": ip.to_text(F.col("__n_network")),
                "prefix_length": F.col("__n_prefix"),
                "netmask": ip.to_text(F.col("__n_mask")),
                "valid": F.col("__n_network").isNotNull(),
            }
        )
        .drop("__n_network", "__n_prefix", "__n_mask")
    )


# --------------------------------------------------------------------------- N4/N5
OFFSET_LISTS = ("infra_offsets", "control_plane_offsets", "compute_offsets")


def plan_addresses(fleet: DataFrame) -> DataFrame:
    """Add the address plan to every wide fleet row: net and mask (BIGINT), the
    offsets (bootstrap_offset, <role>_offsets), network, prefix_length, netmask,
    gateway, bootstrap_ip, infra_ips, control_plane_ips, compute_ips,
    all_in_segment. Row-local (no shuffle). The address lists are for consumers
    that want lists (summary, context); per-node work explodes the offsets
    instead (``nodes.node_rows``), and columns nobody reads are pruned.

    The tool stops before planning a cluster that is not valid (V1 to V3), has
    no usable segment or an address outside IPv4. Such rows have a NULL ``net``,
    and no consumer takes anything from them; ``check_plan`` says why.

    ``fleet`` carries segment (after allocation) and the offset settings with
    code defaults folded in.
    """
    # No filter on the computed network: Catalyst would push it below these
    # projections and inline the whole CIDR computation into it.
    parsed = ip.with_cidr(fleet, "segment", "__n").withColumn("allowed", planning_allowed())
    j = parsed.withColumnsRenamed({"__n_network": "__net", "__n_mask": "mask", "__n_prefix": "prefix_length"}).withColumns(
        {
            "bootstrap_offset": J.as_int("bootstrap_ip_offset"),
            "gateway_at": J.as_int("gateway_offset"),
            "infra_offsets": J.as_int_array("infra_ip_offsets"),
            "control_plane_offsets": J.as_int_array("control_plane_ip_offsets"),
            "compute_offsets": J.as_int_array("compute_ip_offsets"),
        }
    )
    single = [F.col("gateway_at"), F.col("bootstrap_offset")]
    # greatest and least skip NULLs, array_max and array_min too
    high = F.greatest(*single, *[F.array_max(c) for c in OFFSET_LISTS]).cast("bigint")
    low = F.least(*single, *[F.array_min(c) for c in OFFSET_LISTS]).cast("bigint")
    complete = F.lit(True)
    for c in single:
        complete = complete & c.isNotNull()
    for c in OFFSET_LISTS:
        complete = complete & F.coalesce(~F.exists(c, lambda o: o.isNull()), F.lit(False))
    within = (F.col("__net") + low >= 0) & (F.col("__net") + high < ip.TWO_32)
    j = j.withColumn("in_range", F.coalesce(complete & within, F.lit(False)))
    j = j.withColumn("parsed", F.col("__net").isNotNull())
    j = j.withColumn("net", F.when(F.col("allowed") & F.col("in_range"), F.col("__net"))).drop("__net")
    net, mask = F.col("net"), F.col("mask")
    j = j.withColumns({"__gw": ip.address_at(net, F.col("gateway_at")), "__boot": ip.address_at(net, F.col("bootstrap_offset"))})

    def ips(offsets):
        return F.transform(F.col(offsets), lambda o: ip.to_text(ip.address_at(net, o)))

    def inside(offsets):
        return F.forall(F.col(offsets), lambda o: F.coalesce(ip.in_segment(ip.address_at(net, o), net, mask), F.lit(False)))

    gw, boot = F.col("__gw"), F.col("__boot")
    return j.withColumns(
        {
            "network": ip.to_text(net),
            "netmask": ip.to_text(mask),
            "gateway": ip.to_text(gw),
            "bootstrap_ip": ip.to_text(boot),
            "infra_ips": ips("infra_offsets"),
            "control_plane_ips": ips("control_plane_offsets"),
            "compute_ips": ips("compute_offsets"),
            "all_in_segment": (
                F.coalesce(ip.in_segment(gw, net, mask), F.lit(False))
                & F.coalesce(ip.in_segment(boot, net, mask), F.lit(False))
                & inside("infra_offsets")
                & inside("control_plane_offsets")
                & inside("compute_offsets")
            ),
        }
    ).drop("__gw", "__boot")


def check_plan(plan: DataFrame) -> DataFrame:
    """Valid clusters (V1 to V3) that get no plan: (cluster_name, rule, detail),
    rule no_segment, ipv6_segment, invalid_cidr or address_out_of_range (an
    address beyond IPv4, or an offset that is not a number)."""
    rule = (
        F.when(F.col("segment") == "", F.lit("no_segment"))
        .when(F.col("segment").contains(":"), F.lit("ipv6_segment"))
        .when(~F.col("parsed"), F.lit("invalid_cidr"))
        .when(~F.col("in_range"), F.lit("address_out_of_range"))
    )
    row = F.struct(rule.alias("rule"), F.col("segment").alias("detail"))
    found = plan.select("cluster_name", F.inline(F.when(F.col("allowed"), F.array(row))))
    return found.where(F.col("rule").isNotNull())


def addresses(plan: DataFrame) -> DataFrame:
    """One row per planned address: (cluster_name, role, ordinal, ip,
    in_segment). Gateway and bootstrap have ordinal 0, list roles 1-based. Roles
    and their offsets come from two generators, each address is scalar
    arithmetic."""
    single = lambda role, offset: F.struct(F.lit(role).alias("role"), F.lit(0).alias("first"), F.array(offset).alias("offsets"))
    lists = [F.struct(F.lit(c.removesuffix("_offsets")).alias("role"), F.lit(1).alias("first"), F.col(c).alias("offsets")) for c in OFFSET_LISTS]
    roles = F.array(single("gateway", F.col("gateway_at")), single("bootstrap", F.col("bootstrap_offset")), *lists)
    rows = plan.select("cluster_name", "net", "mask", F.inline(F.when(F.col("net").isNotNull(), roles)))
    rows = rows.select("cluster_name", "net", "mask", "role", "first", F.posexplode("offsets").alias("__pos", "offset"))
    address = ip.address_at(F.col("net"), F.col("offset"))
    return rows.select(
        "cluster_name",
        "role",
        (F.col("first") + F.col("__pos")).cast("int").alias("ordinal"),
        ip.to_text(address).alias("ip"),
        F.coalesce(ip.in_segment(address, F.col("net"), F.col("mask")), F.lit(False)).alias("in_segment"),
    )


def check_allocations(allocs: DataFrame) -> DataFrame:
    """V5: allocation answers missing a segment or a VLAN id:
    (cluster_name, rule, detail)."""
    seg_bad = F.coalesce(F.col("segment"), F.lit("")) == ""
    vlan_bad = F.col("vlan_id").isNull()
    rows = F.array(
        F.struct(F.when(seg_bad, F.lit("allocation_segment")).alias("rule"), F.lit("segment missing").alias("detail")),
        F.struct(F.when(vlan_bad, F.lit("allocation_vlan")).alias("rule"), F.lit("vlan_id missing").alias("detail")),
    )
    return allocs.select("cluster_name", F.inline(rows)).where(F.col("rule").isNotNull())
