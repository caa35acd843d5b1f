"""Validation (V1-V8). Every validator returns violations as rows
``(cluster_name, rule, detail)`` (runs add ``run_id``); a good row gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..functions.joins import dim_join
from ..session import write_table
from ..sources.fixed_values import NAME_MAX_CHARS, VARIABLE_CONTRACT

# Letters, digits (any script) and hyphen over the whole text; \z so a trailing
# newline does not pass.
NAME_PATTERN = r"\A[\p{L}\p{N}-]*\z"


def _violations(df: DataFrame, keys: list[str], rules: list[tuple[str, object, object]]) -> DataFrame:
    entries = F.array(
        *[F.struct(F.when(cond, F.lit(rule)).alias("rule"), F.lit(detail).cast("string").alias("detail") if isinstance(detail, str) else detail.alias("detail")) for rule, cond, detail in rules]
    )
    return df.select(*keys, F.inline(entries)).where(F.col("rule").isNotNull())


def identity_allowed() -> Column:
    """Whether the tool would start a run on a wide settings row at all: a good
    name and a site that is given and known. A run on any other cluster ends
    before its first phase, so it needs no tools and asks for nothing."""
    name, site = F.coalesce(F.col("name"), F.lit("")), F.coalesce(F.col("site"), F.lit(""))
    good = (name != "") & (F.char_length(name) <= NAME_MAX_CHARS) & name.rlike(NAME_PATTERN)
    good = good & ~name.startswith("-") & ~name.endswith("-")
    return good & (site != "") & F.col("site_known")


def started(fleet: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` of the clusters that a run may start on. They come out of a
    generator: a filter would be pushed below the projections that compute the
    name and the site, with all of them copied into it."""
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return fleet.select(F.inline(F.when(identity_allowed(), F.array(row))))


def planning_allowed() -> Column:
    """Whether a wide settings row passes V1 to V3, so that the tool would go on
    to plan it: a run may start, and the network that planning needs is named."""
    return identity_allowed() & J.truthy("vm_network")


def check_names(identity: DataFrame) -> DataFrame:
    """V1: at most 27 characters; letters, digits, hyphen; no edge hyphen."""
    name = F.col("name")
    # no pre-filter on name: a NULL name fails no rule here (each rule is NULL),
    # and a filter would be pushed into the projection that computes the name
    return _violations(
        identity,
        ["cluster_name"],
        [
            ("name_too_long", F.char_length(name) > NAME_MAX_CHARS, F.char_length(name).cast("string")),
            ("name_characters", ~name.rlike(NAME_PATTERN), name),
            ("name_hyphen_edge", name.startswith("-") | name.endswith("-"), name),
        ],
    )


def check_required(fleet: DataFrame) -> DataFrame:
    """V2: ``cluster_name`` and ``site`` (cluster document) and ``vm_network``
    (merged profile) must be present and truthy."""
    return _violations(
        fleet,
        ["cluster_name"],
        [
            ("required", F.coalesce(F.col("name"), F.lit("")) == "", "cluster_name"),
            ("required", F.coalesce(F.col("site"), F.lit("")) == "", "site"),
            ("required", ~J.truthy("vm_network"), "vm_network"),
        ],
    )


def check_sites(identity: DataFrame, sites: DataFrame) -> DataFrame:
    """V3: the named site must have a site document."""
    known = sites.select("site").distinct()
    named = identity.where(F.coalesce(F.col("site"), F.lit("")) != "")
    missing = dim_join(named, known, "site", "left_anti", row_key="cluster_name")
    return missing.select("cluster_name", F.lit("unknown_site").alias("rule"), F.col("site").alias("detail"))


def check_conditional(runs: DataFrame, fleet: DataFrame) -> DataFrame:
    """V4: a run that creates DNS needs a wildcard DNS URL; a cluster without a
    segment needs a VLAN manager URL. Destroy runs need neither, and runs on
    refused clusters never come to it.
    Columns: run_id, cluster_name, rule, detail."""
    f = started(
        fleet,
        cluster_name=F.col("cluster_name"),
        __own_segment=F.col("segment"),
        __dns_ok=J.truthy("wildcard_dns_api_url"),
        __vlan_ok=J.truthy("vlan_manager_url"),
    )
    j = runs.join(f, "cluster_name")
    live = ~F.col("destroy")
    return _violations(
        j,
        ["run_id", "cluster_name"],
        [
            ("dns_url_missing", live & ~F.col("skip_dns") & ~F.col("__dns_ok"), "wildcard_dns_api_url"),
            ("vlan_url_missing", live & (F.col("__own_segment") == "") & ~F.col("__vlan_ok"), "vlan_manager_url"),
        ],
    )


def check_contract(supplied: DataFrame, contract: Sequence[tuple[str, str, bool, str | None]] = tuple(VARIABLE_CONTRACT)) -> DataFrame:
    """V6: supplied variable rows (cluster_name, variable, value) against the
    declared contract: required ones present, numbers parse, lists parse;
    undeclared names are reported. Columns: cluster_name, variable, rule.

    What a value breaks is known from its row alone. Which required names a
    cluster lacks takes one bit each, put together before the shuffle: a cluster
    is a row of eight bytes there, and one for each variable that breaks a rule
    (with the number of its rows). Both answers are read from these, written
    once, so that the supplied rows are made once."""
    names = {kind: [n for n, t, _, _ in contract if t == kind] for kind in ("number", "list(string)")}
    required = [n for n, _, needed, _ in contract if needed]
    name, value = F.col("variable"), F.col("value")
    rule = (
        F.when(~name.isin(*[n for n, *_ in contract]), F.lit("undeclared"))
        .when(name.isin(*required) & value.isNull(), F.lit("missing_required"))
        .when(name.isin(*names["number"]) & value.try_cast("double").isNull(), F.lit("not_a_number"))
        .when(name.isin(*names["list(string)"]) & J.as_str_array(value).isNull(), F.lit("not_a_list"))
    )
    bit = F.lit(None).cast("bigint")
    for i, n in enumerate(required):
        bit = F.when(name == n, F.lit(1 << i).cast("bigint")).otherwise(bit)
    judged = supplied.select("cluster_name", name, rule.alias("rule"), bit.alias("__bit"))
    judged = judged.withColumn("variable", F.when(F.col("rule").isNotNull(), name))
    found = judged.groupBy("cluster_name", "variable", "rule").agg(F.bit_or("__bit").alias("__bits"), F.count("*").alias("__n"))
    found = write_table(found, "contract")
    broken = found.where(F.col("rule").isNotNull()).select("cluster_name", "variable", "rule", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    broken = broken.select("cluster_name", "variable", "rule")
    given = found.groupBy("cluster_name").agg(F.coalesce(F.bit_or("__bits"), F.lit(0).cast("bigint")).alias("__given"))
    lacks = F.array_compact(F.array(*[F.when(F.col("__given").bitwiseAND(F.lit(1 << i).cast("bigint")) == 0, F.lit(n)) for i, n in enumerate(required)]))
    missing = given.select("cluster_name", F.explode(lacks).alias("variable"), F.lit("missing_required").alias("rule"))
    return broken.unionByName(missing)


def check_counts(supplied: DataFrame) -> DataFrame:
    """V7: supplied counts equal the lengths of the supplied lists. A count or a
    list that is missing or doesn't parse differs from one that is there.

    Each value becomes a number in its row, before the aggregate."""
    roles = ("control_plane", "compute", "infra")
    name, value = F.col("variable"), F.col("value")
    sides = supplied.where(name.isin(*[f"{r}_{side}" for r in roles for side in ("count", "ips")])).select(
        "cluster_name", "variable", F.when(name.endswith("_count"), value.try_cast("int")).otherwise(F.size(J.as_str_array("value"))).alias("__n")
    )
    number = lambda n: F.coalesce(F.max(F.when(name == n, F.col("__n"))), F.lit(-1)).alias(n)
    rows = sides.groupBy("cluster_name").agg(*[number(f"{r}_{side}") for r in roles for side in ("count", "ips")])
    rules = [(f"{r}_count", F.col(f"{r}_count") != F.col(f"{r}_ips"), f"{r}_count") for r in roles]
    return _violations(rows, ["cluster_name"], rules)


def required_tools(runs: DataFrame, fleet: DataFrame) -> DataFrame:
    """Binaries each run needs: (run_id, cluster_name, host, label, tool).
    ``oc`` is needed when the readiness loop runs or a hub URL is set, whatever
    skip_argocd says; destroy runs go through the same check, runs on refused
    clusters don't get there."""
    f = started(
        fleet,
        cluster_name=F.col("cluster_name"),
        __install=F.coalesce(J.as_text("openshift_install_bin"), F.lit("openshift-install-4.20")),
        __tf=F.coalesce(J.as_text("terraform_bin"), F.lit("terraform")),
        __hub=J.truthy("argocd_hub_api_url"),
    )
    j = runs.join(f, "cluster_name")
    need = F.array(
        F.when(~F.col("skip_ignition"), F.struct(F.lit("openshift-install").alias("label"), F.col("__install").alias("tool"))),
        F.when(~F.col("skip_terraform"), F.struct(F.lit("terraform").alias("label"), F.col("__tf").alias("tool"))),
        F.when(
            (~F.col("skip_csr") & ~F.col("skip_terraform")) | F.col("__hub"),
            F.struct(F.lit("oc").alias("label"), F.lit("oc").alias("tool")),
        ),
    )
    return j.select("run_id", "cluster_name", "host", F.inline(need)).where(F.col("tool").isNotNull())


def missing_tools(runs: DataFrame, fleet: DataFrame, host_tools: DataFrame) -> DataFrame:
    """V8: required binaries not found on the run's host:
    (run_id, cluster_name, host, label, tool)."""
    need = required_tools(runs, fleet)
    return dim_join(need, host_tools.select("host", "tool"), ["host", "tool"], "left_anti", row_key=["run_id", "label"])
