"""Configuration resolution (C1-C10): layered merge, identity, reference keys,
defaults, context, typed variables, install document, mirrors.

Values are JSON text, keyed by (cluster_name, key). The per-site profile
(defaults + site + resolved references) is computed once per site, which is
small, and reaches the clusters by a join on the site; each cluster's own
document is one map, so the winner per key is decided inside the cluster's row.
The site profiles use a ranked union with one ``max_by`` per key, which keeps an
explicit ``null`` winner. Context, variables and the install document are built
inside the plan's row and exploded last.

Secret values never leave this module: documents, site rows and resolved
references carry a fixed text in their place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..functions.joins import dim_join
from ..sources.fixed_values import (
    CODE_DEFAULTS,
    NETWORK_TYPE,
    REDACTED,
    SECRET_SOURCES,
    STRING_VARIABLES,
    TEMPLATE_DEFAULTS,
    V4_INTERNAL_SUBNET,
)

RANK = {"code": 0, "defaults": 1, "site": 2, "env": 3, "cluster": 4}
IDENTITY_KEYS = ("cluster_name", "site")
_NO_SITE = "(no site document)"  # profile key of clusters whose site has none


def _winner(rows: DataFrame, keys: Sequence[str], rank: str = "rank", carry: Sequence[str] = ("value", "layer")) -> DataFrame:
    """Keep, per ``keys``, the row of highest ``rank`` (ties: not expected)."""
    best = F.max_by(F.struct(*[F.col(c) for c in carry]), F.col(rank)).alias("__w")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__w.{c}").alias(c) for c in carry])


# --------------------------------------------------------------------------- C2
def documents_from_layer(clusters: DataFrame) -> DataFrame:
    """Long layer rows (cluster_name, key, value) to one row per document
    (cluster_name, doc MAP key -> JSON text). One aggregate: each group is one
    configuration document (a file a person writes), bounded by that document,
    not by the fleet; keys are unique within a document. Inputs that already
    hold one document per row (``scan_documents``, the fleet views) skip this."""
    return clusters.groupBy("cluster_name").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("doc")
    )


def _as_documents(clusters: DataFrame) -> DataFrame:
    return clusters if "doc" in clusters.columns else documents_from_layer(clusters)


def redacted_documents(docs: DataFrame) -> DataFrame:
    """Document rows (cluster_name, doc) without secret values."""
    return docs.withColumn("doc", J.redacted_document("doc"))


def cluster_documents(clusters: DataFrame) -> DataFrame:
    """One row per cluster document: cluster_name, doc (MAP key -> JSON text),
    and the identity read from the cluster layer only: name, site, segment
    (falsy -> ''), vlan_id (absent -> '0', explicit null -> NULL).
    ``clusters``: documents (cluster_name, doc) or long layer rows."""
    docs = redacted_documents(_as_documents(clusters)).select("cluster_name", "doc")
    seg = F.try_element_at(F.col("doc"), F.lit("segment"))
    vlan = F.try_element_at(F.col("doc"), F.lit("vlan_id"))
    return docs.select(
        "cluster_name",
        "doc",
        J.as_text(F.try_element_at(F.col("doc"), F.lit("cluster_name"))).alias("name"),
        J.as_text(F.try_element_at(F.col("doc"), F.lit("site"))).alias("site"),
        F.when(J.truthy(seg), J.as_text(seg)).otherwise(F.lit("")).alias("segment"),
        F.when(F.map_contains_key("doc", "vlan_id"), J.as_text(vlan)).otherwise(F.lit("0")).alias("vlan_id"),
    )


def fleet_identity(clusters: DataFrame) -> DataFrame:
    """Identity of each cluster document: cluster_name (scope), name, site,
    segment, vlan_id."""
    return cluster_documents(clusters).drop("doc")


# --------------------------------------------------------------------------- C3
def resolve_references(profile: DataFrame, env: DataFrame, scope: str = "site") -> DataFrame:
    """Reference keys: every ``<k>_env`` key of a (defaults + site) profile sets
    ``<k>`` to the named environment value, '' when missing or empty. What such
    a key names is a secret, so a value that is there becomes the redacted text.

    ``profile``: (scope, key, value). Returns (scope, key, value, env_name,
    resolved) where ``key`` is the base key and ``value`` its JSON text.
    """
    refs = profile.where(F.col("key").endswith("_env")).select(
        scope,
        F.regexp_replace("key", "_env$", "").alias("key"),
        J.as_text("value").alias("env_name"),
    )
    named = env.select(F.col("name").alias("env_name"), (F.col("value") != "").alias("__set"))
    looked = dim_join(refs, named, "env_name", "left")
    resolved = F.coalesce(F.col("__set"), F.lit(False))
    value = F.when(resolved, F.lit(REDACTED)).otherwise(F.lit('""'))
    return looked.select(scope, "key", value.alias("value"), "env_name", resolved.alias("resolved"))


# --------------------------------------------------------------------------- C1
def site_profiles(
    defaults: DataFrame,
    sites: DataFrame,
    env: DataFrame | None = None,
    code_defaults: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Merged profile per site document, plus one for clusters whose site has
    no document (defaults only): (profile_key, key, value, layer, rank).
    Small: (number of sites + 1) x keys. Code defaults, when given, are the
    lowest layer (they fill keys no document sets)."""
    site_ids = sites.select("site").distinct().unionByName(
        sites.sparkSession.createDataFrame([(_NO_SITE,)], "site string")
    )
    # every site inherits every default key; the defaults are one document, so
    # they fit a row and are exploded next to each site
    document = defaults.agg(F.collect_list(F.struct("key", J.redacted("key", "value").alias("value"))).alias("__defaults"))
    per_site_defaults = dim_join(site_ids.withColumn("__one", F.lit(1)), document.withColumn("__one", F.lit(1)), "__one").select(
        "site", F.inline("__defaults")
    ).select("site", "key", "value", F.lit("defaults").alias("layer"), F.lit(RANK["defaults"]).alias("rank"))
    site_rows = sites.select(
        "site", "key", J.redacted("key", "value").alias("value"), F.lit("site").alias("layer"), F.lit(RANK["site"]).alias("rank")
    )
    merged = _winner(per_site_defaults.unionByName(site_rows), ["site", "key"], carry=("value", "layer", "rank"))
    extra = []
    if env is not None:
        extra.append(
            resolve_references(merged, env).select(
                "site", "key", "value", F.lit("env").alias("layer"), F.lit(RANK["env"]).alias("rank")
            )
        )
    if code_defaults:
        entries = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in code_defaults])
        extra.append(
            site_ids.select("site", F.inline(entries)).select(
                "site", "key", "value", F.lit("code").alias("layer"), F.lit(RANK["code"]).alias("rank")
            )
        )
    for rows in extra:
        merged = merged.unionByName(rows)
    if extra:
        merged = _winner(merged, ["site", "key"], carry=("value", "layer", "rank"))
    return merged.withColumnRenamed("site", "profile_key")


def stored_profiles(profiles: DataFrame) -> DataFrame:
    """The profiles written once under the shared checkpoint folder and read
    back: every output reads the small table instead of merging it again, and
    its file size is what broadcast decisions go by."""
    from ..session import write_table

    return write_table(profiles, "profiles")


def profile_maps(profiles: DataFrame) -> DataFrame:
    """One row per site profile: (profile_key, profile MAP key ->
    struct(value, layer)). Small: one row per site document, plus one."""
    return profiles.groupBy("profile_key").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct("value", "layer")))).alias("profile")
    )


def _with_profiles(docs: DataFrame, profiles: DataFrame, attached: DataFrame) -> DataFrame:
    """Attach each cluster's row of ``attached`` (keyed by ``profile_key``), the
    defaults' one where its site has no document; adds ``site_known``."""
    known = profiles.select("profile_key").where(F.col("profile_key") != _NO_SITE).distinct().withColumn("__known", F.lit(True))
    docs = dim_join(docs.withColumn("profile_key", F.col("site")), known, "profile_key", "left", row_key="cluster_name")
    docs = docs.withColumn("site_known", F.coalesce(F.col("__known"), F.lit(False))).drop("__known")
    docs = docs.withColumn("profile_key", F.when(F.col("site_known"), F.col("profile_key")).otherwise(F.lit(_NO_SITE)))
    return dim_join(docs, attached, "profile_key", "left", row_key="cluster_name")


def merge_layers(
    clusters: DataFrame,
    defaults: DataFrame,
    sites: DataFrame,
    env: DataFrame | None = None,
    code_defaults: Sequence[tuple[str, str]] | None = None,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Three-layer merge: cluster > resolved references > site > defaults
    (> code defaults when given). Values are replaced whole; an explicit null
    wins over a lower layer. ``cluster_name`` and ``site`` of the cluster layer
    stay out of the overlay. Returns (cluster_name, key, value, layer).

    ``clusters``: one document per row (cluster_name, doc), or long rows that
    are grouped into documents first. The winner per key is decided inside the
    cluster's row: its own keys, then the profile keys it does not set.
    ``profiles``: the result of ``site_profiles``, where it is there already."""
    if profiles is None:
        profiles = site_profiles(defaults, sites, env, code_defaults)
    docs = _with_profiles(cluster_documents(clusters), profiles, profile_maps(profiles))
    own = (
        docs.select("cluster_name", F.explode("doc").alias("key", "value"))
        .where(~F.col("key").isin(*IDENTITY_KEYS))
        .withColumn("layer", F.lit("cluster"))
    )
    overridden = F.map_contains_key("doc", F.col("key")) & ~F.col("key").isin(*IDENTITY_KEYS)
    inherited = (
        docs.select("cluster_name", "doc", F.explode("profile").alias("key", "__p"))
        .where(~overridden)
        .select("cluster_name", "key", F.col("__p.value").alias("value"), F.col("__p.layer").alias("layer"))
    )
    return own.unionByName(inherited)


# --------------------------------------------------------------------------- wide
# Keys the planning operators read. A wide row carries one JSON-text column per
# key (NULL = absent everywhere, the text ``null`` = explicit null).
SETTING_KEYS = [
    "site_name", "vcenter", "vcenter_user", "datacenter", "vsphere_cluster", "vsphere_datastore_cluster",
    "vsphere_dvs_name", "vsphere_folder", "vm_template", "vm_network", "base_domain", "dns_servers",
    "gateway_offset", "infra_ip_offsets", "control_plane_ip_offsets", "bootstrap_ip_offset", "compute_ip_offsets",
    "control_plane_num_cpus", "control_plane_memory", "control_plane_disk_size",
    "infra_num_cpus", "infra_memory", "infra_disk_size",
    "compute_num_cpus", "compute_memory", "compute_disk_size", "bootstrap_disk_size",
    "cluster_network_cidr", "cluster_network_host_prefix", "service_network_cidr", "image_mirrors",
    "openshift_install_bin", "terraform_bin", "wildcard_dns_api_url", "vlan_manager_url", "vlan_manager_vrf",
    "argocd_hub_api_url", "argocd_hub_token", "argocd_hub_token_env", "argocd_namespace", "argocd_insecure_skip_tls",
    "pull_secret_path", "ssh_public_key_path", "additional_trust_bundle_path", "vcenter_password",
]


def merge_settings(
    clusters: DataFrame,
    defaults: DataFrame,
    sites: DataFrame,
    env: DataFrame | None = None,
    keys: Sequence[str] = SETTING_KEYS,
    code_defaults: Sequence[tuple[str, str]] | None = tuple(CODE_DEFAULTS),
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Wide form of the merge for a fixed key list: one row per cluster with
    identity columns, ``site_known``, the cluster's ``doc`` and ``profile_key``,
    and one resolved JSON-text column per key. A key that is in neither layer
    gets its code default (C5): absence only, an explicit null stays.

    A cluster's document map becomes a struct of the wanted keys in one pass
    (``from_json(to_json(doc))``: one scan of the document instead of one map
    lookup per key); the per-site profile is pivoted to one small row per site
    and joined by a size-checked broadcast; each key is ``coalesce(own,
    profile)`` (the own value is NULL only when absent, so an explicit null
    still wins). With document rows as input there is no shuffle.
    """
    schema = "struct<" + ",".join(f"`{k}`:string" for k in keys) + ">"
    docs = cluster_documents(clusters)
    own = docs.select(
        "cluster_name", "name", "site", "segment", "vlan_id", "doc",
        F.from_json(F.to_json("doc"), schema).alias("__own"),
    )
    if profiles is None:
        profiles = site_profiles(defaults, sites, env, code_defaults)
    prof_wide = (
        profiles.where(F.col("key").isin(*keys))
        .groupBy("profile_key")
        .pivot("key", list(keys))
        .agg(F.first("value"))
        .selectExpr("profile_key", *[f"`{k}` AS `__p_{k}`" for k in keys])
    )
    merged = _with_profiles(own, profiles, prof_wide)
    exprs = [f"coalesce(`__own`.`{k}`, `__p_{k}`) AS `{k}`" for k in keys]
    return merged.selectExpr("cluster_name", "name", "site", "segment", "vlan_id", "site_known", "doc", "profile_key", *exprs)


# --------------------------------------------------------------------------- C4
def _planned_values() -> list[tuple[str, Column]]:
    """Context entries that the address plan sets."""
    cidr = F.concat(F.col("network"), F.lit("/"), F.col("prefix_length").cast("string"))
    return [
        ("network", J.quote(cidr)),
        ("machine_network_cidr", J.quote(cidr)),
        ("prefix_length", F.col("prefix_length").cast("string")),
        ("netmask", J.quote("netmask")),
        ("gateway", J.quote("gateway")),
        ("infra_ips", F.to_json("infra_ips")),
        ("control_plane_ips", F.to_json("control_plane_ips")),
        ("bootstrap_ip", J.quote("bootstrap_ip")),
        ("compute_ips", F.to_json("compute_ips")),
    ]


def _explicit_values(work_dir: str) -> list[tuple[str, Column]]:
    """Context entries that are set last. The three network ranges have their
    code default in the settings row already."""
    return [
        ("segment", J.quote("segment")),
        ("vlan_id", F.coalesce(J.quote("vlan_id"), F.lit("null"))),
        ("vm_network", F.col("vm_network")),
        ("ignition_dir", J.quote(F.concat(F.lit(work_dir + "/"), F.col("name"), F.lit("/ignition")))),
        ("cluster_network_cidr", F.col("cluster_network_cidr")),
        ("cluster_network_host_prefix", F.col("cluster_network_host_prefix")),
        ("service_network_cidr", F.col("service_network_cidr")),
    ]


def build_context(
    plan: DataFrame,
    profiles: DataFrame,
    rendered_at: str = "1970-01-01T00:00:00Z",
    work_dir: str = "clusters",
) -> DataFrame:
    """Render context of every planned cluster: base (cluster_name, timestamp) <
    profile (own document over the site's, without code defaults) < address plan
    < explicit fields. Returns (cluster_name, key, value, source).

    All candidates stand in the cluster's row, so precedence is a matter of
    leaving out keys that a later source sets; rows come from one ``inline`` at
    the end, without a shuffle."""
    maps = profile_maps(profiles.where(F.col("layer") != "code"))
    rows = dim_join(plan, maps, "profile_key", "left", row_key="cluster_name")
    last = [(k, v, "plan") for k, v in _planned_values()] + [(k, v, "explicit") for k, v in _explicit_values(work_dir)]
    fixed = [k for k, _, _ in last]
    entry = lambda k, v, source: F.struct(k.alias("key"), v.alias("value"), F.lit(source).alias("source"))
    own = F.map_entries(F.map_filter("doc", lambda k, _: ~k.isin(*IDENTITY_KEYS, *fixed)))
    set_by_cluster = lambda k: F.map_contains_key("doc", k) & ~k.isin(*IDENTITY_KEYS)
    inherited = F.map_entries(F.map_filter("profile", lambda k, _: ~k.isin(*fixed) & ~set_by_cluster(k)))
    free = lambda k: ~F.map_contains_key("profile", k) & ~set_by_cluster(F.lit(k))
    base = [("cluster_name", J.quote("name")), ("timestamp", J.quote(F.lit(rendered_at)))]
    entries = F.concat(
        F.transform(own, lambda e: entry(e["key"], e["value"], "profile")),
        F.transform(inherited, lambda e: entry(e["key"], e["value"]["value"], "profile")),
        F.array_compact(F.array(*[F.when(free(k), entry(F.lit(k), v, "base")) for k, v in base])),
        F.array(*[entry(F.lit(k), v, source) for k, v, source in last]),
    )
    return rows.select("cluster_name", F.inline(F.when(F.col("net").isNotNull(), entries)))


# --------------------------------------------------------------------------- C6
def first_available(fleet: DataFrame, files: DataFrame, env: DataFrame) -> DataFrame:
    """Where each secret input comes from: file at the profile path (content
    used even if blank), else the environment, else a literal. Only the source
    and whether a non-empty value results are kept, never the value.
    ``fleet``: wide settings rows (one per cluster, path keys as columns).
    Returns (cluster_name, item, path, source, present)."""
    items = fleet.select(
        "cluster_name",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(item).alias("item"),
                        F.coalesce(J.as_text(F.col(key)), F.lit(default)).alias("path"),
                        F.lit(env_name).cast("string").alias("env_name"),
                    )
                    for item, key, default, env_name in SECRET_SOURCES
                ]
            )
        ),
    )
    rows = ["cluster_name", "item"]
    with_file = dim_join(items, files.select("path", F.col("nonblank").alias("__nonblank")), "path", "left", row_key=rows)
    with_env = dim_join(
        with_file, env.select(F.col("name").alias("env_name"), F.col("value").alias("__env")), "env_name", "left", row_key=rows
    )
    item = F.col("item")
    has_file = F.col("__nonblank").isNotNull()
    env_val = F.col("__env")
    source = (
        F.when(has_file, F.lit("file"))
        .when((item == "pull_secret") & env_val.isNotNull(), F.lit("env"))
        .when((item == "ssh_key") & (F.coalesce(env_val, F.lit("")) != ""), F.lit("env"))
        .when(item == "pull_secret", F.lit("literal"))
        .otherwise(F.lit("none"))
    )
    present = (
        F.when(has_file, F.col("__nonblank"))
        .when((item == "pull_secret") & env_val.isNotNull(), env_val != "{}")
        .when((item == "ssh_key") & (F.coalesce(env_val, F.lit("")) != ""), F.lit(True))
        .otherwise(F.lit(False))
    )
    return with_env.select("cluster_name", "item", "path", source.alias("source"), present.alias("present"))


# --------------------------------------------------------------------------- C7
LIST_VARIABLES = ("vm_dns_addresses", "control_plane_ips", "compute_ips", "infra_ips")


def _text(value: Column) -> Column:
    """Rendered text of a context value: undefined -> '', null -> 'None'."""
    return F.when(value.isNull(), F.lit("")).when(value == "null", F.lit("None")).otherwise(J.as_text(value))


def _number_text(key: str) -> Column:
    v = F.col(key)
    return F.when(v.isNull(), F.lit(str(TEMPLATE_DEFAULTS[key]))).when(v == "null", F.lit("None")).otherwise(J.as_text(v))


def _variables(work_dir: str = "clusters") -> list[tuple[str, Column]]:
    """Every variable as rendered text, from a plan row."""
    cidr = F.concat(F.col("network"), F.lit("/"), F.col("prefix_length").cast("string"))
    planned = {"cluster_name": F.col("name"), "machine_network_cidr": cidr, "gateway": F.col("gateway"), "bootstrap_ip": F.col("bootstrap_ip")}
    folder = F.concat(F.lit(work_dir + "/"), F.col("name"), F.lit("/ignition"))
    ignition = {"bootstrap": "bootstrap", "control_plane": "master", "compute": "worker", "infra": "worker"}
    pairs = [(name, F.coalesce(planned[key], F.lit("")) if key in planned else _text(F.col(key))) for name, key in STRING_VARIABLES]
    pairs += [
        ("vsphere_password", F.lit("<redacted>")),
        ("vm_dns_addresses", F.coalesce(F.col("dns_servers"), F.lit("[]"))),
        ("cluster_domain", F.concat(F.col("name"), F.lit("."), _text(F.col("base_domain")))),
        *((f"{role}_ignition_path", F.concat(folder, F.lit(f"/{file}.ign"))) for role, file in ignition.items()),
    ]
    for role in ("control_plane", "compute", "infra"):
        ips = F.coalesce(F.col(f"{role}_ips"), F.array().cast("array<string>"))
        pairs += [(f"{role}_ips", F.to_json(ips)), (f"{role}_count", F.size(ips).cast("string"))]
    return pairs + [(key, _number_text(key)) for key in TEMPLATE_DEFAULTS]


def variables_long(plan: DataFrame) -> DataFrame:
    """Provisioning variables of every planned cluster as rendered text:
    (cluster_name, variable, value). Lists are JSON arrays. The password is
    represented by presence only. One ``inline`` of the plan's row."""
    rows = F.array(*[F.struct(F.lit(n).alias("variable"), v.alias("value")) for n, v in _variables()])
    return plan.select("cluster_name", F.inline(F.when(F.col("net").isNotNull(), rows)))


def to_variables(plan: DataFrame) -> DataFrame:
    """Typed variable row per planned cluster (numbers INT, lists ARRAY<STRING>)."""

    def typed(name: str, value: Column) -> Column:
        if name in LIST_VARIABLES:
            return J.as_str_array(value)
        return value.try_cast("int") if name.endswith("_count") or name in TEMPLATE_DEFAULTS else value

    row = F.struct(*[typed(n, v).alias(n) for n, v in _variables()])
    return plan.select("cluster_name", F.inline(F.when(F.col("net").isNotNull(), F.array(row))))


# --------------------------------------------------------------------------- C8/C9/C10
MIRROR_SCHEMA = "array<struct<source:string,mirror:string>>"


def explode_mirrors(settings: DataFrame) -> DataFrame:
    """One row per (cluster, position, source, mirror), list order kept (1-based)."""
    return settings.select("cluster_name", F.posexplode(F.from_json("image_mirrors", MIRROR_SCHEMA))).select(
        "cluster_name",
        (F.col("pos") + 1).cast("int").alias("position"),
        F.col("col.source").alias("source"),
        F.col("col.mirror").alias("mirror"),
    )


def to_install_struct(plan: DataFrame, files: DataFrame) -> DataFrame:
    """Install document per planned cluster as a nested row: networking block,
    trust bundle flag (present only if the file holds something), mirrors.
    ``files``: (path, nonblank). Columns: cluster_name, install (STRUCT)."""
    _, key, default, _ = next(s for s in SECRET_SOURCES if s[0] == "trust_bundle")
    bundle = files.select(F.col("path").alias("__path"), F.col("nonblank").alias("__bundle"))
    path = F.coalesce(J.as_text(key), F.lit(default))
    rows = dim_join(plan.withColumn("__path", path), bundle, "__path", "left", row_key="cluster_name")
    install = F.struct(
        F.col("name").alias("name"),
        _text(F.col("base_domain")).alias("base_domain"),
        F.struct(
            F.lit(NETWORK_TYPE).alias("network_type"),
            _text(F.col("cluster_network_cidr")).alias("cluster_network_cidr"),
            J.as_int("cluster_network_host_prefix").alias("host_prefix"),
            _text(F.col("service_network_cidr")).alias("service_network_cidr"),
            F.lit(V4_INTERNAL_SUBNET).alias("v4_internal_subnet"),
        ).alias("networking"),
        F.coalesce(F.col("__bundle"), F.lit(False)).alias("has_trust_bundle"),
        F.coalesce(F.from_json("image_mirrors", MIRROR_SCHEMA), F.array().cast(MIRROR_SCHEMA)).alias("mirrors"),
    )
    one = F.array(F.struct(install.alias("install")))
    return rows.select("cluster_name", F.inline(F.when(F.col("net").isNotNull(), one)))
