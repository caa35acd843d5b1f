"""DuckDB oracle SQL for the registered queries.

Each query is ``WITH <views> SELECT ...`` over the driver's pre-registered
tables. The views derive the fleet inputs with the same rules as
``fleetplan.plans.views``; the operators are written the plain long-form way
(row_number winners, unions, distinct), independent of the Spark plans.
"""

from __future__ import annotations

from fleetplan.sources.fixed_values import CODE_DEFAULTS, DEFAULTS_DOCUMENT, TEMPLATE_DEFAULTS, VARIABLE_CONTRACT

NO_SITE = "(no site document)"


def _lit(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) if not isinstance(v, (bool, int)) else str(v).upper() if isinstance(v, bool) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def q(col: str) -> str:
    """JSON-quote text (values here hold no quotes or backslashes)."""
    return f"('\"' || {col} || '\"')"


TXT = "json_extract_string({0}, '$')"


def txt(c: str) -> str:
    return TXT.format(c)


def truthy(c: str) -> str:
    return (
        f"(CASE WHEN {c} IS NULL THEN FALSE WHEN trim({c}) IN ('null','false','\"\"','[]','{{}}') THEN FALSE "
        f"WHEN regexp_matches(trim({c}), '^-?0+(\\.0*)?([eE][-+]?[0-9]+)?$') THEN FALSE ELSE TRUE END)"
    )


V: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    V[name] = (deps, sql)


def seed_sql(base: str = "customer") -> str:
    if base == "customer":
        src = "SELECT c_custkey AS k, lower(c_mktsegment) AS tag, c_nationkey AS nation, c_name AS alt_name FROM customer"
    else:
        src = ("SELECT o_orderkey AS k, 'ord' || lower(o_orderstatus) AS tag, CAST(o_custkey % 25 AS INTEGER) AS nation, "
               "'Order#' || o_orderkey AS alt_name FROM orders")
    return f"""
SELECT k, nation, file AS cluster_name, CASE WHEN k % 10 = 6 THEN 'n-' || file ELSE file END AS name,
  CASE WHEN k % 50 = 4 THEN NULL WHEN k % 40 = 3 THEN 'site-99' ELSE 'site-' || nation END AS site,
  CASE WHEN k % 90 = 17 THEN 'fd00::/64' WHEN k % 90 = 37 THEN '10.300.0.0/24' WHEN k % 90 = 57 THEN '255.255.255.200/25'
       WHEN k % 10 <> 0 THEN '10.' || ((k // 256) % 256) || '.' || (k % 256) || '.77/' ||
       CASE WHEN k % 10 = 5 THEN '28' ELSE '24' END END AS segment,
  CAST(CASE WHEN k % 10 NOT IN (0, 3) THEN 100 + k % 3900 END AS BIGINT) AS vlan_id
FROM (SELECT *, CASE WHEN k % 50 = 0 THEN alt_name
       WHEN k % 50 = 1 THEN tag || '-' || k || '-'
       WHEN k % 50 = 2 THEN tag || '-' || k || '-way-too-long-name-xx'
       ELSE tag || '-' || k END AS file FROM ({src}) s) t"""


view("seed", [], seed_sql())


def _kv_union(src: str, scope: str, entries: list[tuple[str, str, str]]) -> str:
    parts = []
    for key, value, cond in entries:
        where = f" WHERE {cond}" if cond else ""
        parts.append(f"SELECT {scope}, '{key}' AS key, {value} AS value FROM {src}{where}")
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE value IS NOT NULL"


view("clusters", ["seed"], _kv_union("seed", "cluster_name", [
    ("cluster_name", q("name"), ""),
    ("site", q("site"), ""),
    ("segment", f"CASE WHEN segment IS NOT NULL THEN {q('segment')} WHEN k % 20 = 10 THEN 'null' END", ""),
    ("vlan_id", "CAST(vlan_id AS VARCHAR)", ""),
    ("vm_network", q("'VLAN' || (100 + k % 3900) || '-OCP'"), "k % 25 <> 7"),
    ("compute_ip_offsets", "CASE k % 4 WHEN 0 THEN '[]' WHEN 1 THEN '[8]' WHEN 2 THEN '[8,9]' ELSE '[8,9,10]' END", "k % 8 <> 4"),
    ("search_domain", "'null'", "k % 9 = 0"),
    ("control_plane_memory", "'32768'", "k % 6 = 0"),
    ("infra_memory", "'\"32G\"'", "k % 23 = 0"),
    ("argocd_hub_api_url", q("'https://api.hub-' || (k % 7) || '.example.local:6443'"), "k % 3 = 0"),
    ("argocd_hub_token", "'\"<redacted>\"'", "k % 6 = 0"),
    ("argocd_hub_token_env", q("'HUB_TOKEN_' || (k % 4)"), "k % 6 = 3"),
    ("argocd_namespace", "'\"gitops\"'", "k % 5 = 0"),
    ("argocd_insecure_skip_tls", "'true'", "k % 7 = 0"),
    ("wildcard_dns_api_url", "'\"\"'", "k % 31 = 5"),
    ("vlan_manager_url", "'null'", "k % 37 = 10"),
]))

view("nr", [], "SELECT n.*, r.r_name, 'site-' || n_nationkey AS site FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")

view("sites", ["nr"], _kv_union("nr", "site", [
    ("site_name", q("site"), ""),
    ("vcenter", q("'vcenter.' || site || '.example.local'"), ""),
    ("vcenter_user", "'\"administrator@vsphere.local\"'", ""),
    ("vcenter_password_env", q("'VC_PW_' || n_regionkey"), ""),
    ("datacenter", q("'DC-' || n_name"), ""),
    ("vsphere_cluster", q("'Cluster-' || n_nationkey"), ""),
    ("vsphere_datastore_cluster", q("'DSC-' || n_nationkey"), ""),
    ("vsphere_dvs_name", q("'DVS-' || n_nationkey"), ""),
    ("vsphere_folder", q("'/DC-' || n_name || '/vm/OCP-Clusters'"), ""),
    ("vm_template", "'\"rhcos-420\"'", ""),
    ("base_domain", q("replace(lower(r_name), ' ', '-') || '.ocp.example.local'"), ""),
    ("search_domain", "'\"example.local\"'", ""),
    ("dns_servers", "'[\"10.100.' || n_regionkey || '.10\",\"10.100.' || n_regionkey || '.11\"]'", ""),
    ("image_mirrors", "'[{\"source\":\"registry.redhat.io\",\"mirror\":\"mirror.' || site || '.example.local:5000\"}]'", "n_nationkey % 5 = 0"),
    ("control_plane_num_cpus", "'16'", "n_nationkey % 3 = 0"),
    ("segment", "'\"10.9.9.0/24\"'", "n_nationkey % 7 = 1"),
    ("argocd_hub_token_env", "'\"HUB_TOKEN_SITE\"'", "n_nationkey % 4 = 2"),
    ("pull_secret_path", q("'config/pull-secret-' || n_nationkey || '.json'"), "n_nationkey % 3 = 1"),
]))

view("defaults", [], "SELECT * FROM " + _values(DEFAULTS_DOCUMENT, ["key", "value"]))
view("code_defaults", [], "SELECT * FROM " + _values(CODE_DEFAULTS, ["key", "value"]))

view("env", [], """
SELECT 'VC_PW_' || r_regionkey AS name, CASE WHEN r_regionkey = 3 THEN '' ELSE 'pw-' || r_regionkey END AS value FROM region WHERE r_regionkey <> 4
UNION ALL SELECT 'HUB_TOKEN_' || r_regionkey, 'hub-' || r_regionkey FROM region WHERE r_regionkey IN (0, 2)
UNION ALL SELECT 'PULL_SECRET', '{"auths":{}}' FROM region WHERE r_regionkey = 0
UNION ALL SELECT 'SSH_PUBLIC_KEY', 'ssh-ed25519 AAAA' FROM region WHERE r_regionkey = 1""")

view("host_files", [], """
SELECT 'config/pull-secret-' || n_nationkey || '.json' AS path, n_nationkey % 4 <> 3 AS nonblank FROM nation WHERE n_nationkey % 2 = 1
UNION ALL SELECT 'config/additional-trust-bundle.pem', TRUE FROM nation WHERE n_nationkey = 0""")

view("allocs", ["seed"], """
SELECT cluster_name, site,
  '10.' || (200 + ((k // 10) // 256) % 4) || '.' || ((k // 10) % 256) || '.0/24' AS segment,
  CAST(CASE WHEN k % 70 <> 0 THEN 2000 + (k // 10) % 1000 END AS BIGINT) AS vlan_id
FROM seed WHERE k % 10 = 0 AND k % 30 <> 0""")

# identity (C2)
view("identity", ["clusters"], f"""
SELECT cluster_name, name, site,
  CASE WHEN {truthy('seg')} THEN {txt('seg')} ELSE '' END AS segment,
  CASE WHEN has_vlan = 1 THEN {txt('vlan')} ELSE '0' END AS vlan_id
FROM (SELECT cluster_name,
        max(CASE WHEN key = 'cluster_name' THEN {txt('value')} END) AS name,
        max(CASE WHEN key = 'site' THEN {txt('value')} END) AS site,
        max(CASE WHEN key = 'segment' THEN value END) AS seg,
        max(CASE WHEN key = 'vlan_id' THEN value END) AS vlan,
        max(CASE WHEN key = 'vlan_id' THEN 1 ELSE 0 END) AS has_vlan
      FROM clusters GROUP BY cluster_name)""")

# site profiles (C1 + C3, per site)
view("prof0", ["sites", "defaults"], f"""
SELECT site, key, value, layer, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY site, key ORDER BY rank DESC) AS rn FROM (
    SELECT s.site, d.key, d.value, 'defaults' AS layer, 1 AS rank
    FROM (SELECT DISTINCT site FROM sites UNION ALL SELECT '{NO_SITE}') s CROSS JOIN defaults d
    UNION ALL SELECT site, key, value, 'site', 2 FROM sites))
WHERE rn = 1""")

view("env_refs", ["prof0", "env"], f"""
SELECT p.site, regexp_replace(p.key, '_env$', '') AS key, {txt('p.value')} AS env_name,
  CASE WHEN coalesce(e.value, '') <> '' THEN '"<redacted>"' ELSE '""' END AS value, coalesce(e.value, '') <> '' AS resolved
FROM prof0 p LEFT JOIN env e ON e.name = {txt('p.value')}
WHERE p.key LIKE '%\\_env' ESCAPE '\\'""")

view("profile", ["prof0", "env_refs"], """
SELECT site AS profile_key, key, value, layer, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY site, key ORDER BY rank DESC) AS rn FROM (
    SELECT site, key, value, layer, rank FROM prof0
    UNION ALL SELECT site, key, value, 'env', 3 FROM env_refs))
WHERE rn = 1""")

view("fleet_keys", ["identity", "sites"], f"""
SELECT cluster_name, site,
  CASE WHEN site IN (SELECT site FROM sites) THEN site ELSE '{NO_SITE}' END AS profile_key
FROM identity""")

view("candidates", ["fleet_keys", "profile", "clusters"], """
SELECT f.cluster_name, p.key, p.value, p.layer, p.rank FROM fleet_keys f JOIN profile p ON p.profile_key = f.profile_key
UNION ALL SELECT cluster_name, key, value, 'cluster', 4 FROM clusters WHERE key NOT IN ('cluster_name', 'site')""")

view("effective", ["candidates"], """
SELECT cluster_name, key, value, layer FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_name, key ORDER BY rank DESC) AS rn FROM candidates)
WHERE rn = 1""")

view("settings_long", ["effective", "identity", "code_defaults"], """
SELECT cluster_name, key, value, layer FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_name, key ORDER BY rank DESC) AS rn FROM (
    SELECT cluster_name, key, value, layer, 1 AS rank FROM effective
    UNION ALL SELECT i.cluster_name, d.key, d.value, 'code', 0 FROM identity i CROSS JOIN code_defaults d))
WHERE rn = 1""")

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

view("settings", ["settings_long", "identity"], "SELECT i.cluster_name, i.name, i.site, i.segment, i.vlan_id, "
     + ", ".join(f"w.{k}" for k in SETTING_KEYS)
     + " FROM identity i LEFT JOIN (SELECT cluster_name, "
     + ", ".join(f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in SETTING_KEYS)
     + " FROM settings_long GROUP BY cluster_name) w ON w.cluster_name = i.cluster_name")

# Allocation applied
view("fleet", ["settings", "allocs"], """
SELECT * EXCLUDE (segment, vlan_id, a_segment, a_vlan, ok),
  CASE WHEN segment <> '' THEN segment WHEN ok THEN a_segment ELSE '' END AS segment,
  CASE WHEN segment <> '' THEN vlan_id WHEN ok THEN CAST(a_vlan AS VARCHAR) END AS vlan_id,
  CASE WHEN segment <> '' THEN 'own' WHEN ok THEN 'allocated' ELSE 'missing' END AS segment_source
FROM (SELECT s.*, a.segment AS a_segment, a.vlan_id AS a_vlan,
             coalesce(a.segment, '') <> '' AND s.site IS NOT DISTINCT FROM a.site AS ok
      FROM settings s LEFT JOIN allocs a ON a.cluster_name = s.cluster_name)""")


def ip_to_long(c: str) -> str:
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])"
    pat = f"^{octet}\\.{octet}\\.{octet}\\.{octet}$"
    return (f"(CASE WHEN regexp_matches({c}, '{pat}') THEN "
            f"CAST(split_part({c}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({c}, '.', 2) AS BIGINT) * 65536 + "
            f"CAST(split_part({c}, '.', 3) AS BIGINT) * 256 + CAST(split_part({c}, '.', 4) AS BIGINT) END)")


def long_to_ip(c: str) -> str:
    return (f"(CASE WHEN {c} >= 0 AND {c} < 4294967296 THEN "
            f"CAST(({c} >> 24) & 255 AS VARCHAR) || '.' || CAST(({c} >> 16) & 255 AS VARCHAR) || '.' || "
            f"CAST(({c} >> 8) & 255 AS VARCHAR) || '.' || CAST({c} & 255 AS VARCHAR) END)")


def cidr_cte(src: str, col: str) -> str:
    """Adds net (BIGINT), plen (INT), mask (BIGINT) to every row of src."""
    mask_prefix = ("(CASE WHEN ((4294967295 - m) & (4294967295 - m + 1)) = 0 THEN bit_count(m) "
                   "WHEN (m & (m + 1)) = 0 THEN 32 - bit_count(m) END)")
    return f"""
SELECT *, CASE WHEN addr IS NOT NULL AND plen IS NOT NULL THEN addr & mask0 END AS net,
          CASE WHEN addr IS NOT NULL AND plen IS NOT NULL THEN plen END AS prefix,
          CASE WHEN addr IS NOT NULL AND plen IS NOT NULL THEN mask0 END AS mask
FROM (SELECT *, CASE WHEN plen IS NOT NULL THEN 4294967296 - (CAST(1 AS BIGINT) << (32 - plen)) END AS mask0
  FROM (SELECT *, CAST(CASE WHEN sfx IS NULL THEN 32
                 WHEN regexp_matches(sfx, '^[0-9]+$') THEN CASE WHEN regexp_matches(sfx, '^0*([0-9]|[12][0-9]|3[0-2])$') THEN CAST(right('0' || sfx, 2) AS BIGINT) END
                 ELSE (SELECT {mask_prefix} FROM (SELECT {ip_to_long('sfx')} AS m)) END AS INTEGER) AS plen
    FROM (SELECT *, {ip_to_long("CASE WHEN strpos(" + col + ", '/') > 0 THEN split_part(" + col + ", '/', 1) ELSE " + col + " END")} AS addr,
                 CASE WHEN strpos({col}, '/') > 0 THEN substr({col}, strpos({col}, '/') + 1) END AS sfx
          FROM {src})))"""


def offsets(c: str) -> str:
    return f"CAST(json({c}) AS INTEGER[])"


def at(off: str) -> str:
    return f"(CASE WHEN net + ({off}) >= 0 AND net + ({off}) < 4294967296 THEN net + ({off}) END)"


# the tool ends a run before its first phase on a cluster without a good name or a known site
view("gated", ["identity", "sites"], """
SELECT cluster_name FROM identity i
WHERE coalesce(i.name, '') <> '' AND length(i.name) <= 27 AND regexp_full_match(i.name, '[\\p{L}\\p{N}-]*')
  AND NOT starts_with(i.name, '-') AND NOT ends_with(i.name, '-')
  AND coalesce(i.site, '') <> '' AND i.site IN (SELECT site FROM sites)""")
# V1 to V3: the tool exits before planning a cluster that fails one of them.
view("allowed", ["gated", "settings"], f"""
SELECT s.cluster_name FROM settings s WHERE s.cluster_name IN (SELECT cluster_name FROM gated) AND {truthy('s.vm_network')}""")

# a plan exists only if every address does: an address outside IPv4 ends the run
view("plan", ["planned"], """
SELECT * FROM planned WHERE net IS NOT NULL AND gateway IS NOT NULL AND bootstrap_ip IS NOT NULL
  AND len(list_filter(list_concat(list_concat(infra_ips, control_plane_ips), compute_ips), lambda a: a IS NULL)) = 0""")
view("planned", ["fleet", "allowed"], f"""
SELECT *, {long_to_ip('net')} AS network, prefix AS prefix_length, {long_to_ip('mask')} AS netmask,
  {long_to_ip(at("CAST(" + txt('gateway_offset') + " AS INTEGER)"))} AS gateway,
  {long_to_ip(at("CAST(" + txt('bootstrap_ip_offset') + " AS INTEGER)"))} AS bootstrap_ip,
  list_transform({offsets('infra_ip_offsets')}, lambda o: {long_to_ip(at('o'))}) AS infra_ips,
  list_transform({offsets('control_plane_ip_offsets')}, lambda o: {long_to_ip(at('o'))}) AS control_plane_ips,
  list_transform({offsets('compute_ip_offsets')}, lambda o: {long_to_ip(at('o'))}) AS compute_ips
FROM ({cidr_cte("(SELECT * FROM fleet WHERE cluster_name IN (SELECT cluster_name FROM allowed))", "segment")})""")

ROLE_LABELS = [("bootstrap", "bootstrap"), ("control_plane", "control-plane"), ("compute", "compute"), ("infra", "infra")]

view("nodes", ["plan"], f"""
SELECT cluster_name, role, ordinal, fqdn, ip, domain FROM (
  SELECT cluster_name, 'bootstrap' AS role, 0 AS ordinal,
         name || '-bootstrap.' || name || '.' || coalesce({txt('base_domain')}, '') AS fqdn,
         bootstrap_ip AS ip, name || '.' || coalesce({txt('base_domain')}, '') AS domain FROM plan
  """ + "".join(f"""
  UNION ALL
  SELECT cluster_name, '{r}', CAST(i AS INTEGER),
         name || '-{lab}-' || printf('%02d', i) || '.' || name || '.' || coalesce({txt('base_domain')}, ''),
         ips[i], name || '.' || coalesce({txt('base_domain')}, '')
  FROM plan, LATERAL (SELECT {r}_ips AS ips) x, range(1, len({r}_ips) + 1) t(i)""" for r, lab in ROLE_LABELS[1:]) + ")")


_ONCE = {"effective", "settings", "plan", "planned", "context", "ctx_wide", "variables", "supplied", "headed", "parsed", "file_parsed"}


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in V[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    # what is read several times is computed once
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in _ONCE else ''}({V[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"


Q: dict[str, str] = {}


def query(name: str, deps: list[str], body: str) -> None:
    Q[name] = with_views(deps, body)


def oracle_queries() -> dict[str, str]:
    return dict(Q)


# ============================================================== configuration
query("config_identity", ["identity"], "SELECT cluster_name, name, site, segment, vlan_id FROM identity")
query("config_effective", ["effective"], "SELECT cluster_name, key, value, layer FROM effective")
query("config_env_refs", ["env_refs"], "SELECT site, key, env_name, resolved FROM env_refs")
query("config_defaults", ["settings_long"], "SELECT cluster_name, key, value, layer FROM settings_long")

# ============================================================== addressing
query("cidr_normalize", ["fleet"], f"""
SELECT cluster_name, segment, {long_to_ip('net')} AS network, prefix AS prefix_length, {long_to_ip('mask')} AS netmask,
       net IS NOT NULL AS valid
FROM ({cidr_cte("(SELECT cluster_name, segment FROM fleet)", "segment")})""")

query("allocation_requests", ["settings", "gated"], f"""
SELECT cluster_name, site, {txt('vlan_manager_vrf')} AS vrf,
       regexp_replace({txt('vlan_manager_url')}, '/+$', '') || '/api/allocate-vlan' AS endpoint
FROM settings WHERE segment = '' AND cluster_name IN (SELECT cluster_name FROM gated)""")

query("apply_allocations", ["fleet"], "SELECT cluster_name, segment, vlan_id, segment_source FROM fleet")

query("address_plan", ["plan"], f"""
SELECT cluster_name, role, CAST(ordinal AS INTEGER) AS ordinal, ip,
       coalesce((({ip_to_long('ip')}) & mask) = net, FALSE) AS in_segment
FROM (
  SELECT cluster_name, net, mask, 'gateway' AS role, 0 AS ordinal, gateway AS ip FROM plan
  UNION ALL SELECT cluster_name, net, mask, 'bootstrap', 0, bootstrap_ip FROM plan
  """ + "".join(f"""UNION ALL SELECT cluster_name, net, mask, '{r}', i, {r}_ips[i] FROM plan, range(1, len({r}_ips) + 1) t(i)
  """ for r in ("infra", "control_plane", "compute")) + ")")

# ============================================================== roster
query("nodes", ["nodes"], "SELECT cluster_name, role, ordinal, fqdn, ip FROM nodes")


def _size(key: str) -> str:
    return f"(CASE WHEN {key} IS NULL THEN {TEMPLATE_DEFAULTS[key]} ELSE TRY_CAST({txt(key)} AS INTEGER) END)"


query("node_sizing", ["nodes", "plan"], f"""
SELECT n.cluster_name, n.fqdn, n.role,
  CAST(CASE n.role WHEN 'bootstrap' THEN 2 WHEN 'control_plane' THEN {_size('control_plane_num_cpus')}
    WHEN 'compute' THEN {_size('compute_num_cpus')} ELSE {_size('infra_num_cpus')} END AS INTEGER) AS num_cpus,
  CAST(CASE n.role WHEN 'bootstrap' THEN 8192 WHEN 'control_plane' THEN {_size('control_plane_memory')}
    WHEN 'compute' THEN {_size('compute_memory')} ELSE {_size('infra_memory')} END AS INTEGER) AS memory_mb,
  CAST(CASE n.role WHEN 'bootstrap' THEN {_size('bootstrap_disk_size')} WHEN 'control_plane' THEN {_size('control_plane_disk_size')}
    WHEN 'compute' THEN {_size('compute_disk_size')} ELSE {_size('infra_disk_size')} END AS INTEGER) AS disk_gb
FROM nodes n JOIN plan p ON p.cluster_name = n.cluster_name""")

query("node_counts", ["plan"], """
SELECT cluster_name, 'bootstrap' AS role, CAST(1 AS BIGINT) AS node_count FROM plan
UNION ALL SELECT cluster_name, 'control_plane', CAST(len(control_plane_ips) AS BIGINT) FROM plan
UNION ALL SELECT cluster_name, 'compute', CAST(len(compute_ips) AS BIGINT) FROM plan
UNION ALL SELECT cluster_name, 'infra', CAST(len(infra_ips) AS BIGINT) FROM plan""")

query("network_args", ["nodes", "plan"], f"""
SELECT n.cluster_name, n.fqdn, split_part(n.fqdn, '.', 1) AS host,
  'ip=' || n.ip || '::' || p.gateway || ':' || p.netmask || ':' || split_part(n.fqdn, '.', 1) || ':ens192:none:' ||
    CAST(json(p.dns_servers) AS VARCHAR[])[1] AS kargs,
  array_to_string(list_transform(coalesce(CAST(json(p.dns_servers) AS VARCHAR[]), []), lambda d, i: 'DNS' || i || '=' || d), chr(10)) AS dns_lines,
  p.prefix_length AS prefix
FROM nodes n JOIN plan p ON p.cluster_name = n.cluster_name""")

# ============================================================== DNS
query("forward_records", ["nodes"], "SELECT cluster_name, fqdn AS name, 'A' AS type, 86400 AS ttl, ip AS value FROM nodes")
query("reverse_records", ["nodes"], """
SELECT cluster_name, split_part(ip, '.', 4) || '.' || split_part(ip, '.', 3) || '.' || split_part(ip, '.', 2) || '.' ||
  split_part(ip, '.', 1) || '.in-addr.arpa.' AS name, 'PTR' AS type, 86400 AS ttl, fqdn || '.' AS value FROM nodes""")
view("api_rec", ["nodes"], """
SELECT cluster_name, p || '.' || domain AS name, 'A' AS type, 86400 AS ttl, ip AS value
FROM (SELECT DISTINCT cluster_name, domain, ip FROM nodes WHERE role IN ('bootstrap', 'control_plane')),
     (VALUES ('api'), ('api-int')) t(p)""")
query("api_records", ["api_rec"], "SELECT * FROM api_rec")
view("apps_rec", ["nodes"], "SELECT DISTINCT cluster_name, '*.apps.' || domain AS name, 'A' AS type, 86400 AS ttl, ip AS value FROM nodes WHERE role = 'infra'")
query("wildcard_records", ["apps_rec"], "SELECT * FROM apps_rec")
view("records", ["nodes", "api_rec", "apps_rec"], """
SELECT DISTINCT * FROM (
  SELECT cluster_name, fqdn AS name, 'A' AS type, 86400 AS ttl, ip AS value FROM nodes
  UNION ALL SELECT cluster_name, split_part(ip, '.', 4) || '.' || split_part(ip, '.', 3) || '.' || split_part(ip, '.', 2) || '.' ||
    split_part(ip, '.', 1) || '.in-addr.arpa.', 'PTR', 86400, fqdn || '.' FROM nodes
  UNION ALL SELECT * FROM api_rec
  UNION ALL SELECT * FROM apps_rec)""")
query("record_set", ["records"], "SELECT * FROM records")

# ============================================================== validation
TR = truthy
query("check_names", ["identity"], """
SELECT cluster_name, 'name_too_long' AS rule, CAST(length(name) AS VARCHAR) AS detail FROM identity WHERE name IS NOT NULL AND length(name) > 27
UNION ALL SELECT cluster_name, 'name_characters', name FROM identity WHERE name IS NOT NULL AND NOT regexp_full_match(name, '[\\p{L}\\p{N}-]*')
UNION ALL SELECT cluster_name, 'name_hyphen_edge', name FROM identity WHERE name IS NOT NULL AND (starts_with(name, '-') OR ends_with(name, '-'))""")

query("check_required", ["settings"], f"""
SELECT cluster_name, 'required' AS rule, 'cluster_name' AS detail FROM settings WHERE coalesce(name, '') = ''
UNION ALL SELECT cluster_name, 'required', 'site' FROM settings WHERE coalesce(site, '') = ''
UNION ALL SELECT cluster_name, 'required', 'vm_network' FROM settings WHERE NOT {TR('vm_network')}""")

query("check_sites", ["identity", "sites"], """
SELECT cluster_name, 'unknown_site' AS rule, site AS detail FROM identity
WHERE coalesce(site, '') <> '' AND site NOT IN (SELECT site FROM sites)""")

query("check_allocations", ["allocs"], """
SELECT cluster_name, 'allocation_segment' AS rule, 'segment missing' AS detail FROM allocs WHERE coalesce(segment, '') = ''
UNION ALL SELECT cluster_name, 'allocation_vlan', 'vlan_id missing' FROM allocs WHERE vlan_id IS NULL""")

view("runs", ["seed"], """
SELECT o.o_orderkey AS run_id, s.cluster_name, o.o_orderkey % 13 = 0 AS destroy, o.o_orderkey % 2 = 0 AS skip_dns,
  o.o_orderkey % 3 = 0 AS skip_terraform, o.o_orderkey % 5 = 0 AS skip_csr, o.o_orderkey % 7 = 0 AS skip_ignition,
  o.o_orderkey % 11 = 0 AS skip_argocd, 45 AS csr_timeout, 'bastion-' || (o.o_orderkey % 10) AS host
FROM orders o JOIN seed s ON s.k = o.o_custkey""")
view("live_runs", ["runs", "gated"], "SELECT r.* FROM runs r WHERE r.cluster_name IN (SELECT cluster_name FROM gated)")

query("check_plan", ["planned"], """
SELECT cluster_name, CASE WHEN segment = '' THEN 'no_segment' WHEN contains(segment, ':') THEN 'ipv6_segment'
    WHEN net IS NULL THEN 'invalid_cidr' ELSE 'address_out_of_range' END AS rule, segment AS detail
FROM planned WHERE net IS NULL OR gateway IS NULL OR bootstrap_ip IS NULL
  OR len(list_filter(list_concat(list_concat(infra_ips, control_plane_ips), compute_ips), lambda a: a IS NULL)) > 0""")

query("check_conditional", ["live_runs", "settings"], f"""
SELECT r.run_id, r.cluster_name, 'dns_url_missing' AS rule, 'wildcard_dns_api_url' AS detail
FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name WHERE NOT destroy AND NOT skip_dns AND NOT {TR('s.wildcard_dns_api_url')}
UNION ALL SELECT r.run_id, r.cluster_name, 'vlan_url_missing', 'vlan_manager_url'
FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name WHERE NOT destroy AND s.segment = '' AND NOT {TR('s.vlan_manager_url')}""")

view("host_tools", [], """
SELECT 'bastion-' || s_suppkey AS host, t.tool FROM supplier,
  (VALUES (0, '/usr/local/bin/openshift-install-4.20'), (1, '/usr/local/bin/terraform'), (2, 'oc')) t(i, tool)
WHERE (s_suppkey + t.i) % 4 <> 0""")

query("missing_tools", ["live_runs", "settings", "host_tools"], f"""
SELECT * FROM (
  SELECT r.run_id, r.cluster_name, r.host, 'openshift-install' AS label,
         coalesce({txt('s.openshift_install_bin')}, 'openshift-install-4.20') AS tool
  FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name WHERE NOT skip_ignition
  UNION ALL SELECT r.run_id, r.cluster_name, r.host, 'terraform', coalesce({txt('s.terraform_bin')}, 'terraform')
  FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name WHERE NOT skip_terraform
  UNION ALL SELECT r.run_id, r.cluster_name, r.host, 'oc', 'oc'
  FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name WHERE (NOT skip_csr AND NOT skip_terraform) OR {TR('s.argocd_hub_api_url')}
) n WHERE NOT EXISTS (SELECT 1 FROM host_tools h WHERE h.host = n.host AND h.tool = n.tool)""")

# ============================================================== readiness
CSR_S = '{"items":[{"metadata":{"name":"VARCHAR"},"status":{"conditions":[{"type":"VARCHAR","status":"VARCHAR"}]}}]}'
VER_S = '{"status":{"conditions":[{"type":"VARCHAR","status":"VARCHAR"}]}}'

view("polls", [], """
SELECT user_id AS run_id, event_id AS poll_id, ts AS polled_at,
  CASE WHEN event_type = 'error' THEN '{"items":[{"metadata":'
       WHEN event_type = 'signup' THEN '{"items":[{"metadata":{"name":"csr-' || user_id || '-' || (event_id % 3) || '"}' ||
            CASE event_id % 4 WHEN 0 THEN ',"status":{}}' WHEN 1 THEN '}' WHEN 2 THEN ',"status":{"conditions":[]}}'
                 ELSE ',"status":{"conditions":null}}' END ||
            ',{"metadata":{"name":"csr-a' || event_id || '"},"status":{"conditions":[{"type":"Approved","status":"True"}]}}]}'
       WHEN event_type = 'click' THEN '{"items":[{"metadata":{"name":"csr-' || user_id || '-' || (event_id % 3) ||
            '"},"status":{"conditions":[{"type":"Approved","status":"True"}]}}]}'
       ELSE '{"items":[]}' END AS csr_json,
  CASE WHEN event_type = 'purchase' AND event_id % 50 = 7
         THEN '{"status":{"conditions":[{"type":"Available","status":"True"},{"type":"Available","status":"True"}]}}'
       WHEN event_type IN ('purchase', 'error')
         THEN '{"status":{"conditions":[{"type":"Progressing","status":"False"},{"type":"Available","status":"True"}]}}'
       WHEN event_type = 'view' THEN '{"status":{"conditions":[{"type":"Available","status":"False"}]}}'
       ELSE '{"status":{}}' END AS version_json
FROM events""")

view("csr_items", ["polls"], f"""
SELECT run_id, poll_id, polled_at, it.metadata.name AS name,
  CAST(coalesce(len(it.status.conditions), 0) AS INTEGER) AS n_conditions,
  coalesce(len(it.status.conditions), 0) = 0 AS pending
FROM (SELECT run_id, poll_id, polled_at, unnest(from_json(csr_json, '{CSR_S}').items) AS it FROM polls WHERE json_valid(csr_json))""")

view("avail", ["polls"], f"""
SELECT *, json_valid(csr_json) AS good, coalesce(len(h) = 1 AND trim(h[1].status) = 'True', FALSE) AS available
FROM (SELECT *, list_filter(coalesce(from_json(version_json, '{VER_S}').status.conditions, []), lambda c: c.type = 'Available') AS h
      FROM polls)""")

query("csr_items", ["csr_items"], "SELECT * FROM csr_items")
query("bad_polls", ["polls"], "SELECT run_id, poll_id, polled_at FROM polls WHERE NOT json_valid(csr_json)")
query("pending_requests", ["csr_items"], "SELECT run_id, poll_id, polled_at, name FROM csr_items WHERE pending")
query("pending_per_poll", ["polls"], f"""
SELECT run_id, poll_id, polled_at, CAST(len(p) AS BIGINT) AS n_pending,
  array_to_string(list_sort(list_transform(p, lambda i: i.metadata.name)), ',') AS pending
FROM (SELECT run_id, poll_id, polled_at,
        list_filter(coalesce(from_json(csr_json, '{CSR_S}').items, []), lambda i: coalesce(len(i.status.conditions), 0) = 0) AS p
      FROM polls WHERE json_valid(csr_json))""")
query("availability", ["avail"], "SELECT run_id, poll_id, available FROM avail")
query("time_to_available", ["avail"], """
SELECT run_id, started_at, CASE WHEN ok THEN first_av END AS available_at,
  CAST(CASE WHEN ok THEN (epoch_us(first_av) - epoch_us(started_at)) // 1000000 END AS BIGINT) AS seconds,
  CASE WHEN ok THEN 'available' ELSE 'timed_out' END AS status
FROM (SELECT *, first_av IS NOT NULL AND first_av < started_at + INTERVAL 2880 MINUTE AS ok
      FROM (SELECT run_id, min(polled_at) AS started_at, min(CASE WHEN good AND available THEN polled_at END) AS first_av
            FROM avail GROUP BY run_id))""")
query("poll_buckets", ["polls"], """
SELECT run_id, time_bucket(INTERVAL 30 SECOND, polled_at) AS window_start, count(*) AS polls FROM polls GROUP BY 1, 2""")
view("attempts", [], """
SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS attempt,
  CASE WHEN event_type = 'purchase' THEN 'dG9rZW4=' WHEN event_type = 'view' AND event_id % 13 = 0 THEN '  ' ELSE '' END AS value
FROM events""")
query("first_non_empty", ["attempts"], """
SELECT run_id, CAST(a AS INTEGER) AS attempt, CASE WHEN a IS NOT NULL THEN 'ok' ELSE 'failed' END AS status
FROM (SELECT run_id, min(CASE WHEN attempt <= 10 AND trim(value) <> '' THEN attempt END) AS a FROM attempts GROUP BY run_id)""")
query("pending_age", ["csr_items"], """
SELECT run_id, name, CAST(count(DISTINCT poll_id) AS BIGINT) AS polls, min(polled_at) AS first_seen, max(polled_at) AS last_seen
FROM csr_items WHERE pending GROUP BY run_id, name""")

# ============================================================== runs, logs, state
_PH = [
    ("preflight", "TRUE"), ("destroy", "destroy"), ("network", "NOT destroy"), ("templates", "NOT destroy"),
    ("ignition", "NOT destroy AND NOT skip_ignition"), ("dns", "NOT destroy AND NOT skip_dns"),
    ("terraform", "NOT destroy AND NOT skip_terraform"), ("csr", "NOT destroy AND NOT skip_terraform AND NOT skip_csr"),
    ("argocd", "NOT destroy AND NOT skip_terraform AND NOT skip_argocd AND hub"), ("save_context", "NOT destroy"),
]
view("runs_hub", ["live_runs", "settings"], f"""
SELECT r.*, {TR('s.argocd_hub_api_url')} AS hub FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name""")
query("phase_plan", ["runs_hub"], "\nUNION ALL ".join(
    f"SELECT run_id, {i + 1} AS ordinal, '{p}' AS phase, ({cond}) AS enabled FROM runs_hub" for i, (p, cond) in enumerate(_PH)))

view("log_lines", [], """
SELECT 'cluster-' || user_id AS cluster_name, event_id * 2 AS line_no,
  CASE WHEN event_type = 'view' AND event_id % 37 = 5 THEN '2026-13-45 10:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END || ' [' || rpad(level, 7, ' ') || '] ' || message AS text
FROM (SELECT *,
  CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'WARNING'
       WHEN event_type IN ('view', 'click') THEN 'DEBUG' ELSE 'INFO' END AS level,
  CASE WHEN event_type = 'error' AND event_id % 41 = 3 THEN 'Command failed (rc=99999999999999999999): oc get csr -o json'
       WHEN event_type = 'error' THEN 'Command failed (rc=' || (event_id % 5 + 1) || '): oc get csr -o json'
       WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'approval of csr-' || event_id || ' did not go through'
       WHEN event_type = 'signup' THEN 'Approving ' || (event_id % 3 + 1) || ' pending CSR(s): [''csr-' || event_id || ''']'
       WHEN event_type = 'click' THEN '  stdout: certificatesigningrequest/csr-' || event_id || ' approved'
       WHEN event_type = 'view' THEN 'waiting for the cluster'
       ELSE 'cluster up (took ' || CAST(floor(value * 10) AS BIGINT) || 's)' END AS message
  FROM events)
UNION ALL SELECT 'cluster-' || user_id, event_id * 2 + 1, 'stderr: connection refused' FROM events WHERE event_type = 'error'""")

LOGP = "^(\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}) \\[([A-Z]+) *\\] (.*)$"


def _parsed(src: str) -> str:
    return f"""
SELECT cluster_name, line_no, s AS is_start,
  CASE WHEN s THEN strptime(regexp_extract(text, '{LOGP}', 1), '%Y-%m-%d %H:%M:%S') END AS logged_at,
  CASE WHEN s THEN regexp_extract(text, '{LOGP}', 2) END AS level,
  CASE WHEN s THEN regexp_extract(text, '{LOGP}', 3) ELSE text END AS message
FROM (SELECT *, regexp_matches(text, '{LOGP}') AND TRY_CAST(regexp_extract(text, '{LOGP}', 1) AS TIMESTAMP) IS NOT NULL AS s FROM {src})"""


def _headed(src: str) -> str:
    return f"""
SELECT m.cluster_name, h.line_no AS start_line, m.line_no, h.logged_at, h.level, m.message
FROM (SELECT *, max(CASE WHEN is_start THEN line_no END) OVER (PARTITION BY cluster_name ORDER BY line_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head FROM {src}) m
LEFT JOIN {src} h ON h.cluster_name = m.cluster_name AND h.line_no = m.head"""


view("parsed", ["log_lines"], _parsed("log_lines"))
query("parse_logs", ["parsed"], "SELECT * FROM parsed")
view("headed", ["parsed"], _headed("parsed"))
view("file_lines", ["log_lines"], """
SELECT cluster_name, CAST(row_number() OVER (PARTITION BY cluster_name ORDER BY line_no) AS BIGINT) AS line_no, text FROM log_lines""")
view("file_parsed", ["file_lines"], _parsed("file_lines"))
query("log_files_stream", ["file_parsed"], _headed("file_parsed"))
query("log_at_least_info", ["headed"], "SELECT cluster_name, line_no, level FROM headed WHERE level IN ('INFO', 'WARNING', 'ERROR', 'CRITICAL')")
query("message_sizes", ["headed"], """
SELECT cluster_name, start_line, any_value(logged_at) AS logged_at, any_value(level) AS level, count(*) AS n_lines
FROM headed WHERE start_line IS NOT NULL GROUP BY cluster_name, start_line""")
query("message_texts", ["headed"], """
SELECT cluster_name, start_line, (line_no - start_line) // 1000 + 1 AS part, string_agg(message, chr(10) ORDER BY line_no) AS message
FROM headed WHERE start_line IS NOT NULL GROUP BY ALL""")
query("join_multiline", ["headed"], "SELECT * FROM headed")
_FACTS = [("took_seconds", "took (\\d+)s"), ("rc", "rc=(\\d+)"), ("pending_count", "Approving (\\d+) pending")]
query("log_facts", ["parsed"], "\nUNION ALL ".join(
    [f"SELECT cluster_name, line_no, '{n}' AS fact, TRY_CAST(regexp_extract(message, '{p}', 1) AS BIGINT) AS value FROM parsed "
     f"WHERE regexp_matches(message, '{p}')" for n, p in _FACTS]
    + [f"SELECT cluster_name, line_no, '{s}', CAST(NULL AS BIGINT) FROM parsed WHERE starts_with(ltrim(message), '{s}:')"
       for s in ("stdout", "stderr")]))

view("artifacts", ["seed"], """
SELECT cluster_name, 'terraform.tfvars' AS file FROM seed WHERE k % 3 <> 0
UNION ALL SELECT cluster_name, 'terraform.tfstate' FROM seed WHERE k % 5 <> 0""")
query("destroyable", ["identity", "artifacts"], """
SELECT i.cluster_name, coalesce(v, 0) = 1 AND coalesce(st, 0) = 1 AS destroyable,
  CASE WHEN coalesce(v, 0) <> 1 THEN 'no_variables_file' WHEN coalesce(st, 0) <> 1 THEN 'no_state_file' ELSE 'ok' END AS reason
FROM identity i LEFT JOIN (SELECT cluster_name, max(CASE WHEN file = 'terraform.tfvars' THEN 1 ELSE 0 END) AS v,
  max(CASE WHEN file = 'terraform.tfstate' THEN 1 ELSE 0 END) AS st FROM artifacts GROUP BY cluster_name) a
ON a.cluster_name = i.cluster_name""")

view("sized", ["nodes", "plan"], f"""
SELECT n.cluster_name, n.fqdn, n.role, n.ordinal,
  CAST(CASE n.role WHEN 'bootstrap' THEN 2 WHEN 'control_plane' THEN {_size('control_plane_num_cpus')}
    WHEN 'compute' THEN {_size('compute_num_cpus')} ELSE {_size('infra_num_cpus')} END AS INTEGER) AS num_cpus,
  CAST(CASE n.role WHEN 'bootstrap' THEN 8192 WHEN 'control_plane' THEN {_size('control_plane_memory')}
    WHEN 'compute' THEN {_size('compute_memory')} ELSE {_size('infra_memory')} END AS INTEGER) AS memory_mb,
  CAST(CASE n.role WHEN 'bootstrap' THEN {_size('bootstrap_disk_size')} WHEN 'control_plane' THEN {_size('control_plane_disk_size')}
    WHEN 'compute' THEN {_size('compute_disk_size')} ELSE {_size('infra_disk_size')} END AS INTEGER) AS disk_gb
FROM nodes n JOIN plan p ON p.cluster_name = n.cluster_name""")
query("diff_state", ["sized"], """
SELECT coalesce(d.cluster_name, a.cluster_name) AS cluster_name, coalesce(d.fqdn, a.fqdn) AS fqdn,
  CASE WHEN a.fqdn IS NULL THEN 'create' WHEN d.fqdn IS NULL THEN 'delete'
       WHEN d.num_cpus IS NOT DISTINCT FROM a.num_cpus AND d.memory_mb IS NOT DISTINCT FROM a.memory_mb
            AND d.disk_gb IS NOT DISTINCT FROM a.disk_gb THEN 'unchanged' ELSE 'update' END AS action
FROM sized d FULL OUTER JOIN (
  SELECT cluster_name, fqdn, num_cpus, CASE WHEN r % 11 = 0 THEN memory_mb + 1024 ELSE memory_mb END AS memory_mb, disk_gb
  FROM (SELECT *, ordinal + length(cluster_name) AS r FROM sized) WHERE r % 7 <> 0
  UNION ALL SELECT cluster_name, 'old-' || fqdn, num_cpus, memory_mb, disk_gb
  FROM (SELECT *, ordinal + length(cluster_name) AS r FROM sized) WHERE r % 13 = 0) a
ON d.cluster_name = a.cluster_name AND d.fqdn = a.fqdn""")
Q["diff_state_digest"] = Q["diff_state"]
view("fwd", ["nodes"], "SELECT cluster_name, fqdn AS name, ip AS value FROM nodes")
query("diff_records", ["fwd"], """
SELECT coalesce(d.cluster_name, a.cluster_name) AS cluster_name, coalesce(d.name, a.name) AS name,
  CASE WHEN a.name IS NULL THEN 'create' WHEN d.name IS NULL THEN 'forget' ELSE 'unchanged' END AS action
FROM fwd d FULL OUTER JOIN (
  SELECT cluster_name, name, CASE WHEN length(name) % 5 = 0 THEN value || '0' ELSE value END AS value FROM fwd WHERE length(name) % 7 <> 0
  UNION ALL SELECT cluster_name, 'old-' || name, value FROM fwd WHERE length(name) % 9 = 0) a
ON d.cluster_name = a.cluster_name AND d.name = a.name""")
query("summary", ["plan"], f"""
SELECT cluster_name, coalesce({txt('site_name')}, site) AS site, segment, gateway,
  array_to_string(control_plane_ips, ', ') AS control_plane, array_to_string(infra_ips, ', ') AS infra,
  coalesce(nullif(array_to_string(compute_ips, ', '), ''), '(none)') AS compute FROM plan""")

# ============================================================== registration
view("reg_candidates", ["live_runs", "settings", "env"], f"""
SELECT run_id, cluster_name, src AS token_source, src <> 'none' AS registrable FROM (
  SELECT r.run_id, r.cluster_name,
    CASE WHEN {TR('s.argocd_hub_token')} THEN 'plain' WHEN coalesce(e.value <> '', FALSE) THEN 'env' ELSE 'none' END AS src
  FROM live_runs r JOIN settings s ON s.cluster_name = r.cluster_name
  LEFT JOIN env e ON e.name = coalesce({txt('s.argocd_hub_token_env')}, '')
  WHERE NOT destroy AND NOT skip_terraform AND NOT skip_argocd AND {TR('s.argocd_hub_api_url')})""")
query("registration_candidates", ["reg_candidates"], "SELECT * FROM reg_candidates")
view("spoke", ["seed"], """
SELECT cluster_name, 'https://api.' || name || '.example.local:6443' AS server, to_base64(encode('CA of ' || name)) AS ca_data
FROM seed WHERE k % 19 <> 0""")
query("registration_records", ["reg_candidates", "settings", "spoke"], f"""
SELECT run_id, 'cluster-' || s.name AS secret_name, coalesce({txt('s.argocd_namespace')}, 'argocd') AS namespace,
  'argocd.argoproj.io/secret-type=cluster' AS label, p.server,
  {TR('s.argocd_insecure_skip_tls')} AS insecure,
  CASE WHEN p.server IS NOT NULL THEN '{{"tlsClientConfig":{{"insecure":' || CASE WHEN {TR('s.argocd_insecure_skip_tls')} THEN 'true' ELSE 'false' END ||
  ',"caData":"' || CASE WHEN {TR('s.argocd_insecure_skip_tls')} THEN '' ELSE p.ca_data END || '"}}}}' END AS config_json
FROM reg_candidates c JOIN settings s ON s.cluster_name = c.cluster_name
LEFT JOIN spoke p ON p.cluster_name = c.cluster_name WHERE registrable""")

# ============================================================== context, variables, lookups
MIR_S = '[{"source":"VARCHAR","mirror":"VARCHAR"}]'
query("config_mirrors", ["settings_long"], f"""
SELECT cluster_name, CAST(i AS INTEGER) AS position, m[i].source AS source, m[i].mirror AS mirror
FROM (SELECT cluster_name, from_json(value, '{MIR_S}') AS m FROM settings_long WHERE key = 'image_mirrors'), range(1, len(m) + 1) t(i)""")

query("config_sources", ["settings", "host_files", "env"], f"""
SELECT cluster_name, item, path,
  CASE WHEN f.path IS NOT NULL THEN 'file'
       WHEN item = 'pull_secret' AND e.value IS NOT NULL THEN 'env'
       WHEN item = 'ssh_key' AND coalesce(e.value, '') <> '' THEN 'env'
       WHEN item = 'pull_secret' THEN 'literal' ELSE 'none' END AS source,
  CASE WHEN f.path IS NOT NULL THEN f.nonblank
       WHEN item = 'pull_secret' AND e.value IS NOT NULL THEN e.value <> '{{}}'
       WHEN item = 'ssh_key' AND coalesce(e.value, '') <> '' THEN TRUE ELSE FALSE END AS present
FROM (
  SELECT cluster_name, 'pull_secret' AS item, coalesce({txt('pull_secret_path')}, 'config/pull-secret.json') AS path, 'PULL_SECRET' AS env_name FROM settings
  UNION ALL SELECT cluster_name, 'ssh_key', coalesce({txt('ssh_public_key_path')}, '~/.ssh/id_rsa.pub'), 'SSH_PUBLIC_KEY' FROM settings
  UNION ALL SELECT cluster_name, 'trust_bundle', coalesce({txt('additional_trust_bundle_path')}, 'config/additional-trust-bundle.pem'), NULL FROM settings
) x LEFT JOIN host_files f USING (path) LEFT JOIN env e ON e.name = x.env_name""")

view("inventory", ["seed"], """
SELECT 'datacenter' AS kind, NULL AS datacenter_id, 'DC-' || n_name AS name, 'datacenter-' || n_nationkey AS id, NULL AS switch_id,
  NULL AS guest_id, NULL AS thin FROM nation
UNION ALL SELECT 'compute_cluster', 'datacenter-' || n_nationkey, 'Cluster-' || n_nationkey, 'domain-c' || n_nationkey, NULL, NULL, NULL FROM nation
UNION ALL SELECT 'compute_cluster', 'datacenter-' || n_nationkey, 'Cluster-' || n_nationkey, 'domain-c' || n_nationkey || '-dup', NULL, NULL, NULL
  FROM nation WHERE n_nationkey % 12 = 7
UNION ALL SELECT 'datastore_cluster', 'datacenter-' || n_nationkey, 'DSC-' || n_nationkey, 'group-p' || n_nationkey, NULL, NULL, NULL
  FROM nation WHERE n_nationkey % 12 <> 11
UNION ALL SELECT 'dvs', 'datacenter-' || n_nationkey, 'DVS-' || n_nationkey, 'dvs-' || n_nationkey, NULL, NULL, NULL FROM nation
UNION ALL SELECT 'template', 'datacenter-' || n_nationkey, 'rhcos-420', 'vm-tmpl-' || n_nationkey, NULL, 'rhcos_64Guest', n_nationkey % 2 = 0 FROM nation
UNION ALL SELECT 'network', 'datacenter-' || nation, 'VLAN' || (100 + k % 3900) || '-OCP', 'dvportgroup-' || k, 'dvs-' || nation, NULL, NULL
  FROM seed WHERE k % 17 <> 0""")
view("inv_index", ["inventory"], """
SELECT kind, datacenter_id, switch_id, name, count(*) AS n, min(id) AS id, any_value(guest_id) AS guest_id, any_value(thin) AS thin
FROM inventory GROUP BY ALL""")


def _lookup(kind: str, key: str, dc: str | None, sw: str | None) -> str:
    cond = [f"x.kind = '{kind}'", f"x.name = {txt('s.' + key)}"]
    cond.append(f"x.datacenter_id = {dc}" if dc else "x.datacenter_id IS NULL")
    if sw:
        cond.append(f"x.switch_id = {sw}")
    return " AND ".join(cond)


view("inv_res", ["settings", "inv_index"], f"""
SELECT s.cluster_name,
  {txt('s.datacenter')} AS r_dc, dc.n AS n_dc, CASE WHEN dc.n = 1 THEN dc.id END AS datacenter_id
FROM settings s LEFT JOIN inv_index dc ON {_lookup('datacenter', 'datacenter', None, None).replace('x.', 'dc.')}""")
_KINDS = [("compute_cluster", "vsphere_cluster", "compute_cluster_id"), ("datastore_cluster", "vsphere_datastore_cluster", "datastore_cluster_id"),
          ("dvs", "vsphere_dvs_name", "dvs_id"), ("network", "vm_network", "network_id"), ("template", "vm_template", "template_id")]
_joins = []
_cols = []
for i, (kind, key, out) in enumerate(_KINDS):
    a = f"j{i}"
    sw = "j2_id" if kind == "network" else None
    _joins.append(f"LEFT JOIN inv_index {a} ON {a}.kind = '{kind}' AND {a}.name = {txt('s.' + key)} AND {a}.datacenter_id = r.datacenter_id"
                  + (f" AND {a}.switch_id = (CASE WHEN j2.n = 1 THEN j2.id END)" if sw else ""))
    _cols.append(f"{txt('s.' + key)} AS r_{out}, {a}.n AS n_{out}, CASE WHEN {a}.n = 1 THEN {a}.id END AS {out}")
view("inv_all", ["inv_res", "settings", "inv_index"], "SELECT r.cluster_name, r.r_dc, r.n_dc, r.datacenter_id, "
     + ", ".join(_cols) + ", CASE WHEN j4.n = 1 THEN j4.guest_id END AS guest_id, CASE WHEN j4.n = 1 THEN j4.thin END AS thin_provisioned "
     + "FROM inv_res r JOIN settings s ON s.cluster_name = r.cluster_name " + " ".join(_joins))
query("inventory_ids", ["inv_all"], "SELECT cluster_name, datacenter_id, " + ", ".join(o for _, _, o in _KINDS)
      + ", guest_id, thin_provisioned FROM inv_all")
query("inventory_issues", ["inv_all"], "\nUNION ALL ".join(
    [f"SELECT cluster_name, '{obj}' AS object, {ref} AS name, CASE WHEN {ref} IS NULL OR {n} IS NULL THEN 'missing' ELSE 'ambiguous' END AS problem "
     f"FROM inv_all WHERE {ref} IS NULL OR {n} IS NULL OR {n} > 1"
     for obj, ref, n in [("datacenter", "r_dc", "n_dc")] + [(k, f"r_{o}", f"n_{o}") for k, _, o in _KINDS]]))

# ============================================================== context (C4) and what reads it
view("context", ["effective", "plan"], """
SELECT cluster_name, key, value, source FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_name, key ORDER BY rank DESC) AS rn FROM (
    SELECT cluster_name, 'cluster_name' AS key, '"' || name || '"' AS value, 'base' AS source, 0 AS rank FROM plan
    UNION ALL SELECT cluster_name, 'timestamp', '"1970-01-01T00:00:00Z"', 'base', 0 FROM plan
    UNION ALL SELECT cluster_name, key, value, 'profile', 1 FROM effective WHERE cluster_name IN (SELECT cluster_name FROM plan)
    UNION ALL SELECT cluster_name, k, v, 'plan', 2 FROM plan, (SELECT unnest([
        {'k': 'network', 'v': '"' || network || '/' || prefix_length || '"'},
        {'k': 'machine_network_cidr', 'v': '"' || network || '/' || prefix_length || '"'},
        {'k': 'prefix_length', 'v': CAST(prefix_length AS VARCHAR)},
        {'k': 'netmask', 'v': '"' || netmask || '"'},
        {'k': 'gateway', 'v': '"' || gateway || '"'},
        {'k': 'infra_ips', 'v': CAST(to_json(infra_ips) AS VARCHAR)},
        {'k': 'control_plane_ips', 'v': CAST(to_json(control_plane_ips) AS VARCHAR)},
        {'k': 'bootstrap_ip', 'v': '"' || bootstrap_ip || '"'},
        {'k': 'compute_ips', 'v': CAST(to_json(compute_ips) AS VARCHAR)}], recursive := true))
    UNION ALL SELECT cluster_name, 'segment', '"' || segment || '"', 'explicit', 3 FROM plan
    UNION ALL SELECT cluster_name, 'vlan_id', coalesce('"' || vlan_id || '"', 'null'), 'explicit', 3 FROM plan
    UNION ALL SELECT cluster_name, 'vm_network', vm_network, 'explicit', 3 FROM plan
    UNION ALL SELECT cluster_name, 'ignition_dir', '"clusters/' || name || '/ignition"', 'explicit', 3 FROM plan
    UNION ALL SELECT p.cluster_name, d.k, coalesce(e.value, d.v), 'explicit', 3
      FROM plan p CROSS JOIN (VALUES ('cluster_network_cidr', '"10.132.0.0/14"'), ('cluster_network_host_prefix', '23'),
        ('service_network_cidr', '"172.31.0.0/16"')) d(k, v)
      LEFT JOIN effective e ON e.cluster_name = p.cluster_name AND e.key = d.k))
WHERE rn = 1""")
query("config_context", ["context"], "SELECT * FROM context")

CTX_KEYS = ["cluster_name", "vcenter", "vcenter_user", "vsphere_cluster", "datacenter", "vsphere_datastore_cluster",
            "vsphere_dvs_name", "vsphere_folder", "vm_template", "vm_network", "dns_servers", "base_domain",
            "machine_network_cidr", "gateway", "ignition_dir", "bootstrap_ip", "control_plane_ips", "compute_ips",
            "infra_ips", *TEMPLATE_DEFAULTS.keys()]


def kc(k: str) -> str:
    return "key_cluster_name" if k == "cluster_name" else k


view("ctx_wide", ["context"], "SELECT cluster_name, " + ", ".join(
    f"max(CASE WHEN key = '{k}' THEN value END) AS {kc(k)}" for k in CTX_KEYS) + " FROM context GROUP BY cluster_name")


def rtext(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL THEN '' WHEN {c} = 'null' THEN 'None' ELSE {txt(c)} END)"


def ntext(k: str) -> str:
    return f"(CASE WHEN {k} IS NULL THEN '{TEMPLATE_DEFAULTS[k]}' WHEN {k} = 'null' THEN 'None' ELSE {txt(k)} END)"


_VARS = [(n, rtext(k)) for n, k in [
    ("vsphere_server", "vcenter"), ("vsphere_user", "vcenter_user"), ("vsphere_cluster", "vsphere_cluster"),
    ("vsphere_datacenter", "datacenter"), ("vsphere_datastore_cluster", "vsphere_datastore_cluster"),
    ("vsphere_dvs_name", "vsphere_dvs_name"), ("vsphere_folder", "vsphere_folder"), ("vm_template", "vm_template"),
    ("vm_network", "vm_network"), ("cluster_id", "key_cluster_name"), ("base_domain", "base_domain"),
    ("machine_cidr", "machine_network_cidr"), ("gateway_ip", "gateway"), ("bootstrap_ip", "bootstrap_ip")]]
_VARS += [
    ("vsphere_password", "'<redacted>'"),
    ("vm_dns_addresses", "coalesce(dns_servers, '[]')"),
    ("cluster_domain", f"{rtext('key_cluster_name')} || '.' || {rtext('base_domain')}"),
    ("bootstrap_ignition_path", f"{rtext('ignition_dir')} || '/bootstrap.ign'"),
    ("control_plane_ignition_path", f"{rtext('ignition_dir')} || '/master.ign'"),
    ("compute_ignition_path", f"{rtext('ignition_dir')} || '/worker.ign'"),
    ("infra_ignition_path", f"{rtext('ignition_dir')} || '/worker.ign'"),
]
for _r in ("control_plane", "compute", "infra"):
    _VARS.append((f"{_r}_ips", f"coalesce({_r}_ips, '[]')"))
    _VARS.append((f"{_r}_count", f"CAST(len(CAST(json(coalesce({_r}_ips, '[]')) AS VARCHAR[])) AS VARCHAR)"))
for _k in TEMPLATE_DEFAULTS:
    _VARS.append((_k, ntext(_k)))
view("variables", ["ctx_wide"], "\nUNION ALL ".join(
    f"SELECT cluster_name, '{n}' AS variable, {e} AS value FROM ctx_wide" for n, e in _VARS))
query("config_variables", ["variables"], "SELECT * FROM variables")

view("contract", [], "SELECT * FROM " + _values(VARIABLE_CONTRACT, ["variable", "type", "required", "dflt"]))
view("supplied", ["variables"], """
SELECT cluster_name, variable, CASE WHEN k % 37 = 8 AND variable = 'control_plane_count' THEN '5'
    WHEN k % 41 = 9 AND variable = 'infra_ips' THEN '10.0.0.1' ELSE value END AS value
FROM (SELECT *, CAST(regexp_extract(cluster_name, '([0-9]+)', 1) AS BIGINT) AS k FROM variables)
WHERE NOT (k % 29 = 3 AND variable = 'base_domain')
UNION ALL SELECT cluster_name, 'ssh_public_key_path', '/root/key' FROM ctx_wide
WHERE CAST(regexp_extract(cluster_name, '([0-9]+)', 1) AS BIGINT) % 31 = 5""")
query("check_contract", ["supplied", "contract"], """
SELECT cluster_name, variable, rule FROM (
  SELECT v.cluster_name, v.variable,
    CASE WHEN c.variable IS NULL THEN 'undeclared'
         WHEN c.required AND v.value IS NULL THEN 'missing_required'
         WHEN c.type = 'number' AND TRY_CAST(v.value AS DOUBLE) IS NULL THEN 'not_a_number'
         WHEN c.type = 'list(string)' AND NOT coalesce(json_valid(v.value) AND json_type(CASE WHEN json_valid(v.value) THEN v.value END) = 'ARRAY', FALSE) THEN 'not_a_list'
    END AS rule
  FROM supplied v LEFT JOIN contract c ON c.variable = v.variable)
WHERE rule IS NOT NULL
UNION ALL
SELECT w.cluster_name, c.variable, 'missing_required' FROM (SELECT DISTINCT cluster_name FROM supplied) w, contract c
WHERE c.required AND NOT EXISTS (SELECT 1 FROM supplied v WHERE v.cluster_name = w.cluster_name AND v.variable = c.variable)""")
query("check_counts", ["supplied"], """
SELECT cluster_name, r || '_count' AS rule, r || '_count' AS detail FROM (
  SELECT cluster_name, r, max(CASE WHEN variable = r || '_count' THEN TRY_CAST(value AS INTEGER) END) AS n,
    max(CASE WHEN variable = r || '_ips' AND json_valid(value) THEN json_array_length(CASE WHEN json_valid(value) THEN value ELSE '[]' END) END) AS m
  FROM supplied CROSS JOIN (VALUES ('control_plane'), ('compute'), ('infra')) t(r) GROUP BY cluster_name, r)
WHERE coalesce(n, -1) <> coalesce(m, -1)""")

query("config_install", ["context", "settings", "host_files"], f"""
SELECT w.cluster_name, {rtext('w.key_cluster_name')} AS name, {rtext('w.base_domain')} AS base_domain,
  'OVNKubernetes' AS network_type, {rtext('w.cluster_network_cidr')} AS cluster_network_cidr,
  TRY_CAST({txt('w.cluster_network_host_prefix')} AS INTEGER) AS host_prefix,
  {rtext('w.service_network_cidr')} AS service_network_cidr, '100.65.0.0/16' AS v4_internal_subnet,
  coalesce(f.nonblank, FALSE) AS has_trust_bundle,
  CAST(coalesce(len(from_json(w.image_mirrors, '{MIR_S}')), 0) AS BIGINT) AS mirror_count
FROM (SELECT cluster_name,
        max(CASE WHEN key = 'cluster_name' THEN value END) AS key_cluster_name,
        max(CASE WHEN key = 'base_domain' THEN value END) AS base_domain,
        max(CASE WHEN key = 'cluster_network_cidr' THEN value END) AS cluster_network_cidr,
        max(CASE WHEN key = 'cluster_network_host_prefix' THEN value END) AS cluster_network_host_prefix,
        max(CASE WHEN key = 'service_network_cidr' THEN value END) AS service_network_cidr,
        max(CASE WHEN key = 'image_mirrors' THEN value END) AS image_mirrors
      FROM context GROUP BY cluster_name) w
JOIN settings s ON s.cluster_name = w.cluster_name
LEFT JOIN host_files f ON f.path = coalesce({txt('s.additional_trust_bundle_path')}, 'config/additional-trust-bundle.pem')""")

query("node_specs", ["sized", "plan", "inv_all"], f"""
SELECT n.cluster_name, n.role, n.ordinal, n.fqdn, split_part(n.fqdn, '.', 1) AS vm_name, x.ip,
  coalesce({txt('p.vsphere_folder')}, '') || '/' || p.name AS folder, p.name AS resource_pool,
  n.num_cpus, n.memory_mb, n.disk_gb,
  'ip=' || x.ip || '::' || p.gateway || ':' || p.netmask || ':' || split_part(n.fqdn, '.', 1) || ':ens192:none:' ||
    CAST(json(p.dns_servers) AS VARCHAR[])[1] AS kargs,
  i.datacenter_id, i.compute_cluster_id, i.datastore_cluster_id, i.network_id, i.template_id, i.guest_id, i.thin_provisioned
FROM sized n JOIN nodes x ON x.cluster_name = n.cluster_name AND x.fqdn = n.fqdn
JOIN plan p ON p.cluster_name = n.cluster_name
LEFT JOIN inv_all i ON i.cluster_name = n.cluster_name""")

# ============================================================== file sources (round trips)
query("scan_layers", ["clusters", "seed"], """
SELECT cluster_name, key, value FROM clusters
UNION ALL SELECT cluster_name || '-twice', u.key, u.value FROM seed, (VALUES ('x', '2'), ('y', '"a"')) u(key, value) WHERE k % 45 = 13""")
query("scan_layers_yaml", ["clusters"], "SELECT cluster_name, key, value FROM clusters")
query("bad_documents", ["seed"], """
SELECT CASE WHEN k % 45 = 10 THEN 'a%zz-' || k ELSE cluster_name END AS cluster_name, 'malformed' AS problem, f AS format
FROM seed, (VALUES ('json'), ('yaml')) t(f) WHERE k % 45 IN (9, 10) OR (f = 'yaml' AND k % 45 IN (11, 12, 14))""")
query("cluster_files", ["clusters", "seed"], """
SELECT cluster_name, key, value, CAST(NULL AS VARCHAR) AS problem FROM clusters
UNION ALL SELECT cluster_name || CASE WHEN k % 45 = 9 THEN '-cut' ELSE '-bytes' END, NULL, NULL, 'malformed' FROM seed WHERE k % 45 IN (9, 11)""")
Q["cluster_files_stream"] = Q["cluster_files"]
query("list_artifacts", ["artifacts"], "SELECT cluster_name, file, regexp_replace(file, '\\.[^.]*$', '') AS stem FROM artifacts")
query("context_sink", ["context"], """
SELECT cluster_name, key, value FROM context WHERE value <> 'null'
  AND key NOT IN ('pull_secret', 'ssh_key', 'vcenter_password', 'argocd_hub_token', 'additional_trust_bundle')""")
query("cluster_table", ["identity"], """
SELECT cluster_name, name, site, segment, CASE WHEN k % 5 = 3 THEN '7' ELSE vlan_id END AS vlan_id
FROM (SELECT *, CAST(regexp_extract(cluster_name, '([0-9]+)', 1) AS BIGINT) AS k FROM identity) WHERE k % 7 <> 2""")
query("scan_logs", ["log_lines"], """
SELECT cluster_name, CAST(row_number() OVER (PARTITION BY cluster_name ORDER BY line_no) AS BIGINT) AS line_no, text FROM log_lines""")

# ============================================================== streaming (same answer as batch L4)
Q["readiness_stream"] = Q["time_to_available"]
Q["poll_buckets_stream"] = Q["poll_buckets"]
query("silence_alarms", ["avail"], """
SELECT run_id, min(polled_at) AS started_at, max(polled_at) AS last_poll, count(*) AS polls, max(polled_at) + INTERVAL 720 MINUTE AS alarm_at
FROM (SELECT *, sum(CASE WHEN pause IS NULL OR pause > INTERVAL 720 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY polled_at, poll_id) AS episode
      FROM (SELECT *, polled_at - lag(polled_at) OVER (PARTITION BY run_id ORDER BY polled_at, poll_id) AS pause FROM avail))
GROUP BY run_id, episode HAVING NOT bool_or(good AND available)""")
Q["silence_alarms_stream"] = Q["silence_alarms"]
view("arrivals", [], """
SELECT a.*, max(latest) AS before
FROM (SELECT user_id AS run_id, event_id AS poll_id, ts,
        least((day(ts) - 1) // 5 + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END, 5) AS arrival FROM events) a
LEFT JOIN (SELECT least((day(ts) - 1) // 5 + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END, 5) AS arrival, max(ts) AS latest
           FROM events GROUP BY 1) m ON m.arrival < a.arrival
GROUP BY ALL""")
query("late_polls", ["arrivals"], """
SELECT run_id, poll_id, coalesce(ts <= before - INTERVAL 1 HOUR, FALSE) AS late FROM arrivals""")
