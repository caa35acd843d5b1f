"""Fixed values that must equal the provisioning tool's own, stated as text.

Nothing here is computed; each block is the literal content of one input the
tool ships (its global defaults document, its variable declarations, its code
defaults). Values are JSON text, keys in document order.
"""

from __future__ import annotations

# --- FIXED VALUES: global defaults document (26 keys), JSON text per key ----
DEFAULTS_DOCUMENT: list[tuple[str, str]] = [
    ("gateway_offset", "254"),
    ("infra_ip_offsets", "[1,2,3]"),
    ("control_plane_ip_offsets", "[4,5,6]"),
    ("bootstrap_ip_offset", "7"),
    ("compute_ip_offsets", "[]"),
    ("guest_id", '"coreos64Guest"'),
    ("control_plane_num_cpus", "8"),
    ("control_plane_memory", "24576"),
    ("control_plane_disk_size", "120"),
    ("infra_num_cpus", "8"),
    ("infra_memory", "32768"),
    ("infra_disk_size", "120"),
    ("compute_num_cpus", "4"),
    ("compute_memory", "8192"),
    ("compute_disk_size", "120"),
    ("bootstrap_disk_size", "100"),
    ("cluster_network_cidr", '"10.132.0.0/14"'),
    ("cluster_network_host_prefix", "23"),
    ("service_network_cidr", '"172.31.0.0/16"'),
    (
        "image_mirrors",
        '[{"source":"quay.io/openshift-release-dev/ocp-release",'
        '"mirror":"mirror.registry.example.local:5000/openshift/release"},'
        '{"source":"quay.io/openshift-release-dev/ocp-v4.0-art-dev",'
        '"mirror":"mirror.registry.example.local:5000/openshift/release"},'
        '{"source":"registry.redhat.io","mirror":"mirror.registry.example.local:5000"}]',
    ),
    ("openshift_install_bin", '"/usr/local/bin/openshift-install-4.20"'),
    ("terraform_bin", '"/usr/local/bin/terraform"'),
    ("terraform_plugin_dir", '"./providers"'),
    ("wildcard_dns_api_url", '"http://dns-api.example.local:8080/api/wildcard"'),
    ("vlan_manager_url", '"http://vlan-manager.example.local:8000"'),
    ("vlan_manager_vrf", '"default"'),
]

# --- FIXED VALUES: defaults the code applies when a key is absent -----------
# (address planning, context building, registration, preflight, VLAN request)
CODE_DEFAULTS: list[tuple[str, str]] = [
    ("gateway_offset", "254"),
    ("infra_ip_offsets", "[1,2,3]"),
    ("control_plane_ip_offsets", "[4,5,6]"),
    ("bootstrap_ip_offset", "7"),
    ("compute_ip_offsets", "[]"),
    ("cluster_network_cidr", '"10.132.0.0/14"'),
    ("cluster_network_host_prefix", "23"),
    ("service_network_cidr", '"172.31.0.0/16"'),
    ("argocd_namespace", '"argocd"'),
    ("argocd_insecure_skip_tls", "false"),
    ("vlan_manager_vrf", '"default"'),
    ("openshift_install_bin", '"openshift-install-4.20"'),
    ("terraform_bin", '"terraform"'),
]

# --- FIXED VALUES: network constants ----------------------------------------
V4_INTERNAL_SUBNET = "100.65.0.0/16"
NETWORK_TYPE = "OVNKubernetes"
BOOT_INTERFACE = "ens192"
RECORD_TTL = 86400
BOOTSTRAP_CPUS = 2
BOOTSTRAP_MEMORY_MB = 8192
NAME_MAX_CHARS = 27
READINESS_TIMEOUT_MINUTES = 45
POLL_SECONDS = 30
TOKEN_TRIES = 10

# --- FIXED VALUES: template defaults, used only when a key is undefined -----
TEMPLATE_DEFAULTS: dict[str, int] = {
    "bootstrap_disk_size": 120,
    "control_plane_num_cpus": 4,
    "control_plane_memory": 16384,
    "control_plane_disk_size": 120,
    "compute_num_cpus": 4,
    "compute_memory": 8192,
    "compute_disk_size": 120,
    "infra_num_cpus": 4,
    "infra_memory": 16384,
    "infra_disk_size": 120,
}

# --- FIXED VALUES: provisioning variable contract (name, type, required, default)
VARIABLE_CONTRACT: list[tuple[str, str, bool, str | None]] = [
    ("vsphere_server", "string", True, None),
    ("vsphere_user", "string", True, None),
    ("vsphere_password", "string", True, None),
    ("vsphere_cluster", "string", True, None),
    ("vsphere_datacenter", "string", True, None),
    ("vsphere_datastore_cluster", "string", True, None),
    ("vsphere_dvs_name", "string", True, None),
    ("vsphere_folder", "string", True, None),
    ("vm_network", "string", True, None),
    ("vm_template", "string", True, None),
    ("vm_dns_addresses", "list(string)", False, '["1.1.1.1","9.9.9.9"]'),
    ("cluster_id", "string", True, None),
    ("base_domain", "string", True, None),
    ("cluster_domain", "string", True, None),
    ("machine_cidr", "string", True, None),
    ("gateway_ip", "string", True, None),
    ("bootstrap_ignition_path", "string", False, '"./bootstrap.ign"'),
    ("bootstrap_ip", "string", False, '""'),
    ("bootstrap_disk_size", "number", False, "100"),
    ("control_plane_ignition_path", "string", False, '"./master.ign"'),
    ("control_plane_count", "number", False, "3"),
    ("control_plane_ips", "list(string)", False, "[]"),
    ("control_plane_memory", "number", False, "16384"),
    ("control_plane_num_cpus", "number", False, "4"),
    ("control_plane_disk_size", "number", False, "120"),
    ("compute_ignition_path", "string", False, '"./worker.ign"'),
    ("compute_count", "number", False, "3"),
    ("compute_ips", "list(string)", False, "[]"),
    ("compute_memory", "number", False, "8192"),
    ("compute_num_cpus", "number", False, "4"),
    ("compute_disk_size", "number", False, "120"),
    ("infra_ignition_path", "string", False, '"./worker.ign"'),
    ("infra_count", "number", False, "3"),
    ("infra_ips", "list(string)", False, "[]"),
    ("infra_memory", "number", False, "16384"),
    ("infra_num_cpus", "number", False, "4"),
    ("infra_disk_size", "number", False, "120"),
]

# --- FIXED VALUES: node roles: table name, host-name label, sizing key prefix
ROLES: list[tuple[str, str, str]] = [
    ("bootstrap", "bootstrap", "bootstrap"),
    ("control_plane", "control-plane", "control_plane"),
    ("compute", "compute", "compute"),
    ("infra", "infra", "infra"),
]

# --- FIXED VALUES: keys never written to a table sink ------------------------
SECRET_KEYS = ["pull_secret", "ssh_key", "vcenter_password", "argocd_hub_token", "additional_trust_bundle"]

REDACTED = '"<redacted>"'  # stands for any secret value; presence is all that is kept

# --- FIXED VALUES: variable <- context key, for plain string variables --------
STRING_VARIABLES: list[tuple[str, str]] = [
    ("vsphere_server", "vcenter"),
    ("vsphere_user", "vcenter_user"),
    ("vsphere_cluster", "vsphere_cluster"),
    ("vsphere_datacenter", "datacenter"),
    ("vsphere_datastore_cluster", "vsphere_datastore_cluster"),
    ("vsphere_dvs_name", "vsphere_dvs_name"),
    ("vsphere_folder", "vsphere_folder"),
    ("vm_template", "vm_template"),
    ("vm_network", "vm_network"),
    ("cluster_id", "cluster_name"),
    ("base_domain", "base_domain"),
    ("machine_cidr", "machine_network_cidr"),
    ("gateway_ip", "gateway"),
    ("bootstrap_ip", "bootstrap_ip"),
]

# --- FIXED VALUES: secret inputs: item, profile key of the path, default path, environment name
SECRET_SOURCES: list[tuple[str, str, str, str | None]] = [
    ("pull_secret", "pull_secret_path", "config/pull-secret.json", "PULL_SECRET"),
    ("ssh_key", "ssh_public_key_path", "~/.ssh/id_rsa.pub", "SSH_PUBLIC_KEY"),
    ("trust_bundle", "additional_trust_bundle_path", "config/additional-trust-bundle.pem", None),
]

# --- FIXED VALUES: labels, phases, patterns of the tool ----------------------
SECRET_TYPE_LABEL = "argocd.argoproj.io/secret-type=cluster"
ALLOCATION_ENDPOINT = "/api/allocate-vlan"
PHASES = ["preflight", "destroy", "network", "templates", "ignition", "dns", "terraform", "csr", "argocd", "save_context"]
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \[([A-Z]+) *\] (.*)$"
LOG_FACTS: list[tuple[str, str]] = [
    ("took_seconds", r"took (\d+)s"),
    ("rc", r"rc=(\d+)"),
    ("pending_count", r"Approving (\d+) pending"),
]

# --- FIXED VALUES: log levels and their order --------------------------------
LOG_LEVELS: list[tuple[str, int]] = [("DEBUG", 10), ("INFO", 20), ("WARNING", 30), ("ERROR", 40), ("CRITICAL", 50)]
