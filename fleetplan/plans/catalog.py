"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole driver tables.

Outputs are scalar columns (arrays are joined to text) so that they compare
one to one with the DuckDB oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..operators import address, config, digests, dns, nodes, readiness, registration, runs, validate
from ..session import scratch_path, write_table
from ..sources import documents, files, logs
from ..streaming import alarms, late
from ..streaming import logs as log_stream
from ..streaming import readiness as stream
from . import staging
from .fleet import Fleet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def wrap(fn):
        QUERIES[name] = fn
        return fn

    return wrap


def _fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    return Fleet(spark, sf_dir)


# ============================================================== configuration
@register("config_identity")
def q_identity(spark, sf_dir):
    return _fleet(spark, sf_dir).identity


@register("config_effective")
def q_effective(spark, sf_dir):
    return _fleet(spark, sf_dir).effective


@register("config_env_refs")
def q_env_refs(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    prof = config.site_profiles(f.defaults, f.sites).withColumnRenamed("profile_key", "site")
    return config.resolve_references(prof, f.env).select("site", "key", "env_name", "resolved")


@register("config_defaults")
def q_defaults(spark, sf_dir):
    return _fleet(spark, sf_dir).settings_long


# ============================================================== addressing
@register("cidr_normalize")
def q_cidr(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return address.normalize_cidr(f.fleet.select("cluster_name", "segment")).select(
        "cluster_name", "segment", "network", "prefix_length", "netmask", "valid"
    )


@register("allocation_requests")
def q_alloc_requests(spark, sf_dir):
    return address.allocation_requests(_fleet(spark, sf_dir).settings)


@register("apply_allocations")
def q_apply_allocs(spark, sf_dir):
    return _fleet(spark, sf_dir).fleet.select("cluster_name", "segment", "vlan_id", "segment_source")


@register("address_plan")
def q_address_plan(spark, sf_dir):
    return address.addresses(_fleet(spark, sf_dir).plan)


# ============================================================== roster
@register("nodes")
def q_nodes(spark, sf_dir):
    return _fleet(spark, sf_dir).nodes.drop("domain")


@register("node_sizing")
def q_node_sizing(spark, sf_dir):
    return nodes.size_nodes(_fleet(spark, sf_dir).plan).select(
        "cluster_name", "fqdn", "role", "num_cpus", "memory_mb", "disk_gb"
    )


@register("node_counts")
def q_node_counts(spark, sf_dir):
    return nodes.count_nodes(_fleet(spark, sf_dir).plan)


@register("network_args")
def q_network_args(spark, sf_dir):
    return nodes.network_args(_fleet(spark, sf_dir).plan)


# ============================================================== DNS
@register("forward_records")
def q_forward(spark, sf_dir):
    return dns.forward_records(_fleet(spark, sf_dir).plan)


@register("reverse_records")
def q_reverse(spark, sf_dir):
    return dns.reverse_records(_fleet(spark, sf_dir).plan)


@register("api_records")
def q_api(spark, sf_dir):
    return dns.api_records(_fleet(spark, sf_dir).plan)


@register("wildcard_records")
def q_wildcard(spark, sf_dir):
    return dns.wildcard_records(_fleet(spark, sf_dir).plan)


@register("record_set")
def q_record_set(spark, sf_dir):
    return _fleet(spark, sf_dir).records


# ============================================================== validation
@register("check_names")
def q_check_names(spark, sf_dir):
    return validate.check_names(_fleet(spark, sf_dir).identity)


@register("check_required")
def q_check_required(spark, sf_dir):
    return validate.check_required(_fleet(spark, sf_dir).settings)


@register("check_sites")
def q_check_sites(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return validate.check_sites(f.identity, f.sites)


@register("check_allocations")
def q_check_allocations(spark, sf_dir):
    return address.check_allocations(_fleet(spark, sf_dir).allocs)


@register("check_plan")
def q_check_plan(spark, sf_dir):
    return address.check_plan(_fleet(spark, sf_dir).plan)


@register("check_conditional")
def q_check_conditional(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return validate.check_conditional(f.runs, f.settings)


@register("missing_tools")
def q_missing_tools(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return validate.missing_tools(f.runs, f.settings, f.host_tools)


# ============================================================== readiness
TIMEOUT_MINUTES = 2880  # the fixture runs span days; see FIXTURES.md


@register("csr_items")
def q_csr_items(spark, sf_dir):
    return readiness.csr_items(_fleet(spark, sf_dir).polls)


@register("bad_polls")
def q_bad_polls(spark, sf_dir):
    return readiness.bad_polls(_fleet(spark, sf_dir).polls)


@register("pending_requests")
def q_pending_requests(spark, sf_dir):
    return readiness.pending_requests(_fleet(spark, sf_dir).polls)


@register("pending_per_poll")
def q_pending_per_poll(spark, sf_dir):
    return readiness.pending_per_poll(_fleet(spark, sf_dir).polls)


@register("availability")
def q_availability(spark, sf_dir):
    return readiness.availability(_fleet(spark, sf_dir).polls).select("run_id", "poll_id", "available")


@register("time_to_available")
def q_time_to_available(spark, sf_dir):
    return readiness.time_to_available(_fleet(spark, sf_dir).polls, TIMEOUT_MINUTES)


@register("poll_buckets")
def q_poll_buckets(spark, sf_dir):
    return readiness.poll_buckets(_fleet(spark, sf_dir).polls)


@register("first_non_empty")
def q_first_non_empty(spark, sf_dir):
    return readiness.first_non_empty(_fleet(spark, sf_dir).attempts)


@register("pending_age")
def q_pending_age(spark, sf_dir):
    return readiness.pending_age(_fleet(spark, sf_dir).polls)


# ============================================================== runs, logs, state
@register("phase_plan")
def q_phase_plan(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return runs.phase_plan(f.runs, f.settings)


@register("parse_logs")
def q_parse_logs(spark, sf_dir):
    return runs.parse_logs(_fleet(spark, sf_dir).log_lines).select(
        "cluster_name", "line_no", "is_start", "logged_at", "level", "message"
    )


@register("log_at_least_info")
def q_at_least(spark, sf_dir):
    messages = runs.join_multiline(runs.parse_logs(_fleet(spark, sf_dir).log_lines))
    return runs.at_least(messages, "INFO").select("cluster_name", "line_no", "level")


@register("join_multiline")
def q_join_multiline(spark, sf_dir):
    return runs.join_multiline(runs.parse_logs(_fleet(spark, sf_dir).log_lines))


@register("message_sizes")
def q_message_sizes(spark, sf_dir):
    return runs.message_sizes(runs.join_multiline(runs.parse_logs(_fleet(spark, sf_dir).log_lines)))


@register("message_texts")
def q_message_texts(spark, sf_dir):
    return runs.message_texts(runs.join_multiline(runs.parse_logs(_fleet(spark, sf_dir).log_lines)))


@register("log_facts")
def q_log_facts(spark, sf_dir):
    return runs.log_facts(runs.parse_logs(_fleet(spark, sf_dir).log_lines))


@register("destroyable")
def q_destroyable(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return runs.destroyable(f.identity, f.artifacts)


def _recorded_nodes(desired: DataFrame) -> DataFrame:
    """Recorded state derived from the desired roster: some nodes missing,
    some with other memory, some extra."""
    r = F.col("ordinal") + F.char_length("cluster_name")
    kept = desired.where(r % 7 != 0).withColumn(
        "memory_mb", F.when(r % 11 == 0, F.col("memory_mb") + 1024).otherwise(F.col("memory_mb"))
    )
    extra = desired.where(r % 13 == 0).withColumn("fqdn", F.concat(F.lit("old-"), F.col("fqdn")))
    return kept.unionByName(extra)


@register("diff_state")
def q_diff_state(spark, sf_dir):
    # desired and recorded state come from one stored roster
    desired = write_table(nodes.size_nodes(_fleet(spark, sf_dir).plan), "desired-nodes")
    return runs.diff_state(desired, _recorded_nodes(desired), ["cluster_name", "fqdn"], ["num_cpus", "memory_mb", "disk_gb"])


@register("diff_records")
def q_diff_records(spark, sf_dir):
    desired = write_table(dns.forward_records(_fleet(spark, sf_dir).plan), "desired-records")
    r = F.char_length("name")
    recorded = desired.where(r % 7 != 0).withColumn(
        "value", F.when(r % 5 == 0, F.concat(F.col("value"), F.lit("0"))).otherwise(F.col("value"))
    ).unionByName(desired.where(r % 9 == 0).withColumn("name", F.concat(F.lit("old-"), F.col("name"))))
    return runs.diff_state(desired, recorded, ["cluster_name", "name"], mode="keys_only")


@register("diff_state_digest")
def q_diff_state_digest(spark, sf_dir):
    """P7 by a digest tree: the answer of ``diff_state``."""
    desired = write_table(nodes.size_nodes(_fleet(spark, sf_dir).plan), "desired-nodes")
    recorded = write_table(_recorded_nodes(desired), "recorded-nodes")
    return digests.diff_by_digest(desired, recorded, ["cluster_name", "fqdn"], ["num_cpus", "memory_mb", "disk_gb"])


@register("summary")
def q_summary(spark, sf_dir):
    return runs.summary(_fleet(spark, sf_dir).plan)


# ============================================================== registration
@register("registration_candidates")
def q_reg_candidates(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return registration.registration_candidates(f.runs, f.settings, f.env)


@register("registration_records")
def q_reg_records(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return registration.registration_records(registration.registration_candidates(f.runs, f.settings, f.env), f.settings, f.spoke)


# ============================================================== context, variables, lookups
@register("config_mirrors")
def q_mirrors(spark, sf_dir):
    return config.explode_mirrors(_fleet(spark, sf_dir).settings)


@register("config_sources")
def q_sources(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return config.first_available(f.settings, f.files, f.env)


@register("inventory_ids")
def q_inventory_ids(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return nodes.resolve_inventory(f.settings, f.inventory)[0]


@register("inventory_issues")
def q_inventory_issues(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return nodes.resolve_inventory(f.settings, f.inventory)[1]


@register("node_specs")
def q_node_specs(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    return nodes.node_specs(f.plan, f.inventory)


@register("config_context")
def q_context(spark, sf_dir):
    return _fleet(spark, sf_dir).context


@register("config_variables")
def q_variables(spark, sf_dir):
    return config.variables_long(_fleet(spark, sf_dir).plan)


@register("check_contract")
def q_contract(spark, sf_dir):
    return validate.check_contract(_fleet(spark, sf_dir).supplied)


@register("check_counts")
def q_counts(spark, sf_dir):
    return validate.check_counts(_fleet(spark, sf_dir).supplied)


@register("config_install")
def q_install(spark, sf_dir):
    f = _fleet(spark, sf_dir)
    inst = config.to_install_struct(f.plan, f.files)
    i = F.col("install")
    return inst.select(
        "cluster_name",
        i.getField("name").alias("name"),
        i.getField("base_domain").alias("base_domain"),
        i.networking.network_type.alias("network_type"),
        i.networking.cluster_network_cidr.alias("cluster_network_cidr"),
        i.networking.host_prefix.alias("host_prefix"),
        i.networking.service_network_cidr.alias("service_network_cidr"),
        i.networking.v4_internal_subnet.alias("v4_internal_subnet"),
        i.has_trust_bundle.alias("has_trust_bundle"),
        F.size(i.mirrors).cast("bigint").alias("mirror_count"),
    )


# ============================================================== file sources
@register("scan_layers")
def q_scan_layers(spark, sf_dir):
    """Cluster documents derived from the tables, written as JSON files,
    scanned back into layer rows."""
    return documents.scan_layers(spark, staging.stage_cluster_documents(spark, sf_dir), "cluster_name", many=True)


@register("scan_layers_yaml")
def q_scan_layers_yaml(spark, sf_dir):
    """S1 from YAML documents."""
    path = staging.stage_cluster_documents(spark, sf_dir, "yaml")
    return documents.scan_layers(spark, path, "cluster_name", "yaml", many=True)


@register("bad_documents")
def q_bad_documents(spark, sf_dir):
    """Documents of both formats that don't parse."""
    formats = ("json", "yaml")
    bad = [documents.bad_documents(spark, staging.stage_cluster_documents(spark, sf_dir, x), "cluster_name", x, many=True) for x in formats]
    one, two = (rows.withColumn("format", F.lit(x)) for rows, x in zip(bad, formats, strict=True))
    return one.unionByName(two)


@register("cluster_files")
def q_cluster_files(spark, sf_dir):
    """S1 in the tool's layout: one YAML file per cluster; a file that doesn't
    parse is one row with its problem."""
    path = scratch_path(spark, f"staged/cluster-files-{uuid.uuid4().hex}")
    for half in (0, 1):
        staging.stage_cluster_files(spark, sf_dir, path, half)
    docs = files.document_files(spark, path, "cluster_name")
    return docs.select("cluster_name", "problem", F.explode_outer("doc").alias("key", "value"))


@register("cluster_files_stream")
def q_cluster_files_stream(spark, sf_dir):
    """The same as a stream, over two arrivals of files."""
    root = scratch_path(spark, f"streams/cluster-files-{uuid.uuid4().hex}")
    for half in (0, 1):
        staging.stage_cluster_files(spark, sf_dir, f"{root}/in", half)
        docs = files.document_files(spark, f"{root}/in", "cluster_name", stream=True)
        writer = docs.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    docs = spark.read.schema(docs.schema).parquet(f"{root}/out")
    return docs.select("cluster_name", "problem", F.explode_outer("doc").alias("key", "value"))


@register("list_artifacts")
def q_list_artifacts(spark, sf_dir):
    """Artifact files, listed by path."""
    files = documents.list_artifacts(spark, staging.stage_artifacts(spark, sf_dir))
    return files.select(F.col("scope").alias("cluster_name"), "file", "stem").distinct()


@register("scan_logs")
def q_scan_logs(spark, sf_dir):
    """Run logs derived from the events, written as text files of many
    logs, read back with line numbers."""
    return logs.scan_logs(spark, staging.stage_logs(spark, sf_dir), suffix=None)


@register("log_files_stream")
def q_log_files_stream(spark, sf_dir):
    """S5 and P4 as a stream: logs in the tool's layout that grow three times,
    their messages joined over the micro-batches."""
    path = scratch_path(spark, f"staged/log-files-{uuid.uuid4().hex}")
    root = None
    for stage in range(staging.LOG_STAGES):
        staging.stage_log_files(spark, sf_dir, path, stage)
        root = log_stream.run_log_messages(spark, path, root)
    return log_stream.log_messages(spark, root)


@register("context_sink")
def q_context_sink(spark, sf_dir):
    """The resolved context written as a table and read back."""
    path = scratch_path(spark, f"sinks/context-{uuid.uuid4().hex}")
    logs.write_context(_fleet(spark, sf_dir).context, path)
    return logs.read_clusters(spark, path)


@register("cluster_table")
def q_cluster_table(spark, sf_dir):
    """A table by cluster, some clusters replaced (a new VLAN id), some
    removed, the others untouched."""
    path = scratch_path(spark, f"sinks/identity-{uuid.uuid4().hex}")
    rows = _fleet(spark, sf_dir).identity
    k = F.regexp_extract("cluster_name", "([0-9]+)", 1).cast("bigint")
    logs.write_clusters(rows, path)
    logs.replace_clusters(spark, rows.where(k % 5 == 3).withColumn("vlan_id", F.lit("7")), path)
    logs.remove_clusters(spark, rows.where(k % 7 == 2), path)
    return logs.read_clusters(spark, path)


# ============================================================== streaming
@register("readiness_stream")
def q_readiness_stream(spark, sf_dir):
    """L4 as Structured Streaming over the events file: a session of polls per
    run, written when it is over, evaluated against the deadline. Equals the
    batch ``time_to_available`` once the input has ended."""
    table = stream.run_time_to_available(spark, stream.poll_stream(spark, sf_dir), TIMEOUT_MINUTES, finish=True)
    return stream.current_time_to_available(spark, table, TIMEOUT_MINUTES)


@register("poll_buckets_stream")
def q_poll_buckets_stream(spark, sf_dir):
    """L5 as Structured Streaming, all windows final."""
    return stream.poll_buckets_table(spark, stream.run_poll_buckets(spark, stream.poll_stream(spark, sf_dir), finish=True))


SILENCE_MINUTES = 720


@register("silence_alarms")
def q_silence_alarms(spark, sf_dir):
    """L4, the alarm form, in batch."""
    return readiness.silence_alarms(_fleet(spark, sf_dir).polls, SILENCE_MINUTES)


@register("silence_alarms_stream")
def q_silence_alarms_stream(spark, sf_dir):
    """L4, the alarm form, with event-time timers, the input at its end."""
    table = alarms.run_silence_alarms(spark, stream.poll_stream(spark, sf_dir), SILENCE_MINUTES, finish=True)
    return alarms.alarms_table(spark, table, SILENCE_MINUTES)


@register("late_polls")
def q_late_polls(spark, sf_dir):
    """Polls that come in over several arrivals, a tenth of them one arrival
    later, each routed as in time or late."""
    root = scratch_path(spark, f"streams/late-{uuid.uuid4().hex}")
    path = scratch_path(spark, f"staged/arrivals-{uuid.uuid4().hex}")
    for arrival in range(staging.ARRIVALS):
        staging.stage_arrival(spark, sf_dir, path, arrival)
        polls = stream.poll_stream(spark, path, "*.parquet")
        late.route_late(spark, polls, root=root)
    return late.routed(spark, root, polls).select("run_id", "poll_id", "late")


__all__ = ["QUERIES", "register", "F", "J"]
