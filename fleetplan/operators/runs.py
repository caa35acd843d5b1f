"""Runs, logs and state (P1-P9): phase plan, log parsing, level threshold,
multi-line messages, facts in messages, destroyable clusters, desired vs
recorded state, completion summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..functions.scans import running_max_within
from ..sources.fixed_values import LOG_FACTS, LOG_LEVELS, LOG_LINE, PHASES
from .validate import started

LINES_PER_CHUNK = 4096


# --------------------------------------------------------------------------- P1
def phase_plan(runs: DataFrame, fleet: DataFrame) -> DataFrame:
    """Phases of every run in order with an ``enabled`` flag. Destroy
    short-circuits; the readiness loop and hub registration run inside the
    provisioning phase, so skipping it skips them; registration also needs a
    truthy hub URL. A run on a refused cluster ends before its first phase and
    has no rows. Columns: run_id, ordinal, phase, enabled."""
    hub = started(fleet, cluster_name=F.col("cluster_name"), __hub=J.truthy("argocd_hub_api_url"))
    # per-cluster table on its unique key: a plain join (AQE broadcasts it when
    # small at run time and splits a run-heavy cluster with its skew handling)
    j = runs.join(hub, "cluster_name")
    live = ~F.col("destroy")
    tf = live & ~F.col("skip_terraform")
    flags = [
        F.lit(True),
        F.col("destroy"),
        live,
        live,
        live & ~F.col("skip_ignition"),
        live & ~F.col("skip_dns"),
        tf,
        tf & ~F.col("skip_csr"),
        tf & ~F.col("skip_argocd") & F.col("__hub"),
        live,
    ]
    entries = F.array(
        *[F.struct(F.lit(i + 1).alias("ordinal"), F.lit(p).alias("phase"), f.alias("enabled")) for i, (p, f) in enumerate(zip(PHASES, flags))]
    )
    return j.select("run_id", F.inline(entries))


# --------------------------------------------------------------------------- P2
def parse_logs(lines: DataFrame) -> DataFrame:
    """Split ``yyyy-MM-dd HH:mm:ss [LEVEL  ] message`` lines; a line without
    the prefix, or with a time that there is not (a 13th month), continues the
    previous message (is_start = false).
    Adds logged_at (TIMESTAMP_NTZ), level, message, is_start."""
    text = F.col("text")
    at = F.regexp_extract(text, LOG_LINE, 1).try_cast("timestamp_ntz")  # '' where the pattern doesn't match: NULL
    start = F.coalesce(at.isNotNull(), F.lit(False))
    return lines.withColumns(
        {
            "is_start": start,
            "logged_at": at,
            "level": F.when(start, F.regexp_extract(text, LOG_LINE, 2)),
            "message": F.when(start, F.regexp_extract(text, LOG_LINE, 3)).otherwise(text),
        }
    )


def level_rank():
    return F.create_map(*[x for name, rank in LOG_LEVELS for x in (F.lit(name), F.lit(rank))])


# --------------------------------------------------------------------------- P4
def join_multiline(parsed: DataFrame) -> DataFrame:
    """Each line with the message it belongs to: cluster_name, start_line, line_no,
    logged_at, level, message. A continuation line has the level and time of the
    line that started its message; lines before the first start have none
    (NULL start_line, level and time), and stay.

    The start of each line is a running max within its file, scanned per chunk
    of 4096 line numbers, so a huge file, and a message of millions of lines,
    are spread over many tasks. Nothing is gathered per message."""
    head = F.struct("line_no", "logged_at", "level")
    marked = running_max_within(
        parsed, ["cluster_name"], ["line_no"], F.expr(f"line_no div {LINES_PER_CHUNK}"), F.when(F.col("is_start"), head), "__head"
    )
    return marked.select(
        "cluster_name", F.col("__head.line_no").alias("start_line"), "line_no",
        F.col("__head.logged_at").alias("logged_at"), F.col("__head.level").alias("level"), "message",
    )


def message_sizes(messages: DataFrame) -> DataFrame:
    """One row per message: cluster_name, start_line, logged_at, level, n_lines
    (counted before the shuffle)."""
    return messages.where(F.col("start_line").isNotNull()).groupBy("cluster_name", "start_line").agg(
        F.first("logged_at").alias("logged_at"), F.first("level").alias("level"), F.count(F.lit(1)).alias("n_lines")
    )


def message_texts(messages: DataFrame, part_lines: int = 1000) -> DataFrame:
    """The lines of each message joined by newline, in parts of ``part_lines``
    lines: (cluster_name, start_line, part from 1, message). Most messages are
    one part; a message of millions of lines is spread over many rows and tasks.
    The parts of a message, joined by newline in order, are the whole of it."""
    # by line number: where numbers are missing, parts are shorter, never longer
    part = F.expr(f"(line_no - start_line) div {int(part_lines)} + 1")
    lines = messages.where(F.col("start_line").isNotNull()).groupBy("cluster_name", "start_line", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("line_no", "message"))).alias("__lines")
    )
    return lines.select("cluster_name", "start_line", "part", F.array_join("__lines.message", "\n").alias("message"))


def at_least(messages: DataFrame, level: str = "INFO") -> DataFrame:
    """Lines of messages at or above ``level`` (the console handler's
    threshold is INFO, the file keeps everything). ``messages`` is the result of
    ``join_multiline``: a message passes or goes as a whole."""
    threshold = dict(LOG_LEVELS)[level]
    return messages.where(level_rank()[F.col("level")] >= threshold)


# --------------------------------------------------------------------------- P5
def log_facts(parsed: DataFrame) -> DataFrame:
    """Facts in messages as rows (cluster_name, line_no, fact, value): elapsed
    seconds, exit codes, pending counts (BIGINT, NULL for a number beyond it),
    and the stream (stdout / stderr) of captured command output (value NULL, fact names the stream)."""
    msg = F.col("message")
    entries = [
        F.struct(F.lit(name).alias("fact"), F.when(msg.rlike(pat), F.regexp_extract(msg, pat, 1).try_cast("bigint")).alias("value"),
                 msg.rlike(pat).alias("__hit"))
        for name, pat in LOG_FACTS
    ]
    for stream in ("stdout", "stderr"):
        hit = F.ltrim(msg).startswith(f"{stream}:")
        entries.append(F.struct(F.lit(stream).alias("fact"), F.lit(None).cast("bigint").alias("value"), hit.alias("__hit")))
    return parsed.select("cluster_name", "line_no", F.inline(F.array(*entries))).where(F.col("__hit")).drop("__hit")


# --------------------------------------------------------------------------- P6
def destroyable(fleet: DataFrame, artifacts: DataFrame) -> DataFrame:
    """A cluster can be destroyed when both its variables file and its state
    file exist. Columns: cluster_name, destroyable, reason."""
    have = artifacts.groupBy("cluster_name").agg(
        F.max((F.col("file") == "terraform.tfvars").cast("int")).alias("__vars"),
        F.max((F.col("file") == "terraform.tfstate").cast("int")).alias("__state"),
    )
    j = fleet.select("cluster_name").join(have, "cluster_name", "left")
    v, s = F.coalesce(F.col("__vars"), F.lit(0)) == 1, F.coalesce(F.col("__state"), F.lit(0)) == 1
    return j.select(
        "cluster_name",
        (v & s).alias("destroyable"),
        F.when(~v, F.lit("no_variables_file")).when(~s, F.lit("no_state_file")).otherwise(F.lit("ok")).alias("reason"),
    )


# --------------------------------------------------------------------------- P7/P8
def diff_state(
    desired: DataFrame, actual: DataFrame, keys: Sequence[str], cols: Sequence[str] = (), mode: str = "full"
) -> DataFrame:
    """Compare desired with recorded state per resource key.

    mode 'full': create / update / delete / unchanged, columns compared
    null-safe. mode 'keys_only' (resources without triggers or destroy step):
    a changed value under the same key is unchanged, and a key only in the
    recorded state is forgotten, not deleted. Keys are unique per side, so the
    full outer join has no hot key. Columns: keys..., action."""
    keys, cols = list(keys), list(cols)
    d = desired.select(*keys, *[F.col(c).alias(f"__d_{c}") for c in cols], F.lit(True).alias("__d"))
    a = actual.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in cols], F.lit(True).alias("__a"))
    j = d.join(a, keys, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"__d_{c}").eqNullSafe(F.col(f"__a_{c}"))
    only_d, only_a = F.col("__a").isNull(), F.col("__d").isNull()
    if mode == "keys_only":
        action = F.when(only_d, F.lit("create")).when(only_a, F.lit("forget")).otherwise(F.lit("unchanged"))
    else:
        action = F.when(only_d, F.lit("create")).when(only_a, F.lit("delete")).when(same, F.lit("unchanged")).otherwise(F.lit("update"))
    return j.select(*keys, action.alias("action"))


# --------------------------------------------------------------------------- P9
def summary(plan: DataFrame) -> DataFrame:
    """Completion summary per cluster: site (site_name, else the site), segment,
    gateway, addresses joined by ', ' per role, compute '(none)' when empty."""
    row = F.struct(
        F.coalesce(J.as_text("site_name"), F.col("site")).alias("site"),
        F.col("segment").alias("segment"),
        F.col("gateway").alias("gateway"),
        F.array_join("control_plane_ips", ", ").alias("control_plane"),
        F.array_join("infra_ips", ", ").alias("infra"),
        F.coalesce(F.nullif(F.array_join("compute_ips", ", "), F.lit("")), F.lit("(none)")).alias("compute"),
    )
    # clusters with a plan only (NULL array -> no row; see plan_addresses)
    return plan.select("cluster_name", F.inline(F.when(F.col("net").isNotNull(), F.array(row))))
