"""Run logs (S5) and the context sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scans import ordinal_within
from .clusters import read_clusters, remove_clusters, replace_clusters, write_clusters
from .fixed_values import SECRET_KEYS

__all__ = ["context_rows", "read_clusters", "remove_clusters", "replace_clusters", "scan_logs", "write_clusters", "write_context"]

LOG_SUFFIX = "-bootstrap.log"


def scan_logs(spark: SparkSession, path: str, suffix: str | None = LOG_SUFFIX) -> DataFrame:
    """Read run logs as (cluster_name, line_no, text), line_no 1-based in order.
    The cluster is the file name without ``suffix`` (``<cluster>-bootstrap.log``,
    the tool's layout). With ``suffix=None`` there are many logs in a file, as a
    fleet of millions of clusters needs: lines of ``<cluster> TAB <line>``, the
    cluster URL-encoded, each cluster's in order over the numbered files of one
    write; or the folders of a partitioned write,
    ``cluster_name=<id>/part_no=<n>``, read in the order of the numbers.

    Files are read line by line and stay splittable: a line's position is its
    split's start offset, then its position within the split; the ordinal is
    computed per split (``ordinal_within`` with the split as chunk) plus the
    line counts of the earlier splits. A huge log is spread over many tasks."""
    path_name = F.col("_metadata.file_path")
    if suffix:
        raw = spark.read.option("pathGlobFilter", f"*{suffix}").text(path)
        cluster = F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), f"{suffix.replace('.', '[.]')}$", ""))
        part, text = F.lit(0).cast("bigint"), F.col("value")
    else:
        # taken from the path, not from partition columns: '007' stays text
        raw = spark.read.option("recursiveFileLookup", "true").text(path)
        folder = F.regexp_extract(path_name, "/cluster_name=([^/]+)/", 1)
        number = F.when(folder != "", F.regexp_extract(path_name, "/part_no=([0-9]+)/", 1))
        part = F.coalesce(number, F.regexp_extract(path_name, "/part-([0-9]+)[^/]*$", 1)).try_cast("bigint")
        line = F.split("value", "\t", 2)
        # file paths are URIs, and a partitioned write escapes names once more
        cluster = F.when(folder != "", F.url_decode(F.url_decode(folder))).otherwise(F.url_decode(line[0]))
        text = F.when(folder != "", F.col("value")).otherwise(F.get(line, F.lit(1)))
    lines = raw.select(
        text.alias("value"),
        cluster.alias("__cluster"),
        F.struct(part.alias("part"), F.col("_metadata.file_block_start").alias("start")).alias("__split"),
        F.monotonically_increasing_id().alias("__pos"),
    )
    numbered = ordinal_within(lines, ["__cluster"], ["__split", "__pos"], F.col("__split"), "line_no")
    return numbered.select(F.col("__cluster").alias("cluster_name"), "line_no", F.col("value").alias("text"))


def context_rows(context: DataFrame) -> DataFrame:
    """What is kept of the resolved context: values that are not null, and
    never a secret key (a stated deviation: the tool dumps its secrets)."""
    keep = context.where((F.col("value") != "null") & ~F.col("key").isin(*SECRET_KEYS))
    return keep.select("cluster_name", "key", "value")


def write_context(context: DataFrame, path: str, buckets: int = 64) -> None:
    """Write the resolved context of every cluster."""
    write_clusters(context_rows(context), path, buckets)
