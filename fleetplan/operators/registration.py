"""Hub registration (H1-H3): which runs register their cluster, where the
token comes from, and the registration record (without the token).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonvalue as J
from ..functions.joins import dim_join
from ..sources.fixed_values import SECRET_TYPE_LABEL
from .validate import started


def registration_candidates(runs: DataFrame, fleet: DataFrame, env: DataFrame) -> DataFrame:
    """H1/H2: runs that reach registration (not destroy, provisioning not
    skipped, registration not skipped, hub URL truthy) and their token source:
    'plain' (a truthy token value), else 'env' (the named variable is set and
    non-empty), else 'none' (not registrable). Runs on refused clusters reach
    nothing. Columns: run_id, cluster_name, token_source, registrable."""
    f = started(
        fleet,
        cluster_name=F.col("cluster_name"),
        __hub=J.truthy("argocd_hub_api_url"),
        __plain=J.truthy("argocd_hub_token"),
        __env_name=F.coalesce(J.as_text("argocd_hub_token_env"), F.lit("")),
    )
    live = runs.where(~F.col("destroy") & ~F.col("skip_terraform") & ~F.col("skip_argocd"))
    j = live.join(f, "cluster_name").where(F.col("__hub"))
    e = env.select(F.col("name").alias("__env_name"), (F.col("value") != "").alias("__env_ok"))
    j = dim_join(j, e, "__env_name", "left", row_key="run_id")
    source = (
        F.when(F.col("__plain"), F.lit("plain"))
        .when(F.coalesce(F.col("__env_ok"), F.lit(False)), F.lit("env"))
        .otherwise(F.lit("none"))
    )
    return j.select("run_id", "cluster_name", source.alias("token_source"), (source != "none").alias("registrable"))


def registration_records(candidates: DataFrame, fleet: DataFrame, spoke: DataFrame) -> DataFrame:
    """H3: the hub's cluster record per registrable run: name
    ``cluster-<name>``, namespace (default 'argocd'), label, the spoke's server,
    and the config JSON without the bearer token (the spoke's CA data, empty
    when TLS verification is off).

    ``spoke``: (cluster_name, server, ca_data), what each cluster answers; a run
    whose cluster has no answer gets a record with a NULL server and config."""
    f = fleet.select(
        "cluster_name",
        "name",
        F.coalesce(J.as_text("argocd_namespace"), F.lit("argocd")).alias("namespace"),
        J.truthy("argocd_insecure_skip_tls").alias("insecure"),
    )
    j = candidates.where(F.col("registrable")).join(f, "cluster_name").join(spoke, "cluster_name", "left")
    tls = F.struct("insecure", F.when(F.col("insecure"), F.lit("")).otherwise(F.col("ca_data")).alias("caData"))
    config = F.when(F.col("server").isNotNull(), F.to_json(F.struct(tls.alias("tlsClientConfig"))))
    return j.select(
        "run_id",
        F.concat(F.lit("cluster-"), F.col("name")).alias("secret_name"),
        "namespace",
        F.lit(SECRET_TYPE_LABEL).alias("label"),
        "server",
        "insecure",
        config.alias("config_json"),
    )
