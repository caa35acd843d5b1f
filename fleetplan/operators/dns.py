"""DNS records (D1-D5): forward A and PTR per node, api / api-int per
management address, ``*.apps`` per infra address, and the whole set.

Records are rows (cluster_name, name, type, ttl, value), emitted from the node
rows of each plan row (``nodes.node_rows``: two generators, no lambdas). The
de-duplication of D3 and D4 needs no shuffle: two nodes of a cluster share an
address exactly when they share an offset, so a node emits the api and apps
records only if its offset is the first occurrence in its list
(``array_position``). A and PTR records are unique per node, so the whole set
is duplicate-free without a ``distinct``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ipv4 as ip
from ..sources.fixed_values import RECORD_TTL
from .nodes import node_rows

RECORD_COLUMNS = ["cluster_name", "name", "type", "ttl", "value"]


def _rec(name: Column, rtype: str, value: Column, when: Column | None = None) -> Column:
    rec = F.struct(
        name.alias("name"), F.lit(rtype).alias("type"), F.lit(RECORD_TTL).cast("int").alias("ttl"), value.alias("value")
    )
    return rec if when is None else F.when(when, rec)


def _first_mgmt(include_bootstrap: bool) -> Column:
    """The node is a management node whose address appears here first."""
    role, offset = F.col("role"), F.col("offset")
    if include_bootstrap:
        mgmt = F.concat(F.array(F.col("bootstrap_offset")), F.col("control_plane_offsets"))
        index = F.when(role == "bootstrap", F.lit(1)).otherwise(F.col("ordinal") + 1)
        is_mgmt = role.isin("bootstrap", "control_plane")
    else:
        mgmt = F.col("control_plane_offsets")
        index = F.col("ordinal")
        is_mgmt = role == "control_plane"
    return is_mgmt & (F.array_position(mgmt, offset) == index)


def _first_infra() -> Column:
    return (F.col("role") == "infra") & (F.array_position(F.col("infra_offsets"), F.col("offset")) == F.col("ordinal"))


def _emit(plan: DataFrame, records: list[Column]) -> DataFrame:
    rows = node_rows(plan, carry=["bootstrap_offset", "control_plane_offsets", "infra_offsets"])
    # a record not due is a NULL element; inline gives it a NULL name
    return rows.select("cluster_name", F.inline(F.array(*records))).where(F.col("name").isNotNull()).select(*RECORD_COLUMNS)


def _a() -> Column:
    return _rec(F.col("fqdn"), "A", F.col("ip"))


def _ptr() -> Column:
    return _rec(ip.reverse_pointer(F.col("ip")), "PTR", F.concat(F.col("fqdn"), F.lit(".")))


def _api(include_bootstrap: bool) -> list[Column]:
    first = _first_mgmt(include_bootstrap)
    return [
        _rec(F.concat(F.lit("api."), F.col("domain")), "A", F.col("ip"), first),
        _rec(F.concat(F.lit("api-int."), F.col("domain")), "A", F.col("ip"), first),
    ]


def _apps() -> Column:
    return _rec(F.concat(F.lit("*.apps."), F.col("domain")), "A", F.col("ip"), _first_infra())


def forward_records(plan: DataFrame) -> DataFrame:
    """``<host>.<cluster domain> A <ip>`` for every node."""
    return _emit(plan, [_a()])


def reverse_records(plan: DataFrame) -> DataFrame:
    """``d.c.b.a.in-addr.arpa. PTR <fqdn>.`` for every node."""
    return _emit(plan, [_ptr()])


def api_records(plan: DataFrame, include_bootstrap: bool = True) -> DataFrame:
    """D3: ``api`` and ``api-int`` A records for each distinct management
    address (bootstrap and control plane)."""
    return _emit(plan, _api(include_bootstrap))


def wildcard_records(plan: DataFrame) -> DataFrame:
    """``*.apps.<cluster domain> A <ip>`` for each distinct infra address."""
    return _emit(plan, [_apps()])


def record_set(plan: DataFrame, include_bootstrap: bool = True) -> DataFrame:
    """D1-D4 together, each record once, in one pass over the nodes."""
    return _emit(plan, [_a(), _ptr(), *_api(include_bootstrap), _apps()])
