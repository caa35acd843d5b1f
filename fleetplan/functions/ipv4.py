"""IPv4 arithmetic as BIGINT column expressions (no UDFs, stays in codegen).

An address is a BIGINT in [0, 2^32) internally and dotted text at the surface.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_32 = 4294967296
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])"
DOTTED_QUAD = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_long(col) -> Column:
    """Dotted quad to BIGINT; NULL when not a strict dotted quad (no leading
    zeros, every octet at most 255)."""
    s = _c(col)
    parts = F.split(s, r"\.")
    value = (
        F.element_at(parts, 1).cast("bigint") * 16777216
        + F.element_at(parts, 2).cast("bigint") * 65536
        + F.element_at(parts, 3).cast("bigint") * 256
        + F.element_at(parts, 4).cast("bigint")
    )
    return F.when(s.rlike(DOTTED_QUAD), value)


def to_text(col) -> Column:
    """BIGINT to dotted quad; NULL outside [0, 2^32)."""
    n = _c(col)
    octets = [F.shiftright(n, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    return F.when((n >= 0) & (n < TWO_32), F.concat_ws(".", *octets))


def prefix_mask(prefix) -> Column:
    """Netmask BIGINT of a prefix length, by arithmetic so /0 and /32 need no
    special case."""
    p = _c(prefix).cast("bigint")
    return F.lit(TWO_32) - F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(32) - p).cast("int"))


def _mask_prefix(mask_long: Column) -> Column:
    """Prefix length of a netmask (contiguous ones) or a host mask (contiguous
    zeros then ones), the two forms a network parser accepts; else NULL."""
    inverse = F.lit(TWO_32 - 1) - mask_long
    is_netmask = inverse.bitwiseAND(inverse + 1) == 0
    is_hostmask = mask_long.bitwiseAND(mask_long + 1) == 0
    return (
        F.when(is_netmask, F.bit_count(mask_long))
        .when(is_hostmask, F.lit(32) - F.bit_count(mask_long))
        .cast("int")
    )


def with_cidr(df: DataFrame, col: str, out: str = "cidr") -> DataFrame:
    """Normalise the CIDR text in ``col`` (host bits allowed) into three
    columns ``<out>_network``, ``<out>_prefix``, ``<out>_mask`` (BIGINT, INT,
    BIGINT); all NULL when the text is not an IPv4 network. No ``/`` means /32;
    the suffix may be a length (leading zeros allowed) or a dotted net or host
    mask.

    Each intermediate is its own column, computed once and referred to by name
    (no struct wrappers, whose fields Catalyst would inline at every use)."""
    s = F.col(col)
    slash = F.instr(s, "/")
    step = df.withColumns(
        {
            "__cidr_addr": to_long(F.when(slash > 0, F.substring_index(s, "/", 1)).otherwise(s)),
            "__cidr_suffix": F.when(slash > 0, F.substr(s, slash + 1)),
        }
    )
    suffix = F.col("__cidr_suffix")
    step = step.withColumns(
        {
            "__cidr_len": F.when(suffix.rlike(r"^0*[0-9]{1,2}$"), F.substring(suffix, -2, 2).cast("bigint")),
            "__cidr_digits": suffix.rlike(r"^[0-9]+$"),
            "__cidr_dotted": to_long(suffix),
        }
    )
    length = F.col("__cidr_len")
    step = step.withColumn(
        "__cidr_p",
        F.when(suffix.isNull(), F.lit(32))
        .when(F.col("__cidr_digits"), F.when(length <= 32, length))
        .otherwise(_mask_prefix(F.col("__cidr_dotted")))
        .cast("int"),
    )
    step = step.withColumns(
        {
            "__cidr_m": prefix_mask(F.col("__cidr_p")),
            "__cidr_ok": F.col("__cidr_addr").isNotNull() & F.col("__cidr_p").isNotNull(),
        }
    )
    ok = F.col("__cidr_ok")
    return step.withColumns(
        {
            f"{out}_network": F.when(ok, F.col("__cidr_addr").bitwiseAND(F.col("__cidr_m"))),
            f"{out}_prefix": F.when(ok, F.col("__cidr_p")),
            f"{out}_mask": F.when(ok, F.col("__cidr_m")),
        }
    ).drop("__cidr_addr", "__cidr_suffix", "__cidr_len", "__cidr_digits", "__cidr_dotted", "__cidr_p", "__cidr_m", "__cidr_ok")


def address_at(network, offset) -> Column:
    """Address at ``offset`` from the network address; NULL beyond the IPv4 range.
    No bounds check against the segment (see ``in_segment``)."""
    a = _c(network) + _c(offset).cast("bigint")
    return F.when((a >= 0) & (a < TWO_32), a)


def in_segment(address, network, mask) -> Column:
    return _c(address).bitwiseAND(_c(mask)) == _c(network)


def reverse_pointer(ip_text) -> Column:
    """``a.b.c.d`` to ``d.c.b.a.in-addr.arpa.``."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(_c(ip_text), r"\."))), F.lit(".in-addr.arpa."))
