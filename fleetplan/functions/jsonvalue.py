"""Column functions over configuration values stored as JSON text.

A configuration value keeps three states apart: no row (key absent), the text
``null`` (key present, value null) and any other JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.fixed_values import REDACTED, SECRET_KEYS

# JSON texts that Python treats as falsy. Numbers equal to zero are handled by
# the pattern below.
_FALSY_TEXTS = ["null", "false", '""', "[]", "{}"]
_ZERO_NUMBER = r"^-?0+(\.0*)?([eE][-+]?[0-9]+)?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_text(col) -> Column:
    """Scalar JSON to text: strings unquoted, numbers and booleans as written,
    ``null`` to NULL, arrays and objects left as JSON."""
    v = _c(col)
    return F.when(F.trim(v) != "null", F.get_json_object(v, "$"))


def truthy(col) -> Column:
    """Python truthiness of a JSON value; a missing value (NULL) is falsy."""
    v = F.trim(_c(col))
    return (
        F.when(v.isNull(), F.lit(False))
        .when(v.isin(*_FALSY_TEXTS), F.lit(False))
        .when(v.rlike(_ZERO_NUMBER), F.lit(False))
        .otherwise(F.lit(True))
    )


def quote(col) -> Column:
    """Encode text as a JSON string, control characters included (NULL stays
    NULL): the only element of a one-element JSON array."""
    v = _c(col)
    return F.when(v.isNotNull(), F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))


def as_int(col) -> Column:
    """JSON number to INT; anything else (text, list, null) to NULL."""
    return F.get_json_object(_c(col), "$").try_cast("int")


def as_int_array(col) -> Column:
    return F.from_json(_c(col), "array<int>")


def as_str_array(col) -> Column:
    return F.from_json(_c(col), "array<string>")



def redacted(key, value) -> Column:
    """``value`` (JSON text) of ``key``, a secret one replaced by a fixed text;
    empty and null secrets stay, since absence is not a secret."""
    return F.when(_c(key).isin(*SECRET_KEYS) & truthy(value), F.lit(REDACTED)).otherwise(_c(value))


def redacted_document(doc) -> Column:
    """A document map (key -> JSON text) without secret values. Only documents
    with a secret key are rewritten: a lambda is interpreted, and with one use of
    the map alone the expressions that make it would be copied into the lambda."""
    d = _c(doc)
    secret = F.arrays_overlap(F.map_keys(d), F.array(*[F.lit(k) for k in SECRET_KEYS]))
    return F.when(secret, F.transform_values(d, redacted)).otherwise(d)
