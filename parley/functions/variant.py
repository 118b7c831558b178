"""VARIANT helpers that mirror how a Python dict from ``json.loads`` behaves.

``vtype`` names the JSON type of one value without walking nested data
(callers only apply it to scalars or to values they are about to read anyway).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMERIC_PREFIXES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE")


def field(v: Column, key: str) -> Column:
    """Value of top-level ``key`` as VARIANT; SQL NULL when absent or ``v`` is no object.

    A JSON ``null`` comes back as a variant null (not SQL NULL), so
    ``field(...).isNotNull()`` is the key-presence test.
    """
    return F.try_variant_get(v, f"$.{_quote(key)}", "variant")


def _quote(key: str) -> str:
    if key.isidentifier():
        return key
    return "[" + "'" + key.replace("'", "\\'") + "'" + "]"


def vtype(v: Column) -> Column:
    """``schema_of_variant`` of a value: 'STRING', 'VOID' (JSON null), 'BIGINT', ...; NULL if absent."""
    return F.schema_of_variant(v)


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def py_truthy(v: Column, t: Column | None = None) -> Column:
    """Python truthiness of a JSON value (absent counts as ``None`` → False).

    Pass ``t`` (its precomputed ``vtype``) to avoid recomputing the type.
    """
    t = vtype(v) if t is None else t
    numeric = F.lit(False)
    for p in _NUMERIC_PREFIXES:
        numeric = numeric | t.startswith(p)
    return (
        F.when(v.isNull() | (t == "VOID"), F.lit(False))
        .when(t == "STRING", F.length(as_string(v)) > 0)
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(numeric, F.try_variant_get(v, "$", "double") != 0)
        .when(t.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .when(t.startswith("OBJECT"), F.size(F.try_variant_get(v, "$", "map<string,variant>")) > 0)
        .otherwise(F.lit(True))
    )


def py_str(v: Column, null_text: str | None = None, t: Column | None = None) -> Column:
    """Text of a JSON value as ``str(value)`` would give for strings and numbers.

    Absent → ''.  JSON null → '' by default, or ``null_text`` (``'None'``
    reproduces Python's ``str(None)``).  Booleans, objects and arrays come
    back as JSON text, which differs from Python's repr (documented).
    """
    t = vtype(v) if t is None else t
    null_val = F.lit(null_text if null_text is not None else "")
    return (
        F.when(v.isNull(), F.lit(""))
        .when(t == "VOID", null_val)
        .when(t == "STRING", as_string(v))
        .when(t.startswith("OBJECT") | t.startswith("ARRAY"), F.to_json(v))
        .otherwise(F.coalesce(as_string(v), F.lit("")))
    )
