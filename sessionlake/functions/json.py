"""Strict access to semi-structured lines parsed as VARIANT.

The session formats are read with typed decoders in the original tool: a field
of the wrong JSON type makes the whole line a parse error, while a missing field
or an explicit ``null`` just means "absent". ``try_variant_get`` coerces
(``"7"`` → 7, ``1.5`` → 1), so every getter here comes with a type check built
on ``schema_of_variant``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def parse(value: Column | str) -> Column:
    """JSON text → VARIANT; NULL for malformed text or duplicate keys."""
    return F.try_parse_json(value)


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def members(v: Column, *names: str) -> Column:
    """The named members of an object as a struct of VARIANTs, absent ones NULL,
    in one walk over the object; NULL when ``v`` is no object. ``field`` walks
    it once a member, also for members that a line lacks."""
    return F.try_variant_get(v, "$", f"struct<{','.join(f'`{n}`:variant' for n in names)}>")


def kind(x: Column) -> Column:
    return F.schema_of_variant(x)


def present(x: Column) -> Column:
    """The member exists and is not JSON ``null``."""
    return x.isNotNull() & ~F.is_variant_null(x)


def _scalar_kind(x: Column) -> Column:
    # schema_of_variant is cheap on scalars; containers are probed by casting
    return kind(x)


def is_string(x: Column) -> Column:
    return F.coalesce(_scalar_kind(x) == "STRING", F.lit(False))


def is_array(x: Column) -> Column:
    return F.try_variant_get(x, "$", "array<variant>").isNotNull()


def is_object(x: Column) -> Column:
    return F.try_variant_get(x, "$", "struct<>").isNotNull()


def is_int(x: Column) -> Column:
    return F.coalesce(_scalar_kind(x).isin(*INT_KINDS), F.lit(False))


def is_number(x: Column) -> Column:
    k = _scalar_kind(x)
    return F.coalesce(k.isin(*INT_KINDS, "FLOAT", "DOUBLE") | k.startswith("DECIMAL"), F.lit(False))


def _absent(x: Column) -> Column:
    return x.isNull() | F.is_variant_null(x)


def opt_string_ok(x: Column) -> Column:
    """True when an optional string member is absent, null or a string."""
    return F.coalesce(_scalar_kind(x).isin("STRING", "VOID"), F.lit(True))


def opt_int_ok(x: Column) -> Column:
    return F.coalesce(_scalar_kind(x).isin(*INT_KINDS, "VOID"), F.lit(True))


def opt_object_ok(x: Column) -> Column:
    return _absent(x) | is_object(x)


def opt_array_ok(x: Column) -> Column:
    return _absent(x) | is_array(x)


def all_ok(*conds: Column) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & F.coalesce(c, F.lit(False))
    return out


def as_string(x: Column) -> Column:
    """String value of a member, NULL when absent/null/not a string."""
    return F.when(_scalar_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))


def as_long(x: Column) -> Column:
    return F.when(_scalar_kind(x).isin(*INT_KINDS), F.try_variant_get(x, "$", "bigint"))


def get_string(v: Column, path: str) -> Column:
    return as_string(field(v, path))


def get_long(v: Column, path: str) -> Column:
    return as_long(field(v, path))


def json_text(x: Column) -> Column:
    """Compact JSON text with sorted object keys; NULL when absent or null."""
    return F.when(present(x), F.to_json(x))


def json_text_requoted(x: Column) -> Column:
    """Like :func:`json_text`, but a JSON string stays a quoted JSON string
    (``"ls -la"`` → ``"\\"ls -la\\""``), as argument payloads are rendered."""
    return F.when(present(x), F.to_json(x))


def array_of(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def extract_text(x: Column) -> Column:
    """Text of a content value: a string is itself; an array gives the string
    ``text`` members of its elements joined by newlines; anything else is its
    JSON text. NULL when absent or null."""
    arr = F.try_variant_get(x, "$", "array<variant>")
    texts = F.filter(
        F.transform(arr, lambda e: as_string(F.try_variant_get(e, "$.text", "variant"))),
        lambda t: t.isNotNull(),
    )
    return (
        F.when(_absent(x), F.lit(None).cast("string"))
        .when(arr.isNotNull(), F.array_join(texts, "\n"))
        .when(_scalar_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
        .otherwise(F.to_json(x))
    )


def parse_lines(lines, *keep: str):
    """``lines(..., value)`` → ``(*keep, v)`` with ``v`` the parsed VARIANT.

    The parse is guarded by an always-true, non-deterministic condition
    (``spark_partition_id() >= 0``). That makes the projection an optimizer
    barrier: later filters on derived columns (marker selection, row-kind
    filters) are not pushed below it, where Catalyst would rewrite them in
    terms of the raw text and parse every line a second time, and the parsed
    value is computed once per line however many columns read it."""
    parsed = F.when(F.spark_partition_id() >= 0, F.try_parse_json(F.col("value")))
    return lines.select(*keep, parsed.alias("v"))


def may_contain(value, *needles: str):
    """Cheap text pre-selection before parsing: true when the raw line contains
    any needle — or any ``\\u`` escape, since an escaped key or value could
    spell a needle without containing it literally. Always a superset of the
    lines the exact (parsed) condition keeps."""
    cond = F.col(value).contains("\\u") if isinstance(value, str) else value.contains("\\u")
    for n in needles:
        cond = cond | (F.col(value).contains(n) if isinstance(value, str) else value.contains(n))
    return cond
