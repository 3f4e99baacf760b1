"""The five output tables. Column order is part of the contract: ``source`` is
always first and every provider produces the same schema, so any two
conversation frames can be ``unionByName``-ed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

S, L, B = StringType(), LongType(), BooleanType()


def _schema(cols: list[tuple[str, object, bool]]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in cols])


CONVERSATIONS = _schema([
    ("source", S, False), ("session_id", S, False), ("project_path", S, False),
    ("project_dir", S, False), ("file_name", S, False), ("is_agent", B, False),
    ("line_number", L, False), ("message_type", S, False), ("uuid", S, True),
    ("parent_uuid", S, True), ("timestamp", S, True), ("message_role", S, True),
    ("message_content", S, True), ("model", S, True), ("tool_name", S, True),
    ("tool_use_id", S, True), ("tool_input", S, True), ("input_tokens", L, True),
    ("output_tokens", L, True), ("cache_creation_tokens", L, True),
    ("cache_read_tokens", L, True), ("reasoning_tokens", L, True), ("slug", S, True),
    ("git_branch", S, True), ("cwd", S, True), ("version", S, True),
    ("stop_reason", S, True), ("reasoning_effort", S, True), ("repository", S, True),
])

PLANS = _schema([
    ("source", S, False), ("session_id", S, True), ("plan_name", S, False),
    ("file_name", S, False), ("file_path", S, False), ("content", S, False),
    ("file_size", L, False),
])

TODOS = _schema([
    ("source", S, False), ("session_id", S, False), ("agent_id", S, True),
    ("file_name", S, False), ("item_index", L, False), ("content", S, False),
    ("status", S, False), ("active_form", S, True),
])

HISTORY = _schema([
    ("source", S, False), ("line_number", L, False), ("timestamp_ms", L, True),
    ("project", S, True), ("session_id", S, True), ("display", S, True),
    ("pasted_contents", S, True),
])

STATS = _schema([
    ("source", S, False), ("date", S, False), ("message_count", L, False),
    ("session_count", L, False), ("tool_call_count", L, False),
])

TABLES = {
    "conversations": CONVERSATIONS, "plans": PLANS, "todos": TODOS,
    "history": HISTORY, "stats": STATS,
}


def _default(dtype) -> Column:
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, LongType):
        return F.lit(0).cast(L)
    return F.lit("")


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become NULL, columns that
    are declared NOT NULL get the type's empty value (``''``, ``0``, ``false``)
    instead of NULL, every column is cast to its declared type, and helper
    columns are dropped. One ``select`` — it fuses into the producing stage."""
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, _default(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def empty(spark, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
