"""Claude (and Claude Desktop) JSONL transcripts → conversations.

Input: a stream ``(file_path, block, ord, value)`` where ``file_path`` ends in
``projects/<encoded-cwd>/<file>.jsonl`` or
``projects/<encoded-cwd>/<session>/subagents/<file>.jsonl``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.functions.paths import decode_project_path
from sessionlake.operators.blocks import KEY, as_stream, attach, not_blank, state_table
from sessionlake.schemas import CONVERSATIONS, align

# The line kinds of the transcript format and its content-block kinds.
LINE_TYPES = ["user", "assistant", "system", "summary", "file-history-snapshot", "queue-operation"]
BLOCK_TYPES = ["text", "thinking", "tool_use", "tool_result"]

_MAIN = r"/projects/([^/]+)/([^/]+\.jsonl)$"
_SUB = r"/projects/([^/]+)/([^/]+)/subagents/([^/]+\.jsonl)$"


def path_columns(file_path: Column) -> dict[str, Column]:
    """project_dir, file_name, is_agent and the file's fallback session id."""
    is_sub = file_path.rlike(_SUB)
    project_dir = F.when(is_sub, F.regexp_extract(file_path, _SUB, 1)).otherwise(F.regexp_extract(file_path, _MAIN, 1))
    file_name = F.substring_index(file_path, "/", -1)
    is_agent = is_sub | file_name.startswith("agent-")
    file_session = F.when(is_sub, F.regexp_extract(file_path, _SUB, 2)).otherwise(
        F.regexp_replace(file_name, r"\.jsonl$", ""))
    return {"project_dir": project_dir, "file_name": file_name, "is_agent": is_agent, "file_session": file_session}


def _blocks_ok(blocks: Column) -> Column:
    """Every block is an object with a known ``type``; text blocks carry a
    string ``text``; tool_use ``id``/``name`` are strings when present."""
    def ok(b: Column) -> Column:
        t = J.get_string(b, "$.type")
        return J.all_ok(
            t.isin(*BLOCK_TYPES),
            F.when(t == "text", J.is_string(J.field(b, "$.text"))).otherwise(F.lit(True)),
            F.when(t == "tool_use", J.opt_string_ok(J.field(b, "$.id")) & J.opt_string_ok(J.field(b, "$.name")))
             .otherwise(F.lit(True)),
        )
    return F.forall(blocks, ok)


def parse_lines(lines: DataFrame, source: str = "claude") -> DataFrame:
    """Per-line parse (no cross-line state). Keeps the line's place and
    ``fallback_path`` for the file-level back-fill."""
    place = [k for k in (*KEY, "ord", "line_number") if k in lines.columns]
    v = F.col("v")
    typ = J.get_string(v, "$.type")
    msg = J.field(v, "$.message")
    content = J.field(v, "$.message.content")
    blocks = J.array_of(v, "$.message.content")
    usage = J.field(v, "$.message.usage")
    base_fields = ["uuid", "parentUuid", "timestamp", "sessionId", "cwd", "version", "slug", "gitBranch"]
    has_base = typ.isin("user", "assistant", "system")

    valid = J.all_ok(
        v.isNotNull(),
        typ.isin(*LINE_TYPES),
        F.when(has_base, J.all_ok(*[J.opt_string_ok(J.field(v, f"$.{f}")) for f in base_fields])).otherwise(F.lit(True)),
        F.when(typ.isin("user", "assistant"), J.opt_object_ok(msg)).otherwise(F.lit(True)),
        F.when(typ == "assistant", J.all_ok(
            J.opt_array_ok(content),
            F.coalesce(_blocks_ok(blocks), F.lit(True)),
            J.opt_string_ok(J.field(v, "$.message.model")),
            J.opt_string_ok(J.field(v, "$.message.stop_reason")),
            J.opt_object_ok(usage),
            *[J.opt_int_ok(J.field(v, f"$.message.usage.{k}")) for k in
              ("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")],
        )).otherwise(F.lit(True)),
        F.when(typ == "summary", J.opt_string_ok(J.field(v, "$.summary"))).otherwise(F.lit(True)),
        F.when(typ == "queue-operation", J.all_ok(*[J.opt_string_ok(J.field(v, f"$.{f}"))
                                                     for f in ("timestamp", "sessionId", "content")]))
         .otherwise(F.lit(True)),
    )

    p = path_columns(F.col("file_path"))
    mtype = F.when(~F.col("valid"), F.lit("_parse_error")).otherwise(typ)
    base = F.col("valid") & has_base

    def b(name: str) -> Column:
        return F.when(base, J.get_string(v, f"$.{name}"))

    first_tool = F.get(F.filter(blocks, lambda x: J.get_string(x, "$.type") == "tool_use"), 0)
    text_blocks = F.transform(F.filter(blocks, lambda x: J.get_string(x, "$.type") == "text"),
                              lambda x: J.get_string(x, "$.text"))
    is_asst = F.col("valid") & (typ == "assistant")

    def u(k: str) -> Column:
        return F.when(is_asst, J.get_long(v, f"$.message.usage.{k}"))

    cwd = b("cwd")
    session = F.coalesce(
        F.when(base | (F.col("valid") & (typ == "queue-operation")), J.get_string(v, "$.sessionId")),
        F.col("file_session"))
    content_col = (
        F.when(~F.col("valid"), F.lit("Parse error: invalid transcript line"))
        .when(typ == "user", J.extract_text(content))
        .when(typ == "assistant", F.when(J.present(content), F.array_join(text_blocks, "\n")))
        .when(typ == "system", J.extract_text(J.field(v, "$.content")))
        .when(typ == "summary", J.get_string(v, "$.summary"))
        .when(typ == "queue-operation", J.get_string(v, "$.content"))
    )
    return (
        J.parse_lines(lines, *place)
        .select("*", valid.alias("valid"), *[c.alias(k) for k, c in p.items()])
        .select(
            F.lit(source).alias("source"),
            session.alias("session_id"),
            F.coalesce(cwd, decode_project_path(F.col("project_dir"))).alias("project_path"),
            "project_dir", "file_name", "is_agent", *place,
            mtype.alias("message_type"),
            b("uuid").alias("uuid"), b("parentUuid").alias("parent_uuid"),
            F.when(base | (F.col("valid") & (typ == "queue-operation")), J.get_string(v, "$.timestamp")).alias("timestamp"),
            F.when(F.col("valid") & typ.isin("user", "assistant"), typ).alias("message_role"),
            content_col.alias("message_content"),
            F.when(is_asst, J.get_string(v, "$.message.model")).alias("model"),
            F.when(is_asst, J.get_string(first_tool, "$.name")).alias("tool_name"),
            F.when(is_asst, J.get_string(first_tool, "$.id")).alias("tool_use_id"),
            F.when(is_asst, J.json_text(J.field(first_tool, "$.input"))).alias("tool_input"),
            u("input_tokens").alias("input_tokens"), u("output_tokens").alias("output_tokens"),
            u("cache_creation_input_tokens").alias("cache_creation_tokens"),
            u("cache_read_input_tokens").alias("cache_read_tokens"),
            b("slug").alias("slug"), b("gitBranch").alias("git_branch"), cwd.alias("cwd"),
            b("version").alias("version"),
            F.when(is_asst, J.get_string(v, "$.message.stop_reason")).alias("stop_reason"),
            decode_project_path(F.col("project_dir")).alias("fallback_path"),
        )
    )


def normalise(lines: DataFrame, source: str = "claude") -> DataFrame:
    """Stream → conversations (29 columns). One pre-pass counts lines and finds
    each file's first ``cwd`` (parsing only lines that can carry one); it replaces
    every ``project_path`` of the file equal to the decoded directory name."""
    lines = as_stream(lines)
    may = lines.withColumn("value", F.when(J.may_contain("value", '"cwd"'), F.col("value")))
    table = state_table(parse_lines(may, source), first={"file_cwd": F.col("cwd")})
    rows = attach(parse_lines(lines.where(not_blank()), source), table)
    return align(rows.withColumn("project_path", F.when(
        (F.col("project_path") == F.col("fallback_path")) & F.col("file_cwd").isNotNull(), F.col("file_cwd"))
        .otherwise(F.col("project_path"))), CONVERSATIONS)
