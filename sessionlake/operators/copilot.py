"""Copilot CLI session event streams → conversations.

Input lines come from ``session-state/<id>/events.jsonl`` or the flat
``session-state/<id>.jsonl``; an optional ``workspace`` frame
``(dir_path, id, cwd, branch, repository, summary)`` supplies the initial
metadata of a session directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.operators.blocks import KEY, as_stream, attach, not_blank, state_table
from sessionlake.schemas import CONVERSATIONS, align

# Event type → (message_type, message_role).
TYPE_MAP = {
    "user.message": ("user", "user"),
    "assistant.message": ("assistant", "assistant"),
    "assistant.reasoning": ("reasoning", "assistant"),
    "assistant.turn_start": ("turn_start", "assistant"),
    "assistant.turn_end": ("turn_end", "assistant"),
    "tool.execution_start": ("tool_start", "tool"),
    "tool.execution_complete": ("tool_result", "tool"),
    "session.start": ("session_start", None),
    "session.resume": ("session_resume", None),
    "session.info": ("session_info", None),
    "session.error": ("session_error", None),
    "session.truncation": ("truncation", None),
    "session.compaction_start": ("compaction_start", None),
    "session.compaction_complete": ("compaction_complete", None),
    "session.model_change": ("model_change", None),
    "abort": ("abort", None),
}

_NESTED = r"/session-state/([^/]+)/events\.jsonl$"
_FLAT = r"/session-state/([^/]+)\.jsonl$"


def dir_session(file_path: Column) -> Column:
    return F.when(file_path.rlike(_NESTED), F.regexp_extract(file_path, _NESTED, 1)) \
        .otherwise(F.regexp_extract(file_path, _FLAT, 1))


def session_dir(file_path: Column) -> Column:
    """Directory that holds the session's ``workspace.yaml``."""
    return F.regexp_replace(file_path, r"/[^/]*$", "")


def _map_type(t: Column, idx: int) -> Column:
    out = None
    for k, v in TYPE_MAP.items():
        val = F.lit(v[idx])
        out = F.when(t == k, val) if out is None else out.when(t == k, val)
    return out.otherwise(F.lit("unknown") if idx == 0 else F.lit(None))


#: The members of ``data`` that any rule reads.
_MEMBERS = ("sessionId", "copilotVersion", "context", "newModel", "content", "messageId", "toolRequests", "toolCallId", "toolName", "arguments",
            "success", "result", "tokenLimit", "preTruncationTokensInMessages", "postTruncationTokensInMessages", "errorType", "message")


def _parsed(lines: DataFrame) -> DataFrame:
    """Per-line parse with the members of ``data`` (``d``, null unless it is an
    object) and, on the event types that use them, of objects inside it."""
    place = [k for k in (*KEY, "ord", "line_number") if k in lines.columns]
    h, d, typ, ctx = F.col("h"), F.col("d"), F.col("typ"), F.col("ctx")
    valid = J.all_ok(J.is_string(h["type"]), *[J.opt_string_ok(h[f]) for f in ("id", "timestamp", "parentId")])
    parsed = (J.parse_lines(lines, *place)
              .select(*place, J.members(F.col("v"), "type", "id", "parentId", "timestamp", "data").alias("h"))
              .select(*place, J.as_string(h["type"]).alias("typ"), valid.alias("valid"), J.as_string(h["id"]).alias("id"),
                      J.as_string(h["parentId"]).alias("parent_id"), J.as_string(h["timestamp"]).alias("ts"),
                      J.members(h["data"], *_MEMBERS).alias("d"))
              .select("*", F.when(typ == "session.start", J.members(d["context"], "cwd", "gitRoot", "branch", "repository")).alias("ctx")))
    # session.start data must decode as a whole, else it changes nothing
    start_ok = J.all_ok(d.isNotNull(), J.opt_string_ok(d["sessionId"]), J.opt_string_ok(d["copilotVersion"]),
                        ctx.isNotNull() | ~J.present(d["context"]),
                        *[J.opt_string_ok(ctx[f]) for f in ("cwd", "gitRoot", "branch", "repository")])
    is_start = F.col("valid") & (typ == "session.start") & start_ok
    is_model = F.col("valid") & (typ == "session.model_change") & d.isNotNull() & J.opt_string_ok(d["newModel"])
    return parsed.select("*", is_start.alias("is_start"), is_model.alias("is_model"))


def normalise(lines: DataFrame, workspace: DataFrame | None = None) -> DataFrame:
    c, d, ctx = F.col, F.col("d"), F.col("ctx")
    typ = c("typ")
    lines = as_stream(lines)
    # the pre-pass parses only lines that can change the state
    marked = _parsed(lines.where(J.may_contain("value", "session.start", "session.model_change")))
    table = state_table(lines, marked=marked, carried={
        "m_sid": F.when(c("is_start"), J.as_string(d["sessionId"])),
        "m_version": F.when(c("is_start"), J.as_string(d["copilotVersion"])),
        "m_cwd": F.when(c("is_start"), J.as_string(ctx["cwd"])),
        "m_branch": F.when(c("is_start"), J.as_string(ctx["branch"])),
        "m_repo": F.when(c("is_start"), J.as_string(ctx["repository"])),
        "m_model": F.when(c("is_model"), J.as_string(d["newModel"]))})
    if workspace is not None:
        # one row a folder, stated as an aggregation so that Catalyst may drop the join; met by the small
        # state table, so that the lines meet both in one join
        ws = workspace.groupBy(F.col("dir_path").alias("_dir")).agg(*[F.first(k, ignorenulls=True).alias(f"w_{n}") for k, n in (
            ("id", "id"), ("cwd", "cwd"), ("branch", "branch"), ("repository", "repo"))])
        table = table.withColumn("_dir", session_dir(F.col("file_path"))).join(ws.hint("shuffle_hash"), "_dir", "left").drop("_dir")
    else:
        table = table.select("*", *[F.lit(None).cast("string").alias(x) for x in ("w_id", "w_cwd", "w_branch", "w_repo")])

    sid = F.coalesce(F.col("m_sid"), F.col("w_id"), dir_session(F.col("file_path")))
    project = F.coalesce(F.col("m_cwd"), F.col("w_cwd"), F.lit(""))
    ok = F.col("valid")

    def when_type(t: str, cond: Column, val: Column) -> Column:
        return F.when(ok & (typ == t) & cond, val)

    obj = d.isNotNull()
    user_ok = obj & J.opt_string_ok(d["content"])
    reqs = F.try_variant_get(d["toolRequests"], "$", "array<variant>")
    req = c("req")
    asst_ok = J.all_ok(obj, J.opt_string_ok(d["messageId"]), J.opt_string_ok(d["content"]),
                       J.opt_array_ok(d["toolRequests"]),
                       F.coalesce(F.forall(reqs, lambda r: J.is_object(r) & J.opt_string_ok(J.field(r, "$.toolCallId"))
                                           & J.opt_string_ok(J.field(r, "$.name"))), F.lit(True)))
    tstart_ok = J.all_ok(obj, J.opt_string_ok(d["toolCallId"]), J.opt_string_ok(d["toolName"]))
    tdone_ok = J.all_ok(obj, J.opt_string_ok(d["toolCallId"]),
                        ~J.present(d["success"]) | (J.kind(d["success"]) == "BOOLEAN"),
                        J.opt_object_ok(d["result"]), J.opt_string_ok(c("rcontent")))
    trunc_ok = J.all_ok(obj, *[J.opt_int_ok(d[f]) for f in ("tokenLimit", "preTruncationTokensInMessages", "postTruncationTokensInMessages")])
    err_ok = J.all_ok(obj, J.opt_string_ok(d["errorType"]), J.opt_string_ok(d["message"]))

    content = F.coalesce(
        when_type("user.message", user_ok, J.as_string(d["content"])),
        when_type("assistant.message", asst_ok, J.as_string(d["content"])),
        when_type("assistant.reasoning", user_ok, J.as_string(d["content"])),
        when_type("tool.execution_complete", tdone_ok, J.as_string(c("rcontent"))),
        when_type("session.error", err_ok, J.as_string(d["message"])),
    )
    content = F.when(~ok, F.lit("Parse error: invalid event line")).otherwise(content)
    tool_name = F.coalesce(when_type("assistant.message", asst_ok, J.as_string(req["name"])),
                           when_type("tool.execution_start", tstart_ok, J.as_string(d["toolName"])))
    tool_id = F.coalesce(when_type("assistant.message", asst_ok, J.as_string(req["toolCallId"])),
                         when_type("tool.execution_start", tstart_ok, J.as_string(d["toolCallId"])),
                         when_type("tool.execution_complete", tdone_ok, J.as_string(d["toolCallId"])))
    tool_input = F.coalesce(when_type("assistant.message", asst_ok, J.json_text(req["arguments"])),
                            when_type("tool.execution_start", tstart_ok, J.json_text(d["arguments"])))
    own = c("is_start")
    # the row's own columns come before the join, so no parsed value travels with it; the guard keeps a
    # filter on the type from evaluating the rules again
    rows = (_parsed(lines.where(not_blank()))
            .select("*", F.when(typ == "tool.execution_complete", J.field(d["result"], "$.content")).alias("rcontent"),
                    F.when(typ == "assistant.message", J.members(J.field(d["toolRequests"], "$[0]"), "toolCallId", "name", "arguments")).alias("req"))
            .select(*[k for k in (*KEY, "ord", "line_number") if k in lines.columns], "valid", "is_start",
                    F.when(F.spark_partition_id() >= 0, F.when(ok, _map_type(typ, 0)).otherwise(F.lit("_parse_error"))).alias("message_type"),
                    F.when(ok, c("id")).alias("uuid"), F.when(ok, c("parent_id")).alias("parent_uuid"), F.when(ok, c("ts")).alias("timestamp"),
                    F.when(ok, _map_type(typ, 1)).alias("message_role"), content.alias("message_content"),
                    tool_name.alias("tool_name"), tool_id.alias("tool_use_id"), tool_input.alias("tool_input"),
                    when_type("session.truncation", trunc_ok, J.as_long(d["preTruncationTokensInMessages"])).alias("input_tokens"),
                    when_type("session.truncation", trunc_ok, J.as_long(d["postTruncationTokensInMessages"])).alias("output_tokens"),
                    F.when(own, J.as_string(d["copilotVersion"])).alias("own_version")))
    out = attach(rows, table).select(
        F.lit("copilot").alias("source"),
        sid.alias("session_id"),
        F.when(ok, project).otherwise(F.lit("")).alias("project_path"),
        F.lit("").alias("project_dir"),
        F.substring_index("file_path", "/", -1).alias("file_name"),
        F.lit(False).alias("is_agent"),
        "line_number", "message_type", "uuid", "parent_uuid", "timestamp", "message_role", "message_content",
        F.when(ok, F.col("m_model")).alias("model"),
        "tool_name", "tool_use_id", "tool_input", "input_tokens", "output_tokens",
        F.when(ok, F.coalesce(F.col("m_branch"), F.col("w_branch"))).alias("git_branch"),
        F.when(ok, F.nullif(project, F.lit(""))).alias("cwd"),
        F.when(ok, F.when(own, c("own_version")).otherwise(c("m_version"))).alias("version"),
        F.when(ok, F.coalesce(F.col("m_repo"), F.col("w_repo"))).alias("repository"),
    )
    return align(out, CONVERSATIONS)
