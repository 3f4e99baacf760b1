"""Codex CLI rollout streams (``sessions/YYYY/MM/DD/rollout-<ts>-<uuid>.jsonl``)
→ conversations.

``session_meta`` and ``turn_context`` lines are state, not rows: the latest
whole ``session_meta`` and the latest ``turn_context.model`` apply to every
later row. ``event_msg`` user/agent messages duplicate ``response_item``
messages and are kept only for files without any ``response_item`` message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.operators.blocks import KEY, as_stream, attach, not_blank, state_table
from sessionlake.schemas import CONVERSATIONS, align


def session_from_file(file_path: Column) -> Column:
    """The last five dash-separated groups of the file stem (a UUID); the
    whole stem when it has fewer groups. Split-based: an end-anchored regex
    over the groups backtracks on every row."""
    stem = F.regexp_replace(F.substring_index(file_path, "/", -1), r"\.jsonl$", "")
    parts = F.split(stem, "-")
    n = F.size(parts)
    return F.when(n >= 5, F.array_join(F.slice(parts, n - 4, 5), "-")).otherwise(stem)


#: The payload's members that any rule reads.
_MEMBERS = ("type", "role", "name", "call_id", "message", "phase", "last_agent_message", "content", "summary", "output", "arguments",
            "id", "cwd", "cli_version", "model_provider", "originator", "source", "git", "model")
_GIT = ("branch", "commit_hash", "repository_url")


def _parsed(lines: DataFrame) -> DataFrame:
    """Per-line parse: ``valid``, ``typ``, ``ts``, the payload's members ``p``
    (null unless it is an object) and ``no_payload`` (absent or null)."""
    place = [k for k in (*KEY, "ord", "line_number") if k in lines.columns]
    h = F.col("h")
    valid = J.all_ok(J.is_string(h["type"]), J.opt_string_ok(h["timestamp"]))
    return (J.parse_lines(lines, *place).select(*place, J.members(F.col("v"), "type", "timestamp", "payload").alias("h"))
            .select(*place, valid.alias("valid"), J.as_string(h["type"]).alias("typ"), J.as_string(h["timestamp"]).alias("ts"),
                    J.members(h["payload"], *_MEMBERS).alias("p"), (~J.present(h["payload"])).alias("no_payload")))


def normalise(lines: DataFrame) -> DataFrame:
    p = F.col("p")
    typ = F.col("typ")
    lines = as_stream(lines)
    parsed = _parsed(lines.where(not_blank()))
    ok = F.col("valid")
    git = F.col("git")
    # an absent or null payload decodes to nothing and keeps the state
    meta_ok = J.all_ok(p.isNotNull(),
                       *[J.opt_string_ok(p[f]) for f in ("id", "cwd", "cli_version", "model_provider", "originator", "source")],
                       git.isNotNull() | ~J.present(p["git"]), *[J.opt_string_ok(git[f]) for f in _GIT])
    is_meta = ok & (typ == "session_meta") & meta_ok
    is_ctx = ok & (typ == "turn_context") & p.isNotNull() & J.opt_string_ok(p["model"]) & J.opt_string_ok(p["cwd"])
    # a session_meta replaces the whole struct, so it is carried as one value
    m_meta = F.when(is_meta, F.struct(J.as_string(p["cwd"]).alias("cwd"), J.as_string(git["branch"]).alias("branch"),
                                      J.as_string(git["repository_url"]).alias("repo"), J.as_string(p["cli_version"]).alias("version")))
    m_model = F.when(is_ctx, J.as_string(p["model"]))

    # response_item payload decoding; the members and flags used by several
    # rules are computed once, in their own projection
    item_ok = J.all_ok(p.isNotNull() | F.col("no_payload"), *[J.opt_string_ok(p[f]) for f in ("type", "role", "name", "call_id")])
    ev_ok = J.all_ok(p.isNotNull() | F.col("no_payload"), *[J.opt_string_ok(p[f]) for f in ("type", "message", "phase", "last_agent_message")])

    def flags(df: DataFrame) -> DataFrame:
        staged = df.select("*", J.as_string(p["type"]).alias("itype"), J.as_string(p["role"]).alias("role"),
                           (ok & (typ == "response_item") & item_ok).alias("item_ok"), (ok & (typ == "event_msg") & ev_ok).alias("ev_ok"))
        it = F.col("itype")
        return staged.select("*", (F.col("item_ok") & it.isNotNull()).alias("is_item"),
                             (F.col("ev_ok") & it.isin("user_message", "agent_message")).alias("is_ev"))

    itype, role, is_item, is_ev = F.col("itype"), F.col("role"), F.col("is_item"), F.col("is_ev")

    mtype = (F.when(~ok, F.lit("_parse_error"))
             .when(is_item & (itype == "message"), F.coalesce(role, F.lit("message")))
             .when(is_item, itype)
             .when(is_ev, F.when(itype == "user_message", F.lit("user")).otherwise(F.lit("assistant"))))
    mrole = (F.when(is_item & (itype == "message"), role)
             .when(is_item & (itype == "reasoning"), F.lit("assistant"))
             .when(is_item & itype.isin("function_call", "function_call_output"), F.lit("tool"))
             .when(is_ev, F.when(itype == "user_message", F.lit("user")).otherwise(F.lit("assistant"))))
    content = (F.when(~ok, F.lit("Parse error: invalid rollout line"))
               .when(is_item & (itype == "message"), J.extract_text(p["content"]))
               .when(is_item & (itype == "reasoning"), J.extract_text(p["summary"]))
               .when(is_item & (itype == "function_call_output"), J.extract_text(p["output"]))
               .when(is_ev, J.as_string(p["message"])))
    fc = is_item & (itype == "function_call")
    tool_use_id = F.when(is_item & itype.isin("function_call", "function_call_output"), J.as_string(p["call_id"]))

    def row_view(df: DataFrame) -> DataFrame:
        # the guard keeps the row filter below from being pushed under this
        # projection (which would evaluate the row rules again, on every line);
        # it is part of the column filtered on, as an unread one is pruned
        return flags(df).select(
            *[k for k in (*KEY, "ord", "line_number") if k in df.columns], "valid",
            F.when(F.spark_partition_id() >= 0, mtype).alias("message_type"), mrole.alias("message_role"), content.alias("message_content"),
            F.when(ok, F.col("ts")).alias("timestamp"),
            F.when(fc, J.as_string(p["name"])).alias("tool_name"), tool_use_id.alias("tool_use_id"),
            F.when(fc, J.json_text(p["arguments"])).alias("tool_input"),
            is_ev.alias("is_fallback"),
        ).where(F.col("message_type").isNotNull())

    rows = row_view(parsed)
    # the pre-pass parses only lines that can be a response_item message, and those that can carry state
    value = F.col("value")
    message = value.contains("\\u") | (value.contains("response_item") & value.contains("message"))
    marked = _parsed(lines.where(J.may_contain("value", "session_meta", "turn_context")))
    marked = marked.select("*", F.when(typ == "session_meta", J.members(p["git"], *_GIT)).alias("git"))
    table = state_table(flags(_parsed(lines.withColumn("value", F.when(message, value)))), anywhere={"has_resp": is_item & (itype == "message")},
                        carried={"m_meta": m_meta, "m_model": m_model}, marked=marked)
    rows = attach(rows, table).where(~F.col("is_fallback") | ~F.col("has_resp"))
    meta = F.col("m_meta")
    out = rows.select(
        F.lit("codex").alias("source"),
        session_from_file(F.col("file_path")).alias("session_id"),
        F.when(ok, F.coalesce(meta.cwd, F.lit(""))).otherwise(F.lit("")).alias("project_path"),
        F.substring_index("file_path", "/", -1).alias("file_name"),
        "line_number", "message_type", "timestamp", "message_role", "message_content",
        F.when(ok, F.col("m_model")).alias("model"),
        "tool_name", "tool_use_id", "tool_input",
        F.when(ok, meta.branch).alias("git_branch"), F.when(ok, meta.cwd).alias("cwd"),
        F.when(ok, meta.version).alias("version"), F.when(ok, meta.repo).alias("repository"),
    )
    return align(out, CONVERSATIONS)
