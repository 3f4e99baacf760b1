"""Side tables: plans, todos, history and daily stats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.schemas import HISTORY, PLANS, STATS, TODOS, align


def _name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


# ── history ──────────────────────────────────────────────────────────────────
def claude_history(lines: DataFrame) -> DataFrame:
    """``history.jsonl`` lines → history. The float millisecond timestamp is
    truncated to a long; ``pastedContents`` becomes compact JSON text; a bad
    line keeps its number with ``display = 'Parse error: …'``."""
    v = F.col("v")
    ts = J.field(v, "$.timestamp")
    valid = J.all_ok(v.isNotNull(), J.is_object(v),
                     *[J.opt_string_ok(J.field(v, f"$.{f}")) for f in ("display", "project", "sessionId")],
                     ~J.present(ts) | J.is_number(ts))
    rows = (
        J.parse_lines(lines, "line_number")
        .select("*", valid.alias("ok"))
        .select(
            F.lit("claude").alias("source"), "line_number",
            F.when(F.col("ok") & J.present(ts), F.try_variant_get(ts, "$", "double").cast("bigint")).alias("timestamp_ms"),
            F.when(F.col("ok"), J.get_string(v, "$.project")).alias("project"),
            F.when(F.col("ok"), J.get_string(v, "$.sessionId")).alias("session_id"),
            F.when(F.col("ok"), J.get_string(v, "$.display")).otherwise(F.lit("Parse error: invalid history line")).alias("display"),
            F.when(F.col("ok"), J.json_text(J.field(v, "$.pastedContents"))).alias("pasted_contents"),
        )
    )
    return align(rows, HISTORY)


def copilot_history(files: DataFrame) -> DataFrame:
    """``command-history-state.json`` → one row per command, 1-based; a file
    that does not decode yields no rows."""
    v = F.col("v")
    arr = J.array_of(v, "$.commandHistory")
    ok = J.is_array(J.field(v, "$.commandHistory")) & F.forall(arr, lambda e: J.is_string(e))
    rows = (
        files.select(J.parse("content").alias("v"))
        .where(F.coalesce(ok, F.lit(False)))
        .select(F.posexplode(arr).alias("pos", "cmd"))
        .select(F.lit("copilot").alias("source"), (F.col("pos") + 1).alias("line_number"),
                J.as_string(F.col("cmd")).alias("display"))
    )
    return align(rows, HISTORY)


# ── todos ────────────────────────────────────────────────────────────────────
def claude_todos(files: DataFrame) -> DataFrame:
    """``todos/<session>-agent-<agent>.json`` (a JSON array) → one row per item
    with a 0-based index; a file that does not decode gives a single row with
    index -1 and status ``_parse_error``."""
    v = F.col("v")
    stem = F.regexp_replace(_name(F.col("file_path")), r"\.json$", "")
    items = F.try_variant_get(v, "$", "array<variant>")
    item_ok = lambda e: J.is_object(e) & J.all_ok(*[J.opt_string_ok(J.field(e, f"$.{f}")) for f in ("content", "status", "activeForm")])
    ok = J.is_array(v) & F.coalesce(F.forall(items, item_ok), F.lit(True))
    base = (
        files.where(stem.contains("-agent-"))
        .select(_name(F.col("file_path")).alias("file_name"),
                F.substring_index(stem, "-agent-", 1).alias("session_id"),
                F.regexp_extract(stem, r"-agent-(.*)$", 1).alias("agent_id"),
                J.parse("content").alias("v"))
        .select("*", F.coalesce(ok, F.lit(False)).alias("ok"))
    )
    good = base.where("ok").select("file_name", "session_id", "agent_id", F.posexplode(items).alias("item_index", "e")) \
        .select(F.lit("claude").alias("source"), "session_id", "agent_id", "file_name", "item_index",
                J.get_string(F.col("e"), "$.content").alias("content"),
                J.get_string(F.col("e"), "$.status").alias("status"),
                J.get_string(F.col("e"), "$.activeForm").alias("active_form"))
    bad = base.where(~F.col("ok")).select(
        F.lit("claude").alias("source"), "session_id", "agent_id", "file_name", F.lit(-1).alias("item_index"),
        F.lit("Parse error: invalid todo file").alias("content"), F.lit("_parse_error").alias("status"))
    return align(good.unionByName(bad, allowMissingColumns=True), TODOS)


def copilot_todos(lines: DataFrame) -> DataFrame:
    """Checkpoint checklists (``session-state/<id>/checkpoints/*.md``, not
    ``index.md``): trimmed lines starting ``- [x] ``/``- [X] `` are completed,
    ``- [ ] `` pending; the index counts matched lines only."""
    t = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    done = t.startswith("- [x] ") | t.startswith("- [X] ")
    todo = t.startswith("- [ ] ")
    m = (
        lines.where(F.col("file_path").rlike(r"/session-state/[^/]+/checkpoints/[^/]+\.md$")
                    & (_name(F.col("file_path")) != "index.md"))
        .select("file_path", "line_number", t.alias("t"), done.alias("done"), todo.alias("todo"))
        .where(F.col("done") | F.col("todo"))
    )
    # a checklist is one small Markdown file: number its matched lines
    w = Window.partitionBy("file_path").orderBy("line_number")
    rows = m.select(
        F.lit("copilot").alias("source"),
        F.regexp_extract("file_path", r"/session-state/([^/]+)/checkpoints/", 1).alias("session_id"),
        _name(F.col("file_path")).alias("file_name"),
        (F.row_number().over(w) - 1).alias("item_index"),
        F.substring(F.col("t"), 7, 1 << 30).alias("content"),
        F.when(F.col("done"), F.lit("completed")).otherwise(F.lit("pending")).alias("status"),
    )
    return align(rows, TODOS)


# ── plans ────────────────────────────────────────────────────────────────────
def claude_plans(files: DataFrame) -> DataFrame:
    """``plans/<name>.md`` → one row per file; ``plan_name`` is the stem."""
    rows = files.where(F.col("file_path").rlike(r"/plans/[^/]+\.md$")).select(
        F.lit("claude").alias("source"),
        F.regexp_replace(_name(F.col("file_path")), r"\.md$", "").alias("plan_name"),
        _name(F.col("file_path")).alias("file_name"), "file_path", "content", "file_size")
    return align(rows, PLANS)


def copilot_plans(files: DataFrame, workspace: DataFrame | None = None) -> DataFrame:
    """``session-state/<id>/plan.md``; name = the workspace ``summary`` else the
    session id."""
    rows = files.where(F.col("file_path").rlike(r"/session-state/[^/]+/plan\.md$")).select(
        F.regexp_extract("file_path", r"/session-state/([^/]+)/plan\.md$", 1).alias("session_id"),
        F.regexp_replace("file_path", r"/[^/]*$", "").alias("_dir"), "file_path", "content", "file_size")
    if workspace is not None:
        rows = rows.join(workspace.select(F.col("dir_path").alias("_dir"), F.col("summary")), "_dir", "left")
    else:
        rows = rows.withColumn("summary", F.lit(None).cast("string"))
    return align(rows.select(F.lit("copilot").alias("source"), "session_id",
                             F.coalesce("summary", "session_id").alias("plan_name"),
                             F.lit("plan.md").alias("file_name"), "file_path", "content", "file_size"), PLANS)


# ── stats ────────────────────────────────────────────────────────────────────
def claude_stats(files: DataFrame) -> DataFrame:
    """``stats-cache.json`` ``dailyActivity[]`` → one row per day; missing
    values become ``''``/0; a file that does not decode yields no rows."""
    v = F.col("v")
    days = J.array_of(v, "$.dailyActivity")
    day_ok = lambda e: J.is_object(e) & J.opt_string_ok(J.field(e, "$.date")) & J.all_ok(
        *[J.opt_int_ok(J.field(e, f"$.{f}")) for f in ("messageCount", "sessionCount", "toolCallCount")])
    ok = J.is_object(v) & J.opt_array_ok(J.field(v, "$.dailyActivity")) & F.coalesce(F.forall(days, day_ok), F.lit(True))
    rows = (
        files.select(J.parse("content").alias("v"))
        .where(F.coalesce(ok, F.lit(False)))
        .select(F.explode(days).alias("e"))
        .select(F.lit("claude").alias("source"),
                J.get_string(F.col("e"), "$.date").alias("date"),
                J.get_long(F.col("e"), "$.messageCount").alias("message_count"),
                J.get_long(F.col("e"), "$.sessionCount").alias("session_count"),
                J.get_long(F.col("e"), "$.toolCallCount").alias("tool_call_count"))
    )
    return align(rows, STATS)
