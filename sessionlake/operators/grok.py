"""Grok CLI sessions (``sessions/<%cwd>/<session>/``) → conversations, plans
and daily stats.

A session directory holds ``chat_history.jsonl`` (the transcript) and
sidecars: ``summary.json`` (branch, remote, model, effort, title, version, git
root), ``updates.jsonl`` (timed update stream with per-turn usage),
``signals.json`` (counts) and, for sub-agents, the parent's
``subagents/<child>/meta.json``. Sidecars become small per-session tables
joined to the lines. Timestamps come from aligning chat lines with the update
stream — an order-dependent greedy fold, the one step run in Python, over a few
bytes per line and update, sessions one after the other in Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.functions import json as J
from sessionlake.functions.paths import url_decode
from sessionlake.functions.time import date_prefix, epoch_s_to_iso
from sessionlake.operators.blocks import numbered
from sessionlake.schemas import CONVERSATIONS, PLANS, STATS, align

# Chat line types, the update kinds kept on the timeline, and the
# update kinds each line type may take its time from.
LINE_TYPES = ["user", "assistant", "tool_result", "system", "reasoning"]
TIMELINE_KINDS = ["user_message_chunk", "agent_thought_chunk", "agent_message_chunk", "tool_call", "tool_call_update",
                  "turn_completed"]
CANDIDATES = {
    "user": ["user_message_chunk"],
    "reasoning": ["agent_thought_chunk"],
    "assistant": ["agent_message_chunk", "tool_call"],
    "tool_call": ["tool_call"],
    "tool_result": ["tool_call_update", "tool_call"],
    "system": ["user_message_chunk", "agent_thought_chunk"],
}

_CHAT = r"/sessions/([^/]+)/([^/]+)/chat_history\.jsonl$"


def _dir(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


# ── sidecars ─────────────────────────────────────────────────────────────────
def summaries(files: DataFrame) -> DataFrame:
    v = F.col("v")
    s = lambda k: J.field(v, f"$.{k}")
    remotes = F.try_variant_get(v, "$.git_remotes", "array<variant>")
    ok = J.all_ok(v.isNotNull(), J.is_object(v), *[J.opt_string_ok(s(k)) for k in (
        "created_at", "updated_at", "last_active_at", "current_model_id", "head_branch", "git_root_dir",
        "generated_title", "reasoning_effort", "agent_name")],
        J.opt_int_ok(s("num_messages")), J.opt_array_ok(s("git_remotes")),
        F.coalesce(F.forall(remotes, lambda r: J.is_string(r)), F.lit(True)))
    cfv = s("chat_format_version")
    return (J.parse_lines(files.where(F.col("file_path").endswith("/summary.json"))
                          .select("file_path", F.col("content").alias("value")), "file_path")
            .where(ok).groupBy(_dir(F.col("file_path")).alias("sdir")).agg(F.first("v").alias("v"))
            .select("sdir",
                    *[J.get_string(v, f"$.{k}").alias(f"s_{k}") for k in (
                        "created_at", "updated_at", "last_active_at", "current_model_id", "head_branch", "git_root_dir",
                        "generated_title", "reasoning_effort")],
                    J.as_string(F.get(remotes, 0)).alias("s_remote"),
                    F.when(J.kind(cfv) == "STRING", J.as_string(cfv)).otherwise(J.json_text(cfv)).alias("s_version"),
                    J.get_long(v, "$.num_messages").alias("s_num_messages")))


def _update_rows(updates: DataFrame) -> DataFrame:
    v = F.col("v")
    u = lambda k: J.field(v, f"$.params.update.{k}")
    ok = J.all_ok(v.isNotNull(), J.is_object(v), J.opt_int_ok(J.field(v, "$.timestamp")),
                  J.opt_object_ok(J.field(v, "$.params")), J.opt_object_ok(J.field(v, "$.params.update")),
                  J.opt_string_ok(u("sessionUpdate")), J.opt_object_ok(u("usage")),
                  *[J.opt_int_ok(u(f"usage.{k}")) for k in ("inputTokens", "outputTokens", "cachedReadTokens", "reasoningTokens")])
    return (J.parse_lines(updates, "file_path", "line_number").where(ok)
            .select(_dir(F.col("file_path")).alias("sdir"), "line_number",
                    J.get_long(v, "$.timestamp").alias("secs"), J.get_string(v, "$.params.update.sessionUpdate").alias("kind"),
                    *[J.get_long(v, f"$.params.update.usage.{k}").alias(k) for k in
                      ("inputTokens", "outputTokens", "cachedReadTokens", "reasoningTokens")]))


def last_usage(upd: DataFrame) -> DataFrame:
    """The last ``turn_completed`` update carrying any token count, per session
    (a partial ``max_by`` aggregate)."""
    toks = ["inputTokens", "outputTokens", "cachedReadTokens", "reasoningTokens"]
    has = F.lit(False)
    for k in toks:
        has = has | F.col(k).isNotNull()
    return (upd.where((F.col("kind") == "turn_completed") & has).groupBy("sdir")
            .agg(F.max_by(F.struct(*toks), "line_number").alias("u"))
            .select("sdir", *[F.col(f"u.{k}").alias(f"u_{k}") for k in toks]))


def subagent_parents(files: DataFrame) -> DataFrame:
    """``sessions/<cwd>/<parent>/subagents/<child>/meta.json`` → (child, parent);
    directory names stand in for missing ids."""
    rx = r"/sessions/[^/]+/([^/]+)/subagents/([^/]+)/meta\.json$"
    v = F.col("v")
    ok = J.all_ok(v.isNotNull(), J.is_object(v), *[J.opt_string_ok(J.field(v, f"$.{k}"))
                                                   for k in ("parent_session_id", "child_session_id", "subagent_type")])
    return (J.parse_lines(files.where(F.col("file_path").rlike(rx)).select("file_path", F.col("content").alias("value")),
                          "file_path").where(ok)
            .select(F.coalesce(J.get_string(v, "$.child_session_id"), F.regexp_extract("file_path", rx, 2)).alias("session_id"),
                    F.coalesce(J.get_string(v, "$.parent_session_id"), F.regexp_extract("file_path", rx, 1)).alias("parent"))
            .groupBy("session_id").agg(F.max("parent").alias("parent")))


# ── timeline alignment (N28) ─────────────────────────────────────────────────
def align_times(line_types: DataFrame, upd: DataFrame) -> DataFrame:
    """Timestamp of each chat line from the session's update stream. Only numbers
    travel to the fold: a line's place and type, an update's place, kind and
    seconds. Updates no line type takes are dropped before the shuffle."""
    types = [t for t in CANDIDATES if t != "system"]
    takes = [[TIMELINE_KINDS.index(k) for k in CANDIDATES[t]] for t in types]

    def code(name: str, values: list[str]) -> Column:
        out = F.lit(-1)
        for i, x in enumerate(values):
            out = F.when(F.col(name) == x, F.lit(i)).otherwise(out)
        return out.cast("byte")

    # Defined here so it travels to the Python workers by value (with its
    # lookup table) and needs nothing from this package installed there.
    def fold(batches):
        """Greedy cursor over one session after the other; a session's rows come together, its updates first,
        both in line order. Each line takes the next update whose kind fits its type; updates passed over are
        consumed, so a line whose type fits nothing consumes the rest of the stream. Each type walks its own
        rising list of places once, so the work is that of both streams; only one session's updates are held."""
        import pyarrow as pa

        takers = [[t for t, kinds in enumerate(takes) if k in kinds] for k in range(max(map(max, takes)) + 1)]
        session, begun = None, False
        places, at, secs, cursor = [], [], [], 0
        for batch in batches:
            dirs, numbers, found = [], [], []
            for sdir, is_line, number, code, sec in zip(*(x.to_pylist() for x in batch.columns)):
                if not begun or sdir != session:
                    session, begun = sdir, True
                    places, at, secs, cursor = [[] for _ in takes], [0] * len(takes), [], 0
                if not is_line:
                    for t in takers[code] if code < len(takers) else ():
                        places[t].append(len(secs))
                    secs.append(sec)
                    continue
                if code < 0:
                    cursor = len(secs)
                    continue
                mine, i = places[code], at[code]
                while i < len(mine) and mine[i] < cursor:
                    i += 1
                at[code] = i
                if i < len(mine):
                    cursor = mine[i] + 1
                    dirs.append(sdir)
                    numbers.append(number)
                    found.append(secs[mine[i]])
                else:
                    cursor = len(secs)
            yield pa.RecordBatch.from_arrays([pa.array(dirs, pa.string()), pa.array(numbers, pa.int64()), pa.array(found, pa.int64())],
                                             names=["sdir", "line_number", "secs"])

    events = upd.where(F.col("secs").isNotNull() & F.col("kind").isin(*TIMELINE_KINDS)).select(
        "sdir", F.lit(False).alias("is_line"), "line_number", code("kind", TIMELINE_KINDS).alias("code"), "secs")
    lines = line_types.where(F.col("peek") != "system").select(
        "sdir", F.lit(True).alias("is_line"), "line_number", code("peek", types).alias("code"), F.lit(None).cast("long").alias("secs"))
    # many sessions go through one worker's batches: a call a session costs milliseconds, whatever its length
    matched = (lines.unionByName(events).repartition("sdir")
               .sortWithinPartitions("sdir", "is_line", F.col("line_number").asc_nulls_last(), "secs", "code")
               .mapInArrow(fold, "sdir string, line_number long, secs long"))
    # one row a line, stated as an aggregation so that Catalyst may drop the join
    return matched.groupBy("sdir", "line_number").agg(F.first("secs").alias("secs")).select(
        "sdir", "line_number", epoch_s_to_iso(F.col("secs")).alias("matched"))


# ── conversations ────────────────────────────────────────────────────────────
def normalise(chat: DataFrame, updates: DataFrame, files: DataFrame) -> DataFrame:
    c, v = F.col, F.col("v")
    chat, updates = numbered(chat), numbered(updates)
    parsed = J.parse_lines(chat.where(c("file_path").rlike(_CHAT)), "file_path", "line_number")
    t = J.get_string(v, "$.type")
    calls = F.try_variant_get(v, "$.tool_calls", "array<variant>")
    s = lambda k: J.field(v, f"$.{k}")
    valid = J.all_ok(
        v.isNotNull(), t.isin(*LINE_TYPES),
        F.when(t == "reasoning", J.opt_string_ok(s("id")) & J.opt_string_ok(s("reasoning_effort"))).otherwise(F.lit(True)),
        F.when(t == "assistant", J.all_ok(
            J.opt_string_ok(s("content")), J.opt_string_ok(s("model_id")), J.opt_string_ok(s("reasoning_effort")),
            J.opt_array_ok(s("tool_calls")),
            F.coalesce(F.forall(calls, lambda x: J.is_object(x) & J.opt_string_ok(J.field(x, "$.id"))
                                & J.opt_string_ok(J.field(x, "$.name"))), F.lit(True)))).otherwise(F.lit(True)),
        F.when(t == "tool_result", J.opt_string_ok(s("tool_call_id"))).otherwise(F.lit(True)))
    rows = parsed.select(
        _dir(c("file_path")).alias("sdir"), F.regexp_extract("file_path", _CHAT, 1).alias("project_dir"),
        F.regexp_extract("file_path", _CHAT, 2).alias("session_id"), "line_number", "v",
        F.coalesce(t, F.lit("")).alias("peek"), valid.alias("ok"))

    upd = _update_rows(updates)
    times = align_times(rows.select("sdir", "line_number", "peek"), upd)
    summ = summaries(files)
    session_ts = F.coalesce(c("s_last_active_at"), c("s_updated_at"), c("s_created_at"))
    rows = (rows.join(summ, "sdir", "left").join(last_usage(upd), "sdir", "left")
            .join(subagent_parents(files), "session_id", "left").join(times, ["sdir", "line_number"], "left"))

    ok, tt = c("ok"), c("peek")
    eff = F.coalesce(J.get_string(v, "$.reasoning_effort"), c("s_reasoning_effort"))
    model = F.coalesce(J.get_string(v, "$.model_id"), c("s_current_model_id"))
    content = F.nullif(J.get_string(v, "$.content"), F.lit(""))
    args = lambda x: J.field(x, "$.arguments")
    row_t = ("struct<message_type:string,message_role:string,uuid:string,message_content:string,model:string,"
             "reasoning_effort:string,tool_name:string,tool_use_id:string,tool_input:string>")
    null = F.lit(None).cast("string")

    def one(mt, role, uuid, cont, mdl, effort, tn=null, tid=null, ti=null):
        return F.array(F.struct(F.lit(mt) if isinstance(mt, str) else mt, F.lit(role).cast("string"), uuid, cont, mdl, effort,
                                tn, tid, ti).cast(row_t))

    tool_rows = F.transform(F.coalesce(calls, F.array().cast("array<variant>")), lambda x: F.struct(
        F.lit("tool_call"), F.lit("tool"), null, null, model, eff, J.get_string(x, "$.name"), J.get_string(x, "$.id"),
        F.when(J.kind(args(x)) == "STRING", J.as_string(args(x))).otherwise(J.json_text(args(x)))).cast(row_t))
    fan = (F.when(~ok, one("_parse_error", None, null, F.lit("Parse error: invalid chat line"), null, null))
           .when(tt == "user", one("user", "user", null, J.extract_text(s("content")), null, null))
           .when(tt == "system", one("system", None, null, J.extract_text(s("content")), null, null))
           .when(tt == "tool_result", one("tool_result", "tool", null, J.extract_text(s("content")), null, null,
                                          tid=J.get_string(v, "$.tool_call_id")))
           .when(tt == "reasoning", one("reasoning", "assistant", J.get_string(v, "$.id"), J.extract_text(s("summary")),
                                        c("s_current_model_id"), eff))
           .otherwise(F.concat(F.when(content.isNotNull() | (F.coalesce(F.size(calls), F.lit(0)) == 0),
                                      one("assistant", "assistant", null, content, model, eff))
                               .otherwise(F.array().cast(f"array<{row_t}>")), tool_rows)))
    ts = F.when(tt == "system", F.coalesce(c("s_created_at"), session_ts)).otherwise(F.coalesce(c("matched"), session_ts))
    cwd = url_decode(c("project_dir"))
    out = rows.select(
        F.lit("grok").alias("source"), "session_id", F.coalesce(c("s_git_root_dir"), cwd).alias("project_path"),
        "project_dir", F.lit("chat_history.jsonl").alias("file_name"), c("parent").isNotNull().alias("is_agent"),
        "line_number", c("parent").alias("parent_uuid"), ts.alias("timestamp"),
        c("s_generated_title").alias("slug"), c("s_head_branch").alias("git_branch"), cwd.alias("cwd"),
        c("s_version").alias("version"), c("s_remote").alias("repository"),
        c("u_inputTokens").alias("input_tokens"), c("u_outputTokens").alias("output_tokens"),
        c("u_cachedReadTokens").alias("cache_read_tokens"), c("u_reasoningTokens").alias("reasoning_tokens"),
        F.explode(fan).alias("r"))
    out = out.select("*", "r.*").drop("r").withColumn(
        "uuid", F.coalesce(c("uuid"), F.concat_ws(":", c("session_id"), c("line_number").cast("string"))))
    return align(out, CONVERSATIONS)


# ── plans and stats ──────────────────────────────────────────────────────────
def plans(chat: DataFrame, files: DataFrame) -> DataFrame:
    """``<session>/plan.md`` beside a ``chat_history.jsonl``; name = the
    summary's generated title, else the session id."""
    sessions = chat.where(F.col("file_path").rlike(_CHAT)).select(_dir(F.col("file_path")).alias("sdir")).distinct()
    p = files.where(F.col("file_path").rlike(r"/sessions/[^/]+/[^/]+/plan\.md$")).select(
        _dir(F.col("file_path")).alias("sdir"), "file_path", "content", "file_size")
    p = p.join(sessions, "sdir", "left_semi").join(summaries(files).select("sdir", "s_generated_title"), "sdir", "left")
    sid = F.regexp_extract("sdir", r"([^/]*)$", 1)
    return align(p.select(F.lit("grok").alias("source"), sid.alias("session_id"),
                          F.coalesce(F.col("s_generated_title"), sid).alias("plan_name"), F.lit("plan.md").alias("file_name"),
                          "file_path", "content", "file_size"), PLANS)


def stats(chat: DataFrame, files: DataFrame) -> DataFrame:
    """Daily rollup over sessions: messages = user + assistant counts when
    either is positive, else turns, if positive, else the summary's
    ``num_messages``, else 0; one session each; tool calls summed."""
    sessions = chat.where(F.col("file_path").rlike(_CHAT)).select(_dir(F.col("file_path")).alias("sdir")).distinct()
    v = F.col("v")
    sig_ok = J.all_ok(v.isNotNull(), J.is_object(v), *[J.opt_int_ok(J.field(v, f"$.{k}")) for k in (
        "userMessageCount", "assistantMessageCount", "toolCallCount", "turnCount")])
    sig = (J.parse_lines(files.where(F.col("file_path").endswith("/signals.json"))
                         .select("file_path", F.col("content").alias("value")), "file_path").where(sig_ok)
           .select(_dir(F.col("file_path")).alias("sdir"), *[J.get_long(v, f"$.{k}").alias(k) for k in (
               "userMessageCount", "assistantMessageCount", "toolCallCount", "turnCount")], F.lit(True).alias("has_sig")))
    x = sessions.join(sig, "sdir", "left").join(summaries(files), "sdir", "left")
    u, a = F.coalesce(F.col("userMessageCount"), F.lit(0)), F.coalesce(F.col("assistantMessageCount"), F.lit(0))
    from_sig = F.when((u > 0) | (a > 0), u + a).otherwise(F.coalesce(F.col("turnCount"), F.lit(0)))
    msgs = F.coalesce(F.when(F.col("has_sig") & (from_sig > 0), from_sig), F.col("s_num_messages"), F.lit(0))
    day = F.coalesce(date_prefix(F.col("s_created_at")), F.lit("unknown"))
    return align(x.groupBy(day.alias("date")).agg(
        F.sum(msgs).alias("message_count"), F.count("*").alias("session_count"),
        F.sum(F.coalesce(F.col("toolCallCount"), F.lit(0))).alias("tool_call_count")).select(
        F.lit("grok").alias("source"), "*"), STATS)
