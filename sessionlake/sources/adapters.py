"""Adapters: the benchmark parquet tables → provider-shaped raw input.

Each adapter writes *provider-format JSON text* from rows of the given tables
(``conversations``, ``events``, ``documents``), with Spark, row by row, so the
real normalisers parse it exactly as they parse files from disk. Nothing is
sampled or capped: every row of the source table becomes input, so the work of
every query grows with the tables.

Output contracts match :mod:`sessionlake.sources.raw`: streams
``(file_path, block, ord, value)``, ``files(file_path, content, file_size)`` and
``kv(key, value)``. Streams are cut into blocks of BLOCK_LINES lines and give no
line numbers, as files read in splits do not; some files hold blank lines.

The mapping rules are fixed so the expected answers can be stated in closed
form straight from the tables (the DuckDB oracle in ``sessionlake.plans.oracle``
mirrors every rule below)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions.time import epoch, iso_millis

# Fixed values of the adapters (the oracle repeats them).
TOOLS = ["Read", "Edit", "Bash", "Grep", "Write"]
BASE_EPOCH_S = 1704067200  # 2024-01-01T00:00:00Z
CLAUDE_ROOT = "/lake/claude"
COPILOT_ROOT = "/lake/copilot"
CODEX_ROOT = "/lake/codex"
DESKTOP_ROOT = "/lake/desktop/local-agent-mode-sessions"
#: Lines a block, and events after which a blank line follows (``event_id % 29 == 5``).
BLOCK_LINES = 16
BLANK_EVERY, BLANK_AT = 29, 5
#: Lines of a file that one task builds together.
RUN_LINES = 1024


def _materialised(df: DataFrame, text_col: str) -> DataFrame:
    """Guard the built text with an always-true, non-deterministic condition so
    the optimizer cannot push a later filter on it (e.g. a normaliser's
    pre-selection) into this projection, which would build every line twice.
    The adapter's output then behaves like text read from a file."""
    return df.select(*[F.when(F.spark_partition_id() >= 0, F.col(c)).alias(c) if c == text_col else F.col(c)
                       for c in df.columns])


def _placed(lines: DataFrame) -> DataFrame:
    """``(file_path, line_number, value)`` as a stream: blocks start at some byte,
    and a block's lines have rising places that begin anywhere."""
    n = F.col("line_number") - 1
    block = F.floor(n / BLOCK_LINES).cast("long")
    return _materialised(lines.select("file_path", (block * 4096).alias("block"), (n + block * 1000 + F.pmod(F.hash("file_path"), F.lit(977))).cast("long").alias("ord"),
                                      "value"), "value")


def _event_lines(events: DataFrame, path: Column, value: Column, text: Column | None = None) -> DataFrame:
    """A user's events as lines from the second on, with blank lines between.
    Places are found on narrow rows, which are then dealt in runs of neighbours;
    ``text`` (``__j`` in ``value``) is built after that, so no text is sorted or sent."""
    from sessionlake.plans.tables import dealt

    w = Window.partitionBy("user_id").orderBy("event_id")
    blank = F.col("event_id") % BLANK_EVERY == BLANK_AT
    at = 1 + F.row_number().over(w) + F.coalesce(F.count_if(blank).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt(events.select("user_id", "event_id", "event_type", "ts", at.cast("long").alias("at")), F.col("user_id"), F.floor(F.col("at") / RUN_LINES))
    rows = (placed if text is None else placed.withColumn("__j", text)).select("event_id", path.alias("file_path"), "at", value.alias("value"))
    own = F.struct(F.col("at").alias("line_number"), "value")
    empty = F.struct((F.col("at") + 1).alias("line_number"), F.lit("").alias("value"))
    return rows.select("file_path", F.explode(F.when(blank, F.array(own, empty)).otherwise(F.array(own))).alias("l")).select("file_path", "l.*")


def _fmt(pattern: str, *cols: Column) -> Column:
    return F.format_string(pattern, *cols)


def claude_session_id(c: Column) -> Column:
    return _fmt("%08d-0000-4000-8000-000000000000", c)


def claude_uuid(c: Column, t: Column) -> Column:
    return _fmt("%08d-%04d-4000-8000-%012d", c, t, c)


def _pick(options: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (idx + 1).cast("int"))


def _obj(**fields: Column) -> Column:
    """A JSON object value (VARIANT) from named columns."""
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _claude_lines(conversations: DataFrame) -> DataFrame:
    """One transcript file per conversation (every sixth one is a sub-agent
    transcript of the previous conversation's session); one JSON line per
    turn at ``line = turn + 2``; line 1 is a summary (or a file-history
    snapshot for ``conv_id % 3 == 2``). System turns of ``conv_id % 5 == 0``
    are written truncated (malformed JSON)."""
    C, T, R, X = F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")
    sc = F.when(C % 6 == 5, C - 1).otherwise(C)
    k = (sc % 7).cast("string")
    sid = claude_session_id(sc)
    enc = F.concat(F.lit("-home-dev-my-app"), k)
    path = F.when(C % 6 == 5, F.concat_ws("/", F.lit(CLAUDE_ROOT + "/projects"), enc, sid, F.lit("subagents"),
                                          F.concat(F.lit("agent-a"), C.cast("string"), F.lit(".jsonl"))))\
        .otherwise(F.concat_ws("/", F.lit(CLAUDE_ROOT + "/projects"), enc, F.concat(sid, F.lit(".jsonl"))))
    ts = iso_millis(F.timestamp_add("SECOND", F.lit(BASE_EPOCH_S) + C * 3600 + T * 37, epoch()))
    user_text = F.when((C % 8 == 1) & (T == 0), F.concat(F.lit("<command-name>/clear</command-name> "), X)).otherwise(X)
    thinking = _obj(type=F.lit("thinking"), thinking=F.lit("considering"))
    text_block = _obj(type=F.lit("text"), text=X)
    tool = _obj(type=F.lit("tool_use"),
                id=F.concat(F.lit("toolu_"), C.cast("string"), F.lit("_"), T.cast("string")),
                name=_pick(TOOLS, (C + T) % 5),
                input=_obj(file_path=F.concat(F.lit("/home/dev/my-app"), k, F.lit("/f"), T.cast("string"), F.lit(".py")),
                           limit=T.cast("bigint")))
    blocks = F.when(T % 3 == 1, F.array(thinking, text_block, tool)).otherwise(F.array(thinking, text_block))
    assistant_msg = _obj(
        model=F.concat(F.lit("model-"), (C % 3).cast("string")),
        stop_reason=F.when(T % 3 == 1, F.lit("tool_use")).otherwise(F.lit("end_turn")),
        content=blocks,
        usage=_obj(input_tokens=F.length(X).cast("bigint"),
                   output_tokens=F.floor(F.length(X) / 3).cast("bigint"),
                   cache_creation_input_tokens=(T * 10).cast("bigint"),
                   cache_read_input_tokens=C.cast("bigint")))
    user_content = F.when(T % 4 == 2, F.to_variant_object(F.array(_obj(type=F.lit("text"), text=user_text))))\
        .otherwise(user_text.cast("variant"))
    user_msg = _obj(role=F.lit("user"), content=user_content)
    line = F.to_json(F.struct(
        R.alias("type"),
        claude_uuid(C, T).alias("uuid"),
        F.when(T > 0, claude_uuid(C, T - 1)).alias("parentUuid"),
        F.when(R != "system", ts).alias("timestamp"),
        sid.alias("sessionId"),
        F.when(T > 0, F.concat(F.lit("/home/dev/my-app"), k)).alias("cwd"),
        F.concat(F.lit("2.0."), (C % 4).cast("string")).alias("version"),
        F.when(sc % 9 != 0, F.concat(F.lit("plan-"), sc.cast("string"))).alias("slug"),
        F.when(C % 2 == 0, F.lit("main")).otherwise(F.concat(F.lit("feature/x"), (C % 3).cast("string"))).alias("gitBranch"),
        F.when(R == "system", X).alias("content"),
        F.when(R == "assistant", assistant_msg).when(R == "user", user_msg).alias("message"),
    ))
    turn_json = F.when((R == "system") & (C % 5 == 0), F.expr("substring(__j, 1, length(__j) - 1)")).otherwise(F.col("__j"))
    line1 = F.when(C % 3 == 2, F.to_json(F.struct(F.lit("file-history-snapshot").alias("type"),
                                                  F.concat(F.lit("m"), C.cast("string")).alias("messageId"),
                                                  F.struct(F.lit(False).alias("isSnapshotUpdate")).alias("snapshot"))))\
        .otherwise(F.to_json(F.struct(F.lit("summary").alias("type"),
                                      F.concat(F.lit("Session "), C.cast("string")).alias("summary"),
                                      claude_uuid(C, F.lit(0)).alias("leafUuid"))))
    first = F.struct(F.lit(1).cast("bigint").alias("line_number"), F.col("__l1").alias("value"))
    turn = F.struct((T + 2).cast("bigint").alias("line_number"), turn_json.alias("value"))
    return (
        conversations.select(C, T, R, path.alias("file_path"), line.alias("__j"), line1.alias("__l1"))
        .select("file_path", F.explode(F.when(T == 0, F.array(first, turn)).otherwise(F.array(turn))).alias("l"))
        .select("file_path", "l.line_number", "l.value")
    )


def claude_lines(conversations: DataFrame) -> DataFrame:
    return _placed(_claude_lines(conversations))


def claude_desktop_lines(conversations: DataFrame) -> DataFrame:
    """The same transcripts below a hidden ``.claude`` folder of each desktop
    session; session ids equal those of the command line's transcripts."""
    lines = _claude_lines(conversations)
    below = F.regexp_replace("file_path", "^" + CLAUDE_ROOT, "")
    folder = F.concat(F.lit(DESKTOP_ROOT + "/local_"), F.pmod(F.hash("file_path"), F.lit(3)).cast("string"), F.lit("/.claude"))
    return _placed(lines.select(F.concat(folder, below).alias("file_path"), "line_number", "value"))


def _iso_ts(ts: Column) -> Column:
    return iso_millis(ts.cast("timestamp_ntz"))


def copilot_session_id(u: Column) -> Column:
    return _fmt("%08d-c0c0-4000-8000-%012d", u, u)


def _copilot_lines(events: DataFrame) -> DataFrame:
    """One ``session-state/<id>/events.jsonl`` per user: line 1 is a
    ``session.start`` (from the user's first event time), then one event line
    per row in event order, with blank lines between. signup → model change;
    view → user / assistant message; click → tool start; purchase → reasoning
    or tool result; error → truncation / turn start / error, and every 50th
    (``event_id % 50 == 7``) is written malformed."""
    u, E, ty = F.col("user_id"), F.col("event_id"), F.col("event_type")
    sid = copilot_session_id(u)
    path = F.concat(F.lit(COPILOT_ROOT + "/session-state/"), sid, F.lit("/events.jsonl"))
    e = F.col("event_id").cast("string")
    nul = F.lit(None).cast("string")
    tool_req = F.to_variant_object(F.array(_obj(toolCallId=F.concat(F.lit("req"), e), name=F.lit("view"),
                                                arguments=_obj(path=F.concat(F.lit("/work/f"), (E % 10).cast("string"), F.lit(".txt"))))))
    data = (
        F.when(ty == "signup", _obj(newModel=F.concat(F.lit("gpt-"), (E % 3).cast("string"))))
        .when((ty == "view") & (E % 2 == 0), _obj(content=F.concat(F.lit("ask "), e)))
        .when(ty == "view", _obj(messageId=F.concat(F.lit("m"), e), content=F.concat(F.lit("answer "), e),
                                 toolRequests=F.when(E % 3 == 0, tool_req).otherwise(F.to_variant_object(F.array().cast("array<string>")))))
        .when(ty == "click", _obj(toolCallId=F.concat(F.lit("call"), e), toolName=_pick(TOOLS, E % 5),
                                  arguments=_obj(path=F.concat(F.lit("/work/f"), (E % 10).cast("string"), F.lit(".txt")))))
        .when((ty == "purchase") & (E % 4 == 0), _obj(content=F.concat(F.lit("thinking "), e)))
        .when(ty == "purchase", _obj(toolCallId=F.concat(F.lit("call"), e), success=F.lit(True),
                                     result=_obj(content=F.concat(F.lit("done "), e))))
        .when((ty == "error") & (E % 4 == 0), _obj(tokenLimit=F.lit(128000).cast("bigint"),
                                                   preTruncationTokensInMessages=(E % 1000 + 1000).cast("bigint"),
                                                   postTruncationTokensInMessages=(E % 500 + 500).cast("bigint")))
        .when((ty == "error") & (E % 4 == 1), F.lit(None).cast("variant"))
        .when(ty == "error", _obj(errorType=F.lit("net"), message=F.concat(F.lit("error "), e)))
    )
    etype = (
        F.when(ty == "signup", F.lit("session.model_change"))
        .when((ty == "view") & (E % 2 == 0), F.lit("user.message"))
        .when(ty == "view", F.lit("assistant.message"))
        .when(ty == "click", F.lit("tool.execution_start"))
        .when((ty == "purchase") & (E % 4 == 0), F.lit("assistant.reasoning"))
        .when(ty == "purchase", F.lit("tool.execution_complete"))
        .when((ty == "error") & (E % 4 == 0), F.lit("session.truncation"))
        .when((ty == "error") & (E % 4 == 1), F.lit("assistant.turn_start"))
        .otherwise(F.lit("session.error"))
    )
    j = F.to_json(F.struct(etype.alias("type"), F.concat(F.lit("e"), e).alias("id"), _iso_ts(F.col("ts")).alias("timestamp"),
                           F.concat(F.lit("s"), u.cast("string")).alias("parentId"), data.alias("data")))
    value = F.when((ty == "error") & (E % 50 == 7), F.expr("substring(__j, 1, length(__j) - 2)")).otherwise(F.col("__j"))
    ev = _event_lines(events, path, value, j)
    starts = events.groupBy("user_id").agg(F.min("ts").alias("t0")).select(
        path.alias("file_path"), F.lit(1).cast("bigint").alias("line_number"),
        F.to_json(F.struct(
            F.lit("session.start").alias("type"), F.concat(F.lit("s"), u.cast("string")).alias("id"),
            _iso_ts(F.col("t0")).alias("timestamp"),
            _obj(sessionId=sid, copilotVersion=F.concat(F.lit("0.0."), (u % 5).cast("string")),
                 context=_obj(cwd=F.when(u % 10 != 3, F.concat(F.lit("/work/repo"), (u % 4).cast("string"))),
                              branch=F.when(u % 6 != 5, F.lit("main")),
                              repository=F.concat(F.lit("org/repo"), (u % 4).cast("string")))).alias("data"),
        )).alias("value"))
    return ev.unionByName(starts)


def copilot_lines(events: DataFrame) -> DataFrame:
    return _placed(_copilot_lines(events))


def _copilot_dir(u: Column) -> Column:
    return F.concat(F.lit(COPILOT_ROOT + "/session-state/"), copilot_session_id(u))


def copilot_side_files(events: DataFrame) -> DataFrame:
    """Per user: ``workspace.yaml`` (not for ``user_id % 4 == 1``; its summary not
    for ``user_id % 3 == 0``) and ``plan.md`` (not for ``user_id % 5 == 2``)."""
    u = F.col("user_id")
    us = u.cast("string")
    per = events.groupBy("user_id").agg(F.count("*").alias("n"))
    yaml = F.concat(F.lit("id: "), copilot_session_id(u), F.lit("\ncwd: /work/ws"), (u % 5).cast("string"), F.lit("\nbranch: ws-main\n"),
                    F.when(u % 3 != 0, F.concat(F.lit('summary: "Work of user '), us, F.lit('"\n'))).otherwise(F.lit("")))
    plan = F.concat(F.lit("# Plan of "), us, F.lit("\n\n"), F.col("n").cast("string"), F.lit(" steps\n"))
    f = lambda name, content: F.struct(F.concat(_copilot_dir(u), F.lit(f"/{name}")).alias("file_path"), content.alias("content"))
    files = F.array(f("workspace.yaml", F.when(u % 4 != 1, yaml)), f("plan.md", F.when(u % 5 != 2, plan)))
    rows = per.select(F.explode(files).alias("f")).where(F.col("f.content").isNotNull()).select("f.file_path", "f.content")
    return _materialised(rows.withColumn("file_size", F.octet_length("content").cast("bigint")), "content")


def copilot_checkpoint_lines(events: DataFrame) -> DataFrame:
    """``checkpoints/001.md`` per user: a checklist with one line per event after
    a title (purchases done, clicks open, signups done and indented, the rest no
    items), and an ``index.md`` that counts for nothing."""
    u, E, ty = F.col("user_id"), F.col("event_id").cast("string"), F.col("event_type")
    value = (F.when(ty == "purchase", F.concat(F.lit("- [x] order "), E)).when(ty == "click", F.concat(F.lit("- [ ] follow "), E))
             .when(ty == "signup", F.concat(F.lit("  - [X] join "), E, F.lit(" "))).otherwise(F.concat(F.lit("note "), E)))
    items = _event_lines(events, F.concat(_copilot_dir(u), F.lit("/checkpoints/001.md")), value)
    users = events.select("user_id").distinct()
    one = F.lit(1).cast("long").alias("line_number")
    title = users.select(F.concat(_copilot_dir(u), F.lit("/checkpoints/001.md")).alias("file_path"), one, F.lit("# Steps").alias("value"))
    index = users.select(F.concat(_copilot_dir(u), F.lit("/checkpoints/index.md")).alias("file_path"), one, F.lit("- [ ] 001").alias("value"))
    return _placed(items.unionByName(title).unionByName(index))


def copilot_history_files(events: DataFrame) -> DataFrame:
    """``command-history-state.json`` of each user's root: the user's clicks as
    commands, in order; malformed for ``user_id % 11 == 4``."""
    u = F.col("user_id")
    per = events.where(F.col("event_type") == "click").groupBy("user_id").agg(F.sort_array(F.collect_list("event_id")).alias("es"))
    j = F.to_json(F.struct(F.transform("es", lambda e: F.concat(F.lit("run "), e.cast("string"))).alias("commandHistory")))
    content = F.when(u % 11 == 4, F.lit('{"commandHistory": [1]}')).otherwise(j)
    return _materialised(per.select(F.concat(F.lit(COPILOT_ROOT + "/u"), u.cast("string"), F.lit("/command-history-state.json")).alias("file_path"),
                                    content.alias("content")), "content")


def codex_session_id(u: Column) -> Column:
    return _fmt("%08d-c0de-4000-8000-%012d", u, u)


def _codex_lines(events: DataFrame) -> DataFrame:
    """One rollout file per user: line 1 ``session_meta``; then per event (in
    order, with blank lines between): signup → turn context (even ids) or reasoning;
    view → ``response_item`` message, or for users with ``user_id % 7 == 0``
    only ``event_msg`` messages; click → function call (every 40th malformed);
    purchase → function output; error → ``event_msg`` (agent message, dropped
    when the file has response messages; token count for the %7 users)."""
    u, E, ty = F.col("user_id"), F.col("event_id"), F.col("event_type")
    cid = codex_session_id(u)
    path = F.concat(F.lit(CODEX_ROOT + "/sessions/2024/01/01/rollout-2024-01-01T00-00-00-"), cid, F.lit(".jsonl"))
    e = E.cast("string")
    only_events = u % 7 == 0
    even = E % 2 == 0
    kind = (
        F.when((ty == "signup") & even, F.lit("turn_context"))
        .when(ty == "signup", F.lit("response_item"))
        .when((ty == "view") & only_events, F.lit("event_msg"))
        .when(ty.isin("view", "click", "purchase"), F.lit("response_item"))
        .otherwise(F.lit("event_msg"))
    )
    payload = (
        F.when((ty == "signup") & even, _obj(model=F.concat(F.lit("codex-"), (E % 3).cast("string")),
                                             cwd=F.concat(F.lit("/src/proj"), (u % 3).cast("string"))))
        .when(ty == "signup", _obj(type=F.lit("reasoning"),
                                   summary=F.to_variant_object(F.array(_obj(type=F.lit("summary_text"), text=F.concat(F.lit("plan "), e))))))
        .when((ty == "view") & only_events, _obj(type=F.when(even, F.lit("user_message")).otherwise(F.lit("agent_message")),
                                                 message=F.concat(F.lit("msg "), e)))
        .when(ty == "view", _obj(type=F.lit("message"), role=F.when(even, F.lit("user")).otherwise(F.lit("assistant")),
                                 content=F.to_variant_object(F.array(_obj(
                                     type=F.when(even, F.lit("input_text")).otherwise(F.lit("output_text")),
                                     text=F.concat(F.lit("msg "), e))))))
        .when(ty == "click", _obj(type=F.lit("function_call"), name=F.lit("shell"),
                                  arguments=F.to_json(F.struct(F.concat(F.lit("ls "), e).alias("cmd"))),
                                  call_id=F.concat(F.lit("c"), e)))
        .when(ty == "purchase", _obj(type=F.lit("function_call_output"), call_id=F.concat(F.lit("c"), e),
                                     output=F.concat(F.lit("exit "), (E % 3).cast("string"))))
        .when(only_events, _obj(type=F.lit("token_count")))
        .otherwise(_obj(type=F.lit("agent_message"), message=F.concat(F.lit("warn "), e)))
    )
    j = F.to_json(F.struct(_iso_ts(F.col("ts")).alias("timestamp"), kind.alias("type"), payload.alias("payload")))
    value = F.when((ty == "click") & (E % 40 == 3), F.expr("substring(__j, 1, length(__j) - 2)")).otherwise(F.col("__j"))
    ev = _event_lines(events, path, value, j)
    metas = events.groupBy("user_id").agg(F.min("ts").alias("t0")).select(
        path.alias("file_path"), F.lit(1).cast("bigint").alias("line_number"),
        F.to_json(F.struct(
            _iso_ts(F.col("t0")).alias("timestamp"), F.lit("session_meta").alias("type"),
            _obj(id=cid, cwd=F.concat(F.lit("/src/proj"), (u % 3).cast("string")),
                 git=_obj(branch=F.concat(F.lit("dev"), (u % 2).cast("string")),
                          repository_url=F.concat(F.lit("https://git.example/r"), (u % 3).cast("string"), F.lit(".git"))),
                 cli_version=F.concat(F.lit("0."), (u % 4).cast("string"), F.lit(".0"))).alias("payload"),
        )).alias("value"))
    return ev.unionByName(metas)


def codex_lines(events: DataFrame) -> DataFrame:
    return _placed(_codex_lines(events))

def _claude_history_lines(conversations: DataFrame) -> DataFrame:
    """``history.jsonl``: one prompt line per user turn at
    ``line = conv_id * 1000 + turn + 1``. Turn-2 prompts point at archived
    projects, and for odd conversations at a session with no transcript
    (orphans). ``conv_id % 10 == 9`` turn-1 lines are malformed."""
    C, T, X = F.col("conv_id"), F.col("turn"), F.col("text")
    sc = F.when(C % 6 == 5, C - 1).otherwise(C)
    pasted = F.when(C % 4 == 0, _obj(**{"1": _obj(id=F.lit(1).cast("bigint"), type=F.lit("text"),
                                                  content=F.concat(F.lit("snippet "), C.cast("string")))})) \
        .otherwise(F.to_variant_object(F.struct()))
    j = F.to_json(F.struct(
        X.alias("display"), pasted.alias("pastedContents"),
        ((F.lit(BASE_EPOCH_S) + C * 3600 + T * 37) * 1000 + F.lit(0.25)).cast("decimal(18,2)").alias("timestamp"),
        F.when(T == 2, F.concat(F.lit("/home/dev/archived"), (C % 3).cast("string")))
        .otherwise(F.concat(F.lit("/home/dev/my-app"), (sc % 7).cast("string"))).alias("project"),
        F.when((T == 2) & (C % 2 == 1), claude_session_id(C + 1000000)).otherwise(claude_session_id(sc)).alias("sessionId"),
    ))
    value = F.when((C % 10 == 9) & (T == 1), F.expr("substring(__j, 1, length(__j) - 1)")).otherwise(F.col("__j"))
    return conversations.where(F.col("role") == "user").select(
        F.lit(CLAUDE_ROOT + "/history.jsonl").alias("file_path"), (C * 1000 + T + 1).cast("bigint").alias("line_number"),
        j.alias("__j"), C, T).select("file_path", "line_number", value.alias("value"))


_STATUSES = ["pending", "in_progress", "completed"]


def claude_history_lines(conversations: DataFrame) -> DataFrame:
    return _materialised(_claude_history_lines(conversations), "value")

def _claude_todo_files(conversations: DataFrame) -> DataFrame:
    """One ``todos/<session>-agent-a<conv>t<turn>.json`` per assistant turn,
    holding ``1 + (conv_id + turn) % 3`` items; files of ``conv_id % 9 == 4``
    are malformed, those of ``conv_id % 8 == 3`` belong to sessions without a
    transcript (orphans)."""
    C, T = F.col("conv_id"), F.col("turn")
    sc = F.when(C % 8 == 3, C + 2000000).when(C % 6 == 5, C - 1).otherwise(C)
    n = (C + T) % 3 + 1
    items = F.transform(F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint")), lambda i: F.struct(
        F.concat(F.lit("step "), i.cast("string"), F.lit(" of turn "), T.cast("string")).alias("content"),
        _pick(_STATUSES, (C + T + i) % 3).alias("status"),
        F.when((C + T + i) % 3 == 1, F.concat(F.lit("Working on step "), i.cast("string"))).alias("activeForm")))
    content = F.when(C % 9 == 4, F.lit('[{"content":')).otherwise(F.to_json(items))
    return conversations.where(F.col("role") == "assistant").select(
        F.concat(F.lit(CLAUDE_ROOT + "/todos/"), claude_session_id(sc), F.lit("-agent-a"), C.cast("string"),
                 F.lit("t"), T.cast("string"), F.lit(".json")).alias("file_path"),
        content.alias("content"))


def claude_todo_files(conversations: DataFrame) -> DataFrame:
    return _materialised(_claude_todo_files(conversations), "content")

def _claude_plan_files(documents: DataFrame) -> DataFrame:
    """Every document becomes ``plans/plan-<doc_id>.md`` (whole text)."""
    return documents.select(
        F.concat(F.lit(CLAUDE_ROOT + "/plans/plan-"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_path"),
        F.col("text").alias("content"), F.octet_length("text").cast("bigint").alias("file_size"))


def claude_plan_files(documents: DataFrame) -> DataFrame:
    return _materialised(_claude_plan_files(documents), "content")

def _claude_stats_files(events: DataFrame) -> DataFrame:
    """One ``stats-cache.json`` per user root (``user_id % 4``) whose
    ``dailyActivity`` has a day entry per active day: events, distinct users
    and clicks. Days are aggregated first (partial aggregation), so the one
    document per root holds at most one entry per calendar day."""
    daily = events.groupBy((F.col("user_id") % 4).alias("r"), F.to_date("ts").alias("d")).agg(
        F.count("*").alias("messageCount"), F.countDistinct("user_id").alias("sessionCount"),
        F.count_if(F.col("event_type") == "click").alias("toolCallCount"))
    return daily.groupBy("r").agg(F.sort_array(F.collect_list(F.struct(
        F.date_format("d", "yyyy-MM-dd").alias("date"), "messageCount", "sessionCount", "toolCallCount"))).alias("days"))\
        .select(F.concat(F.lit("/lake/claude/u"), F.col("r").cast("string"), F.lit("/stats-cache.json")).alias("file_path"),
                F.to_json(F.struct(F.col("days").alias("dailyActivity"))).alias("content"))


GEMINI_ROOT = "/lake/gemini"
CURSOR_DB = "/lake/cursor/state.vscdb"


def claude_stats_files(events: DataFrame) -> DataFrame:
    return _materialised(_claude_stats_files(events), "content")

def gemini_dir(c: Column) -> Column:
    """Project directory under ``tmp/``: an alias known to ``projects.json``
    (``proj<conv_id % 5>``) except for ``conv_id % 4 == 3`` (an unknown hash)."""
    return F.when(c % 4 != 3, F.concat(F.lit("proj"), (c % 5).cast("string"))).otherwise(F.concat(F.lit("h"), c.cast("string")))


def gemini_session_id(c: Column) -> Column:
    return _fmt("%08d-6e00-4000-8000-%012d", c, c)


def _gemini_message(C: Column, T: Column, R: Column, X: Column) -> Column:
    ts = iso_millis(F.timestamp_add("SECOND", F.lit(BASE_EPOCH_S) + C * 3600 + T * 37, epoch()))
    calls = F.transform(F.sequence(F.lit(0), (T % 3).cast("int")), lambda i: _obj(
        id=F.concat(F.lit("tc"), C.cast("string"), F.lit("-"), T.cast("string"), F.lit("-"), i.cast("string")),
        name=_pick(TOOLS, i.cast("bigint")), args=_obj(q=i.cast("bigint")), status=F.lit("success")))
    calls = F.slice(calls, 1, (T % 3).cast("int"))
    return _obj(
        id=F.concat(F.lit("m"), C.cast("string"), F.lit("-"), T.cast("string")),
        timestamp=F.when(T % 5 != 4, ts),
        type=F.when(R == "user", F.lit("user")).when(R == "assistant", F.lit("gemini")).otherwise(F.lit("info")),
        content=F.when((R == "system") & (C % 7 == 0), F.lit("")).otherwise(X),
        model=F.when(R == "assistant", F.concat(F.lit("gemini-"), (C % 2).cast("string"))),
        tokens=F.when(R == "assistant", _obj(input=F.length(X).cast("bigint"), output=F.floor(F.length(X) / 3).cast("bigint"),
                                             cached=(T * 100).cast("bigint"))),
        toolCalls=F.when(R == "assistant", F.to_variant_object(calls)),
    )


def _gemini_files(conversations: DataFrame) -> DataFrame:
    """One ``tmp/<dir>/chats/session-<conv_id>.json`` document per
    conversation (the format stores a whole session in one JSON file, so its
    turns are gathered per conversation, in turn order). Assistant turns carry
    ``turn % 3`` tool calls; every fifth message has no timestamp (it falls
    back to the session start); ``conv_id % 13 == 6`` files are malformed."""
    C, T, R, X = F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")
    per_turn = conversations.select(C, F.struct(T.alias("t"), F.to_json(_gemini_message(C, T, R, X)).alias("m")).alias("tm"))
    docs = per_turn.groupBy("conv_id").agg(F.sort_array(F.collect_list("tm")).alias("tms"))
    start = iso_millis(F.timestamp_add("SECOND", F.lit(BASE_EPOCH_S) + C * 3600, epoch()))
    body = F.concat(
        F.lit('{"sessionId":"'), gemini_session_id(C), F.lit('","startTime":"'), start,
        F.lit('","kind":"'), F.when(C % 6 == 5, F.lit("subagent")).otherwise(F.lit("main")),
        F.lit('","messages":['), F.array_join(F.transform(F.col("tms"), lambda x: x.m), ","), F.lit("]}"))
    return docs.select(C, body.alias("__b")).select(
        F.concat(F.lit(GEMINI_ROOT + "/tmp/"), gemini_dir(C), F.lit("/chats/session-"), C.cast("string"), F.lit(".json")).alias("file_path"),
        F.when(C % 13 == 6, F.expr("substring(__b, 1, length(__b) - 3)")).otherwise(F.col("__b")).alias("content"))


def gemini_files(conversations: DataFrame) -> DataFrame:
    return _materialised(_gemini_files(conversations), "content")

def _gemini_projects(conversations: DataFrame) -> DataFrame:
    """``projects.json``: ``{abs path: alias}`` for every alias in use (at most
    five entries, aggregated before they are gathered)."""
    k = (F.col("conv_id") % 5)
    aliases = conversations.where(F.col("conv_id") % 4 != 3).select(k.alias("k")).distinct()
    return aliases.agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat(F.lit("/home/dev/gem"), F.col("k").cast("string")), F.concat(F.lit("proj"), F.col("k").cast("string"))))).alias("m"))\
        .select(F.lit(GEMINI_ROOT + "/projects.json").alias("file_path"),
                F.to_json(F.struct(F.col("m").alias("projects"))).alias("content"))


def gemini_projects(conversations: DataFrame) -> DataFrame:
    return _materialised(_gemini_projects(conversations), "content")

def gemini_pieces(conversations: DataFrame) -> DataFrame:
    """The same documents as the pieces between their commas, in blocks."""
    pieces = _gemini_files(conversations).select("file_path", F.posexplode(F.split("content", ",", -1)).alias("at", "value"))
    return _placed(pieces.select("file_path", (F.col("at") + 1).cast("long").alias("line_number"), "value"))


def gemini_marks(conversations: DataFrame) -> DataFrame:
    """The marker file of the root."""
    return conversations.select(F.lit(GEMINI_ROOT + "/installation_id").alias("file_path"), F.lit("").alias("content")).distinct()


def cursor_composer_id(c: Column) -> Column:
    return _fmt("%08d-cc00-4000-8000-%012d", c, c)


def _cursor_kv(conversations: DataFrame) -> DataFrame:
    """``cursorDiskKV`` rows: one ``composerData:<id>`` per conversation whose
    ordered headers list its turns (bubble type 1 user, 2 assistant, 3 other;
    ``conv_id % 4 == 1`` has an id-less header after turn 0), one
    ``bubbleId:<id>:<bubble>`` per turn except ``turn % 5 == 4`` (missing
    bubbles), and one unrelated key per conversation."""
    C, T, R, X = F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")
    cid = cursor_composer_id(C)
    bid = F.concat(F.lit("b"), C.cast("string"), F.lit("-"), T.cast("string"))
    ms = (F.lit(BASE_EPOCH_S) + C * 3600 + T * 37) * 1000 + 250
    tool = (F.when((R == "assistant") & (T % 3 == 1), _obj(
                name=_pick(TOOLS, (C + T) % 5), toolCallId=F.concat(F.lit("tc"), C.cast("string"), F.lit("-"), T.cast("string")),
                rawArgs=F.to_json(F.struct(T.cast("string").alias("q")))))
            .when((R == "assistant") & (T % 3 == 0), _obj(tool=F.lit("search"), params=_obj(q=T.cast("bigint")))))
    bubble = F.to_json(_obj(
        text=X,
        createdAt=F.when(T % 3 != 2, ms.cast("bigint")),
        timingInfo=F.when(T % 3 == 2, _obj(clientStartTime=ms.cast("bigint"))),
        isAgentic=F.when(C % 6 == 5, F.lit(True)),
        tokenCount=F.when(R == "assistant", _obj(inputTokens=F.length(X).cast("bigint"),
                                                 outputTokens=F.floor(F.length(X) / 3).cast("bigint"))),
        toolFormerData=tool,
    ))
    bubbles = conversations.where(T % 5 != 4).select(
        F.concat(F.lit("bubbleId:"), cid, F.lit(":"), bid).alias("key"),
        F.when((C % 11 == 10) & (T == 0), F.lit('{"text":')).otherwise(bubble).alias("value"))
    htype = F.when(R == "user", F.lit(1)).when(R == "assistant", F.lit(2)).otherwise(F.lit(3)).cast("bigint")
    headers = conversations.select(C, F.explode(F.when((C % 4 == 1) & (T == 0), F.array(
        F.struct((T * 2).alias("pos"), bid.alias("bubbleId"), htype.alias("type")),
        F.struct((T * 2 + 1).alias("pos"), F.lit(None).cast("string").alias("bubbleId"), F.lit(1).cast("bigint").alias("type"))))
        .otherwise(F.array(F.struct((T * 2).alias("pos"), bid.alias("bubbleId"), htype.alias("type"))))).alias("h"))
    composers = headers.groupBy("conv_id").agg(F.sort_array(F.collect_list("h")).alias("hs")).select(
        F.concat(F.lit("composerData:"), cursor_composer_id(C)).alias("key"),
        F.to_json(F.struct(cursor_composer_id(C).alias("composerId"),
                           F.transform(F.col("hs"), lambda h: F.struct(h.bubbleId.alias("bubbleId"), h.type.alias("type")))
                           .alias("fullConversationHeadersOnly"),
                           F.struct(F.concat(F.lit("cursor-"), (C % 2).cast("string")).alias("modelName")).alias("modelConfig")))
        .alias("value"))
    noise = conversations.where(T == 0).select(F.concat(F.lit("checkpointId:"), cid).alias("key"), F.lit("{}").alias("value"))
    return bubbles.unionByName(composers).unionByName(noise)


GROK_ROOT = "/lake/grok"


def cursor_kv(conversations: DataFrame) -> DataFrame:
    return _materialised(_cursor_kv(conversations), "value")

def grok_session_id(c: Column) -> Column:
    return _fmt("%08d-6b00-4000-8000-%012d", c, c)


def grok_cwd(c: Column) -> Column:
    return F.concat(F.lit("/home/dev/grok"), (c % 3).cast("string"))


def _grok_dir(c: Column) -> Column:
    return F.concat(F.lit(GROK_ROOT + "/sessions/"), F.url_encode(grok_cwd(c)), F.lit("/"), grok_session_id(c))


def _grok_kind(T: Column, R: Column) -> Column:
    """Chat line type of a turn."""
    return (F.when(R == "system", F.lit("system")).when((R == "user") & (T % 5 == 3), F.lit("tool_result"))
            .when(R == "user", F.lit("user")).when(T % 4 == 1, F.lit("reasoning")).otherwise(F.lit("assistant")))


def _grok_chat_lines(conversations: DataFrame) -> DataFrame:
    """``sessions/<%cwd>/<session>/chat_history.jsonl``: one line per turn at
    ``line = turn + 1``. Assistant turns are reasoning (``turn % 4 == 1``) or
    assistant messages with ``turn % 3`` tool calls (empty text when
    ``turn % 6 == 0``); some user turns (``turn % 5 == 3``) are tool results;
    ``conv_id % 9 == 2`` writes turn 1 malformed."""
    C, T, R, X = F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")
    kind = _grok_kind(T, R)
    n_calls = (T % 3).cast("int")
    calls = F.slice(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: _obj(
        id=F.concat(F.lit("call"), C.cast("string"), F.lit("-"), T.cast("string"), F.lit("-"), i.cast("string")),
        name=_pick(TOOLS, i.cast("bigint")),
        arguments=F.when(i == 0, F.to_json(F.struct(T.cast("bigint").alias("n"))).cast("variant"))
        .otherwise(_obj(n=T.cast("bigint"))))), 1, n_calls)
    msg = (F.when(kind == "system", _obj(type=kind, content=X))
           .when(kind == "user", _obj(type=kind, content=X))
           .when(kind == "tool_result", _obj(type=kind, tool_call_id=F.concat(F.lit("call"), C.cast("string"), F.lit("-"),
                                                                          (T - 1).cast("string"), F.lit("-0")), content=X))
           .when(kind == "reasoning", _obj(type=kind, id=F.concat(F.lit("r"), C.cast("string"), F.lit("-"), T.cast("string")),
                                           summary=F.to_variant_object(F.array(_obj(text=X))),
                                           reasoning_effort=F.when(T % 2 == 1, F.lit("high"))))
           .otherwise(_obj(type=kind, content=F.when(T % 6 == 0, F.lit("")).otherwise(X),
                           model_id=F.when(T % 2 == 0, F.lit("grok-fast")), tool_calls=F.to_variant_object(calls))))
    j = F.to_json(msg)
    value = F.when((C % 9 == 2) & (T == 1), F.expr("substring(__j, 1, length(__j) - 1)")).otherwise(F.col("__j"))
    return conversations.select(F.concat(_grok_dir(C), F.lit("/chat_history.jsonl")).alias("file_path"),
                                (T + 1).cast("bigint").alias("line_number"), j.alias("__j"), C, T) \
        .select("file_path", "line_number", value.alias("value"))


def grok_chat_lines(conversations: DataFrame) -> DataFrame:
    return _placed(_grok_chat_lines(conversations))

def _grok_update_lines(conversations: DataFrame) -> DataFrame:
    """``updates.jsonl``: per turn, at lines ``4 * turn + 1..4``: before user
    lines of ``turn % 4 == 2`` a thought that no line takes, the update that times the turn's chat line (none for system lines), a
    ``turn_completed`` with usage after assistant turns, and an unrelated
    update kind; what a turn lacks is a blank line."""
    C, T, R, X = F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")
    kind = _grok_kind(T, R)
    ev = (F.when(kind == "user", F.lit("user_message_chunk")).when(kind == "reasoning", F.lit("agent_thought_chunk"))
          .when(kind == "tool_result", F.lit("tool_call_update"))
          .when(kind == "assistant", F.when(T % 6 == 0, F.lit("tool_call")).otherwise(F.lit("agent_message_chunk"))))
    secs = (F.lit(BASE_EPOCH_S) + C * 3600 + T * 37).cast("bigint")
    usage = _obj(inputTokens=F.length(X).cast("bigint"), outputTokens=F.floor(F.length(X) / 3).cast("bigint"),
                 cachedReadTokens=T.cast("bigint"), reasoningTokens=F.lit(5).cast("bigint"))

    def upd(k: Column, with_usage: bool = False) -> Column:
        u = _obj(sessionUpdate=k, usage=usage) if with_usage else _obj(sessionUpdate=k)
        return F.to_json(F.struct(secs.alias("timestamp"), F.struct(u.alias("update")).alias("params")))

    items = F.array(
        F.struct(F.lit(0).alias("k"), F.when((kind == "user") & (T % 4 == 2), upd(F.lit("agent_thought_chunk"))).alias("v")),
        F.struct(F.lit(1).alias("k"), F.when(ev.isNotNull(), upd(ev)).alias("v")),
        F.struct(F.lit(2).alias("k"), F.when(kind.isin("assistant", "reasoning"), upd(F.lit("turn_completed"), True)).alias("v")),
        F.struct(F.lit(3).alias("k"), upd(F.lit("available_commands_update")).alias("v")))
    return conversations.select(F.concat(_grok_dir(C), F.lit("/updates.jsonl")).alias("file_path"), T,
                                F.explode(items).alias("x")) \
        .select("file_path", (T * 4 + F.col("x.k") + 1).cast("bigint").alias("line_number"), F.coalesce(F.col("x.v"), F.lit("")).alias("value"))


def grok_update_lines(conversations: DataFrame) -> DataFrame:
    return _placed(_grok_update_lines(conversations))

def _grok_side_files(conversations: DataFrame) -> DataFrame:
    """Per session: ``summary.json``, ``signals.json`` (not for
    ``conv_id % 7 == 3``), ``plan.md`` and, for
    sub-agent sessions (``conv_id % 6 == 5``), the parent's
    ``subagents/<child>/meta.json``. Counts come from one aggregate per
    conversation."""
    C, T, R = F.col("conv_id"), F.col("turn"), F.col("role")
    per = conversations.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.count_if(R == "user").alias("users"), F.count_if(R == "assistant").alias("assts"),
        F.sum(F.when((R == "assistant") & (T % 4 != 1), T % 3).otherwise(0)).alias("calls"),
        F.min_by("text", "turn").alias("first_text"))
    start = iso_millis(F.timestamp_add("SECOND", F.lit(BASE_EPOCH_S) + C * 3600, epoch()))
    later = iso_millis(F.timestamp_add("SECOND", F.lit(BASE_EPOCH_S) + C * 3600 + 999, epoch()))
    summary = F.to_json(_obj(
        created_at=start, updated_at=later, last_active_at=F.when(C % 4 != 0, later),
        current_model_id=F.lit("grok-code"), head_branch=F.lit("main"),
        git_root_dir=F.when(C % 2 == 0, F.concat(F.lit("/repo/g"), (C % 3).cast("string"))),
        git_remotes=F.to_variant_object(F.array(F.concat(F.lit("git@host:r"), (C % 3).cast("string"), F.lit(".git")))),
        generated_title=F.when(C % 5 != 0, F.concat(F.lit("Grok task "), C.cast("string"))),
        chat_format_version=F.when(C % 2 == 1, F.lit(2).cast("bigint").cast("variant")).otherwise(F.lit("v2").cast("variant")),
        reasoning_effort=F.lit("medium"), num_messages=F.col("n").cast("bigint")))
    signals = F.to_json(_obj(userMessageCount=F.col("users").cast("bigint"), assistantMessageCount=F.col("assts").cast("bigint"),
                             toolCallCount=F.col("calls").cast("bigint"), turnCount=F.col("n").cast("bigint")))
    meta = F.to_json(_obj(parent_session_id=grok_session_id(C - 1), child_session_id=grok_session_id(C)))
    parent_dir = F.concat(F.lit(GROK_ROOT + "/sessions/"), F.url_encode(grok_cwd(C - 1)), F.lit("/"), grok_session_id(C - 1))
    def f(path: Column, content: Column) -> Column:
        return F.struct(path.alias("file_path"), content.alias("content"))
    files = F.array(
        f(F.concat(_grok_dir(C), F.lit("/summary.json")), summary),
        f(F.concat(_grok_dir(C), F.lit("/signals.json")), F.when(C % 7 != 3, signals)),
        f(F.concat(_grok_dir(C), F.lit("/plan.md")), F.col("first_text")),
        f(F.concat(parent_dir, F.lit("/subagents/"), grok_session_id(C), F.lit("/meta.json")), F.when(C % 6 == 5, meta)))
    return per.select(F.explode(files).alias("f")).where(F.col("f.content").isNotNull()).select(
        "f.file_path", "f.content", F.octet_length("f.content").cast("bigint").alias("file_size"))


def grok_side_files(conversations: DataFrame) -> DataFrame:
    return _materialised(_grok_side_files(conversations), "content")
