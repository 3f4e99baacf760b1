"""The analytics catalogue over the canonical tables.

Every function takes a :class:`~sessionlake.plans.tables.Tables` and returns a
DataFrame; nothing is collected. Conventions:

* every LIMIT has a unique tie-break, so the top-k is deterministic;
* aggregates are aliased to stable names;
* a session timeline orders by ``(line_number, is_agent, file_name)`` — line
  numbers restart per file and a session can span a main and a sub-agent file;
* days are ``yyyy-MM-dd`` strings, taken from the ISO text without any time
  zone conversion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.functions import labels as LB
from sessionlake.functions.time import day_of, epoch_millis
from sessionlake.plans.tables import PROVIDERS, Tables

c = F.col


def not_err() -> Column:
    return c("message_type") != "_parse_error"

TIMELINE_ORDER = ["line_number", "is_agent", "file_name"]
#: A session: ids of two assistants may be equal.
SESSION = ["source", "session_id"]


def _sum0(col: str) -> Column:
    return F.sum(F.coalesce(c(col), F.lit(0))).cast("bigint")


# ── overview aggregates (A1–A12) ─────────────────────────────────────────────
def q_source_metrics(t: Tables) -> DataFrame:
    return t.conv.groupBy("source").agg(F.countDistinct("session_id").alias("sessions"), F.count("*").alias("messages"))


def q_totals(t: Tables) -> DataFrame:
    return t.conv.agg(F.countDistinct("session_id").alias("sessions"), F.count("*").alias("messages"))


def q_messages_by_source(t: Tables) -> DataFrame:
    return t.conv.groupBy("source").agg(F.count("*").alias("messages"))


def q_message_types_top(t: Tables, limit: int = 10) -> DataFrame:
    return (t.conv.where(c("message_type").isNotNull()).groupBy("message_type").agg(F.count("*").alias("n"))
            .orderBy(c("n").desc(), c("message_type")).limit(limit))


def q_types_by_source(t: Tables) -> DataFrame:
    return t.conv.where(not_err()).groupBy("source", "message_type").agg(F.count("*").alias("n"))


def _with_day(df: DataFrame) -> DataFrame:
    return df.where(c("timestamp").isNotNull()).withColumn("day", day_of(c("timestamp")))


def q_daily_activity(t: Tables) -> DataFrame:
    return _with_day(t.conv).groupBy("day", "source").agg(F.count("*").alias("messages"))


def q_daily_pivot(t: Tables, sources: tuple[str, ...] = tuple(PROVIDERS)) -> DataFrame:
    """Day × source message counts, missing cells 0. The pivot values are
    given, so Spark does not run an extra job to discover them."""
    return (_with_day(t.conv).groupBy("day").pivot("source", list(sources)).agg(F.count(F.lit(1)))
            .fillna(0, subset=list(sources)))


def q_activity_14d(t: Tables, limit: int = 14) -> DataFrame:
    return (_with_day(t.conv).groupBy("day").agg(F.count("*").alias("messages"))
            .orderBy(c("day").asc_nulls_last()).limit(limit))


def q_sessions_by_day(t: Tables, limit: int = 7) -> DataFrame:
    return (_with_day(t.conv).groupBy("day").agg(F.countDistinct("session_id").alias("sessions"))
            .orderBy(c("day").desc_nulls_last()).limit(limit))


def q_top_projects(t: Tables, limit: int = 10) -> DataFrame:
    return (t.conv.where(c("project_path").isNotNull() & (c("project_path") != ""))
            .groupBy(F.coalesce(F.split_part(c("project_path"), F.lit("/"), F.lit(-1)), F.lit("unknown")).alias("project"))
            .agg(F.count("*").alias("messages"))
            .orderBy(c("messages").desc(), c("project")).limit(limit))


def q_tokens_by_source(t: Tables) -> DataFrame:
    return t.conv.groupBy("source").agg(_sum0("input_tokens").alias("input_tokens"),
                                         _sum0("output_tokens").alias("output_tokens"))


def q_tokens_dedup(t: Tables) -> DataFrame:
    """Token sums over all providers where Grok's per-session totals (stamped
    on every row of a session) count once per session."""
    conv = t.conv_all
    per_session = conv.groupBy("source", "session_id").agg(
        F.when(c("source") == "grok", F.max(F.coalesce(c("input_tokens"), F.lit(0))))
         .otherwise(_sum0("input_tokens")).alias("i"),
        F.when(c("source") == "grok", F.max(F.coalesce(c("output_tokens"), F.lit(0))))
         .otherwise(_sum0("output_tokens")).alias("o"))
    return per_session.groupBy("source").agg(F.sum("i").cast("bigint").alias("input_tokens"),
                                             F.sum("o").cast("bigint").alias("output_tokens"))


def q_top_tools(t: Tables, limit: int = 15) -> DataFrame:
    return (t.conv.where(c("tool_name").isNotNull() & (c("tool_name") != ""))
            .groupBy("tool_name").agg(F.count("*").alias("uses"))
            .orderBy(c("uses").desc(), c("tool_name")).limit(limit))


def q_tools_per_session(t: Tables, limit: int = 20) -> DataFrame:
    return (t.conv.groupBy(*SESSION).agg(F.countDistinct("tool_name").alias("unique_tools"),
                                         F.count("tool_name").alias("total_tool_calls"))
            .orderBy(c("total_tool_calls").desc(), *SESSION).limit(limit))


def q_session_overview(t: Tables, limit: int = 50) -> DataFrame:
    return (t.conv.where(not_err()).groupBy("source", "session_id", "project_path")
            .agg(F.count("*").alias("msg_count"), F.min("timestamp").alias("started"), F.max("timestamp").alias("ended"))
            .orderBy(c("started").desc_nulls_last(), c("source"), c("session_id"), c("project_path")).limit(limit))


def q_longest_sessions(t: Tables, limit: int = 10) -> DataFrame:
    return (t.conv.where(not_err()).groupBy("source", "session_id", "project_path")
            .agg(F.count("*").alias("messages"), _sum0("input_tokens").alias("total_input_tokens"),
                 _sum0("output_tokens").alias("total_output_tokens"))
            .orderBy(c("messages").desc(), c("source"), c("session_id"), c("project_path")).limit(limit))


def q_models_used(t: Tables) -> DataFrame:
    return (t.conv.where(c("model").isNotNull()).groupBy("model")
            .agg(F.count("*").alias("messages"), _sum0("input_tokens").alias("input_tokens"),
                 _sum0("output_tokens").alias("output_tokens")))


def q_having(t: Tables, n: int = 6) -> DataFrame:
    return t.conv.groupBy(*SESSION).agg(F.count("*").alias("n")).where(c("n") == n)


# ── session index (A15 + W1 + J9) ────────────────────────────────────────────
def _prompt() -> Column:
    """The first (by timeline order) user message that is not a local command,
    with its place and cut to 200 characters: a partial aggregate, so a huge
    session is combined map-side, never gathered in one task."""
    m = ((c("message_type") == "user") & c("message_content").isNotNull()
         & ~c("message_content").startswith("<local-command") & ~c("message_content").startswith("<command-name>"))
    return F.min(F.when(m, F.struct(*TIMELINE_ORDER, F.left(c("message_content"), F.lit(200)).alias("text"))))


def first_user_messages(conv: DataFrame) -> DataFrame:
    return (conv.groupBy(*SESSION).agg(_prompt().alias("p")).where(c("p").isNotNull())
            .select(*SESSION, c("p.text").alias("first_user_message")))


def q_first_user_message(t: Tables) -> DataFrame:
    return first_user_messages(t.conv)


def session_index(conv: DataFrame) -> DataFrame:
    """One pass: each group keeps its own first prompt, and the session's is the
    least of its few groups'."""
    groups = conv.where(not_err()).groupBy(*SESSION, "project_path", "slug").agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
        F.count("*").alias("event_count"),
        F.count(c("tool_name")).alias("tool_calls"),
        _sum0("input_tokens").alias("total_input_tokens"), _sum0("output_tokens").alias("total_output_tokens"),
        _prompt().alias("_prompt"))
    return groups.select(
        "source", "session_id", "project_path", "slug", "first_ts", "last_ts", "event_count", "tool_calls",
        "total_input_tokens", "total_output_tokens",
        F.min("_prompt").over(Window.partitionBy(*SESSION)).getField("text").alias("first_user_message"))


def q_session_index(t: Tables) -> DataFrame:
    return session_index(t.conv)


def _matches(term: str) -> Column:
    q = term.lower()
    return (F.lower(F.coalesce(c("project_path"), F.lit(""))).contains(q)
            | F.lower(F.coalesce(c("session_id"), F.lit(""))).contains(q)
            | F.lower(F.coalesce(c("first_user_message"), F.lit(""))).contains(q))


def q_session_search(t: Tables, term: str = "app3") -> DataFrame:
    return session_index(t.conv).where(_matches(term))


def q_session_exclude(t: Tables, term: str = "repo1", projects: tuple[str, ...] = ("/work/repo1", "/work/repo2", "/home/dev/my-app2"),
                      min_events: int = 5) -> DataFrame:
    return (session_index(t.conv).where(c("project_path").isin(*projects)).where(c("event_count") >= min_events)
            .where(~_matches(term)))


def q_session_table(t: Tables) -> DataFrame:
    idx = session_index(t.conv)
    return idx.select(
        "source",
        F.coalesce(F.left(c("last_ts"), F.lit(16)), F.lit("—")).alias("last_active"),
        c("event_count").alias("events"),
        LB.project_short(c("project_path")).alias("project"),
        F.coalesce(F.left(F.replace(c("first_user_message"), F.lit("\n"), F.lit(" ")), F.lit(120)), F.lit("—")).alias("first_message"),
    )


# ── one session (F2, F3, F6) ─────────────────────────────────────────────────
SESSION_EVENT_COLUMNS = ["line_number", "message_type", "message_role", "timestamp", "model", "tool_name", "tool_use_id",
                         "tool_input", "message_content", "input_tokens", "output_tokens", "cache_creation_tokens",
                         "cache_read_tokens", "stop_reason", "uuid", "parent_uuid", "slug", "git_branch", "cwd", "version"]


def q_session_events(t: Tables, session_id: str) -> DataFrame:
    return t.conv.where((c("session_id") == session_id) & not_err()).select(*SESSION_EVENT_COLUMNS).orderBy("line_number")


def q_session_messages(t: Tables, session_id: str) -> DataFrame:
    return (t.conv.where(c("session_id") == session_id)
            .select("line_number", "message_type", "message_role", "timestamp", "message_content", "tool_name", "model")
            .orderBy("line_number"))


def q_event_search(t: Tables, types: tuple[str, ...] = ("user", "assistant", "tool_start"), term: str = "read") -> DataFrame:
    q = term.lower()
    return (t.conv.where(c("message_type").isin(*types))
            .where(F.lower(F.coalesce(c("message_content"), F.lit(""))).contains(q)
                   | F.lower(F.coalesce(c("tool_name"), F.lit(""))).contains(q)
                   | F.lower(F.coalesce(c("message_type"), F.lit(""))).contains(q))
            .select("session_id", "line_number", "message_type", "tool_name", "message_content"))


# ── filter predicates as labelled counts (F7–F10, U4) ─────────────────────────
def _label_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass: every predicate becomes a ``count_if`` of a single aggregate,
    then the one-row result is unpivoted to (label, n)."""
    row = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(k) for k, cond in checks.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("label"), c(k).alias("n")) for k in checks])).alias("x")) \
        .select("x.label", "x.n")


def q_filters(t: Tables) -> DataFrame:
    conv = t.conv
    return _label_counts(conv, {
        "claude_agent_rows": (c("source") == "claude") & c("is_agent"),
        "assistant_with_tokens_100_500": (c("message_type") == "assistant") & c("input_tokens").between(100, 500),
        "tool_in_read_edit": c("tool_name").isin("Read", "Edit"),
        "cwd_null": c("cwd").isNull(),
        "uuid_not_null": c("uuid").isNotNull(),
        "not_agent_user": ~c("is_agent") & (c("message_type") == "user"),
        "cache_read_gt_0": c("cache_read_tokens") > 0,
    })


def q_prefix_filters(t: Tables) -> DataFrame:
    conv = t.conv
    return _label_counts(conv, {
        "tool_use_id_like_toolu": c("tool_use_id").like("toolu_%"),
        "tool_use_id_not_like_toolu": ~c("tool_use_id").like("toolu_%"),
        "file_name_starts_agent": c("file_name").startswith("agent-"),
        "content_like_command": c("message_content").like("<command-name>%"),
        "project_like_home": c("project_path").like("/home/%"),
    })


UUID_RE = r"^(?:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
ISO_RE = r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?Z)$"


def q_regex_validate(t: Tables) -> DataFrame:
    conv = t.conv
    return _label_counts(conv, {
        "uuid_shaped": c("uuid").rlike(UUID_RE),
        "uuid_not_shaped": c("uuid").isNotNull() & ~c("uuid").rlike(UUID_RE),
        "timestamp_iso": c("timestamp").rlike(ISO_RE),
        "session_uuid_shaped": c("session_id").rlike(UUID_RE),
    })


def q_source_filter(t: Tables, source: str = "copilot") -> DataFrame:
    """Filter after the union; Catalyst prunes the other provider's branch."""
    return t.conv.where(c("source") == source).groupBy(c("message_type").alias("label")).agg(F.count("*").alias("n"))


def q_exclusive_types(t: Tables) -> DataFrame:
    return (t.conv_all.groupBy(c("message_type").alias("label")).agg(F.countDistinct("source").alias("n")))


# ── todos, plans, history, stats (F11, F12, A13, A16, L2) ────────────────────
def q_active_todos(t: Tables) -> DataFrame:
    return t.todos.where(c("status") != "completed").orderBy("item_index").select(
        "source", "session_id", "content", "status")


def q_todo_status(t: Tables) -> DataFrame:
    return t.todos.groupBy("source", "status").agg(F.count("*").alias("n"))


def q_plans_overview(t: Tables) -> DataFrame:
    return t.plans.select("source", "session_id", "plan_name", "file_name", "file_size").orderBy(c("file_size").desc())


def q_recent_commands(t: Tables, limit: int = 50) -> DataFrame:
    return (t.history.orderBy(c("line_number").desc(), "source", c("session_id").asc_nulls_last(), c("project").asc_nulls_last(),
                              c("timestamp_ms").asc_nulls_last(), c("display").asc_nulls_last()).limit(limit)
            .select("source", "display", "timestamp_ms", "project", "session_id"))


def q_history_view(t: Tables) -> DataFrame:
    from sessionlake.functions.time import ntz_from_epoch_millis
    return (t.history.select("source", F.date_format(ntz_from_epoch_millis(c("timestamp_ms")), "yyyy-MM-dd HH:mm:ss").alias("ts"),
                             "display", "project", "timestamp_ms", "line_number")
            .orderBy(c("timestamp_ms").desc_nulls_last(), c("line_number").desc()).drop("timestamp_ms", "line_number"))


def q_table_counts(t: Tables) -> DataFrame:
    parts = [(name, df) for name, df in (("conversations", t.conv_all), ("plans", t.plans), ("todos", t.todos),
                                         ("history", t.history), ("stats", t.stats))]
    out = None
    for name, df in parts:
        g = df.groupBy("source").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "source", "n")
        out = g if out is None else out.unionByName(g)
    return out


def q_overall_counts(t: Tables) -> DataFrame:
    """Five one-row aggregates side by side (a cross join of single rows)."""
    one = [t.conv_all.agg(F.count("*").alias("conversations")), t.plans.agg(F.count("*").alias("plans")),
           t.todos.agg(F.count("*").alias("todos")), t.history.agg(F.count("*").alias("history")),
           t.stats.agg(F.count("*").alias("stats"))]
    out = one[0]
    for df in one[1:]:
        out = out.crossJoin(df)
    return out


def q_recent_stats(t: Tables, limit: int = 30) -> DataFrame:
    return (t.stats.select("date", "message_count", "session_count", "tool_call_count")
            .orderBy(c("date").desc(), c("message_count").desc(), c("session_count").desc(), c("tool_call_count").desc())
            .limit(limit))


def q_stats_totals(t: Tables) -> DataFrame:
    return t.stats.agg(F.sum("message_count").cast("bigint").alias("messages"),
                       F.sum("session_count").cast("bigint").alias("sessions"),
                       F.sum("tool_call_count").cast("bigint").alias("tool_calls"))


# ── joins (J1–J8) ────────────────────────────────────────────────────────────
#: Only these assistants have history, todos or plans; the other branches of the union need no reading.
WITH_HISTORY, WITH_TODOS, WITH_PLANS = ("claude", "copilot"), ("claude", "copilot"), ("claude", "copilot", "grok")


def _of(conv: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    return conv.where(c("source").isin(*sources))


#: Joined rows of one session that one task should make at most.
PAIRS_A_TASK = 1_000_000


def conv_history(conv: DataFrame, history: DataFrame, pairs_a_task: int = PAIRS_A_TASK) -> DataFrame:
    """Rows of both sides with the same session, many to many. Sessions are
    measured first; one whose pairs exceed ``pairs_a_task`` is dealt over salts:
    its conversation rows by hash, its history rows to every salt. The small table
    of hot sessions tells the salts (AQE broadcasts it when its measured size is
    small)."""
    place = F.xxhash64("file_name", "line_number")
    # one exchange that no hot session unbalances serves the counts and the join
    x = (conv.select(*SESSION, "uuid", place.alias("_place")).where(c("session_id").isNotNull())
         .withColumn("_part", F.pmod("_place", F.lit(64))).repartition(*SESSION, "_part"))
    h = history.where(c("session_id").isNotNull()).select(*SESSION, "display")
    sizes = x.groupBy(*SESSION, "_part").agg(F.count("*").alias("_k")).groupBy(*SESSION).agg(F.sum("_k").alias("_n")).join(h.groupBy(*SESSION).agg(F.count("*").alias("_m")), SESSION)
    hot = (sizes.select(*SESSION, F.ceil(c("_n") * c("_m") / pairs_a_task).alias("_salts")).where(c("_salts") > 1)
           .groupBy(*SESSION).agg(F.max("_salts").alias("_salts")))
    salts = F.coalesce(c("_salts"), F.lit(1))
    x = x.join(hot, SESSION, "left").select(*SESSION, "uuid", F.pmod(c("_place"), salts).alias("_salt"))
    h = h.join(hot, SESSION, "left").select(*SESSION, "display", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt"))
    return x.join(h, [*SESSION, "_salt"]).select("session_id", "uuid", "display")


def q_conv_history(t: Tables) -> DataFrame:
    return conv_history(_of(t.conv, WITH_HISTORY), t.history)


def q_conv_history_project(t: Tables) -> DataFrame:
    h = t.history.where(c("project").isNotNull()).select("source", c("project").alias("project_path")).distinct()
    return _of(t.conv, WITH_HISTORY).select("source", "project_path").distinct().join(h, ["source", "project_path"], "inner").select("project_path").distinct()


def q_conv_todos(t: Tables) -> DataFrame:
    key = ["source", "session_id"]
    return _of(t.conv, WITH_TODOS).select(*key).distinct().join(t.todos.select(*key).distinct(), key, "inner").select("session_id").distinct()


def _sessions_todos(t: Tables, conv: DataFrame) -> DataFrame:
    """COUNT(DISTINCT uuid) and COUNT(DISTINCT todo content) per session,
    computed on each side *before* the join: the same answer as joining rows
    first, without the messages × todos blow-up."""
    msgs = conv.groupBy("source", "session_id", "project_path").agg(F.countDistinct("uuid").alias("messages"))
    todos = t.todos.groupBy("source", "session_id").agg(F.countDistinct("content").alias("todos"))
    return msgs.join(todos, ["source", "session_id"], "left").select(
        "source", "session_id", "project_path", "messages", F.coalesce(c("todos"), F.lit(0)).alias("todos"))


def q_sessions_with_todos(t: Tables) -> DataFrame:
    return _sessions_todos(t, _of(t.conv, WITH_TODOS)).where(c("todos") > 0)


def q_cross_source_summary(t: Tables) -> DataFrame:
    return _sessions_todos(t, t.conv)


def q_sessions_with_plans(t: Tables) -> DataFrame:
    p = t.plans.select("source", c("plan_name"), "file_size")
    return (_of(t.conv, WITH_PLANS).where(c("slug").isNotNull()).groupBy("source", "session_id", "slug").agg(F.count("*").alias("messages"))
            .join(p.withColumnRenamed("plan_name", "slug").withColumn("plan_name", c("slug")), ["source", "slug"], "inner")
            .select("source", "session_id", "slug", "plan_name", "file_size", "messages"))


def q_orphan_projects(t: Tables) -> DataFrame:
    """History projects that no conversation of the same source ran in."""
    h = t.history.where(c("project").isNotNull()).select("source", "project").distinct()
    ran = _of(t.conv, WITH_HISTORY).select("source", c("project_path").alias("project")).distinct()
    return h.join(ran, ["source", "project"], "left_anti").select("project").distinct()


def q_orphan_todos(t: Tables) -> DataFrame:
    key = ["source", "session_id"]
    return t.todos.select(*key).distinct().join(_of(t.conv, WITH_TODOS).select(*key).distinct(), key, "left_anti").select("session_id").distinct()


# ── windows over a session timeline (W2–W4) ──────────────────────────────────
#: Lines of a timeline that one window may hold.
TIMELINE_BUCKET = 4096


def _with_neighbours(x: DataFrame, value: str, bucket_lines: int = TIMELINE_BUCKET) -> DataFrame:
    """Adds ``_prev`` (the last non-null ``value`` before the row in its session's
    timeline) and ``_first`` (the session's first one).

    A timeline is cut into buckets of line numbers, its first order key. A window
    holds one bucket; what a bucket inherits comes from one row a bucket. Both
    read the same exchange, so a session of any length spreads over tasks and
    nothing is parsed twice."""
    order = F.struct(*TIMELINE_ORDER)
    x = x.withColumn("_bucket", F.floor(c("line_number") / bucket_lines)).repartition(*SESSION, "_bucket")
    at = F.when(c(value).isNotNull(), order)
    per = x.groupBy(*SESSION, "_bucket").agg(F.max_by(value, at).alias("_last_in"), F.min_by(value, at).alias("_first_in"))
    w = Window.partitionBy(*SESSION).orderBy("_bucket")
    per = per.select(*SESSION, "_bucket",
                     F.last("_last_in", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_entry"),
                     F.first("_first_in", ignorenulls=True).over(
                         w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"))
    inside = Window.partitionBy(*SESSION, "_bucket").orderBy(*TIMELINE_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    return (x.join(per, [*SESSION, "_bucket"])
            .withColumn("_prev", F.coalesce(F.last(value, ignorenulls=True).over(inside), c("_entry"))))


def _timed(conv: DataFrame) -> DataFrame:
    return conv.where(not_err()).select(*SESSION, *TIMELINE_ORDER, epoch_millis(c("timestamp")).alias("ts_ms"))


def timeline_deltas(conv: DataFrame, bucket_lines: int = TIMELINE_BUCKET) -> DataFrame:
    """Milliseconds since the previous timed event and since the first timed
    event of the session (untimed rows: NULL; first timed row: delta 0)."""
    x = _with_neighbours(_timed(conv), "ts_ms", bucket_lines)
    return x.select(*SESSION, "file_name", "line_number",
                    F.when(c("ts_ms").isNotNull(), F.coalesce(c("ts_ms") - c("_prev"), F.lit(0))).alias("delta_ms"),
                    F.when(c("ts_ms").isNotNull(), c("ts_ms") - c("_first")).alias("offset_ms"))


def q_timeline_deltas(t: Tables) -> DataFrame:
    return timeline_deltas(t.conv)


def q_session_duration(t: Tables) -> DataFrame:
    """Last minus first timed event in timeline order: two partial aggregates."""
    x = _timed(t.conv).where(c("ts_ms").isNotNull())
    o = F.struct(*TIMELINE_ORDER)
    return x.groupBy(*SESSION).agg((F.max_by("ts_ms", o) - F.min_by("ts_ms", o)).alias("duration_ms"))


def day_breaks(conv: DataFrame, bucket_lines: int = TIMELINE_BUCKET) -> DataFrame:
    # a struct around the day, so that a day that cannot be read still counts as the row before
    x = conv.where(not_err() & c("timestamp").isNotNull()).select(*SESSION, *TIMELINE_ORDER, F.struct(day_of(c("timestamp")).alias("day")).alias("_d"))
    x = _with_neighbours(x, "_d", bucket_lines)
    return x.select(*SESSION, "file_name", "line_number", c("_d.day").alias("day"),
                    F.coalesce(c("_prev.day") != c("_d.day"), F.lit(True)).alias("is_new_day"))


def q_day_breaks(t: Tables) -> DataFrame:
    return day_breaks(t.conv)


# ── set operations across all providers (U1–U3) ──────────────────────────────
def q_union_counts(t: Tables) -> DataFrame:
    return t.conv_all.groupBy("source").agg(F.count("*").alias("n"))


def q_session_collisions(t: Tables) -> DataFrame:
    conv = t.conv_all
    a = conv.where(c("source") == "claude").select("session_id").distinct()
    b = conv.where(c("source") != "claude").select("session_id").distinct()
    return a.intersect(b)


def q_distinct_sessions(t: Tables) -> DataFrame:
    return t.conv_all.select("source", "session_id", "project_path", "file_name").distinct()


# ── ad-hoc builder (F1) ──────────────────────────────────────────────────────
def q_builder(t: Tables, table: str = "conversations", columns: tuple[str, ...] = ("*",), where: str | None = None,
              order_by: tuple[str, ...] = (), limit: int | None = 100) -> DataFrame:
    """Columns / WHERE (SQL text) / ORDER BY / LIMIT over one of the five tables."""
    src = {"conversations": t.conv_all, "plans": t.plans, "todos": t.todos, "history": t.history, "stats": t.stats}[table]
    df = src.select(*columns)
    if where:
        df = df.where(F.expr(where))
    if order_by:
        df = df.orderBy(*[F.expr(o) for o in order_by])
    return df.limit(limit) if limit else df


# ── data quality (A18) ───────────────────────────────────────────────────────
def _report(table: str, df: DataFrame, rows: dict[str, Column], by: list[str] | None = None,
            measures: dict[str, Column] | None = None, groups: dict[str, Column] | None = None) -> DataFrame:
    """Violations per check in one pass. Row checks are counted per group of
    ``by`` along with the group's ``measures``; the second level adds the counts
    up and applies the ``groups`` checks to the measures."""
    per = df.groupBy(*(by or [])).agg(*[F.count_if(F.coalesce(x, F.lit(False))).alias(k) for k, x in rows.items()],
                                      *[x.alias(k) for k, x in (measures or {}).items()])
    total = per.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in rows],
                    *[F.count_if(F.coalesce(x, F.lit(False))).alias(k) for k, x in (groups or {}).items()])
    names = [*rows, *(groups or {})]
    return total.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), c(k).alias("violations")) for k in names])).alias("x")) \
        .select(F.lit(table).alias("table"), "x.check", "x.violations")


def q_quality_report(t: Tables) -> DataFrame:
    """Invariant violations, each table read once."""
    neg = F.lit(False)
    for k in ("input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens", "reasoning_tokens"):
        neg = neg | (F.coalesce(c(k), F.lit(0)) < 0)
    n = F.count("*")
    parts = [
        _report("conversations", t.conv_all, {
            "empty_session_id": c("session_id") == "",
            "negative_tokens": neg,
            "line_number_below_1": c("line_number") < 1,
            "uuid_not_uuid_shaped": c("uuid").isNotNull() & ~c("uuid").rlike(UUID_RE),
            "timestamp_not_iso": c("timestamp").isNotNull() & ~c("timestamp").rlike(ISO_RE),
            "parse_errors": c("message_type") == "_parse_error",
            "role_without_type": c("message_role").isNotNull() & c("message_type").isNull(),
        }, [*SESSION, "project_dir", "file_name"], {"lo": F.min("line_number"), "hi": F.max("line_number"), "n": n},
            {"file_min_line_not_1": c("lo") != 1, "file_max_line_not_count": c("hi") != c("n")}),
        _report("plans", t.plans, {"empty_content": c("content") == "", "non_positive_size": c("file_size") <= 0},
                ["source", "plan_name"], {"k": n}, {"duplicate_plan_name": c("k") > 1}),
        _report("todos", t.todos, {"empty_content": c("content") == "",
                                   "unknown_status": ~c("status").isin("pending", "in_progress", "completed")}),
        _report("history", t.history, {"null_display": c("display").isNull(), "null_timestamp": c("timestamp_ms").isNull()}),
        _report("stats", t.stats, {"negative_counts": (c("message_count") < 0) | (c("session_count") < 0)
                                   | (c("tool_call_count") < 0), "empty_date": c("date") == ""},
                ["source", "date"], {"k": n}, {"duplicate_date": c("k") > 1}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ── scalar functions (X1–X9) ─────────────────────────────────────────────────
def x_epoch_iso(t: Tables) -> DataFrame:
    from sessionlake.functions.time import epoch_ms_to_iso
    return t.history.select("source", "line_number", "timestamp_ms", epoch_ms_to_iso(c("timestamp_ms")).alias("iso"))


def x_date_prefix(t: Tables) -> DataFrame:
    from sessionlake.functions.time import date_prefix
    return t.conv_all.select("source", "session_id", "file_name", "line_number", date_prefix(c("timestamp")).alias("date"))


def x_parse_ts(t: Tables) -> DataFrame:
    return t.conv_all.select("source", "session_id", "file_name", "line_number", epoch_millis(c("timestamp")).alias("ts_ms"))


def x_duration_labels(t: Tables) -> DataFrame:
    d = q_session_duration(t)
    return d.select(*SESSION, "duration_ms", LB.duration_label(c("duration_ms")).alias("duration"),
                    LB.delta_label(c("duration_ms")).alias("delta"))


def x_event_summary(t: Tables) -> DataFrame:
    return t.conv.select("source", "session_id", "file_name", "line_number", LB.event_summary().alias("summary"))


def x_project_label(t: Tables) -> DataFrame:
    """Short project names; when two paths share a last component, the first
    path (in sorted order) keeps it and later ones get two components."""
    p = t.conv_all.where(c("project_path") != "").select("project_path").distinct()
    short = LB.project_short(c("project_path"))
    p = p.select("project_path", short.alias("short"))
    first = p.groupBy("short").agg(F.min("project_path").alias("owner"))
    return p.join(first, "short").select("project_path", F.when(c("project_path") == c("owner"), c("short"))
                                         .otherwise(LB.project_two_parts(c("project_path"))).alias("label"))


def x_string_basics(t: Tables) -> DataFrame:
    return t.conv.select(
        "source", "session_id", "file_name", "line_number",
        F.left(c("message_content"), F.lit(10)).alias("head"), F.right(c("message_content"), F.lit(5)).alias("tail"),
        F.length("message_content").alias("chars"), F.lower("message_type").alias("kind"),
        F.coalesce(c("model"), F.lit("none")).alias("model_or_none"),
        F.split_part(c("project_path"), F.lit("/"), F.lit(-1)).alias("project"),
        F.replace(c("session_id"), F.lit("-"), F.lit("")).alias("compact_id"),
        c("line_number").cast("string").alias("line_text"),
        F.when(c("input_tokens") > 300, F.lit("big")).when(c("input_tokens").isNotNull(), F.lit("small")).alias("size"))


def x_url_decode(t: Tables) -> DataFrame:
    from sessionlake.functions.paths import url_decode
    enc = F.url_encode(c("project_path"))
    damaged = F.concat(F.lit("%2FU%2F%zz+"), enc, F.lit("%"))
    return t.conv_all.where(c("project_path") != "").select("project_path").distinct().select(
        "project_path", enc.alias("encoded"), url_decode(enc).alias("decoded"), damaged.alias("damaged"),
        url_decode(damaged).alias("damaged_decoded"))


def x_event_json(t: Tables) -> DataFrame:
    """Each event as one JSON object without NULL members; ``tool_input`` is
    nested as JSON, not quoted text."""
    cols = [x for x in SESSION_EVENT_COLUMNS if x != "tool_input"]
    return t.conv.select("session_id", "file_name", "line_number", F.to_json(F.struct(
        *cols, F.try_parse_json(c("tool_input")).alias("tool_input"))).alias("json"))


# ── sources (S17, S18) ───────────────────────────────────────────────────────
def classify_paths(files: DataFrame, source: str | None = None) -> DataFrame:
    from sessionlake.operators.detect import classify
    return classify(files, source)


def benchmark_file_listing(spark, sf_dir: str) -> DataFrame:
    """Every file path the benchmark adapters write, once."""
    from sessionlake.sources import adapters as A
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    conv, ev, docs = read("conversations"), read("events"), read("documents")
    parts = [A.claude_lines(conv), A.copilot_lines(ev), A.codex_lines(ev), A.claude_history_lines(conv),
             A.claude_todo_files(conv), A.claude_plan_files(docs), A.claude_stats_files(ev), A.gemini_files(conv),
             A.gemini_projects(conv), A.gemini_marks(conv), A.claude_desktop_lines(conv), A.copilot_side_files(ev),
             A.copilot_checkpoint_lines(ev), A.copilot_history_files(ev), A.grok_chat_lines(conv), A.grok_side_files(conv)]
    out = None
    for p in parts:
        q = p.select("file_path")
        out = q if out is None else out.unionByName(q)
    return out.distinct()


def sink_csv_roundtrip(t: Tables) -> DataFrame:
    from sessionlake.sources.sinks import csv_roundtrip
    return csv_roundtrip(t.spark, q_source_metrics(t))
