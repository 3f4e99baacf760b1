"""Registry of every runnable query: ``name → (spark, sf_dir) → DataFrame``,
with the DuckDB oracle statement for each one that SQL can state.

Parameters (a session id, a search term, a LIMIT) are bound here to values
that exist in every benchmark scale."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.plans import oracle as O
from sessionlake.plans import queries as Q
from sessionlake.plans.tables import PROVIDERS, Tables

SESSION = "00000003-0000-4000-8000-000000000000"
COPILOT_SESSION = "00000007-c0c0-4000-8000-000000000007"
TL = "line_number, is_agent, file_name"
DAY = "strftime(TRY_CAST(left(timestamp, 10) AS DATE), '%Y-%m-%d')"
TS_MS = "epoch_ms(TRY_CAST(replace(timestamp, 'Z', '') AS TIMESTAMP))"
FIRST_MSG = """(SELECT source, session_id, left(arg_min(message_content, (line_number, is_agent, file_name)), 200) AS first_user_message
  FROM x_conv WHERE message_type = 'user' AND message_content IS NOT NULL
    AND message_content NOT LIKE '<local-command%' AND message_content NOT LIKE '<command-name>%'
  GROUP BY source, session_id)"""
INDEX = f"""(SELECT s.*, f.first_user_message FROM (
  SELECT source, session_id, project_path, slug, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
    count(*) AS event_count, count(tool_name) AS tool_calls,
    CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS total_input_tokens,
    CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS total_output_tokens
  FROM x_conv WHERE message_type <> '_parse_error' GROUP BY ALL) s
  LEFT JOIN {FIRST_MSG} f USING (source, session_id))"""


def _contains(term: str) -> str:
    return (f"(lower(coalesce(project_path, '')) LIKE '%{term}%' OR lower(coalesce(session_id, '')) LIKE '%{term}%' "
            f"OR lower(coalesce(first_user_message, '')) LIKE '%{term}%')")


def _labels(checks: dict[str, str], src: str = "x_conv") -> str:
    sel = ", ".join(f"count(*) FILTER (WHERE coalesce({cond}, false)) AS \"{k}\"" for k, cond in checks.items())
    unp = " UNION ALL ".join(f"SELECT '{k}' AS label, CAST(\"{k}\" AS BIGINT) AS n FROM a" for k in checks)
    return f"SELECT * FROM (WITH a AS (SELECT {sel} FROM {src}) {unp})"


UUID_RE = "^(?:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
ISO_RE = r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?Z)$"

# name → (query on Tables, oracle body over the x_* views or None)
_Q: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {
    # ── ingest (S1–S15) ──
    "ingest_claude": (lambda t: t.get("conv_claude"), f"SELECT {O.CONV_COLS} FROM x_claude"),
    "ingest_copilot": (lambda t: t.get("conv_copilot"), f"SELECT {O.CONV_COLS} FROM x_copilot"),
    "ingest_codex": (lambda t: t.get("conv_codex"), f"SELECT {O.CONV_COLS} FROM x_codex"),
    "ingest_gemini": (lambda t: t.get("conv_gemini"), f"SELECT {O.CONV_COLS} FROM x_gemini"),
    "ingest_gemini_pieces": (lambda t: t.get("gemini_pieces"), f"SELECT {O.CONV_COLS} FROM x_gemini"),
    "ingest_cursor": (lambda t: t.get("conv_cursor"), f"SELECT {O.CONV_COLS} FROM x_cursor"),
    "ingest_grok": (lambda t: t.get("conv_grok"), f"SELECT {O.CONV_COLS} FROM x_grok"),
    "ingest_claude_subagents": (lambda t: t.get("conv_claude").where("is_agent"), f"SELECT {O.CONV_COLS} FROM x_claude WHERE is_agent"),
    "ingest_claude_desktop": (lambda t: t.get("conv_claude_desktop"), f"SELECT {O.CONV_COLS} FROM x_claude_desktop"),
    "ingest_plans_copilot": (lambda t: t.get("plans_copilot"), "SELECT * FROM x_plans WHERE source = 'copilot'"),
    "ingest_todos_copilot": (lambda t: t.get("todos_copilot"), "SELECT * FROM x_todos WHERE source = 'copilot'"),
    "ingest_history_copilot": (lambda t: t.get("history_copilot"), "SELECT * FROM x_history WHERE source = 'copilot'"),
    "ingest_plans_claude": (lambda t: t.get("plans_claude"), "SELECT * FROM x_plans WHERE source = 'claude'"),
    "ingest_todos_claude": (lambda t: t.get("todos_claude"), "SELECT * FROM x_todos WHERE source = 'claude'"),
    "ingest_history_claude": (lambda t: t.get("history_claude"), "SELECT * FROM x_history WHERE source = 'claude'"),
    "ingest_stats_claude": (lambda t: t.get("stats_claude"), "SELECT * FROM x_stats WHERE source = 'claude'"),
    "ingest_plans_grok": (lambda t: t.get("plans_grok"), "SELECT * FROM x_grok_plans"),
    "ingest_stats_grok": (lambda t: t.get("stats_grok"), "SELECT * FROM x_grok_stats"),
    "ingest_conversations_all": (lambda t: t.conv_all, f"SELECT {O.CONV_COLS} FROM x_conv_all"),
    "ingest_history_all": (lambda t: t.history, "SELECT * FROM x_history"),
    "ingest_todos_all": (lambda t: t.todos, "SELECT * FROM x_todos"),
    "ingest_plans_all": (lambda t: t.plans, "SELECT * FROM x_plans"),
    "ingest_stats_all": (lambda t: t.stats, "SELECT * FROM x_stats"),
    # ── normalisation operators, each as the columns it produces ──
    "norm_line_numbers": (
        lambda t: t.get("line_numbers"),
        "SELECT CASE WHEN is_agent THEN 'subagents' ELSE project_dir END || '/' || file_name AS file, line_number FROM x_claude "
        "UNION ALL SELECT session_id || '/' || file_name, line_number FROM x_copilot "
        f"UNION ALL SELECT '01/rollout-2024-01-01T00-00-00-' || {O.S_CODEX.format('u')} || '.jsonl', CAST(ln AS BIGINT) FROM x_codex_b "
        f"UNION ALL SELECT DISTINCT '01/rollout-2024-01-01T00-00-00-' || {O.S_CODEX.format('u')} || '.jsonl', CAST(1 AS BIGINT) FROM x_codex_b"),
    "norm_cursor_keys": (
        lambda t: t.get("cursor_keys").select("key", "kind", "composer", "bubble"),
        f"SELECT 'bubbleId:' || {O.S_CURSOR.format('conv_id')} || ':b' || conv_id || '-' || turn AS key, 'bubble' AS kind, "
        f"{O.S_CURSOR.format('conv_id')} AS composer, 'b' || conv_id || '-' || turn AS bubble FROM conversations WHERE turn % 5 <> 4 "
        f"UNION ALL SELECT DISTINCT 'composerData:' || {O.S_CURSOR.format('conv_id')}, 'composer', {O.S_CURSOR.format('conv_id')}, NULL FROM conversations "
        f"UNION ALL SELECT 'checkpointId:' || {O.S_CURSOR.format('conv_id')}, NULL, NULL, NULL FROM conversations WHERE turn = 0"),
    "norm_parse_errors": (
        lambda t: t.conv_all.where(F.col("message_type") == "_parse_error").select(
            "source", "session_id", "file_name", "line_number", "project_path", "message_content"),
        "SELECT source, session_id, file_name, line_number, project_path, message_content FROM x_conv_all "
        "WHERE message_type = '_parse_error'"),
    "norm_claude_types": (
        lambda t: t.get("conv_claude").groupBy("message_type", "message_role").agg(F.count("*").alias("n")),
        "SELECT message_type, message_role, count(*) AS n FROM x_claude GROUP BY ALL"),
    "norm_extract_text": (
        lambda t: t.get("conv_claude").select("file_name", "line_number", "message_type", "message_content"),
        "SELECT file_name, line_number, message_type, message_content FROM x_claude"),
    "norm_first_tool": (
        lambda t: t.get("conv_claude").where(F.col("tool_name").isNotNull()).select(
            "file_name", "line_number", "tool_name", "tool_use_id", "tool_input", "stop_reason"),
        "SELECT file_name, line_number, tool_name, tool_use_id, tool_input, stop_reason FROM x_claude WHERE tool_name IS NOT NULL"),
    "norm_usage": (
        lambda t: t.get("conv_claude").where(F.col("message_type") == "assistant").select(
            "file_name", "line_number", "model", "input_tokens", "output_tokens", "cache_creation_tokens", "cache_read_tokens"),
        "SELECT file_name, line_number, model, input_tokens, output_tokens, cache_creation_tokens, cache_read_tokens "
        "FROM x_claude WHERE message_type = 'assistant'"),
    "norm_project_path": (
        lambda t: t.get("conv_claude").select("project_dir", "project_path").distinct(),
        "SELECT DISTINCT project_dir, project_path FROM x_claude"),
    "norm_cwd_backfill": (
        lambda t: t.get("conv_claude").where(F.col("cwd").isNull()).select("file_name", "line_number", "project_path"),
        "SELECT file_name, line_number, project_path FROM x_claude WHERE cwd IS NULL"),
    "norm_session_fallback": (
        lambda t: t.get("conv_claude").select("file_name", "is_agent", "session_id").distinct(),
        "SELECT DISTINCT file_name, is_agent, session_id FROM x_claude"),
    "norm_copilot_types": (
        lambda t: t.get("conv_copilot").groupBy("message_type", "message_role").agg(F.count("*").alias("n")),
        "SELECT message_type, message_role, count(*) AS n FROM x_copilot GROUP BY ALL"),
    "norm_copilot_carry": (
        lambda t: t.get("conv_copilot").select("session_id", "line_number", "model", "version", "cwd", "git_branch",
                                              "repository", "project_path"),
        "SELECT session_id, line_number, model, version, cwd, git_branch, repository, project_path FROM x_copilot"),
    "norm_copilot_fields": (
        lambda t: t.get("conv_copilot").select("session_id", "line_number", "message_content", "tool_name", "tool_use_id",
                                              "tool_input", "input_tokens", "output_tokens"),
        "SELECT session_id, line_number, message_content, tool_name, tool_use_id, tool_input, input_tokens, output_tokens "
        "FROM x_copilot"),
    "norm_codex_carry": (
        lambda t: t.get("conv_codex").select("session_id", "line_number", "model", "version", "cwd", "git_branch", "repository"),
        "SELECT session_id, line_number, model, version, cwd, git_branch, repository FROM x_codex"),
    "norm_codex_dedup": (
        lambda t: t.get("conv_codex").groupBy("session_id", "message_type").agg(F.count("*").alias("n")),
        "SELECT session_id, message_type, count(*) AS n FROM x_codex GROUP BY ALL"),
    "norm_codex_items": (
        lambda t: t.get("conv_codex").select("session_id", "line_number", "message_type", "message_role",
                                            "message_content", "tool_name", "tool_use_id", "tool_input"),
        "SELECT session_id, line_number, message_type, message_role, message_content, tool_name, tool_use_id, tool_input "
        "FROM x_codex"),
    "norm_gemini_fanout": (
        lambda t: t.get("conv_gemini").where(F.col("message_type") == "tool_call").select(
            "session_id", "line_number", "uuid", "parent_uuid", "timestamp", "tool_name", "tool_input", "message_content"),
        "SELECT session_id, line_number, uuid, parent_uuid, timestamp, tool_name, tool_input, message_content "
        "FROM x_gemini WHERE message_type = 'tool_call'"),
    "norm_gemini_alias": (
        lambda t: t.get("conv_gemini").select("project_dir", "project_path", "cwd").distinct(),
        "SELECT DISTINCT project_dir, project_path, cwd FROM x_gemini"),
    "norm_cursor_join": (
        lambda t: t.get("conv_cursor").select("session_id", "line_number", "uuid", "message_type", "message_content",
                                             "timestamp", "tool_name", "tool_input", "is_agent"),
        "SELECT session_id, line_number, uuid, message_type, message_content, timestamp, tool_name, tool_input, is_agent "
        "FROM x_cursor"),
    "norm_cursor_parent": (
        lambda t: t.get("conv_cursor").select("session_id", "line_number", "uuid", "parent_uuid"),
        "SELECT session_id, line_number, uuid, parent_uuid FROM x_cursor"),
    "norm_grok_summary": (
        lambda t: t.get("conv_grok").select("session_id", "project_path", "slug", "git_branch", "version", "repository",
                                           "cwd").distinct(),
        "SELECT DISTINCT session_id, project_path, slug, git_branch, version, repository, cwd FROM x_grok"),
    "norm_grok_usage": (
        lambda t: t.get("conv_grok").select("session_id", "input_tokens", "output_tokens", "cache_read_tokens",
                                           "reasoning_tokens").distinct(),
        "SELECT DISTINCT session_id, input_tokens, output_tokens, cache_read_tokens, reasoning_tokens FROM x_grok"),
    "norm_grok_timeline": (
        lambda t: t.get("conv_grok").select("session_id", "line_number", "message_type", "timestamp"),
        "SELECT session_id, line_number, message_type, timestamp FROM x_grok"),
    "norm_grok_subagents": (
        lambda t: t.get("conv_grok").select("session_id", "is_agent", "parent_uuid").distinct(),
        "SELECT DISTINCT session_id, is_agent, parent_uuid FROM x_grok"),
    "norm_grok_fanout": (
        lambda t: t.get("conv_grok").select("session_id", "line_number", "message_type", "uuid", "message_content", "model",
                                           "reasoning_effort", "tool_name", "tool_use_id", "tool_input"),
        "SELECT session_id, line_number, message_type, uuid, message_content, model, reasoning_effort, tool_name, "
        "tool_use_id, tool_input FROM x_grok"),
    # ── overview aggregates ──
    "q_source_metrics": (Q.q_source_metrics,
                         "SELECT source, count(DISTINCT session_id) AS sessions, count(*) AS messages FROM x_conv GROUP BY source"),
    "q_totals": (Q.q_totals, "SELECT count(DISTINCT session_id) AS sessions, count(*) AS messages FROM x_conv"),
    "q_messages_by_source": (Q.q_messages_by_source, "SELECT source, count(*) AS messages FROM x_conv GROUP BY source"),
    "q_message_types_top": (Q.q_message_types_top,
                            "SELECT message_type, count(*) AS n FROM x_conv WHERE message_type IS NOT NULL GROUP BY 1 "
                            "ORDER BY n DESC, message_type LIMIT 10"),
    "q_types_by_source": (Q.q_types_by_source,
                          "SELECT source, message_type, count(*) AS n FROM x_conv WHERE message_type <> '_parse_error' GROUP BY ALL"),
    "q_daily_activity": (Q.q_daily_activity,
                         f"SELECT {DAY} AS day, source, count(*) AS messages FROM x_conv WHERE timestamp IS NOT NULL GROUP BY ALL"),
    "q_daily_pivot": (Q.q_daily_pivot,
                      f"SELECT {DAY} AS day, " + ", ".join(f"count(*) FILTER (WHERE source = '{s}') AS \"{s}\"" for s in PROVIDERS)
                      + " FROM x_conv WHERE timestamp IS NOT NULL GROUP BY 1"),
    "q_activity_14d": (Q.q_activity_14d,
                       f"SELECT {DAY} AS day, count(*) AS messages FROM x_conv WHERE timestamp IS NOT NULL GROUP BY 1 "
                       "ORDER BY day LIMIT 14"),
    "q_sessions_by_day": (Q.q_sessions_by_day,
                          f"SELECT {DAY} AS day, count(DISTINCT session_id) AS sessions FROM x_conv WHERE timestamp IS NOT NULL "
                          "GROUP BY 1 ORDER BY day DESC LIMIT 7"),
    "q_top_projects": (Q.q_top_projects,
                       "SELECT coalesce(split_part(project_path, '/', -1), 'unknown') AS project, count(*) AS messages FROM x_conv "
                       "WHERE project_path IS NOT NULL AND project_path <> '' GROUP BY 1 ORDER BY messages DESC, project LIMIT 10"),
    "q_tokens_by_source": (Q.q_tokens_by_source,
                           "SELECT source, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens, "
                           "CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens FROM x_conv GROUP BY source"),
    "q_tokens_dedup": (Q.q_tokens_dedup,
                       "SELECT source, CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(o) AS BIGINT) AS output_tokens FROM ("
                       "SELECT source, session_id, CASE WHEN source = 'grok' THEN max(coalesce(input_tokens, 0)) "
                       "ELSE sum(coalesce(input_tokens, 0)) END AS i, CASE WHEN source = 'grok' THEN max(coalesce(output_tokens, 0)) "
                       "ELSE sum(coalesce(output_tokens, 0)) END AS o FROM x_conv_all GROUP BY source, session_id) GROUP BY source"),
    "q_top_tools": (Q.q_top_tools,
                    "SELECT tool_name, count(*) AS uses FROM x_conv WHERE tool_name IS NOT NULL AND tool_name <> '' GROUP BY 1 "
                    "ORDER BY uses DESC, tool_name LIMIT 15"),
    "q_tools_per_session": (Q.q_tools_per_session,
                            "SELECT source, session_id, count(DISTINCT tool_name) AS unique_tools, count(tool_name) AS total_tool_calls "
                            "FROM x_conv GROUP BY 1, 2 ORDER BY total_tool_calls DESC, source, session_id LIMIT 20"),
    "q_session_overview": (Q.q_session_overview,
                           "SELECT source, session_id, project_path, count(*) AS msg_count, min(timestamp) AS started, "
                           "max(timestamp) AS ended FROM x_conv WHERE message_type <> '_parse_error' GROUP BY ALL "
                           "ORDER BY started DESC NULLS LAST, source, session_id, project_path LIMIT 50"),
    "q_longest_sessions": (Q.q_longest_sessions,
                           "SELECT source, session_id, project_path, count(*) AS messages, "
                           "CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS total_input_tokens, "
                           "CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS total_output_tokens FROM x_conv "
                           "WHERE message_type <> '_parse_error' GROUP BY ALL ORDER BY messages DESC, source, session_id, project_path LIMIT 10"),
    "q_models_used": (Q.q_models_used,
                      "SELECT model, count(*) AS messages, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens, "
                      "CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens FROM x_conv WHERE model IS NOT NULL GROUP BY 1"),
    "q_having": (Q.q_having, "SELECT source, session_id, count(*) AS n FROM x_conv GROUP BY 1, 2 HAVING count(*) = 6"),
    # ── session index and browser ──
    "q_first_user_message": (Q.q_first_user_message, f"SELECT * FROM {FIRST_MSG}"),
    "q_session_index": (Q.q_session_index, f"SELECT * FROM {INDEX}"),
    "q_session_search": (Q.q_session_search, f"SELECT * FROM {INDEX} WHERE {_contains('app3')}"),
    "q_session_exclude": (Q.q_session_exclude,
                          f"SELECT * FROM {INDEX} WHERE project_path IN ('/work/repo1', '/work/repo2', '/home/dev/my-app2') "
                          f"AND event_count >= 5 AND NOT {_contains('repo1')}"),
    "q_session_table": (Q.q_session_table,
                        f"SELECT source, coalesce(left(last_ts, 16), '—') AS last_active, event_count AS events, "
                        "CASE WHEN project_path IS NULL THEN '—' WHEN project_path LIKE '%/%' THEN split_part(project_path, '/', -1) "
                        "ELSE project_path END AS project, coalesce(left(replace(first_user_message, chr(10), ' '), 120), '—') "
                        f"AS first_message FROM {INDEX}"),
    "q_session_events": (lambda t: Q.q_session_events(t, SESSION),
                         "SELECT line_number, message_type, message_role, timestamp, model, tool_name, tool_use_id, tool_input, "
                         "message_content, input_tokens, output_tokens, cache_creation_tokens, cache_read_tokens, stop_reason, uuid, "
                         f"parent_uuid, slug, git_branch, cwd, version FROM x_conv WHERE session_id = '{SESSION}' "
                         "AND message_type <> '_parse_error'"),
    "q_session_messages": (lambda t: Q.q_session_messages(t, COPILOT_SESSION),
                           "SELECT line_number, message_type, message_role, timestamp, message_content, tool_name, model "
                           f"FROM x_conv WHERE session_id = '{COPILOT_SESSION}'"),
    "q_event_search": (Q.q_event_search,
                       "SELECT session_id, line_number, message_type, tool_name, message_content FROM x_conv "
                       "WHERE message_type IN ('user', 'assistant', 'tool_start') AND ("
                       "lower(coalesce(message_content, '')) LIKE '%read%' OR lower(coalesce(tool_name, '')) LIKE '%read%' "
                       "OR lower(coalesce(message_type, '')) LIKE '%read%')"),
    # ── predicates ──
    "q_filters": (Q.q_filters, _labels({
        "claude_agent_rows": "source = 'claude' AND is_agent",
        "assistant_with_tokens_100_500": "message_type = 'assistant' AND input_tokens BETWEEN 100 AND 500",
        "tool_in_read_edit": "tool_name IN ('Read', 'Edit')",
        "cwd_null": "cwd IS NULL",
        "uuid_not_null": "uuid IS NOT NULL",
        "not_agent_user": "NOT is_agent AND message_type = 'user'",
        "cache_read_gt_0": "cache_read_tokens > 0"})),
    "q_prefix_filters": (Q.q_prefix_filters, _labels({
        "tool_use_id_like_toolu": "tool_use_id LIKE 'toolu\\_%' ESCAPE '\\'",
        "tool_use_id_not_like_toolu": "tool_use_id NOT LIKE 'toolu\\_%' ESCAPE '\\'",
        "file_name_starts_agent": "starts_with(file_name, 'agent-')",
        "content_like_command": "message_content LIKE '<command-name>%'",
        "project_like_home": "project_path LIKE '/home/%'"})),
    "q_regex_validate": (Q.q_regex_validate, _labels({
        "uuid_shaped": f"regexp_full_match(uuid, '{UUID_RE}')",
        "uuid_not_shaped": f"uuid IS NOT NULL AND NOT regexp_full_match(uuid, '{UUID_RE}')",
        "timestamp_iso": f"regexp_full_match(timestamp, '{ISO_RE}')",
        "session_uuid_shaped": f"regexp_full_match(session_id, '{UUID_RE}')"})),
    "q_source_filter": (Q.q_source_filter,
                        "SELECT message_type AS label, count(*) AS n FROM x_conv WHERE source = 'copilot' GROUP BY 1"),
    "q_exclusive_types": (Q.q_exclusive_types,
                          "SELECT message_type AS label, count(DISTINCT source) AS n FROM x_conv_all GROUP BY 1"),
    # ── side tables ──
    "q_active_todos": (Q.q_active_todos, "SELECT source, session_id, content, status FROM x_todos WHERE status <> 'completed'"),
    "q_todo_status": (Q.q_todo_status, "SELECT source, status, count(*) AS n FROM x_todos GROUP BY ALL"),
    "q_plans_overview": (Q.q_plans_overview, "SELECT source, session_id, plan_name, file_name, file_size FROM x_plans"),
    "q_recent_commands": (Q.q_recent_commands,
                          "SELECT source, display, timestamp_ms, project, session_id FROM x_history "
                          "ORDER BY line_number DESC, source, session_id, project, timestamp_ms, display LIMIT 50"),
    "q_history_view": (Q.q_history_view,
                       "SELECT source, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d %H:%M:%S') AS ts, display, project "
                       "FROM x_history"),
    "q_table_counts": (Q.q_table_counts,
                       "SELECT 'conversations' AS \"table\", source, count(*) AS n FROM x_conv_all GROUP BY source UNION ALL "
                       "SELECT 'plans', source, count(*) FROM x_plans GROUP BY source UNION ALL "
                       "SELECT 'todos', source, count(*) FROM x_todos GROUP BY source UNION ALL "
                       "SELECT 'history', source, count(*) FROM x_history GROUP BY source UNION ALL "
                       "SELECT 'stats', source, count(*) FROM x_stats GROUP BY source"),
    "q_overall_counts": (Q.q_overall_counts,
                         "SELECT (SELECT count(*) FROM x_conv_all) AS conversations, (SELECT count(*) FROM x_plans) AS plans, "
                         "(SELECT count(*) FROM x_todos) AS todos, (SELECT count(*) FROM x_history) AS history, "
                         "(SELECT count(*) FROM x_stats) AS stats"),
    "q_recent_stats": (Q.q_recent_stats,
                       "SELECT date, message_count, session_count, tool_call_count FROM x_stats "
                       "ORDER BY date DESC, message_count DESC, session_count DESC, tool_call_count DESC LIMIT 30"),
    "q_stats_totals": (Q.q_stats_totals,
                       "SELECT CAST(sum(message_count) AS BIGINT) AS messages, CAST(sum(session_count) AS BIGINT) AS sessions, "
                       "CAST(sum(tool_call_count) AS BIGINT) AS tool_calls FROM x_stats"),
    # ── joins ──
    "q_conv_history": (Q.q_conv_history,
                       "SELECT c.session_id, c.uuid, h.display FROM x_conv c JOIN x_history h ON c.session_id = h.session_id AND c.source = h.source"),
    "q_conv_history_project": (Q.q_conv_history_project,
                               "SELECT DISTINCT c.project_path FROM x_conv c JOIN x_history h ON c.project_path = h.project AND c.source = h.source"),
    "q_conv_todos": (Q.q_conv_todos, "SELECT DISTINCT c.session_id FROM x_conv c JOIN x_todos t ON c.session_id = t.session_id AND c.source = t.source"),
    "q_sessions_with_todos": (Q.q_sessions_with_todos,
                              "SELECT c.source, c.session_id, c.project_path, count(DISTINCT c.uuid) AS messages, "
                              "count(DISTINCT t.content) AS todos FROM x_conv c LEFT JOIN x_todos t "
                              "ON c.session_id = t.session_id AND c.source = t.source GROUP BY ALL HAVING count(DISTINCT t.content) > 0"),
    "q_cross_source_summary": (Q.q_cross_source_summary,
                               "SELECT c.source, c.session_id, c.project_path, count(DISTINCT c.uuid) AS messages, "
                               "count(DISTINCT t.content) AS todos FROM x_conv c LEFT JOIN x_todos t "
                               "ON c.session_id = t.session_id AND c.source = t.source GROUP BY ALL"),
    "q_sessions_with_plans": (Q.q_sessions_with_plans,
                              "SELECT c.source, c.session_id, c.slug, p.plan_name, p.file_size, count(*) AS messages "
                              "FROM x_conv c JOIN x_plans p ON c.slug = p.plan_name AND c.source = p.source GROUP BY ALL"),
    "q_orphan_projects": (Q.q_orphan_projects,
                          "SELECT DISTINCT project FROM x_history h WHERE project IS NOT NULL AND NOT EXISTS (SELECT 1 FROM x_conv c "
                          "WHERE c.source = h.source AND c.project_path = h.project)"),
    "q_orphan_todos": (Q.q_orphan_todos,
                       "SELECT DISTINCT session_id FROM x_todos t WHERE NOT EXISTS (SELECT 1 FROM x_conv c "
                       "WHERE c.source = t.source AND c.session_id = t.session_id)"),
    # ── timeline windows ──
    "q_timeline_deltas": (Q.q_timeline_deltas,
                          f"SELECT source, session_id, file_name, line_number, CASE WHEN ts_ms IS NOT NULL THEN coalesce(ts_ms - "
                          f"last_value(ts_ms IGNORE NULLS) OVER (PARTITION BY source, session_id ORDER BY {TL} ROWS BETWEEN UNBOUNDED "
                          f"PRECEDING AND 1 PRECEDING), 0) END AS delta_ms, CASE WHEN ts_ms IS NOT NULL THEN ts_ms - "
                          f"first_value(ts_ms IGNORE NULLS) OVER (PARTITION BY source, session_id ORDER BY {TL} ROWS BETWEEN UNBOUNDED "
                          f"PRECEDING AND UNBOUNDED FOLLOWING) END AS offset_ms FROM (SELECT source, session_id, file_name, line_number, "
                          f"is_agent, {TS_MS} AS ts_ms FROM x_conv WHERE message_type <> '_parse_error')"),
    "q_session_duration": (Q.q_session_duration,
                           f"SELECT source, session_id, arg_max(ts_ms, ({TL})) - arg_min(ts_ms, ({TL})) AS duration_ms FROM ("
                           f"SELECT source, session_id, file_name, line_number, is_agent, {TS_MS} AS ts_ms FROM x_conv "
                           "WHERE message_type <> '_parse_error') WHERE ts_ms IS NOT NULL GROUP BY 1, 2"),
    "q_day_breaks": (Q.q_day_breaks,
                     f"SELECT source, session_id, file_name, line_number, day, coalesce(lag(day) OVER (PARTITION BY source, session_id ORDER BY {TL}) "
                     f"<> day, true) AS is_new_day FROM (SELECT source, session_id, file_name, line_number, is_agent, {DAY} AS day "
                     "FROM x_conv WHERE message_type <> '_parse_error' AND timestamp IS NOT NULL)"),
    # ── set operations ──
    "q_union_counts": (Q.q_union_counts, "SELECT source, count(*) AS n FROM x_conv_all GROUP BY source"),
    "q_session_collisions": (Q.q_session_collisions,
                             "SELECT session_id FROM x_conv_all WHERE source = 'claude' INTERSECT "
                             "SELECT session_id FROM x_conv_all WHERE source <> 'claude'"),
    "q_distinct_sessions": (Q.q_distinct_sessions,
                            "SELECT DISTINCT source, session_id, project_path, file_name FROM x_conv_all"),
}


_TOOLS = "['Read','Edit','Bash','Grep','Write']"
_Q.update({
    "q_builder": (
        lambda t: Q.q_builder(t, "conversations", ("source", "session_id", "file_name", "line_number", "tool_name"),
                              "tool_name IS NOT NULL AND source IN ('claude', 'copilot')",
                              ("session_id", "file_name", "line_number"), 100),
        "SELECT source, session_id, file_name, line_number, tool_name FROM x_conv_all WHERE tool_name IS NOT NULL "
        "AND source IN ('claude', 'copilot') ORDER BY session_id, file_name, line_number LIMIT 100"),
    "q_quality_report": (Q.q_quality_report, """SELECT * FROM (
  WITH cv AS (SELECT * FROM x_conv_all),
  f AS (SELECT min(line_number) AS lo, max(line_number) AS hi, count(*) AS n FROM cv GROUP BY source, session_id, project_dir, file_name),
  pn AS (SELECT count(*) AS k FROM x_plans GROUP BY source, plan_name),
  sd AS (SELECT count(*) AS k FROM x_stats GROUP BY source, date)
  SELECT 'conversations' AS "table", 'empty_session_id' AS "check", count(*) FILTER (WHERE session_id = '') AS violations FROM cv
  UNION ALL SELECT 'conversations', 'negative_tokens', count(*) FILTER (WHERE input_tokens < 0 OR output_tokens < 0
    OR cache_creation_tokens < 0 OR cache_read_tokens < 0 OR reasoning_tokens < 0) FROM cv
  UNION ALL SELECT 'conversations', 'line_number_below_1', count(*) FILTER (WHERE line_number < 1) FROM cv
  UNION ALL SELECT 'conversations', 'uuid_not_uuid_shaped', count(*) FILTER (WHERE uuid IS NOT NULL
    AND NOT regexp_full_match(uuid, '""" + UUID_RE + """')) FROM cv
  UNION ALL SELECT 'conversations', 'timestamp_not_iso', count(*) FILTER (WHERE timestamp IS NOT NULL
    AND NOT regexp_full_match(timestamp, '""" + ISO_RE + """')) FROM cv
  UNION ALL SELECT 'conversations', 'parse_errors', count(*) FILTER (WHERE message_type = '_parse_error') FROM cv
  UNION ALL SELECT 'conversations', 'role_without_type', count(*) FILTER (WHERE message_role IS NOT NULL AND message_type IS NULL) FROM cv
  UNION ALL SELECT 'conversations', 'file_min_line_not_1', count(*) FILTER (WHERE lo <> 1) FROM f
  UNION ALL SELECT 'conversations', 'file_max_line_not_count', count(*) FILTER (WHERE hi <> n) FROM f
  UNION ALL SELECT 'plans', 'empty_content', count(*) FILTER (WHERE content = '') FROM x_plans
  UNION ALL SELECT 'plans', 'non_positive_size', count(*) FILTER (WHERE file_size <= 0) FROM x_plans
  UNION ALL SELECT 'plans', 'duplicate_plan_name', count(*) FILTER (WHERE k > 1) FROM pn
  UNION ALL SELECT 'todos', 'empty_content', count(*) FILTER (WHERE content = '') FROM x_todos
  UNION ALL SELECT 'todos', 'unknown_status', count(*) FILTER (WHERE status NOT IN ('pending', 'in_progress', 'completed')) FROM x_todos
  UNION ALL SELECT 'history', 'null_display', count(*) FILTER (WHERE display IS NULL) FROM x_history
  UNION ALL SELECT 'history', 'null_timestamp', count(*) FILTER (WHERE timestamp_ms IS NULL) FROM x_history
  UNION ALL SELECT 'stats', 'negative_counts', count(*) FILTER (WHERE message_count < 0 OR session_count < 0 OR tool_call_count < 0) FROM x_stats
  UNION ALL SELECT 'stats', 'empty_date', count(*) FILTER (WHERE date = '') FROM x_stats
  UNION ALL SELECT 'stats', 'duplicate_date', count(*) FILTER (WHERE k > 1) FROM sd)"""),
    "x_epoch_iso": (Q.x_epoch_iso,
                    "SELECT source, line_number, timestamp_ms, strftime(make_timestamp((timestamp_ms // 1000) * 1000000), "
                    "'%Y-%m-%dT%H:%M:%SZ') AS iso FROM x_history"),
    "x_date_prefix": (Q.x_date_prefix,
                      "SELECT source, session_id, file_name, line_number, CASE WHEN regexp_matches(timestamp, '^.{4}-.{2}-.{2}') "
                      "THEN left(timestamp, 10) END AS date FROM x_conv_all"),
    "x_parse_ts": (Q.x_parse_ts, f"SELECT source, session_id, file_name, line_number, {TS_MS} AS ts_ms FROM x_conv_all"),
    "x_duration_labels": (Q.x_duration_labels, """SELECT source, session_id, duration_ms,
  CASE WHEN duration_ms IS NULL OR duration_ms <= 0 THEN ''
       WHEN duration_ms < 60000 THEN printf('%.1f', duration_ms / 1000.0) || 's'
       WHEN duration_ms < 3600000 THEN (duration_ms // 60000) || 'm ' || lpad(CAST((duration_ms % 60000) // 1000 AS VARCHAR), 2, '0') || 's'
       ELSE (duration_ms // 3600000) || 'h ' || ((duration_ms % 3600000) // 60000) || 'm' END AS duration,
  CASE WHEN duration_ms IS NULL OR duration_ms <= 0 THEN ''
       WHEN duration_ms < 1000 THEN '+' || duration_ms || 'ms'
       WHEN duration_ms < 60000 THEN '+' || printf('%.1f', duration_ms / 1000.0) || 's'
       ELSE '+' || (duration_ms // 60000) || 'm ' || lpad(CAST((duration_ms % 60000) // 1000 AS VARCHAR), 2, '0') || 's' END AS delta
FROM (""" + f"SELECT source, session_id, arg_max(ts_ms, ({TL})) - arg_min(ts_ms, ({TL})) AS duration_ms FROM ("
        f"SELECT source, session_id, file_name, line_number, is_agent, {TS_MS} AS ts_ms FROM x_conv "
        "WHERE message_type <> '_parse_error') WHERE ts_ms IS NOT NULL GROUP BY 1, 2)"),
    "x_event_summary": (Q.x_event_summary, """SELECT source, session_id, file_name, line_number,
  CASE WHEN length(s) > 300 THEN left(s, 300) || '…' ELSE s END AS summary FROM (
  SELECT *, CASE
    WHEN message_type = 'user' THEN CASE WHEN ct <> '' THEN ct ELSE '(empty)' END
    WHEN message_type = 'assistant' THEN CASE WHEN tl <> '' THEN 'calls ' || tl WHEN ct <> '' THEN ct ELSE '(no content)' END
    WHEN message_type = 'tool_start' THEN '⚡ ' || tl || '(' || CASE WHEN tool_input IS NULL OR tool_input = '' THEN ''
         WHEN json_type(tool_input) <> 'OBJECT' THEN '…'
         ELSE array_to_string(list_transform(json_keys(tool_input)[1:2], lambda k: k || '=…'), ', ') END || ')'
    WHEN message_type = 'tool_result' THEN '✓ ' || tl || ' completed'
    WHEN message_type = 'session_start' THEN CASE WHEN version IS NOT NULL THEN 'Session started — v' || version ELSE 'Session started' END
    WHEN message_type = 'session_info' THEN CASE WHEN ct <> '' THEN ct ELSE 'Session info' END
    WHEN message_type = 'session_error' THEN CASE WHEN ct <> '' THEN ct ELSE 'Error' END
    WHEN message_type = 'turn_start' THEN 'Turn started'
    WHEN message_type = 'turn_end' THEN 'Turn ended'
    WHEN message_type = 'truncation' THEN CASE WHEN input_tokens IS NOT NULL THEN 'Truncation: ' || input_tokens || ' tokens' ELSE 'Truncation' END
    WHEN message_type = 'reasoning' THEN CASE WHEN ct <> '' THEN ct ELSE 'Reasoning' END
    ELSE CASE WHEN ct <> '' THEN ct ELSE coalesce(message_type, '') END END AS s
  FROM (SELECT *, trim(replace(coalesce(message_content, ''), chr(10), ' ')) AS ct, coalesce(tool_name, '') AS tl FROM x_conv))"""),
    "x_project_label": (Q.x_project_label,
                        "SELECT project_path, CASE WHEN row_number() OVER (PARTITION BY short ORDER BY project_path) = 1 THEN short "
                        "WHEN len(string_split(project_path, '/')) >= 2 THEN array_to_string(string_split(project_path, '/')[-2:], '/') "
                        "ELSE project_path END AS label FROM (SELECT DISTINCT project_path, CASE WHEN project_path LIKE '%/%' "
                        "THEN split_part(project_path, '/', -1) ELSE project_path END AS short FROM x_conv_all WHERE project_path <> '')"),
    "x_string_basics": (Q.x_string_basics,
                        "SELECT source, session_id, file_name, line_number, left(message_content, 10) AS head, "
                        "right(message_content, 5) AS tail, CAST(length(message_content) AS INTEGER) AS chars, lower(message_type) AS kind, "
                        "coalesce(model, 'none') AS model_or_none, split_part(project_path, '/', -1) AS project, "
                        "replace(session_id, '-', '') AS compact_id, CAST(line_number AS VARCHAR) AS line_text, "
                        "CASE WHEN input_tokens > 300 THEN 'big' WHEN input_tokens IS NOT NULL THEN 'small' END AS size FROM x_conv"),
    "x_url_decode": (Q.x_url_decode,
                     "SELECT project_path, replace(url_encode(project_path), '%20', '+') AS encoded, project_path AS decoded, "
                     "'%2FU%2F' || chr(37) || 'zz+' || url_encode(project_path) || chr(37) AS damaged, "
                     "'/U/' || chr(37) || 'zz+' || project_path || chr(37) AS damaged_decoded "
                     "FROM (SELECT DISTINCT project_path FROM x_conv_all WHERE project_path <> '')"),
    "x_event_json": (Q.x_event_json, None),
    "sink_csv_roundtrip": (Q.sink_csv_roundtrip,
                           "SELECT source, CAST(count(DISTINCT session_id) AS VARCHAR) AS sessions, CAST(count(*) AS VARCHAR) AS messages "
                           "FROM x_conv GROUP BY source"),
})


def _classify_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    # desktop folders are named by a hash that SQL does not have; tests cover them
    files = Q.benchmark_file_listing(spark, sf_dir)
    return Q.classify_paths(files).where(~F.col("file_path").contains("local-agent-mode-sessions"))


_GROK_DIR = "'/lake/grok/sessions/%2Fhome%2Fdev%2Fgrok' || ({0} % 3) || '/' || " + O.S_GROK.format("{0}")
_CLASSIFY_SQL = O.sql(f"""SELECT DISTINCT file_path, source, kind, root, project_dir, session_id, is_agent FROM (
  SELECT '/lake/claude/projects/' || project_dir || CASE WHEN is_agent THEN '/' || session_id || '/subagents/' ELSE '/' END || file_name AS file_path,
    'claude' AS source, 'conversations' AS kind, '/lake/claude' AS root, project_dir, session_id, is_agent FROM x_claude
  UNION ALL SELECT '/lake/copilot/session-state/' || session_id || '/events.jsonl', 'copilot', 'conversations', '/lake/copilot', NULL, session_id, false FROM x_copilot
  UNION ALL SELECT '/lake/copilot/session-state/' || session_id || '/plan.md', 'copilot', 'plans', '/lake/copilot', NULL, session_id, false
    FROM x_plans WHERE source = 'copilot'
  UNION ALL SELECT '/lake/copilot/session-state/' || {O.S_COPILOT.format('user_id')} || '/workspace.yaml', 'copilot', 'metadata', '/lake/copilot', NULL,
    {O.S_COPILOT.format('user_id')}, false FROM events WHERE user_id % 4 <> 1
  UNION ALL SELECT '/lake/copilot/session-state/' || {O.S_COPILOT.format('user_id')} || '/checkpoints/' || f, 'copilot', 'todos', '/lake/copilot', NULL,
    {O.S_COPILOT.format('user_id')}, false FROM events, (SELECT unnest(['001.md', 'index.md']) AS f) k
  UNION ALL SELECT '/lake/copilot/u' || user_id || '/command-history-state.json', NULL, NULL, NULL, NULL, NULL, false FROM events WHERE event_type = 'click'
  UNION ALL SELECT '/lake/codex/sessions/2024/01/01/' || file_name, 'codex', 'conversations', '/lake/codex', NULL, session_id, false FROM (
    SELECT 'rollout-2024-01-01T00-00-00-' || {O.S_CODEX.format('user_id')} || '.jsonl' AS file_name, {O.S_CODEX.format('user_id')} AS session_id FROM events)
  UNION ALL SELECT '/lake/claude/history.jsonl', 'claude', 'history', '/lake/claude', NULL, NULL, false FROM conversations WHERE role = 'user'
  UNION ALL SELECT '/lake/claude/todos/' || file_name, 'claude', 'todos', '/lake/claude', NULL, session_id, false FROM x_todos WHERE source = 'claude'
  UNION ALL SELECT '/lake/claude/plans/plan-' || doc_id || '.md', 'claude', 'plans', '/lake/claude', NULL, NULL, false FROM documents
  UNION ALL SELECT '/lake/claude/u' || (user_id % 4) || '/stats-cache.json', NULL, NULL, NULL, NULL, NULL, false FROM events
  UNION ALL SELECT '/lake/gemini/tmp/' || dir || '/chats/session-' || c || '.json', 'gemini', 'conversations', '/lake/gemini', dir, NULL, false FROM x_gemini_b
  UNION ALL SELECT '/lake/gemini/' || f, 'gemini', 'metadata', '/lake/gemini', NULL, NULL, false FROM (SELECT unnest(['projects.json', 'installation_id']) AS f)
  UNION ALL SELECT {_GROK_DIR.format('conv_id')} || '/chat_history.jsonl', 'grok', 'conversations', '/lake/grok', '%2Fhome%2Fdev%2Fgrok' || (conv_id % 3),
    {O.S_GROK.format('conv_id')}, false FROM conversations
  UNION ALL SELECT {_GROK_DIR.format('conv_id')} || '/' || f, 'grok', CASE WHEN f = 'plan.md' THEN 'plans' ELSE 'metadata' END, '/lake/grok',
    '%2Fhome%2Fdev%2Fgrok' || (conv_id % 3), {O.S_GROK.format('conv_id')}, false
    FROM conversations, (SELECT unnest(['summary.json', 'signals.json', 'plan.md']) AS f) k WHERE f <> 'signals.json' OR conv_id % 7 <> 3
  UNION ALL SELECT {_GROK_DIR.format('conv_id - 1').replace('(conv_id - 1 % 3)', '((conv_id - 1) % 3)')} || '/subagents/' || {O.S_GROK.format('conv_id')} || '/meta.json', 'grok', 'metadata',
    '/lake/grok', '%2Fhome%2Fdev%2Fgrok' || ((conv_id - 1) % 3), {O.S_GROK.format('(conv_id - 1)')}, false FROM conversations WHERE conv_id % 6 = 5)
WHERE NOT contains(file_path, 'local-agent-mode-sessions')""")


def _runner(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables.from_benchmark(spark, sf_dir))
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _runner(fn) for k, (fn, _) in _Q.items()}
    out["classify_paths"] = _classify_run
    return out


def oracle_sql() -> dict[str, str]:
    out = {k: O.sql(body) for k, (_, body) in _Q.items() if body is not None}
    out["classify_paths"] = _CLASSIFY_SQL
    return out
