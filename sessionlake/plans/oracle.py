"""DuckDB statements that state every registered query's expected answer
straight from the benchmark tables.

The ``x_*`` views below are the canonical tables written in closed form from
the adapter rules in :mod:`sessionlake.sources.adapters` — no JSON is built or
parsed here, so a normaliser bug cannot hide on both sides. Each query's SQL is
the catalogue query over those views."""

from __future__ import annotations

S_CLAUDE = "printf('%08d-0000-4000-8000-000000000000', {})"
U_CLAUDE = "printf('%08d-%04d-4000-8000-%012d', {0}, {1}, {0})"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%gZ')"
TOOLS = "['Read','Edit','Bash','Grep','Write']"

CONV_COLS = ("source, session_id, project_path, project_dir, file_name, is_agent, line_number, message_type, uuid, "
             "parent_uuid, timestamp, message_role, message_content, model, tool_name, tool_use_id, tool_input, "
             "input_tokens, output_tokens, cache_creation_tokens, cache_read_tokens, reasoning_tokens, slug, git_branch, "
             "cwd, version, stop_reason, reasoning_effort, repository")

X_CLAUDE = f"""
x_claude_b AS (
  SELECT conv_id AS c, turn AS t, role AS r, text AS x,
         CASE WHEN conv_id % 6 = 5 THEN conv_id - 1 ELSE conv_id END AS sc,
         (role = 'system' AND conv_id % 5 = 0) AS bad
  FROM conversations
),
x_claude AS (
  SELECT 'claude' AS source, {S_CLAUDE.format('sc')} AS session_id,
    '/home/dev/my-app' || (sc % 7) AS project_path, '-home-dev-my-app' || (sc % 7) AS project_dir,
    CASE WHEN c % 6 = 5 THEN 'agent-a' || c || '.jsonl' ELSE {S_CLAUDE.format('c')} || '.jsonl' END AS file_name,
    (c % 6 = 5) AS is_agent, CAST(t + 2 AS BIGINT) AS line_number,
    CASE WHEN bad THEN '_parse_error' ELSE r END AS message_type,
    CASE WHEN NOT bad THEN {U_CLAUDE.format('c', 't')} END AS uuid,
    CASE WHEN NOT bad AND t > 0 THEN {U_CLAUDE.format('c', 't - 1')} END AS parent_uuid,
    CASE WHEN r <> 'system' THEN {ISO.format("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600 + t * 37)")} END AS timestamp,
    CASE WHEN r IN ('user', 'assistant') THEN r END AS message_role,
    CASE WHEN bad THEN 'Parse error: invalid transcript line'
         WHEN r = 'user' AND c % 8 = 1 AND t = 0 THEN '<command-name>/clear</command-name> ' || x
         ELSE x END AS message_content,
    CASE WHEN r = 'assistant' THEN 'model-' || (c % 3) END AS model,
    CASE WHEN r = 'assistant' AND t % 3 = 1 THEN list_extract({TOOLS}, CAST((c + t) % 5 + 1 AS INTEGER)) END AS tool_name,
    CASE WHEN r = 'assistant' AND t % 3 = 1 THEN 'toolu_' || c || '_' || t END AS tool_use_id,
    CASE WHEN r = 'assistant' AND t % 3 = 1
         THEN '{{"file_path":"/home/dev/my-app' || (sc % 7) || '/f' || t || '.py","limit":' || t || '}}' END AS tool_input,
    CASE WHEN r = 'assistant' THEN CAST(length(x) AS BIGINT) END AS input_tokens,
    CASE WHEN r = 'assistant' THEN CAST(length(x) // 3 AS BIGINT) END AS output_tokens,
    CASE WHEN r = 'assistant' THEN CAST(t * 10 AS BIGINT) END AS cache_creation_tokens,
    CASE WHEN r = 'assistant' THEN CAST(c AS BIGINT) END AS cache_read_tokens,
    CAST(NULL AS BIGINT) AS reasoning_tokens,
    CASE WHEN NOT bad AND sc % 9 <> 0 THEN 'plan-' || sc END AS slug,
    CASE WHEN bad THEN NULL WHEN c % 2 = 0 THEN 'main' ELSE 'feature/x' || (c % 3) END AS git_branch,
    CASE WHEN NOT bad AND t > 0 THEN '/home/dev/my-app' || (sc % 7) END AS cwd,
    CASE WHEN NOT bad THEN '2.0.' || (c % 4) END AS version,
    CASE WHEN r = 'assistant' THEN CASE WHEN t % 3 = 1 THEN 'tool_use' ELSE 'end_turn' END END AS stop_reason,
    CAST(NULL AS VARCHAR) AS reasoning_effort, CAST(NULL AS VARCHAR) AS repository
  FROM x_claude_b
  UNION ALL
  SELECT 'claude', {S_CLAUDE.format('sc')}, '/home/dev/my-app' || (sc % 7), '-home-dev-my-app' || (sc % 7),
    CASE WHEN c % 6 = 5 THEN 'agent-a' || c || '.jsonl' ELSE {S_CLAUDE.format('c')} || '.jsonl' END,
    (c % 6 = 5), CAST(1 AS BIGINT), CASE WHEN c % 3 = 2 THEN 'file-history-snapshot' ELSE 'summary' END,
    NULL, NULL, NULL, NULL, CASE WHEN c % 3 = 2 THEN NULL ELSE 'Session ' || c END,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM x_claude_b WHERE t = 0
)"""

# a user's events start at line 2, and a blank line follows every event_id % 29 = 5
LN = """1 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) + coalesce(sum(CASE WHEN event_id % 29 = 5 THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ln,"""
# session.start without a cwd or branch leaves the workspace's
PROJ = """CASE WHEN user_id % 10 <> 3 THEN '/work/repo' || (user_id % 4) WHEN user_id % 4 <> 1 THEN '/work/ws' || (user_id % 5) ELSE '' END"""
BRANCH = "CASE WHEN u % 6 <> 5 THEN 'main' WHEN u % 4 <> 1 THEN 'ws-main' END"
S_COPILOT = "printf('%08d-c0c0-4000-8000-%012d', {0}, {0})"
X_COPILOT = f"""
x_copilot_b AS (
  SELECT event_id AS e, user_id AS u, event_type AS ty, ts,
    (event_type = 'error' AND event_id % 50 = 7) AS bad,
    {PROJ} AS proj, {LN}
    last_value(CASE WHEN event_type = 'signup' THEN 'gpt-' || (event_id % 3) END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur_model
  FROM events
),
x_copilot AS (
  SELECT 'copilot' AS source, {S_COPILOT.format('u')} AS session_id,
    CASE WHEN bad THEN '' ELSE proj END AS project_path, '' AS project_dir, 'events.jsonl' AS file_name,
    false AS is_agent, CAST(ln AS BIGINT) AS line_number,
    CASE WHEN bad THEN '_parse_error'
         WHEN ty = 'signup' THEN 'model_change'
         WHEN ty = 'view' AND e % 2 = 0 THEN 'user' WHEN ty = 'view' THEN 'assistant'
         WHEN ty = 'click' THEN 'tool_start'
         WHEN ty = 'purchase' AND e % 4 = 0 THEN 'reasoning' WHEN ty = 'purchase' THEN 'tool_result'
         WHEN e % 4 = 0 THEN 'truncation' WHEN e % 4 = 1 THEN 'turn_start' ELSE 'session_error' END AS message_type,
    CASE WHEN NOT bad THEN 'e' || e END AS uuid,
    CASE WHEN NOT bad THEN 's' || u END AS parent_uuid,
    CASE WHEN NOT bad THEN {ISO.format('ts')} END AS timestamp,
    CASE WHEN bad THEN NULL
         WHEN ty = 'view' AND e % 2 = 0 THEN 'user' WHEN ty = 'view' THEN 'assistant'
         WHEN ty = 'click' THEN 'tool'
         WHEN ty = 'purchase' AND e % 4 = 0 THEN 'assistant' WHEN ty = 'purchase' THEN 'tool'
         WHEN ty = 'error' AND e % 4 = 1 THEN 'assistant' END AS message_role,
    CASE WHEN bad THEN 'Parse error: invalid event line'
         WHEN ty = 'view' AND e % 2 = 0 THEN 'ask ' || e WHEN ty = 'view' THEN 'answer ' || e
         WHEN ty = 'purchase' AND e % 4 = 0 THEN 'thinking ' || e WHEN ty = 'purchase' THEN 'done ' || e
         WHEN ty = 'error' AND e % 4 NOT IN (0, 1) THEN 'error ' || e END AS message_content,
    CASE WHEN NOT bad THEN cur_model END AS model,
    CASE WHEN bad THEN NULL WHEN ty = 'view' AND e % 2 = 1 AND e % 3 = 0 THEN 'view'
         WHEN ty = 'click' THEN list_extract({TOOLS}, CAST(e % 5 + 1 AS INTEGER)) END AS tool_name,
    CASE WHEN bad THEN NULL WHEN ty = 'view' AND e % 2 = 1 AND e % 3 = 0 THEN 'req' || e
         WHEN ty = 'click' OR (ty = 'purchase' AND e % 4 <> 0) THEN 'call' || e END AS tool_use_id,
    CASE WHEN bad THEN NULL WHEN (ty = 'view' AND e % 2 = 1 AND e % 3 = 0) OR ty = 'click'
         THEN '{{"path":"/work/f' || (e % 10) || '.txt"}}' END AS tool_input,
    CASE WHEN NOT bad AND ty = 'error' AND e % 4 = 0 THEN CAST(e % 1000 + 1000 AS BIGINT) END AS input_tokens,
    CASE WHEN NOT bad AND ty = 'error' AND e % 4 = 0 THEN CAST(e % 500 + 500 AS BIGINT) END AS output_tokens,
    CAST(NULL AS BIGINT) AS cache_creation_tokens, CAST(NULL AS BIGINT) AS cache_read_tokens,
    CAST(NULL AS BIGINT) AS reasoning_tokens, CAST(NULL AS VARCHAR) AS slug,
    CASE WHEN NOT bad THEN {BRANCH} END AS git_branch,
    CASE WHEN NOT bad THEN NULLIF(proj, '') END AS cwd,
    CASE WHEN NOT bad THEN '0.0.' || (u % 5) END AS version,
    CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS VARCHAR) AS reasoning_effort,
    CASE WHEN NOT bad THEN 'org/repo' || (u % 4) END AS repository
  FROM x_copilot_b
  UNION ALL
  SELECT 'copilot', {S_COPILOT.format('u')}, proj, '', 'events.jsonl', false, CAST(1 AS BIGINT), 'session_start',
    's' || u, NULL, {ISO.format('t0')}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    {BRANCH}, NULLIF(proj, ''), '0.0.' || (u % 5), NULL, NULL, 'org/repo' || (u % 4)
  FROM (SELECT user_id AS u, min(ts) AS t0, {PROJ} AS proj
        FROM events GROUP BY user_id)
)"""

S_CODEX = "printf('%08d-c0de-4000-8000-%012d', {0}, {0})"
X_CODEX = f"""
x_codex_b AS (
  SELECT event_id AS e, user_id AS u, event_type AS ty, ts,
    (user_id % 7 = 0) AS only_ev, {LN}
    (event_type = 'click' AND event_id % 40 = 3) AS bad,
    (user_id % 7 <> 0 AND count(*) FILTER (WHERE event_type = 'view') OVER (PARTITION BY user_id) > 0) AS has_resp,
    last_value(CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'codex-' || (event_id % 3) END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur_model
  FROM events
),
x_codex_r AS (
  SELECT *,
    CASE WHEN bad THEN '_parse_error'
         WHEN ty = 'signup' AND e % 2 = 0 THEN NULL
         WHEN ty = 'signup' THEN 'reasoning'
         WHEN ty = 'view' AND only_ev THEN CASE WHEN e % 2 = 0 THEN 'user' ELSE 'assistant' END
         WHEN ty = 'view' THEN CASE WHEN e % 2 = 0 THEN 'user' ELSE 'assistant' END
         WHEN ty = 'click' THEN 'function_call'
         WHEN ty = 'purchase' THEN 'function_call_output'
         WHEN only_ev THEN NULL
         WHEN NOT has_resp THEN 'assistant' END AS mtype
  FROM x_codex_b
),
x_codex AS (
  SELECT 'codex' AS source, {S_CODEX.format('u')} AS session_id,
    CASE WHEN bad THEN '' ELSE '/src/proj' || (u % 3) END AS project_path, '' AS project_dir,
    'rollout-2024-01-01T00-00-00-' || {S_CODEX.format('u')} || '.jsonl' AS file_name, false AS is_agent,
    CAST(ln AS BIGINT) AS line_number, mtype AS message_type, CAST(NULL AS VARCHAR) AS uuid,
    CAST(NULL AS VARCHAR) AS parent_uuid,
    CASE WHEN NOT bad THEN {ISO.format('ts')} END AS timestamp,
    CASE WHEN mtype IN ('user', 'assistant') THEN mtype WHEN mtype = 'reasoning' THEN 'assistant'
         WHEN mtype IN ('function_call', 'function_call_output') THEN 'tool' END AS message_role,
    CASE WHEN bad THEN 'Parse error: invalid rollout line'
         WHEN ty = 'signup' THEN 'plan ' || e
         WHEN ty = 'view' THEN 'msg ' || e
         WHEN ty = 'purchase' THEN 'exit ' || (e % 3)
         WHEN ty = 'error' THEN 'warn ' || e END AS message_content,
    CASE WHEN NOT bad THEN cur_model END AS model,
    CASE WHEN mtype = 'function_call' THEN 'shell' END AS tool_name,
    CASE WHEN mtype IN ('function_call', 'function_call_output') THEN 'c' || e END AS tool_use_id,
    CASE WHEN mtype = 'function_call' THEN '"{{\\"cmd\\":\\"ls ' || e || '\\"}}"' END AS tool_input,
    CAST(NULL AS BIGINT) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens,
    CAST(NULL AS BIGINT) AS cache_creation_tokens, CAST(NULL AS BIGINT) AS cache_read_tokens,
    CAST(NULL AS BIGINT) AS reasoning_tokens, CAST(NULL AS VARCHAR) AS slug,
    CASE WHEN NOT bad THEN 'dev' || (u % 2) END AS git_branch,
    CASE WHEN NOT bad THEN '/src/proj' || (u % 3) END AS cwd,
    CASE WHEN NOT bad THEN '0.' || (u % 4) || '.0' END AS version,
    CAST(NULL AS VARCHAR) AS stop_reason, CAST(NULL AS VARCHAR) AS reasoning_effort,
    CASE WHEN NOT bad THEN 'https://git.example/r' || (u % 3) || '.git' END AS repository
  FROM x_codex_r WHERE mtype IS NOT NULL
)"""


S_GEMINI = "printf('%08d-6e00-4000-8000-%012d', {0}, {0})"
ISO_CT = ISO.format("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600 + t * 37)")
X_GEMINI = f"""
x_gemini_b AS (
  SELECT conv_id AS c, turn AS t, role AS r, text AS x,
    CASE WHEN conv_id % 4 <> 3 THEN 'proj' || (conv_id % 5) ELSE 'h' || conv_id END AS dir,
    CASE WHEN conv_id % 4 <> 3 THEN '/home/dev/gem' || (conv_id % 5) ELSE '' END AS proj,
    conv_id % 13 = 6 AS bad
  FROM conversations
),
x_gemini AS (
  SELECT 'gemini' AS source, {S_GEMINI.format('c')} AS session_id, proj AS project_path, dir AS project_dir,
    'session-' || c || '.json' AS file_name, c % 6 = 5 AS is_agent, CAST(t + 1 AS BIGINT) AS line_number,
    CASE WHEN r = 'user' THEN 'user' WHEN r = 'assistant' THEN 'assistant' ELSE 'info' END AS message_type,
    'm' || c || '-' || t AS uuid, CAST(NULL AS VARCHAR) AS parent_uuid,
    CASE WHEN t % 5 <> 4 THEN {ISO_CT} ELSE {ISO.format("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600)")} END AS timestamp,
    CASE WHEN r IN ('user', 'assistant') THEN r END AS message_role,
    CASE WHEN r = 'system' AND c % 7 = 0 THEN NULL ELSE NULLIF(x, '') END AS message_content,
    CASE WHEN r = 'assistant' THEN 'gemini-' || (c % 2) END AS model,
    CAST(NULL AS VARCHAR) AS tool_name, CAST(NULL AS VARCHAR) AS tool_use_id, CAST(NULL AS VARCHAR) AS tool_input,
    CASE WHEN r = 'assistant' THEN CAST(length(x) AS BIGINT) END AS input_tokens,
    CASE WHEN r = 'assistant' THEN CAST(length(x) // 3 AS BIGINT) END AS output_tokens,
    CAST(NULL AS BIGINT) AS cache_creation_tokens,
    CASE WHEN r = 'assistant' THEN CAST(t * 100 AS BIGINT) END AS cache_read_tokens,
    CAST(NULL AS BIGINT) AS reasoning_tokens, CAST(NULL AS VARCHAR) AS slug, CAST(NULL AS VARCHAR) AS git_branch,
    NULLIF(proj, '') AS cwd, CAST(NULL AS VARCHAR) AS version, CAST(NULL AS VARCHAR) AS stop_reason,
    CAST(NULL AS VARCHAR) AS reasoning_effort, CAST(NULL AS VARCHAR) AS repository
  FROM x_gemini_b WHERE NOT bad
  UNION ALL
  SELECT 'gemini', {S_GEMINI.format('c')}, proj, dir, 'session-' || c || '.json', c % 6 = 5, CAST(t + 1 AS BIGINT),
    'tool_call', 'tc' || c || '-' || t || '-' || i, 'm' || c || '-' || t,
    CASE WHEN t % 5 <> 4 THEN {ISO_CT} END, 'tool', 'success', 'gemini-' || (c % 2),
    list_extract({TOOLS}, CAST(i + 1 AS INTEGER)), 'tc' || c || '-' || t || '-' || i, '{{"q":' || i || '}}',
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULLIF(proj, ''), NULL, NULL, NULL, NULL
  FROM x_gemini_b, (SELECT unnest(range(0, 2)) AS i) k WHERE NOT bad AND r = 'assistant' AND i < t % 3
  UNION ALL
  SELECT 'gemini', dir, '', dir, 'session-' || c || '.json', false, CAST(1 AS BIGINT), '_parse_error', NULL, NULL, NULL,
    NULL, 'Parse error: invalid session file', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, NULL, NULL
  FROM x_gemini_b WHERE bad AND t = 0
)"""

S_CURSOR = "printf('%08d-cc00-4000-8000-%012d', {0}, {0})"
X_CURSOR = f"""
x_cursor_b AS (
  SELECT conv_id AS c, turn AS t, role AS r, text AS x,
    turn % 5 <> 4 AND NOT (conv_id % 11 = 10 AND turn = 0) AS has_b
  FROM conversations
),
x_cursor AS (
  SELECT 'cursor' AS source, {S_CURSOR.format('c')} AS session_id, '' AS project_path, '' AS project_dir,
    'state.vscdb' AS file_name, has_b AND c % 6 = 5 AS is_agent,
    CAST(t + 1 + CASE WHEN c % 4 = 1 AND t > 0 THEN 1 ELSE 0 END AS BIGINT) AS line_number,
    CASE WHEN r IN ('user', 'assistant') THEN r ELSE 'unknown' END AS message_type,
    'b' || c || '-' || t AS uuid, CASE WHEN t > 0 THEN 'b' || c || '-' || (t - 1) END AS parent_uuid,
    CASE WHEN has_b THEN strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600 + t * 37), '%Y-%m-%dT%H:%M:%SZ') END AS timestamp,
    CASE WHEN r IN ('user', 'assistant') THEN r END AS message_role,
    CASE WHEN has_b THEN x END AS message_content,
    'cursor-' || (c % 2) AS model,
    CASE WHEN has_b AND r = 'assistant' AND t % 3 = 1 THEN list_extract({TOOLS}, CAST((c + t) % 5 + 1 AS INTEGER))
         WHEN has_b AND r = 'assistant' AND t % 3 = 0 THEN 'search' END AS tool_name,
    CASE WHEN has_b AND r = 'assistant' AND t % 3 = 1 THEN 'tc' || c || '-' || t END AS tool_use_id,
    CASE WHEN has_b AND r = 'assistant' AND t % 3 = 1 THEN '"{{\\"q\\":\\"' || t || '\\"}}"'
         WHEN has_b AND r = 'assistant' AND t % 3 = 0 THEN '{{"q":' || t || '}}' END AS tool_input,
    CASE WHEN has_b AND r = 'assistant' THEN CAST(length(x) AS BIGINT) END AS input_tokens,
    CASE WHEN has_b AND r = 'assistant' THEN CAST(length(x) // 3 AS BIGINT) END AS output_tokens,
    CAST(NULL AS BIGINT) AS cache_creation_tokens, CAST(NULL AS BIGINT) AS cache_read_tokens,
    CAST(NULL AS BIGINT) AS reasoning_tokens, CAST(NULL AS VARCHAR) AS slug, CAST(NULL AS VARCHAR) AS git_branch,
    CAST(NULL AS VARCHAR) AS cwd, CAST(NULL AS VARCHAR) AS version, CAST(NULL AS VARCHAR) AS stop_reason,
    CAST(NULL AS VARCHAR) AS reasoning_effort, CAST(NULL AS VARCHAR) AS repository
  FROM x_cursor_b
)"""

S_GROK = "printf('%08d-6b00-4000-8000-%012d', {0}, {0})"
GROK_TS0 = ISO.format("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600)")
GROK_TS1 = ISO.format("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600 + 999)")
X_GROK = f"""
x_grok_b AS (
  SELECT conv_id AS c, turn AS t, role AS r, text AS x,
    CASE WHEN role = 'system' THEN 'system' WHEN role = 'user' AND turn % 5 = 3 THEN 'tool_result'
         WHEN role = 'user' THEN 'user' WHEN turn % 4 = 1 THEN 'reasoning' ELSE 'assistant' END AS k,
    conv_id % 9 = 2 AND turn = 1 AS bad,
    bool_or(conv_id % 9 = 2 AND turn = 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS exhausted,
    arg_max(CASE WHEN role = 'assistant' THEN text END, CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS ux,
    max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS ut
  FROM conversations
),
x_grok_r AS (
  SELECT *, {S_GROK.format('c')} AS sid, '/home/dev/grok' || (c % 3) AS cwd0, '%2Fhome%2Fdev%2Fgrok' || (c % 3) AS enc,
    CASE WHEN c % 2 = 0 THEN '/repo/g' || (c % 3) END AS groot, {GROK_TS1} AS sts,
    CASE WHEN k = 'system' THEN {GROK_TS0} WHEN exhausted THEN {GROK_TS1}
         ELSE strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c * 3600 + t * 37), '%Y-%m-%dT%H:%M:%SZ') END AS ts,
    CASE WHEN c % 6 = 5 THEN {S_GROK.format('c - 1')} END AS parent
  FROM x_grok_b
),
x_grok_rows AS (
  SELECT *, CASE WHEN bad THEN '_parse_error' ELSE k END AS mtype, -1 AS i FROM x_grok_r WHERE NOT (k = 'assistant' AND NOT bad) 
  UNION ALL SELECT *, 'assistant', -1 FROM x_grok_r WHERE k = 'assistant' AND NOT bad
  UNION ALL SELECT x_grok_r.*, 'tool_call', i FROM x_grok_r, (SELECT unnest(range(0, 2)) AS i) q
    WHERE k = 'assistant' AND NOT bad AND i < t % 3
),
x_grok AS (
  SELECT 'grok' AS source, sid AS session_id, coalesce(groot, cwd0) AS project_path, enc AS project_dir,
    'chat_history.jsonl' AS file_name, parent IS NOT NULL AS is_agent, CAST(t + 1 AS BIGINT) AS line_number,
    mtype AS message_type,
    CASE WHEN mtype = 'reasoning' THEN 'r' || c || '-' || t ELSE sid || ':' || (t + 1) END AS uuid,
    parent AS parent_uuid, ts AS timestamp,
    CASE WHEN mtype = 'user' THEN 'user' WHEN mtype IN ('tool_result', 'tool_call') THEN 'tool'
         WHEN mtype IN ('reasoning', 'assistant') THEN 'assistant' END AS message_role,
    CASE WHEN mtype = '_parse_error' THEN 'Parse error: invalid chat line' WHEN mtype = 'tool_call' THEN NULL
         WHEN mtype = 'assistant' AND t % 6 = 0 THEN NULL ELSE x END AS message_content,
    CASE WHEN mtype = 'reasoning' THEN 'grok-code'
         WHEN mtype IN ('assistant', 'tool_call') THEN CASE WHEN t % 2 = 0 THEN 'grok-fast' ELSE 'grok-code' END END AS model,
    CASE WHEN mtype = 'tool_call' THEN list_extract({TOOLS}, CAST(i + 1 AS INTEGER)) END AS tool_name,
    CASE WHEN mtype = 'tool_call' THEN 'call' || c || '-' || t || '-' || i
         WHEN mtype = 'tool_result' THEN 'call' || c || '-' || (t - 1) || '-0' END AS tool_use_id,
    CASE WHEN mtype = 'tool_call' THEN '{{"n":' || t || '}}' END AS tool_input,
    CAST(length(ux) AS BIGINT) AS input_tokens, CAST(length(ux) // 3 AS BIGINT) AS output_tokens,
    CAST(NULL AS BIGINT) AS cache_creation_tokens, CAST(ut AS BIGINT) AS cache_read_tokens,
    CASE WHEN ut IS NOT NULL THEN CAST(5 AS BIGINT) END AS reasoning_tokens,
    CASE WHEN c % 5 <> 0 THEN 'Grok task ' || c END AS slug, 'main' AS git_branch, cwd0 AS cwd,
    CASE WHEN c % 2 = 1 THEN '2' ELSE 'v2' END AS version, CAST(NULL AS VARCHAR) AS stop_reason,
    CASE WHEN mtype = 'reasoning' THEN CASE WHEN t % 2 = 1 THEN 'high' ELSE 'medium' END
         WHEN mtype IN ('assistant', 'tool_call') THEN 'medium' END AS reasoning_effort,
    'git@host:r' || (c % 3) || '.git' AS repository
  FROM x_grok_rows
),
x_grok_sessions AS (
  SELECT conv_id AS c, count(*) AS n, count(*) FILTER (WHERE role = 'user') AS users,
    count(*) FILTER (WHERE role = 'assistant') AS assts,
    sum(CASE WHEN role = 'assistant' AND turn % 4 <> 1 THEN turn % 3 ELSE 0 END) AS calls,
    arg_min(text, turn) AS first_text
  FROM conversations GROUP BY conv_id
),
x_grok_plans AS (
  SELECT 'grok' AS source, {S_GROK.format('c')} AS session_id, coalesce(CASE WHEN c % 5 <> 0 THEN 'Grok task ' || c END,
    {S_GROK.format('c')}) AS plan_name, 'plan.md' AS file_name,
    '/lake/grok/sessions/%2Fhome%2Fdev%2Fgrok' || (c % 3) || '/' || {S_GROK.format('c')} || '/plan.md' AS file_path,
    first_text AS content, CAST(strlen(first_text) AS BIGINT) AS file_size
  FROM x_grok_sessions
),
x_grok_stats AS (
  SELECT 'grok' AS source, left({GROK_TS0}, 10) AS date,
    CAST(sum(CASE WHEN c % 7 = 3 THEN n WHEN users > 0 OR assts > 0 THEN users + assts WHEN n > 0 THEN n ELSE n END) AS BIGINT) AS message_count,
    CAST(count(*) AS BIGINT) AS session_count,
    CAST(sum(CASE WHEN c % 7 = 3 THEN 0 ELSE calls END) AS BIGINT) AS tool_call_count
  FROM x_grok_sessions GROUP BY 2
)"""

X_DESKTOP = "x_claude_desktop AS (SELECT * REPLACE ('claude-desktop' AS source) FROM x_claude)"

X_SIDE = f"""
x_history AS (
  SELECT 'claude' AS source, CAST(c * 1000 + t + 1 AS BIGINT) AS line_number,
    CASE WHEN NOT bad THEN CAST((1704067200 + c * 3600 + t * 37) * 1000 AS BIGINT) END AS timestamp_ms,
    CASE WHEN bad THEN NULL WHEN t = 2 THEN '/home/dev/archived' || (c % 3) ELSE '/home/dev/my-app' || (sc % 7) END AS project,
    CASE WHEN bad THEN NULL WHEN t = 2 AND c % 2 = 1 THEN {S_CLAUDE.format('c + 1000000')} ELSE {S_CLAUDE.format('sc')} END AS session_id,
    CASE WHEN bad THEN 'Parse error: invalid history line' ELSE x END AS display,
    CASE WHEN bad THEN NULL WHEN c % 4 = 0 THEN '{{"1":{{"content":"snippet ' || c || '","id":1,"type":"text"}}}}' ELSE '{{}}' END AS pasted_contents
  FROM (SELECT conv_id AS c, turn AS t, text AS x, CASE WHEN conv_id % 6 = 5 THEN conv_id - 1 ELSE conv_id END AS sc,
               (conv_id % 10 = 9 AND turn = 1) AS bad
        FROM conversations WHERE role = 'user')
  UNION ALL
  SELECT 'copilot', row_number() OVER (PARTITION BY user_id ORDER BY event_id), NULL, NULL, NULL, 'run ' || event_id, NULL
  FROM events WHERE event_type = 'click' AND user_id % 11 <> 4
),
x_todo_files AS (
  SELECT conv_id AS c, turn AS t,
         CASE WHEN conv_id % 8 = 3 THEN conv_id + 2000000 WHEN conv_id % 6 = 5 THEN conv_id - 1 ELSE conv_id END AS sc,
         (conv_id + turn) % 3 + 1 AS n, conv_id % 9 = 4 AS bad
  FROM conversations WHERE role = 'assistant'
),
x_todos AS (
  SELECT 'claude' AS source, {S_CLAUDE.format('sc')} AS session_id, 'a' || c || 't' || t AS agent_id,
    {S_CLAUDE.format('sc')} || '-agent-a' || c || 't' || t || '.json' AS file_name, CAST(i AS BIGINT) AS item_index,
    'step ' || i || ' of turn ' || t AS content,
    list_extract(['pending', 'in_progress', 'completed'], CAST((c + t + i) % 3 + 1 AS INTEGER)) AS status,
    CASE WHEN (c + t + i) % 3 = 1 THEN 'Working on step ' || i END AS active_form
  FROM x_todo_files, (SELECT unnest(range(0, 3)) AS i) k WHERE NOT bad AND i < n
  UNION ALL
  SELECT 'claude', {S_CLAUDE.format('sc')}, 'a' || c || 't' || t, {S_CLAUDE.format('sc')} || '-agent-a' || c || 't' || t || '.json',
    CAST(-1 AS BIGINT), 'Parse error: invalid todo file', '_parse_error', NULL
  FROM x_todo_files WHERE bad
  UNION ALL
  SELECT 'copilot', {S_COPILOT.format('user_id')}, NULL, '001.md', row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1,
    CASE event_type WHEN 'purchase' THEN 'order ' WHEN 'click' THEN 'follow ' ELSE 'join ' END || event_id,
    CASE WHEN event_type = 'click' THEN 'pending' ELSE 'completed' END, NULL
  FROM events WHERE event_type IN ('purchase', 'click', 'signup')
),
x_plans AS (
  SELECT 'claude' AS source, CAST(NULL AS VARCHAR) AS session_id, 'plan-' || doc_id AS plan_name,
    'plan-' || doc_id || '.md' AS file_name, '/lake/claude/plans/plan-' || doc_id || '.md' AS file_path,
    text AS content, CAST(strlen(text) AS BIGINT) AS file_size
  FROM documents
  UNION ALL SELECT * FROM x_grok_plans
  UNION ALL
  SELECT 'copilot', {S_COPILOT.format('u')}, CASE WHEN u % 4 <> 1 AND u % 3 <> 0 THEN 'Work of user ' || u ELSE {S_COPILOT.format('u')} END,
    'plan.md', '/lake/copilot/session-state/' || {S_COPILOT.format('u')} || '/plan.md', body, CAST(strlen(body) AS BIGINT)
  FROM (SELECT user_id AS u, '# Plan of ' || user_id || chr(10) || chr(10) || count(*) || ' steps' || chr(10) AS body
        FROM events WHERE user_id % 5 <> 2 GROUP BY user_id)
),
x_stats AS (
  SELECT 'claude' AS source, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS message_count,
    CAST(count(DISTINCT user_id) AS BIGINT) AS session_count,
    CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS tool_call_count
  FROM events GROUP BY user_id % 4, CAST(ts AS DATE)
  UNION ALL SELECT * FROM x_grok_stats
),
x_conv_all AS (SELECT * FROM x_claude UNION ALL SELECT * FROM x_claude_desktop UNION ALL SELECT * FROM x_copilot UNION ALL SELECT * FROM x_codex
  UNION ALL SELECT * FROM x_gemini UNION ALL SELECT * FROM x_cursor UNION ALL SELECT * FROM x_grok),
x_conv AS (SELECT * FROM x_conv_all)"""

PRELUDE = "WITH " + ",".join(s.strip() for s in (X_CLAUDE, X_COPILOT, X_CODEX, X_GEMINI, X_CURSOR, X_GROK, X_DESKTOP, X_SIDE))


def sql(body: str) -> str:
    return PRELUDE + "\n" + body
