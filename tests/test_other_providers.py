import json
import sqlite3

from trees import write

from sessionlake.plans.tables import from_roots


def j(**kw):
    return json.dumps(kw)


def test_copilot_carry_forward_and_workspace(spark, tmp_path):
    root = str(tmp_path)
    d = f"{root}/session-state/dir-1"
    write(f"{d}/workspace.yaml", "id: ws-1\ncwd: /w/start\nbranch: trunk\nsummary: My plan\n")
    write(f"{d}/events.jsonl", "\n".join([
        j(type="user.message", id="e1", data={"content": "before start"}),
        j(type="session.start", id="e2", data={"sessionId": "sid-9", "copilotVersion": "1.2",
                                               "context": {"cwd": "/w/real", "repository": "o/r"}}),
        j(type="session.model_change", id="e3", data={"newModel": "gpt-x"}),
        j(type="assistant.message", id="e4", data={"content": "hi", "toolRequests": [
            {"toolCallId": "c1", "name": "bash", "arguments": "ls"}]}),
        "{oops",
        j(type="tool.execution_complete", id="e5", data={"toolCallId": "c1", "result": {"content": "done"}}),
        j(type="session.truncation", data={"preTruncationTokensInMessages": 9, "postTruncationTokensInMessages": 4}),
        j(type="brand.new"),
    ]) + "\n")
    write(f"{d}/plan.md", "# plan")
    write(f"{d}/checkpoints/001.md", "# cp\n  - [x] done one\n- [ ] open two\nnot an item\n- [X] done three\n")
    write(f"{d}/checkpoints/index.md", "- [x] ignored\n")
    write(f"{root}/session-state/flat-2.jsonl", j(type="abort") + "\n")
    write(f"{root}/command-history-state.json", json.dumps({"commandHistory": ["ls", "pwd"]}))
    t = from_roots(spark, copilot=root)
    r = {(x.file_name, x.line_number): x for x in t.get("conv_copilot").collect()}
    e = "events.jsonl"
    assert r[(e, 1)].session_id == "ws-1" and r[(e, 1)].project_path == "/w/start" and r[(e, 1)].model is None
    assert r[(e, 1)].git_branch == "trunk" and r[(e, 1)].version is None
    assert r[(e, 2)].session_id == "sid-9" and r[(e, 2)].version == "1.2" and r[(e, 2)].cwd == "/w/real"
    assert r[(e, 2)].git_branch == "trunk" and r[(e, 2)].repository == "o/r"
    assert r[(e, 3)].model == "gpt-x" and r[(e, 3)].message_type == "model_change"
    assert (r[(e, 4)].tool_name, r[(e, 4)].tool_use_id, r[(e, 4)].tool_input) == ("bash", "c1", '"ls"')
    assert r[(e, 5)].message_type == "_parse_error" and r[(e, 5)].project_path == "" and r[(e, 5)].session_id == "sid-9"
    assert r[(e, 6)].message_content == "done" and r[(e, 6)].message_role == "tool"
    assert (r[(e, 7)].input_tokens, r[(e, 7)].output_tokens) == (9, 4)
    assert r[(e, 8)].message_type == "unknown"
    assert r[("flat-2.jsonl", 1)].session_id == "flat-2" and r[("flat-2.jsonl", 1)].message_type == "abort"
    todos = sorted((x.item_index, x.content, x.status) for x in t.todos.collect())
    assert todos == [(0, "done one", "completed"), (1, "open two", "pending"), (2, "done three", "completed")]
    assert [(p.plan_name, p.session_id) for p in t.plans.collect()] == [("My plan", "dir-1")]
    assert sorted((h.line_number, h.display) for h in t.history.collect()) == [(1, "ls"), (2, "pwd")]


def test_codex_state_and_dedup(spark, tmp_path):
    root = str(tmp_path)
    uid = "0199a1b2-c3d4-7e5f-8a9b-0c1d2e3f4a5b"
    write(f"{root}/sessions/2026/01/02/rollout-2026-01-02T10-00-00-{uid}.jsonl", "\n".join([
        j(type="session_meta", payload={"id": uid, "cwd": "/c", "git": {"branch": "b"}, "cli_version": "0.9"}),
        j(type="event_msg", payload={"type": "user_message", "message": "dup"}),
        j(type="turn_context", payload={"model": "m1"}),
        j(type="response_item", payload={"type": "message", "role": "user", "content": [{"type": "input_text", "text": "q"}]}),
        j(type="response_item", payload={"type": "function_call", "name": "shell", "arguments": "{\"a\":1}", "call_id": "k"}),
        j(type="response_item", payload={"type": "function_call_output", "call_id": "k", "output": "out"}),
        j(type="turn_context", payload={"cwd": "/x"}),
        j(type="response_item", payload={"type": "web_search_call"}),
    ]) + "\n")
    write(f"{root}/sessions/2026/01/03/rollout-2026-01-03T10-00-00-short.jsonl", "\n".join([
        j(type="event_msg", payload={"type": "user_message", "message": "only events"}),
        j(type="event_msg", payload={"type": "token_count"}),
        "{bad",
    ]) + "\n")
    t = from_roots(spark, codex=root)
    r = {(x.session_id, x.line_number): x for x in t.get("conv_codex").collect()}
    assert sorted(k[1] for k in r if k[0] == uid) == [4, 5, 6, 8]  # event_msg duplicate dropped
    assert r[(uid, 4)].model == "m1" and r[(uid, 4)].project_path == "/c" and r[(uid, 4)].version == "0.9"
    assert r[(uid, 5)].tool_input == '"{\\"a\\":1}"' and r[(uid, 6)].message_content == "out"
    assert r[(uid, 8)].message_type == "web_search_call" and r[(uid, 8)].model == "m1"
    short = "01-03T10-00-00-short"  # the last five dash-separated groups of the stem
    assert r[(short, 1)].message_type == "user" and r[(short, 3)].message_type == "_parse_error"


def test_gemini_documents(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/projects.json", json.dumps({"projects": {"/abs/app": "app", "/abs/z": 5}}))
    write(f"{root}/tmp/app/chats/session-1.json", json.dumps({"sessionId": "g1", "startTime": "T0", "kind": "subagent",
        "messages": [{"id": "m1", "type": "user", "content": ""},
                     {"id": "m2", "type": "gemini", "timestamp": "T2", "model": "g", "tokens": {"cached": 7},
                      "toolCalls": [{"id": "t1", "name": "ls", "args": {"p": 1}, "status": "ok"}]}]}))
    write(f"{root}/tmp/hash9/chats/session-2.json", "{broken")
    t = from_roots(spark, gemini=root)
    r = sorted(t.get("conv_gemini").collect(), key=lambda x: (x.file_name, x.line_number, x.message_type))
    m1, m2, tc, bad = r
    assert (m1.message_content, m1.timestamp, m1.is_agent, m1.project_path) == (None, "T0", True, "/abs/app")
    assert (m2.message_type, m2.cache_read_tokens) == ("assistant", 7)
    assert (tc.message_type, tc.parent_uuid, tc.timestamp, tc.tool_input, tc.line_number) == ("tool_call", "m2", "T2", '{"p":1}', 2)
    assert (bad.message_type, bad.session_id, bad.project_path, bad.line_number) == ("_parse_error", "hash9", "", 1)


def test_cursor_sqlite(spark, tmp_path):
    db = str(tmp_path / "state.vscdb")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE cursorDiskKV (key TEXT, value BLOB)")
    rows = [
        ("composerData:c1", json.dumps({"fullConversationHeadersOnly": [
            {"bubbleId": "b1", "type": 1}, {"type": 2}, {"bubbleId": "b2", "type": 2}, {"bubbleId": "b3", "type": 9}],
            "modelConfig": {"modelName": "cm"}})),
        ("bubbleId:c1:b1", json.dumps({"text": "hi", "createdAt": 1767866400999})),
        ("bubbleId:c1:b2", json.dumps({"text": "x" * 100000, "timingInfo": {"clientStartTime": 1767866401000},
                                       "isAgentic": True, "toolFormerData": {"tool": "t", "rawArgs": "{}"}})),
        ("noise:1", "{}"),
    ]
    con.executemany("INSERT INTO cursorDiskKV VALUES (?, ?)", [(k, v.encode()) for k, v in rows])
    con.commit()
    con.close()
    t = from_roots(spark, cursor=str(tmp_path))
    r = sorted(t.get("conv_cursor").collect(), key=lambda x: x.line_number)
    assert [(x.line_number, x.uuid, x.parent_uuid) for x in r] == [(1, "b1", None), (3, "b2", "b1"), (4, "b3", "b2")]
    assert r[0].timestamp == "2026-01-08T10:00:00Z" and r[0].model == "cm"
    assert len(r[1].message_content) == 100000 and r[1].is_agent and r[1].tool_input == '"{}"' and r[1].tool_name == "t"
    assert r[2].message_type == "unknown" and r[2].message_content is None and not r[2].is_agent
