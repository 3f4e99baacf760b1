import json

from trees import write
from pyspark.sql import functions as F

from sessionlake.plans.tables import from_roots

SID = "11111111-2222-3333-4444-555555555555"


def line(**kw):
    return json.dumps(kw)


def make_tree(root):
    p = f"{root}/projects/-home-u-my-app/{SID}.jsonl"
    lines = [
        line(type="summary", summary="Fix the bug"),
        "",  # blank line: counted, not emitted
        line(type="user", uuid="u1", sessionId=SID, timestamp="2026-01-08T10:00:00.000Z",
             message={"role": "user", "content": "hello"}),
        line(type="assistant", uuid="a1", parentUuid="u1", sessionId=SID, cwd="/home/u/my-app",
             timestamp="2026-01-08T10:00:05.000Z",
             message={"model": "m1", "stop_reason": "tool_use",
                      "content": [{"type": "thinking", "thinking": "x"}, {"type": "text", "text": "ok"},
                                  {"type": "text", "text": "two"},
                                  {"type": "tool_use", "id": "t1", "name": "Read", "input": {"z": 1, "a": "b"}},
                                  {"type": "tool_use", "id": "t2", "name": "Edit"}],
                      "usage": {"input_tokens": 10, "output_tokens": 3}}),
        "{not json",
        line(type="mystery", uuid="q"),
        line(type="user", uuid="u2", sessionId=SID, cwd=7, message={"content": "wrong-typed cwd"}),
        line(type="assistant", uuid="a2", sessionId=SID, message={"content": "not an array"}),
        line(type="user", uuid="u3", sessionId=SID, message={"content": [{"type": "text", "text": "a"}, {"type": "image"},
                                                                         {"type": "text", "text": "b"}]}),
        line(type="system", sessionId=SID, content={"k": 1}),
        line(type="queue-operation", sessionId="other", timestamp="2026-01-08T11:00:00Z", content="queued"),
    ]
    write(p, "\r\n".join(lines) + "\r\n")
    write(f"{root}/projects/-home-u-my-app/{SID}/subagents/agent-x1.jsonl",
          line(type="user", uuid="s1", message={"content": "sub"}) + "\n")
    write(f"{root}/projects/-home-u-my-app/agent-y.jsonl", line(type="summary", summary="s") + "\n")
    return p


def test_claude_transcript_rules(spark, tmp_path):
    make_tree(str(tmp_path))
    t = from_roots(spark, claude=str(tmp_path))
    rows = {(r.file_name, r.line_number): r for r in t.get("conv_claude").collect()}
    main = f"{SID}.jsonl"
    assert sorted(k[1] for k in rows if k[0] == main) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert rows[(main, 1)].message_type == "summary" and rows[(main, 1)].message_content == "Fix the bug"
    a = rows[(main, 4)]
    assert a.message_content == "ok\ntwo" and a.tool_name == "Read" and a.tool_use_id == "t1"
    assert a.tool_input == '{"a":"b","z":1}' and a.input_tokens == 10 and a.model == "m1"
    for ln in (5, 6, 7, 8):  # bad JSON, unknown type, wrong-typed field, non-array assistant content
        assert rows[(main, ln)].message_type == "_parse_error"
        assert rows[(main, ln)].message_content.startswith("Parse error: ")
        assert rows[(main, ln)].session_id == SID
    assert rows[(main, 9)].message_content == "a\nb"
    assert rows[(main, 10)].message_content == '{"k":1}' and rows[(main, 10)].message_role is None
    assert rows[(main, 11)].session_id == "other" and rows[(main, 11)].timestamp == "2026-01-08T11:00:00Z"
    # cwd back-fill: every row whose path is the decoded directory gets the file's first cwd
    assert {r.project_path for k, r in rows.items() if k[0] == main} == {"/home/u/my-app"}
    sub = rows[("agent-x1.jsonl", 1)]
    assert sub.is_agent and sub.session_id == SID and sub.project_path == "/home/u/my/app"
    assert rows[("agent-y.jsonl", 1)].is_agent and rows[("agent-y.jsonl", 1)].session_id == "agent-y"


def test_missing_root_is_empty(spark, tmp_path):
    t = from_roots(spark, claude=str(tmp_path / "nope"), copilot=str(tmp_path / "nope2"))
    assert t.conv.count() == 0 and t.history.count() == 0 and t.todos.count() == 0


def test_side_tables(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/history.jsonl", "\n".join([
        line(display="one", pastedContents={"b": 1, "a": [1, 2]}, timestamp=1767866400123.9, project="/p", sessionId="s"),
        "", "{bad", line(display="two")]) + "\n")
    write(f"{root}/todos/s1-agent-a1.json", json.dumps([{"content": "c1", "status": "pending"},
                                                         {"content": "c2", "status": "in_progress", "activeForm": "Doing"}]))
    write(f"{root}/todos/s2-agent-x-agent-y.json", "[{")
    write(f"{root}/todos/nodash.json", "[]")
    write(f"{root}/plans/my-plan.md", "# Plan\nstep")
    write(f"{root}/stats-cache.json", json.dumps({"dailyActivity": [{"date": "2026-01-01", "messageCount": 5},
                                                                    {"sessionCount": 2}]}))
    t = from_roots(spark, claude=root)
    h = {r.line_number: r for r in t.history.collect()}
    assert set(h) == {1, 3, 4}
    assert h[1].timestamp_ms == 1767866400123 and h[1].pasted_contents == '{"a":[1,2],"b":1}'
    assert h[3].display.startswith("Parse error: ") and h[4].timestamp_ms is None
    todos = sorted((r.session_id, r.agent_id, r.item_index, r.status) for r in t.todos.collect())
    assert todos == [("s1", "a1", 0, "pending"), ("s1", "a1", 1, "in_progress"), ("s2", "x-agent-y", -1, "_parse_error")]
    p = t.plans.collect()[0]
    assert (p.plan_name, p.file_name, p.file_size, p.session_id) == ("my-plan", "my-plan.md", 11, None)
    s = sorted(tuple(r) for r in t.stats.collect())
    assert s == [("claude", "", 0, 2, 0), ("claude", "2026-01-01", 5, 0, 0)]


def test_claude_desktop_tree(spark, tmp_path):
    root = str(tmp_path)
    base = f"{root}/local-agent-mode-sessions/acct-1/ws-2/.claude/projects/-Users-me-proj"
    write(f"{base}/d-1.jsonl", line(type="user", sessionId="d-1", cwd="/Users/me/proj", message={"content": "hi"}) + "\n")
    write(f"{base}/d-1/subagents/agent-z.jsonl", line(type="user", message={"content": "sub"}) + "\n")
    write(f"{root}/local-agent-mode-sessions/.claude/projects/-top/t.jsonl", line(type="summary", summary="top") + "\n")
    t = from_roots(spark, claude_desktop=root)
    rows = sorted((r.source, r.session_id, r.file_name, r.is_agent, r.project_path) for r in t.get("conv_claude_desktop").collect())
    assert rows == [("claude-desktop", "d-1", "agent-z.jsonl", True, "/Users/me/proj"),
                    ("claude-desktop", "d-1", "d-1.jsonl", False, "/Users/me/proj"),
                    ("claude-desktop", "t", "t.jsonl", False, "/top")]
