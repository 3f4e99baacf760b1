"""Cases where rules used to be bent: white space, null payloads, several
roots, damaged escapes, negative times, float labels, deep folders, Grok trees."""

import json

from trees import write
from pyspark.sql import functions as F

from sessionlake.functions import labels, time as T
from sessionlake.functions.paths import url_decode
from sessionlake.plans import queries as Q
from sessionlake.plans.tables import from_roots


def j(**kw):
    return json.dumps(kw)


def test_blank_lines_of_any_white_space_are_no_rows(spark, tmp_path):
    write(f"{tmp_path}/projects/-p/s.jsonl", "\n".join([j(type="user", message={"content": "a"}), "\t", "  ", j(type="user", message={"content": "b"})]))
    rows = from_roots(spark, claude=str(tmp_path)).get("conv_claude").collect()
    assert sorted((r.line_number, r.message_type) for r in rows) == [(1, "user"), (4, "user")]


def test_tab_indented_checklist(spark, tmp_path):
    write(f"{tmp_path}/session-state/d/checkpoints/1.md", "\t- [x] done\n\t- [ ] open\t\n")
    got = from_roots(spark, copilot=str(tmp_path)).todos.collect()
    assert sorted((r.content, r.status) for r in got) == [("done", "completed"), ("open", "pending")]


def test_null_payload_keeps_codex_state_at_any_depth(spark, tmp_path):
    uid = "0199a1b2-c3d4-7e5f-8a9b-0c1d2e3f4a5b"
    write(f"{tmp_path}/sessions/a/b/c/d/e/f/rollout-2026-01-02T10-00-00-{uid}.jsonl", "\n".join([
        j(type="session_meta", payload={"id": uid, "cwd": "/c", "cli_version": "0.9"}),
        j(type="session_meta"), j(type="session_meta", payload=None), j(type="turn_context", payload=None),
        j(type="response_item", payload={"type": "message", "role": "user", "content": [{"type": "input_text", "text": "hi"}]})]))
    t = from_roots(spark, codex=str(tmp_path))
    row = t.get("conv_codex").first()
    assert (row.cwd, row.version, row.message_content) == ("/c", "0.9", "hi")
    assert Q.q_totals(t).first().messages == 1
    assert Q.q_totals(from_roots(spark, codex=str(tmp_path), sources=("claude",))).first().messages == 0


def test_gemini_aliases_belong_to_their_root(spark, tmp_path):
    for user in "ab":
        write(f"{tmp_path}/{user}/tmp/app/chats/session-{user}.json", j(sessionId=user, messages=[{"id": "1", "type": "user", "content": "x"}]))
        write(f"{tmp_path}/{user}/projects.json", j(projects={f"/home/{user}/app": "app"}))
    got = from_roots(spark, gemini=f"{tmp_path}/*").get("conv_gemini").collect()
    assert {(r.session_id, r.project_path) for r in got} == {("a", "/home/a/app"), ("b", "/home/b/app")}


def test_desktop_folders_at_any_depth(spark, tmp_path):
    write(f"{tmp_path}/local-agent-mode-sessions/1/2/3/4/5/.claude/projects/-p/s.jsonl", j(type="user", message={"content": "deep"}))
    assert from_roots(spark, claude_desktop=str(tmp_path)).conv.first().source == "claude-desktop"


def test_grok_tree(spark, tmp_path):
    d = f"{tmp_path}/sessions/%2Fw%2Fx/0199a1b2-c3d4-7e5f-8a9b-0c1d2e3f4a5b"
    write(f"{d}/chat_history.jsonl", "\n".join([j(type="user", content="hi"), "\t", j(type="assistant", content="yo", model_id="m")]))
    write(f"{d}/summary.json", j(created_at="2026-05-18T10:00:00Z", generated_title="Title", num_messages=2))
    write(f"{d}/signals.json", j(userMessageCount=1, assistantMessageCount=1, toolCallCount=0))
    write(f"{d}/plan.md", "# plan")
    t = from_roots(spark, grok=str(tmp_path))
    assert sorted((r.line_number, r.message_type, r.message_content) for r in t.conv.collect()) == [(1, "user", "hi"), (3, "assistant", "yo")]
    assert [(r.plan_name, r.content) for r in t.plans.collect()] == [("Title", "# plan")]
    assert [(r.date, r.message_count) for r in t.stats.collect()] == [("2026-05-18", 2)]


def test_url_decode_keeps_only_the_bad_escape(spark):
    row = spark.createDataFrame([("%2FU%2Fa%zz+%",)], "s string").select(url_decode(F.col("s")).alias("d")).first()
    assert row.d == "/U/a%zz+%"


def test_epoch_is_cut_toward_zero(spark):
    df = spark.createDataFrame([(-500,), (-1500,), (1999,), (1704067200704,)], "ms long").select(T.epoch_ms_to_iso(F.col("ms")).alias("s"))
    assert [r.s for r in df.collect()] == ["1970-01-01T00:00:00Z", "1969-12-31T23:59:59Z", "1970-01-01T00:00:01Z", "2024-01-01T00:00:00Z"]


def test_tenths_print_like_floats(spark):
    ms = [1, 49, 50, 150, 950, 1000, 1050, 1150, 1250, 1350, 1750, 1850, 2050, 9950, 9949, 33350, 59950, 59999, *range(50, 60000, 100)]
    got = spark.createDataFrame([(m,) for m in ms], "ms long").select("ms", labels.tenths_label(F.col("ms")).alias("s")).collect()
    assert {r.ms: r.s for r in got} == {m: f"{m / 1000:.1f}" for m in ms}


def test_missing_roots_are_empty(spark, tmp_path):
    t = from_roots(spark, claude=f"{tmp_path}/none", codex=f"{tmp_path}/none", grok=f"{tmp_path}/none", claude_desktop=f"{tmp_path}/none")
    assert t.conv.count() == 0 and t.plans.count() == 0
