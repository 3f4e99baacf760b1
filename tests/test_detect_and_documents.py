"""Detection per root, documents cut into pieces, and the consuming timeline, each against a plain version."""

import json
import random

from trees import write

from sessionlake.operators import gemini, grok
from sessionlake.operators.detect import classify
from sessionlake.operators.json_split import split_array
from sessionlake.sources.raw import piece_stream, raw_files


def _classified(spark, paths, source=None):
    df = spark.createDataFrame([(p,) for p in paths], "file_path string")
    return {r.file_path: tuple(r)[1:] for r in classify(df, source).collect()}


def test_precedence_marks_and_override_per_root(spark):
    both = ["/h/a/projects/-x/s1.jsonl", "/h/a/session-state/s2/events.jsonl", "/h/a/history.jsonl", "/h/a/plans/p.md"]
    desktop = ["/d/local-agent-mode-sessions/u/o/local_1/.claude/projects/-y/s3/subagents/agent-1.jsonl"]
    copilot = ["/h/projects/app/.copilot/session-state/s4.jsonl", "/h/projects/app/.copilot/command-history-state.json"]
    date, enc = ["/h/c/sessions/2024/01/02/rollout-x-1-2-3-4-5.jsonl"], ["/h/g/sessions/%2Fw/s5/chat_history.jsonl"]
    mixed = ["/h/m/sessions/2024/01/01/rollout-a.jsonl", "/h/m/sessions/%2Fw/s6/chat_history.jsonl"]
    marked, bare = ["/h/.gemini/tmp/p1/chats/session-1.json", "/h/.gemini/installation_id", "/h/.gemini/projects.json"], ["/h/t/tmp/p/chats/session-1.json"]
    got = _classified(spark, both + desktop + copilot + date + enc + mixed + marked + bare + ["/h/x/state.vscdb", "/h/none.txt"])
    none = (None,) * 5 + (False,)
    assert got[both[0]] == ("claude", "conversations", "/h/a", "-x", "s1", False)
    assert got[both[1]] == none  # the root is Claude's, so Copilot's files there count for nothing
    assert got[both[2]][:3] == ("claude", "history", "/h/a") and got[both[3]][:2] == ("claude", "plans")
    assert got[desktop[0]] == ("claude-desktop", "conversations", "/d", "-y", "s3", True)
    assert got[copilot[0]] == ("copilot", "conversations", "/h/projects/app/.copilot", None, "s4", False)
    assert got[copilot[1]][:2] == ("copilot", "history")
    assert got[date[0]] == ("codex", "conversations", "/h/c", None, "1-2-3-4-5", False)
    assert got[enc[0]] == ("grok", "conversations", "/h/g", "%2Fw", "s5", False)
    assert got[mixed[0]][0] == "codex" and got[mixed[1]] == none
    assert got[marked[0]][:4] == ("gemini", "conversations", "/h/.gemini", "p1") and got[marked[2]][0] == "gemini" and got[bare[0]] == none
    assert got["/h/x/state.vscdb"][0] == "cursor" and got["/h/none.txt"] == none
    over = _classified(spark, both + bare, "CoPilot")
    assert over[both[1]][:2] == ("copilot", "conversations") and over[both[0]] == none
    assert _classified(spark, bare, "gemini")[bare[0]][0] == "gemini" and _classified(spark, both, "other") == {k: got[k] for k in both}
    assert classify(spark.createDataFrame([], "file_path string")).count() == 0


def _stream(spark, docs, rng):
    rows = []
    for name, text in docs.items():
        block = at = 0
        for piece in text.split(","):
            if rng.random() < 0.2:
                block, at = block + rng.randrange(1, 5), rng.randrange(1000)
            rows.append((name, block, at, piece))
            at += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "file_path string, block long, ord long, value string")


def _messages(rng, n):
    odd = ['a, "b", [c', 'x\\"]},{', "}{][", "line\nbreak, \t", "é, ü", "\\", '\\\\"', ""]
    return [{"id": f"m{i}", "type": rng.choice(["user", "gemini"]), "content": rng.choice(odd) * rng.randrange(3),
             "tokens": {"input": i, "output": 1}, "toolCalls": [{"id": f"t{i}", "name": "N", "args": {"l": [1, [2, {"k": ","}]], "s": rng.choice(odd)}}] * (i % 3)}
            for i in range(n)]


def test_arrays_cut_anywhere_equal_whole_documents(spark):
    rng = random.Random(5)
    docs = {}
    for k in range(12):
        body = [("sessionId", f"s{k}"), ("startTime", "T0"), ("other", {"a": [1, {"b": "messages\":["}], "c": "}"})]
        body.insert(rng.randrange(4), ("messages", _messages(rng, rng.choice([0, 1, 2, 30]))))
        docs[f"/g/tmp/h{k}/chats/session-{k}.json"] = json.dumps(dict(body), indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
    whole = list(docs.items())
    docs["/g/tmp/h/chats/session-cut.json"] = whole[3][1][:-2]
    docs["/g/tmp/h/chats/session-typed.json"] = '{"sessionId": 7, "messages": [{"id": "a"}]}'
    docs["/g/tmp/h/chats/session-badmsg.json"] = '{"messages": [{"id": "a"}, {"id": 1}]}'
    docs["/g/tmp/h/chats/session-none.json"] = '{"sessionId": "s"}'
    docs["/g/tmp/h/chats/session-object.json"] = '{"messages": {"a": [1, 2]}}'
    docs["/g/tmp/h/chats/session-text.json"] = 'no, json'
    pieces = _stream(spark, docs, rng)
    elements, rest = split_array(pieces, "messages")
    got = {}
    for r in elements.orderBy("pos").collect():
        got.setdefault(r.file_path, []).append(r.value)
    for name, text in whole:
        assert [json.loads(x) for x in got.get(name, [])] == json.loads(text)["messages"]
    left = {r.file_path: (r.whole, r.value) for r in rest.collect()}
    for name, text in whole:
        want = json.loads(text)
        del want["messages"]
        assert left[name][0] and json.loads(left[name][1]) == want
    files = spark.createDataFrame(list(docs.items()), "file_path string, content string")
    rows = lambda df: sorted((json.dumps(r.asDict(), sort_keys=True) for r in df.collect()))
    assert rows(gemini.normalise_pieces(pieces)) == rows(gemini.normalise(files))
    # a message beyond the limit is told apart from a damaged file
    said = {r.file_name: r.message_content for r in gemini.normalise_pieces(pieces, largest=60).where("message_type = '_parse_error'").collect()}
    assert said["session-cut.json"] == "Parse error: invalid session file" or "too large" in said["session-cut.json"]
    assert said["session-text.json"] == "Parse error: invalid session file"
    assert any("too large" in x for x in said.values())


def test_large_document_read_in_splits(spark, tmp_path):
    rng = random.Random(9)
    path = write(f"{tmp_path}/tmp/h/chats/session-big.json", json.dumps({"sessionId": "s", "messages": _messages(rng, 3000)}))
    write(f"{tmp_path}/tmp/h/chats/session-small.json", json.dumps({"sessionId": "t", "messages": _messages(rng, 2)}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        pieces = piece_stream(spark, [f"{tmp_path}/tmp/*/chats/*.json"], 10_000)
        assert pieces.select("block").distinct().count() > 3 and {r[0] for r in pieces.select("file_path").distinct().collect()} == {path}
        got = gemini.normalise_pieces(pieces)
        want = gemini.normalise(raw_files(spark, [path]))
        assert got.count() == want.count() > 3000 and got.exceptAll(want).count() == 0
        assert raw_files(spark, [f"{tmp_path}/tmp/*/chats/*.json"], 10_000).count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_timeline_consumes_what_it_passes(spark):
    rng = random.Random(4)
    types, kinds = [*grok.LINE_TYPES, "", "odd"], [*grok.TIMELINE_KINDS, "noise"]
    lines = [(f"s{s}", i + 1, rng.choices(types, [8, 8, 5, 3, 5, 0.3, 0.3])[0]) for s in range(6) for i in range(rng.choice([0, 5, 120]))]
    events = [(f"s{s}", i, rng.choice(kinds), rng.choice([None, 1_700_000_000 + i])) for s in range(6) for i in range(rng.choice([0, 3, 400]))]
    want = {}
    for s in {x[0] for x in lines}:
        stream = [e for e in events if e[0] == s and e[3] is not None and e[2] in grok.TIMELINE_KINDS]
        i = 0
        for _, n, t in (x for x in lines if x[0] == s):
            if t == "system":
                continue
            while i < len(stream):
                i += 1
                if stream[i - 1][2] in grok.CANDIDATES.get(t, ()):
                    want[s, n] = stream[i - 1][3]
                    break
    rng.shuffle(lines)
    rng.shuffle(events)
    got = grok.align_times(spark.createDataFrame(lines, "sdir string, line_number long, peek string"),
                           spark.createDataFrame(events, "sdir string, line_number long, kind string, secs long"))
    from datetime import datetime, timezone
    assert {(r.sdir, r.line_number): r.matched for r in got.collect()} == {
        k: datetime.fromtimestamp(v, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for k, v in want.items()}
