"""Block summaries, carried state, timelines in buckets and the salted join, each against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from sessionlake.operators import blocks, cursor
from sessionlake.plans import queries as Q


def _file(rng, name, lines):
    """Lines cut into blocks of random size, with places that begin anywhere."""
    rows, line, block, at = [], 1, rng.randrange(100), rng.randrange(10**6)
    while line <= lines:
        for _ in range(min(rng.choice([1, 3, 50, 700]), lines - line + 1)):
            rows.append((name, block, at, line, rng.choice(["", "  ", "x", "a=1", "a=2", "b=7", "a=3 b=8", "fact"])))
            line, at = line + 1, at + 1
        block, at = block + rng.randrange(1, 9), rng.randrange(10**6)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_carried_state_facts_and_line_numbers(spark, seed):
    rng = random.Random(seed)
    rows = _file(rng, "f1", 3000) + _file(rng, "f2", 1) + _file(rng, "f3", 400)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    stream = spark.createDataFrame([(f, b, o, v) for f, b, o, _, v in shuffled], "file_path string, block long, ord long, value string").repartition(5)
    take = lambda k: F.nullif(F.regexp_extract("value", rf"{k}=(\d)", 1), F.lit(""))
    table = blocks.state_table(stream, first={"first_b": take("b")}, anywhere={"has": F.col("value") == "fact"},
                               carried={"a": take("a"), "b": F.struct(take("b").alias("x")) if seed == 2 else take("b")})
    assert table.groupBy(*blocks.KEY, "_stretch").count().where("count > 1").count() == 0
    got = {(r.file_path, r.line_number): r for r in blocks.attach(stream.where(blocks.not_blank()), table).collect()}
    import re
    want = {}
    for f in ("f1", "f2", "f3"):
        mine = [r for r in rows if r[0] == f]
        bs = [m.group(1) for r in mine if (m := re.search(r"b=(\d)", r[4]))]
        has, a, b = any(r[4] == "fact" for r in mine), None, None
        for r in mine:
            a = m.group(1) if (m := re.search(r"a=(\d)", r[4])) else a
            # a struct replaces the whole state, also with nothing in it
            m = re.search(r"b=(\d)", r[4])
            b = (m.group(1) if m else None) if seed == 2 else (m.group(1) if m else b)
            if r[4].strip():
                want[f, r[3]] = (r[4], a, b, bs[0] if bs else None, has)
    assert set(got) == set(want)
    for k, w in want.items():
        r = got[k]
        assert (r.value, r.a, r.b.x if seed == 2 else r.b, r.first_b, r.has) == w, k


def test_numbered_frames_keep_their_numbers(spark):
    lines = spark.createDataFrame([("f", 3, "a=1"), ("f", 10, "x"), ("f", 500, "a=2"), ("f", 501, "y")], "file_path string, line_number long, value string")
    stream = blocks.as_stream(lines)
    table = blocks.state_table(stream, carried={"a": F.nullif(F.regexp_extract("value", r"a=(\d)", 1), F.lit(""))})
    assert sorted((r.line_number, r.a) for r in blocks.attach(stream, table).collect()) == [(3, "1"), (10, "1"), (500, "2"), (501, "2")]
    assert blocks.numbered(lines) is lines


def test_no_line_is_compared_with_a_range_and_plain_counts_join_nothing(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    plan = E.queries()["ingest_codex"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "line_number" in plan and not any(" < " in x and "Join" in x for x in plan.splitlines())
    plan = E.queries()["norm_copilot_types"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def _events(spark, rng, n=600):
    rows = []
    for s in ("s1", "s2"):
        for source in ("p", "q"):
            for i in range(n if s == "s1" else 3):
                ts = None if rng.random() < 0.5 else f"2024-01-0{rng.randrange(1, 4)}T00:00:{rng.randrange(60):02d}Z"
                rows.append((source, s, "f", i + 1, False, ts if rng.random() < 0.97 else "no time", rng.choice(["user", "_parse_error"])))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "source string, session_id string, file_name string, line_number long, is_agent boolean, "
                                             "timestamp string, message_type string")


@pytest.mark.parametrize("bucket", [7, 4096])
def test_timelines_in_buckets(spark, bucket):
    import datetime
    rows, df = _events(spark, random.Random(bucket))
    def ms(t):
        try:
            return int(datetime.datetime.fromisoformat(t.replace("Z", "+00:00")).timestamp() * 1000)
        except (ValueError, AttributeError):
            return None
    want, breaks = {}, {}
    for key in {r[:2] for r in rows}:
        prev = first = None
        day, seen = None, False
        for r in sorted((r for r in rows if r[:2] == key and r[6] != "_parse_error"), key=lambda r: r[3]):
            t = ms(r[5])
            if t is None:
                want[(*key, r[3])] = (None, None)
            else:
                first = t if first is None else first
                want[(*key, r[3])] = (0 if prev is None else t - prev, t - first)
                prev = t
            if r[5] is not None:
                d = r[5][:10] if ms(r[5]) is not None else None
                breaks[(*key, r[3])] = (d, True if not seen or day is None or d is None else d != day)
                day, seen = d, True
    got = {(r.source, r.session_id, r.line_number): (r.delta_ms, r.offset_ms) for r in Q.timeline_deltas(df, bucket).collect()}
    assert got == want
    got = {(r.source, r.session_id, r.line_number): (r.day, r.is_new_day) for r in Q.day_breaks(df, bucket).collect()}
    assert got == breaks


def test_salted_many_to_many_join(spark):
    conv = spark.createDataFrame([("p", "hot", f"u{i % 9}", "f", i) for i in range(500)] + [("p", "cold", "u", "f", 1), ("q", "hot", "u", "f", 1), ("p", None, "u", "f", 1)],
                                 "source string, session_id string, uuid string, file_name string, line_number long")
    hist = spark.createDataFrame([("p", "hot", f"h{i % 4}") for i in range(40)] + [("p", "cold", "h"), ("p", "none", "h"), ("p", None, "h")],
                                 "source string, session_id string, display string")
    plain = conv.join(hist, ["source", "session_id"]).select("session_id", "uuid", "display")
    count = lambda df: sorted(map(tuple, df.collect()))
    want = count(plain)
    assert len(want) == 20001
    for size in (10, 1000, 10**6):
        assert count(Q.conv_history(conv, hist, size)) == want


def test_long_composer_in_linear_work(spark):
    import json
    import time
    n = 16000
    heads = [{"bubbleId": f"b{i}", "type": 1} if i % 5 else {"type": 2} for i in range(n)]
    kv = spark.createDataFrame([("composerData:c", json.dumps({"fullConversationHeadersOnly": heads})), ("bubbleId:c:x:b1", "{not parsed"),
                                ("bubbleId:short", "{}"), ("other:c", "{}")], "key string, value string")
    keys = sorted((r.key, r.kind, r.composer, r.bubble) for r in cursor.keys(kv).select("key", "kind", "composer", "bubble").collect())
    assert keys == [("bubbleId:c:x:b1", "bubble", "c", "x:b1"), ("bubbleId:short", None, None, None),
                    ("composerData:c", "composer", "c", None), ("other:c", None, None, None)]
    t0 = time.time()
    got = sorted((r.line_number, r.uuid, r.parent_uuid) for r in cursor.normalise(kv).collect())
    assert time.time() - t0 < 60
    ids = [i for i in range(n) if i % 5]
    assert got == [(i + 1, f"b{i}", f"b{ids[k - 1]}" if k else None) for k, i in enumerate(ids)]
