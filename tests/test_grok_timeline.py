"""The Grok timeline fold takes many sessions a call."""

import random
from datetime import datetime, timezone

from sessionlake.operators import grok


def _greedy(lines, events):
    want = {}
    for s in {x[0] for x in lines}:
        stream, i = sorted((e for e in events if e[0] == s), key=lambda e: e[1]), 0
        for _, n, t in sorted((x for x in lines if x[0] == s), key=lambda x: x[1]):
            while i < len(stream):
                i += 1
                if stream[i - 1][2] in grok.CANDIDATES.get(t, ()):
                    want[s, n] = stream[i - 1][3]
                    break
    return want


def test_grok_timeline_folds_many_sessions_a_call(spark):
    """Sessions of every kind go through shared batches, and one that a batch ends in goes on in the next."""
    rng = random.Random(3)
    types = [t for t in grok.LINE_TYPES if t != "system"] + ["odd"]
    lines = [(f"s{s}", i + 1, rng.choices(types, [8, 8, 5, 5, 0.2])[0]) for s in range(90) for i in range(rng.choice([0, 1, 4, 40]))]
    events = [(f"s{s}", i, rng.choice(grok.TIMELINE_KINDS), 1_700_000_000 + i) for s in range(90) for i in range(rng.choice([0, 2, 6, 90]))]
    rng.shuffle(lines)
    rng.shuffle(events)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = grok.align_times(spark.createDataFrame(lines, "sdir string, line_number long, peek string"),
                               spark.createDataFrame(events, "sdir string, line_number long, kind string, secs long"))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "InPandas" not in plan and "MapInArrow" in plan
    assert {(r.sdir, r.line_number): r.matched for r in rows} == {
        k: datetime.fromtimestamp(v, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") for k, v in _greedy(lines, events).items()}


def test_lines_and_updates_without_a_number_come_last(spark):
    lines = [("s", None, "user"), ("s", 1, "user"), ("s", 2, "user")]
    events = [("s", None, "user_message_chunk", 30), ("s", 1, "user_message_chunk", 10), ("s", 2, "user_message_chunk", 20)]
    got = grok.align_times(spark.createDataFrame(lines, "sdir string, line_number long, peek string"),
                           spark.createDataFrame(events, "sdir string, line_number long, kind string, secs long"))
    assert {r.line_number: r.matched[-3:] for r in got.collect()} == {1: "10Z", 2: "20Z", None: "30Z"}
