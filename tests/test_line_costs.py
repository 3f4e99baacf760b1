"""What a line costs: members are read in one walk, parsed values stay out of shuffles, text is built after its place is known."""

import re

from pyspark.sql import functions as F

from sessionlake.operators import codex, copilot
from sessionlake.sources import adapters as A


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def _lines(spark, path, *values):
    rows = [(path, 0, n, v) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "file_path string, block long, ord long, value string")


def test_codex_lines_are_walked_once(spark):
    df = codex.normalise(_lines(spark, "/s/rollout-a.jsonl", '{"type":"event_msg","payload":{}}'))
    for line in _plan(df):  # one call on the parsed line and none with a path on its payload, not one a member
        assert len(re.findall(r"try_variant_get\(v#", line)) <= 1 and not re.search(r"try_variant_get\(p#\d+, \$\.", line), line


def test_copilot_joins_lines_without_parsed_values(spark):
    ws = spark.createDataFrame([], "dir_path string, id string, cwd string, branch string, repository string")
    lines = _lines(spark, "/c/session-state/a/events.jsonl", '{"type":"abort"}')
    plan = _plan(copilot.normalise(lines, ws))
    first = next(i for i, x in enumerate(plan) if "Join LeftOuter" in x)
    assert not any("variant" in x.lower() for x in plan[:first])
    # the folder's facts are met by the state table, not by every line
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    left = next(x for x in plan[first + 1:])
    assert "Join" not in left and depth(left) > depth(plan[first])


def test_copilot_first_start_and_folder_give_the_metadata(spark):
    ws = spark.createDataFrame([("/c/session-state/a", "w", "/w", "wb", "wr")], "dir_path string, id string, cwd string, branch string, repository string")
    lines = _lines(spark, "/c/session-state/a/events.jsonl", '{"type":"abort","id":7}', '{"type":"abort"}',
                   '{"type":"session.start","data":{"sessionId":"s","context":{"cwd":"/x","branch":null}}}',
                   '{"type":"session.start","data":{"sessionId":"t","context":{"cwd":1}}}', '{"type":"session.model_change","data":{"newModel":"m"}}', "7")
    got = [tuple(r) for r in copilot.normalise(lines, ws).orderBy("line_number").select(
        "line_number", "session_id", "message_type", "cwd", "git_branch", "repository", "model").collect()]
    assert got == [(1, "w", "_parse_error", None, None, None, None), (2, "w", "abort", "/w", "wb", "wr", None),
                   (3, "s", "session_start", "/x", "wb", "wr", None), (4, "s", "session_start", "/x", "wb", "wr", None),
                   (5, "s", "model_change", "/x", "wb", "wr", "m"), (6, "s", "_parse_error", None, None, None, None)]


def test_text_is_built_after_places(spark):
    events = spark.range(3).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("long").alias("user_id"),
                                   F.lit("view").alias("event_type"))
    for lines in (A.copilot_lines(events), A.codex_lines(events)):
        plan = [x for x in _plan(lines) if x.lstrip().startswith(":")]
        at = next(i for i, x in enumerate(plan) if "Window [" in x)
        assert any("StructsToJson" in x for x in plan[:at]) and not any("StructsToJson" in x for x in plan[at:])
