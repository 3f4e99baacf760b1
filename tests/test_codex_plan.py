"""The row rules of Codex lines are evaluated once, not again in a pushed-down filter."""

from sessionlake.operators import codex


def test_row_filter_stays_above_the_row_rules(spark):
    lines = spark.createDataFrame([("/x/sessions/rollout-a.jsonl", 1, "{}")], "file_path string, line_number long, value string")
    plan = codex.normalise(lines).select("session_id", "message_type")._jdf.queryExecution().optimizedPlan()
    filters = [x for x in plan.toString().split("\n") if "Filter" in x]
    assert filters and not any("variant_get" in x for x in filters)
