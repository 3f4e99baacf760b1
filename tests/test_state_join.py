"""Wide rows meet the state of their stretch without being sorted."""

from sessionlake.operators import codex, copilot


def test_state_tables_are_hashed(spark):
    lines = spark.createDataFrame([("/x/session-state/a/events.jsonl", 0, 1, "{}")], "file_path string, block long, ord long, value string")
    folders = spark.createDataFrame([("/x/session-state/a", "a", "/w", "main", "r", "s")], "dir_path string, id string, cwd string, branch string, repository string, summary string")
    for rows, joins in ((codex.normalise(lines), 1), (copilot.normalise(lines, folders), 2)):
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("ShuffledHashJoin") == joins and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    # a query that reads nothing of the tables plans no join
    assert "Join" not in copilot.normalise(lines, folders).select("message_type")._jdf.queryExecution().sparkPlan().toString()
