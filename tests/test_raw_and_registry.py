import os

import pytest
from trees import write

from sessionlake.sources.raw import raw_lines


def test_line_numbers_across_splits(spark, tmp_path):
    p = write(str(tmp_path / "big.jsonl"), "".join(("" if i % 97 == 0 else f'{{"i":{i}}}') + "\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = raw_lines(spark, [p])
        assert df.rdd.getNumPartitions() > 1
        got = {r.line_number: r.value for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {i: f'{{"i":{i}}}' for i in range(1, 5001) if i % 97 != 0}
    assert got == want


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert "first_user_message" in df.columns and df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80


ORACLE_SAMPLE = ["ingest_claude", "ingest_copilot", "ingest_codex", "ingest_gemini", "ingest_cursor",
                 "ingest_history_all", "ingest_todos_all", "ingest_stats_all", "q_session_index", "q_timeline_deltas",
                 "q_sessions_with_todos", "q_orphan_projects", "q_filters", "q_daily_pivot", "q_quality_report"]


@pytest.mark.parametrize("name", ORACLE_SAMPLE if not os.environ.get("ORACLE_ALL") else None)
def test_oracle_sf0001(spark, name):
    import duckdb
    import pandas as pd
    from tools.check_oracle import TABLES, digest
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    q, o = E.queries(), E.oracle_sql()
    if name not in q:
        pytest.skip(f"{name} not registered")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sdf = q[name](spark, sf)
    s = digest(pd.DataFrame(sdf.collect(), columns=sdf.columns))
    assert s == digest(con.execute(o[name]).df())
