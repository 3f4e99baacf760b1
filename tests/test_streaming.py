import json

from trees import write

from sessionlake.operators import claude
from sessionlake.streaming.incremental import ingest_transcripts


def test_incremental_ingest(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    sid = "s-1"
    write(f"{src}/projects/-home-u-app/{sid}.jsonl",
          "\n".join(json.dumps({"type": "user", "sessionId": sid, "cwd": "/home/u/app", "message": {"content": f"m{i}"}})
                    for i in range(3)) + "\n")
    q = ingest_transcripts(spark, str(src), out, claude.normalise, name=f"t{abs(hash(str(tmp_path)))}", trigger_once=True)
    q.awaitTermination(120)
    write(f"{src}/projects/-home-u-app/s-2.jsonl", json.dumps({"type": "summary", "summary": "x"}) + "\n")
    q = ingest_transcripts(spark, str(src), out, claude.normalise, name=f"t{abs(hash(str(tmp_path)))}", trigger_once=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted((r.session_id, r.line_number) for r in rows) == [("s-1", 1), ("s-1", 2), ("s-1", 3), ("s-2", 1)]
    assert {r.project_path for r in rows if r.session_id == "s-1"} == {"/home/u/app"}
