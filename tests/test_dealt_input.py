"""Provider files of a small table are still written, and read, in many tasks."""

import glob

from sessionlake.plans.tables import Tables
from sessionlake.session import checkpoint_dir


def test_provider_files_of_a_one_file_table_are_many(spark, tmp_path):
    """A table in one row group must not become provider files that one task writes and one task parses."""
    turns = [(c, t, ("user", "assistant")[t % 2], f"text {c} {t}") for c in range(60) for t in range(4)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    tables = Tables.from_benchmark(spark, str(tmp_path))
    conv = tables.get("conv_claude")
    written = [d for d in glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/lake-*/claude_lines") if conv.inputFiles()[0].removeprefix("file://").startswith(d)]
    assert len(written) == 1 and len(glob.glob(f"{written[0]}/part-*")) > 4
    assert conv.where("message_type in ('user', 'assistant')").count() == len(turns)
