"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words in every contract of this package.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does that for pure ASCII
    strings and is much faster than ``translate``."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder: the rows are computed once, survive a
    lost executor, and later plans start from them."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def kept_table(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in the shared folder, for what is read more
    than once and is large. The folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def lower_batches(spark: SparkSession, rows: int) -> str | None:
    """Let no more than ``rows`` rows go to a Python worker at a time in this
    session; the setting before. Lower settings stay."""
    before = spark.conf.get(BATCH_ROWS, None)
    if before is None or not 0 < int(before) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))
    return before


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int):
    """``lower_batches`` for what runs inside."""
    before = lower_batches(spark, rows)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_ROWS)
        else:
            spark.conf.set(BATCH_ROWS, before)


def ship(df: DataFrame) -> DataFrame:
    """Hand this package's modules to the Python workers of ``df``'s session,
    once per application, through Spark's own file service; ``df`` itself."""
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_sessionlake_shipped", False):
        root = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="sessionlake-")) / "sessionlake_modules.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(path))
        sc._sessionlake_shipped = True
    return df
