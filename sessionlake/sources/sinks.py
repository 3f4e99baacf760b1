"""Sinks: write a result as CSV (the download of a query result)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sessionlake.session import checkpoint_dir


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def csv_roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write ``df`` as CSV below the shared checkpoint folder and read it back
    (all columns as text, as a CSV download would be)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_csv(df, path)
    return spark.read.option("header", True).csv(path)
