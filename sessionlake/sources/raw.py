"""Readers for real session trees.

* :func:`raw_lines` — every line of text files as ``(file_path, line_number,
  value)``: 1-based physical line numbers, a trailing ``\\r`` stripped, blank
  lines counted but not returned.
* :func:`raw_files` — whole files as ``(file_path, content, file_size)``.
* :func:`sqlite_kv` — the key/value table of SQLite files (Cursor state).

A text file is split into blocks (input splits) that are read in order, one task
each, so a line's place is its block and its order there. The normalisers turn
places into line numbers from one small record a block
(:mod:`sessionlake.operators.blocks`); no task ever needs a whole file.

Missing roots give empty frames (no error), as a missing history directory
simply means "no sessions"."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from sessionlake.operators.blocks import numbered

FILES = StructType([StructField("file_path", StringType()), StructField("content", StringType()),
                    StructField("file_size", LongType())])
STREAM = StructType([StructField("file_path", StringType()), StructField("block", LongType()), StructField("ord", LongType()),
                     StructField("value", StringType())])
KV = StructType([StructField("key", StringType()), StructField("value", StringType())])


def decode_path(uri):
    """``_metadata.file_path`` is a URI: drop the scheme and undo the
    percent-encoding once (``+`` stays a plus)."""
    p = F.regexp_replace(uri, r"^file:(//)?", "")
    return F.coalesce(F.try_url_decode(F.regexp_replace(p, r"\+", "%2B")), p)


def _matches(spark: SparkSession, pattern: str) -> list:
    """File states that a path pattern matches, on any file system Spark reads;
    nothing for a missing one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return list(found) if found is not None else []


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Keep the patterns that match something: a missing root means no rows."""
    return [p for p in paths if _matches(spark, p)]


def folders_named(spark: SparkSession, root: str, name: str) -> list[str]:
    """Folders of a name below a root (a pattern), at any depth; only folders
    are visited, and none below a match."""
    out, todo = [], [s for s in _matches(spark, root) if s.isDirectory()]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while todo:
        path = todo.pop().getPath()
        if path.getName() == name:
            out.append(path.toString())
        else:
            todo += [s for s in path.getFileSystem(conf).listStatus(path) if s.isDirectory()]
    return sorted(out)


def line_stream(spark: SparkSession, paths: list[str], below: str | None = None) -> DataFrame:
    """The lines of the files that the patterns match or, with ``below``, of the
    files of that name at any depth below the folders they match, as a stream of
    blocks (see :mod:`sessionlake.operators.blocks`)."""
    paths = _existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], STREAM)
    reader = spark.read.option("lineSep", "\n")
    if below:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", below)
    return text_stream(reader.text(paths).select("value", "_metadata"))


def text_stream(text: DataFrame) -> DataFrame:
    """``text(value, _metadata)`` as read by the text source, as a stream. The
    non-deterministic place keeps later filters above it, so that both passes
    over a file see the same places."""
    return text.select(decode_path(F.col("_metadata.file_path")).alias("file_path"),
                       F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("ord"), F.regexp_replace("value", "\r$", "").alias("value"))


def raw_lines(spark: SparkSession, paths: list[str], below: str | None = None) -> DataFrame:
    """Numbered, non-blank lines of the same files."""
    return numbered(line_stream(spark, paths, below))


#: Bytes of a document that is still read as one row.
LARGEST_DOCUMENT = 8_000_000


def raw_files(spark: SparkSession, paths: list[str], largest: int | None = None) -> DataFrame:
    """Whole files as ``(file_path, content, file_size)``; with ``largest`` only
    those of at most that size (a file filter, so the others are not opened)."""
    paths = _existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], FILES)
    text = spark.read.text(paths, wholetext=True)
    if largest is not None:
        text = text.where(F.col("_metadata.file_size") <= largest)
    return text.select(decode_path(F.col("_metadata.file_path")).alias("file_path"), F.col("value").alias("content"),
                       F.col("_metadata.file_size").alias("file_size"))


def piece_stream(spark: SparkSession, paths: list[str], larger_than: int = 0) -> DataFrame:
    """Files beyond a size as streams of the pieces between their commas."""
    paths = _existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], STREAM)
    text = spark.read.option("lineSep", ",").text(paths).where(F.col("_metadata.file_size") > larger_than)
    return text_stream(text.select("value", "_metadata"))


def sqlite_kv(spark: SparkSession, paths: list[str], table: str = "cursorDiskKV") -> DataFrame:
    """Rows of a key/value table inside SQLite database files. Each database
    is one binary file row; a Python task opens it in memory with the
    standard library and streams its rows out in Arrow batches."""
    paths = _existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], KV)

    def read(batches):
        import sqlite3

        import pandas as pd
        for pdf in batches:
            for content in pdf["content"]:
                con = sqlite3.connect(":memory:")
                try:
                    con.deserialize(bytes(content))
                    cur = con.execute(f"SELECT key, value FROM {table}")
                    while True:
                        chunk = cur.fetchmany(2048)
                        if not chunk:
                            break
                        yield pd.DataFrame({
                            "key": [k.decode("utf-8", "replace") if isinstance(k, bytes) else k for k, _ in chunk],
                            "value": [v.decode("utf-8", "replace") if isinstance(v, bytes) else v for _, v in chunk]})
                finally:
                    con.close()

    return spark.read.format("binaryFile").load(paths).select("content").mapInPandas(read, KV)


def workspace_yaml(files: DataFrame) -> DataFrame:
    """Flat ``workspace.yaml`` files → ``(dir_path, id, cwd, git_root,
    repository, branch, summary)`` (one ``key: value`` per line)."""
    def key(k: str):
        v = F.regexp_extract("content", rf"(?m)^{k}:[ \t]*(.*?)[ \t]*\r?$", 1)
        v = F.regexp_replace(v, r'^"(.*)"$|^\'(.*)\'$', "$1$2")
        return F.nullif(v, F.lit("")).alias(k)
    return files.select(F.regexp_replace("file_path", r"/[^/]*$", "").alias("dir_path"),
                        *[key(k) for k in ("id", "cwd", "git_root", "repository", "branch", "summary")])


def join(root: str, *parts: str) -> str:
    return os.path.join(root, *parts)
