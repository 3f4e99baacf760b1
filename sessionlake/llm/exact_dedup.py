"""Exact dedup by content sort.

Texts are equal when identical after lower-casing A-Z. Rows are dealt to tasks
by sampled range splitters over the normalised bytes (a bounded head, then a
hash of the whole text, then a bucket of the id, so neither a common beginning
nor one text held by a third of the rows lands in one task); the external sort
places equal texts next to each other and every row is compared in full with
its neighbours: where they differ a run ends, and its last row knows the run's
largest id and how many rows it has. Runs of one text that a splitter or an id
bucket parted, one row each, are put together by digest and byte length.

Defined results: a null text counts as empty; of equal texts the row with the
largest id stays (a null id is smaller than any id); rows that repeat both id
and text keep one row; an empty table gives no rows; other columns never count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import ascii_lower, cut, fresh

HEAD_CHARS = 64
ID_BUCKETS = 1024


def _norm(text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


def sorted_runs(docs: DataFrame, id_col: str, text_col: str, head_chars: int = HEAD_CHARS) -> tuple[DataFrame, list[str]]:
    """``docs`` with four added columns: the number of rows of the run on its last
    row in content order (null on the others), whether a row is that last one (so
    it has the run's largest id), the SHA-256 of the normalised text, and its byte
    length. Also returns the names of those columns."""
    head, key, bucket, norm, begins, place, rows, last, sha, size = fresh(
        docs, "head_", "key_", "bucket_", "norm_", "begins_", "place_", "rows_", "last_", "sha_", "size_")
    dealt = (docs
             .withColumns({head: F.substring(_norm(text_col), 1, head_chars), key: F.xxhash64(_norm(text_col)),
                           bucket: F.coalesce(F.pmod(F.xxhash64(F.col(id_col)), F.lit(ID_BUCKETS)), F.lit(0))})
             .repartitionByRange(head, key, bucket)
             .withColumn(norm, _norm(text_col)))
    run = Window.partitionBy(head, key, bucket).orderBy(F.col(norm), F.col(id_col).asc_nulls_first())
    before, after = F.lag(norm).over(run), F.lead(norm).over(run)
    out = (dealt.withColumns({begins: before.isNull() | (before != F.col(norm)), last: after.isNull() | (after != F.col(norm)),
                              place: F.row_number().over(run)})
           .withColumn(rows, F.col(place) - F.max(F.when(F.col(begins), F.col(place))).over(
               run.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + 1)
           .withColumns({rows: F.when(F.col(last), F.col(rows)), sha: F.sha2(norm, 256), size: F.octet_length(norm)})
           .drop(head, key, bucket, norm, begins, place))
    return out, [rows, last, sha, size]


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id (id of the row that stays),
    group_size, kept, text_sha256."""
    rows, (run_rows, last, sha, size) = sorted_runs(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                          "doc_id", "text")
    rows = cut(rows.select("doc_id", run_rows, last, sha, size))
    groups = rows.filter(last).groupBy(sha, size).agg(F.max("doc_id").alias("keep_id"), F.sum(run_rows).alias("group_size"))
    return rows.join(groups, [sha, size]).select(
        "doc_id", "keep_id", "group_size",
        (F.col(last) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), F.col(sha).alias("text_sha256"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, (_, last, sha, size) = sorted_runs(docs, id_col, text_col)
    rank = fresh(rows, "rank_")[0]
    best = Window.partitionBy(sha, size).orderBy(F.col(id_col).desc_nulls_last())
    return (rows.filter(last).withColumn(rank, F.row_number().over(best)).filter(F.col(rank) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW g AS (PARTITION BY norm)
"""
