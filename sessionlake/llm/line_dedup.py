"""Line dedup over overlapping three-line windows.

Every window of three consecutive lines is hashed (128 bits). A window that is
found more than once in the whole table keeps its first occurrence, by
(doc_id, text hash, line); the lines covered by its later occurrences are
merged and removed. Only windows that occur again are joined back, after
partial aggregation, so one window in a third of all rows is one row per task.

Defined results: lines are the \\n-split parts; a line without a word is no part
of any window and always stays; lines are compared after trimming white space;
a document with fewer than three worded lines has no window and stays as it is;
a null text stays null; rows that repeat both id and text count as one document
and are all cleaned alike; a null id comes first; an empty table gives no rows;
extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import fresh

WINDOW = 3
BLANKS = " \t\n\x0b\x0c\r"


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per window: doc_id, row hash, first line of the window (counted
    over worded lines), window hash in two halves."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_hash"),
                        F.filter(F.transform(F.split(F.col(text_col), "\n", -1), _trim), lambda x: x != "").alias("lines"))
    hashed = (lines.filter(F.size("lines") >= WINDOW)
              .select("doc_id", "row_hash", F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
                      F.transform("lines", lambda x: F.xxhash64(x, F.lit(1))).alias("b")))
    return hashed.select("doc_id", "row_hash", F.inline(F.transform(
        F.sequence(F.lit(0), F.size("a") - WINDOW),
        lambda i: F.struct(i.alias("at"),
                           F.xxhash64(*[F.get(F.col("a"), i + k) for k in range(WINDOW)]).alias("w1"),
                           F.xxhash64(*[F.get(F.col("b"), i + k) for k in range(WINDOW)]).alias("w2")))))


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with a later occurrence: doc_id, row hash and the sorted
    numbers of the worded lines to remove."""
    w = windows(docs, id_col, text_col)
    first = (w.groupBy("w1", "w2")
             .agg(F.min(F.struct("doc_id", "row_hash", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("w1", "w2", "first"))
    later = (w.join(first, ["w1", "w2"])
             .filter(~F.struct("doc_id", "row_hash", "at").eqNullSafe(F.col("first"))))
    return (later.groupBy("doc_id", "row_hash").agg(F.collect_set("at").alias("starts"))
            .select("doc_id", "row_hash", F.array_sort(F.array_distinct(F.flatten(F.transform(
                "starts", lambda s: F.sequence(s, s + (WINDOW - 1)))))).alias("removed")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and the columns
    n_lines (worded lines found) and n_removed."""
    key, gone_id, gone_key, gone, parts, worded = fresh(docs, "key_", "gone_id_", "gone_key_", "gone_", "parts_", "worded_")
    removed = covered(docs, id_col, text_col).select(F.col("doc_id").alias(gone_id), F.col("row_hash").alias(gone_key),
                                                     F.col("removed").alias(gone))
    joined = docs.withColumn(key, F.xxhash64(F.col(text_col))).join(
        removed, F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left")
    split = joined.withColumn(parts, F.split(F.col(text_col), "\n", -1))
    numbered = split.withColumn(worded, F.filter(F.sequence(F.lit(0), F.size(parts) - 1),
                                                 lambda i: _trim(F.get(F.col(parts), i)) != ""))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1),
                          F.transform(F.col(gone), lambda r: F.get(F.col(worded), r)))
    text = (F.when(F.col(gone).isNull(), F.col(text_col))
            .otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n")))
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (text_col.lower(), "n_lines", "n_removed")]
    return numbered.select(*rest, text.alias(text_col), F.coalesce(F.size(worded), F.lit(0)).alias("n_lines"),
                           F.coalesce(F.size(gone), F.lit(0)).alias("n_removed"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that is left."""
    return dedup_lines(docs).select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                                    F.col("n_removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


SQL = """
WITH l AS (SELECT doc_id, text, line, raw, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
           FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
                        generate_subscripts(string_split(text, chr(10)), 1) AS raw
                 FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, raw, t, row_number() OVER d - 1 AS pos, lead(t, 1) OVER d AS t2, lead(t, 2) OVER d AS t3
      FROM l WHERE t <> '' WINDOW d AS (PARTITION BY doc_id, text ORDER BY raw)),
later AS (SELECT doc_id, pos FROM w WHERE t3 IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY t, t2, t3 ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS v(k)),
lost AS (SELECT w.doc_id, w.raw FROM w JOIN gone USING (doc_id, pos)),
left_over AS (SELECT l.doc_id, count(*) FILTER (WHERE t <> '') AS n_lines, count(lost.raw) AS n_removed,
                     coalesce(string_agg(line, chr(10) ORDER BY l.raw) FILTER (WHERE lost.raw IS NULL), '') AS rest
              FROM l LEFT JOIN lost ON l.doc_id = lost.doc_id AND l.raw = lost.raw GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(rest) AS text_sha256
FROM documents d LEFT JOIN left_over USING (doc_id)
"""
