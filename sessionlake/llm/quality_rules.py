"""Line-first cleaning: rules per line, then a verdict per document.

Every line with a word is tested for (1) punctuation: it must end a sentence
and not consist of decorated words, (2) navigation: it is a list of items set
apart by bars or arrows, (3) boilerplate: a licence, rights, cookie or sign-up
phrase, one word over and over, or a line that stood earlier in the text.
Failing lines are removed; a document is rejected if the base rules fail or if
the lines that pass hold less than ``MIN_LEFT`` percent of its words.

Defined results: a null or empty text has no words and fails the base rules;
rows are judged one by one, so repeated rows, ties and null ids do not matter;
an empty table gives no rows; extra columns are kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import SPACE, WORD, fresh

MIN_WORDS = 50
MAX_REPEAT = 50
MIN_LEFT = 50
SYMBOLS = r"[#*$%&|<>]"
#: Share of decorated words (percent) from which a line fails.
MAX_DECORATED = 30
#: Share of separators among the items of a line (percent) from which it is navigation.
MIN_SEPARATORS = 25
#: Lower-case phrases that mark a line as boilerplate.
BOILERPLATE = ["all rights reserved", "licensed under", "is licensed", "under the mit license", "terms of use",
               "terms of service", "privacy policy", "accept cookies", "use of cookies", "sign up for", "subscribe to",
               "click here", "log in to", "share this", "enable javascript", "lorem ipsum", "copyright ©", "copyright (c)"]

_POS_BITS = 24
_HASH_MASK = -(1 << _POS_BITS)


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def line_fails(line: Column) -> Column:
    """Whether a line (with at least one word) breaks a rule."""
    words = n_words(line)
    ending = F.regexp(F.substring(F.btrim(line, F.lit(" \t\x0b\x0c\r")), -3, 3), F.lit("[.!?…。！？;:][\"'»”’)\\]]*$"))
    decorated = F.regexp_count(line, F.lit(r"!!|[#*$%&<>]{2}[#*$%&<>]*"))
    separators = F.regexp_count(line, F.lit(r"[\x20\t][|»›·•→][\x20\t]"))
    lowered = F.lower(line)
    phrase = F.lit(False)
    for p in BOILERPLATE:
        phrase = phrase | lowered.contains(p)
    return (~ending | (decorated * 100 > words * MAX_DECORATED)
            | ((separators >= 2) & (separators * 100 >= words * MIN_SEPARATORS)) | phrase)


def one_word_line(line: Column) -> Column:
    """A line of five or more words, fewer than a quarter of them distinct."""
    words = F.regexp_extract_all(line, F.lit(WORD), F.lit(0))
    return (n_words(line) >= 5) & (F.size(F.array_distinct(words)) * 4 < F.size(words))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the base measures, n_lines, n_failed_lines, words_left,
    base_failed, kept and text_left (the text of the lines that pass)."""
    return _measured(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))


def _measured(rows: DataFrame) -> DataFrame:
    """Adds the measures to rows with the columns doc_id and text."""
    d = rows.withColumns({
        "words": F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
        "lines": F.filter(F.split("text", "\n", -1), lambda x: F.regexp(x, F.lit(WORD)))})
    # Windows of three words: hashes sorted with their positions packed into the
    # low bits; neighbours that agree in the high bits are candidates, and the
    # full hashes of the candidates decide.
    d = d.withColumn("windows", F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get(F.col("words"), i), F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2)))
    ).otherwise(F.array().cast("array<bigint>")))
    short = F.size("windows") < (1 << _POS_BITS)
    d = d.withColumn("packed", F.sort_array(F.when(short, F.transform(
        "windows", lambda h, i: h.bitwiseAND(F.lit(_HASH_MASK)).bitwiseOR(i.cast("long"))))
        .otherwise(F.array().cast("array<bigint>"))))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(F.lit(_HASH_MASK)) == 0, F.lit(False))

    near = F.filter("packed", lambda x, i: same(x, F.get(F.col("packed"), i + 1)) | same(x, F.get(F.col("packed"), i - 1)))
    at = F.when(short, F.transform(near, lambda x: x.bitwiseAND(F.lit((1 << _POS_BITS) - 1)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.size("windows") - 1))
    d = d.withColumn("places", at)
    d = d.withColumn("exact", F.array_sort(F.transform("places", lambda p: F.struct(
        F.get(F.col("windows"), p).alias("h"), p.alias("p")))))
    d = d.withColumn("found", F.sort_array(F.transform(F.filter("exact", lambda x, i: (
        F.coalesce(x["h"] == F.get(F.col("exact"), i + 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(F.col("exact"), i - 1)["h"], F.lit(False)))), lambda x: x["p"])))
    repeated = F.aggregate(F.transform("found", lambda p, i: F.least(F.lit(3), F.coalesce(
        F.get(F.col("found"), i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    distinct = F.array_distinct(F.col("lines"))
    d = d.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.regexp_replace("text", SPACE + "+", "")).cast("long"),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(distinct)).cast("long"),
        "n_repeat_words": repeated.cast("long"),
        "passing": F.filter(distinct, lambda x: ~line_fails(x) & ~one_word_line(x))})
    d = d.withColumn("text_left", F.array_join("passing", "\n"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT)
    d = d.withColumns({"words_left": n_words(F.col("text_left")).cast("long"), "base_failed": failed,
                       "n_failed_lines": F.col("n_lines") - F.size("passing")})
    # Always true, but not deterministic: filters on the verdict stay above the
    # rules instead of being rewritten as all of them, nested in one expression.
    once = F.monotonically_increasing_id() >= 0
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("words_left") * 100 >= F.col("n_words") * MIN_LEFT) & once).select(
        *rows.columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_failed_lines", "words_left", "text_left")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns, with the failing lines removed."""
    row = fresh(docs, "row_")[0]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(id_col).alias("doc_id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = _measured(d).filter("kept")
    return d.select(*[F.col("text_left").alias(c) if c.lower() == text_col.lower() else F.col(f"{row}.`{c}`")
                      for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    return measures(docs).drop("text", "text_left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_failed_lines", "words_left")


_PHRASES = " OR ".join(f"contains(lower(x), '{p}')" for p in BOILERPLATE)
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM m)),
r AS (SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM g WHERE k > 1) GROUP BY doc_id),
x AS (SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS xw
      FROM (SELECT doc_id, unnest(list_distinct(lines)) AS x FROM m)),
p AS (SELECT doc_id, count(*) AS n_passing, sum(len(xw)) AS words_left FROM x
      WHERE regexp_matches(right(trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 3), '[.!?…。！？;:]["''»”’)\]]*$')
        AND len(regexp_extract_all(x, '!!|[#*$%&<>]{{2}}[#*$%&<>]*')) * 100 <= len(xw) * {MAX_DECORATED}
        AND NOT (len(regexp_extract_all(x, '[\x20\t][|»›·•→][\x20\t]')) >= 2
                 AND len(regexp_extract_all(x, '[\x20\t][|»›·•→][\x20\t]')) * 100 >= len(xw) * {MIN_SEPARATORS})
        AND NOT ({_PHRASES}) AND NOT (len(xw) >= 5 AND len(list_distinct(xw)) * 4 < len(xw))
      GROUP BY doc_id),
f AS (SELECT m.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
             len(lines) - coalesce(n_passing, 0) AS n_failed_lines, CAST(coalesce(words_left, 0) AS BIGINT) AS words_left
      FROM m LEFT JOIN r USING (doc_id) LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND words_left * 100 >= n_words * {MIN_LEFT} AS kept FROM b
"""
