"""One long JSON array cut into its elements, without a document in one row.

Input is a stream ``(file_path, block, ord, value)`` of the pieces between the
commas of JSON documents (``text`` read with a comma as line separator), so a file
of any size is read in splits by many tasks. What a piece needs to know of the
text before it is whether it begins inside a string, and at which bracket depth.
Both are running sums (of quotes, modulo two, and then of brackets outside
strings): within a block by a window, over blocks from one row a block. The
commas that part members of the document or elements of the wanted array are
then those outside strings at depth one or two, and pieces are put together again
element by element; no step holds more than a block's pieces or one element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.operators.blocks import KEY, attach, state_table


def _with_sum(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The sum of ``value`` over all rows of the file before each row."""
    inside = Window.partitionBy(*KEY).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_v", value)
    blocks = df.groupBy(*KEY).agg(F.sum("_v").alias("_s")).select(*KEY, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_entry"))
    return (df.join(blocks, KEY).withColumn(name, F.col("_entry") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
            .drop("_v", "_entry"))


def _brackets(parts: Column, begin: int) -> Column:
    """Opening minus closing brackets in every other stretch between quotes."""
    text = F.array_join(F.transform(F.filter(parts, lambda x, i: i % 2 == begin), lambda x: F.regexp_replace(x, r"[^{}\[\]]", "")), "")
    return F.length(F.regexp_replace(text, r"[\]}]", "")) * 2 - F.length(text)


def split_array(pieces: DataFrame, member: str) -> tuple[DataFrame, DataFrame]:
    """``(file_path, pos, value)`` of the elements of the document's array
    ``member``, in order from 0, and ``(file_path, whole, value)`` of the document
    without it. ``whole`` is false where brackets or quotes do not close."""
    c = F.col
    # escaped characters are neither quotes nor brackets; no valid escape spans a comma
    plain = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    p = pieces.select(*KEY, "ord", "value", (F.size(plain) - 1).alias("_q"),
                      _brackets(plain, 0).alias("_out"), _brackets(plain, 1).alias("_in"))
    p = _with_sum(p, "_quotes", c("_q")).withColumn("_string", c("_quotes") % 2 == 1)
    p = p.withColumn("_d", F.when(c("_string"), c("_in")).otherwise(c("_out")))
    p = _with_sum(p, "_depth", c("_d"))
    opens = c("value").rlike(r'(?s)^\s*\{?\s*"' + member + r'"\s*:\s*\[')
    free = ~c("_string")
    at = F.struct("block", "ord")
    # the last of the document's members, and of the array's elements, that begins at or before a piece
    carried = {"_member": F.when(free & (c("_depth") <= 1), F.struct(at.alias("at"), opens.alias("array"))),
               "_element": F.when(free & (c("_depth") <= 2), at)}
    p = attach(p, state_table(p, carried=carried))
    head = F.regexp_replace("value", r'(?s)^\s*\{?\s*"' + member + r'"\s*:\s*\[', "")
    end = c("_depth") + c("_d")
    p = p.withColumn("_array", F.coalesce(c("_member.array"), F.lit(False)))
    own = p.where("_array").select(
        "file_path", c("_element").alias("_at"), at.alias("_place"), end.alias("_end"),
        F.when((c("block") == c("_member.at.block")) & (c("ord") == c("_member.at.ord")), head).otherwise(c("value")).alias("value"))
    close = F.when(c("_end") == 1, r"(?s)\]\s*$").when(c("_end") <= 0, r"(?s)\]\s*\}\s*$")
    own = own.withColumn("value", F.when(c("_end") < 2, F.regexp_replace("value", close, F.lit(""))).otherwise(c("value")))
    elements = (own.groupBy("file_path", "_at").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_place", "value"))), lambda x: x["value"]), ",").alias("value"))
        .where(c("value").rlike(r"\S")).select("file_path", "_at.block", "_at.ord", "value"))
    elements = _with_sum(elements, "pos", F.lit(1)).select("file_path", "pos", "value")
    rest = p.groupBy("file_path").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~c("_array"), F.struct(at.alias("place"), "value")))), lambda x: x["value"]), ",").alias("_text"),
        ((F.sum("_d") == 0) & (F.sum("_q") % 2 == 0) & (F.min(end) >= 0)).alias("whole"),
        # the array may hold the document's first brace or its last one
        F.min_by(c("_array"), at).alias("_first"), F.max_by(c("_array"), at).alias("_last"))
    text = F.concat(F.when(c("_first"), F.lit("{")).otherwise(F.lit("")), c("_text"), F.when(c("_last"), F.lit("}")).otherwise(F.lit("")))
    return elements, rest.select("file_path", F.coalesce("whole", F.lit(False)).alias("whole"), text.alias("value"))
