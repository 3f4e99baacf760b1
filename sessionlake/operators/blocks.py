"""Per-file state of line streams, from one summary per block.

A stream is ``(file_path, block, ord, value)``: ``block`` orders the input blocks
of a file, ``ord`` the lines of a block (any growing number; blank lines are
rows too). Whatever a line needs to know of the rest of its file comes from one
pre-pass with one mergeable record a block:

* the number of lines, whose running sum over the few blocks of a file gives
  physical line numbers;
* *facts* of the whole file: the first non-null value of a column, or whether a
  condition holds anywhere;
* *marks*, the few lines that change carried state (a session start, a model
  change). A block's last state is merged over the file's blocks; inside a block
  the state is filled mark by mark.

The records become a table with one row a block or, with carried state, one row
for every ``1 << SHIFT`` lines, which holds the states that begin in it. Lines
meet it in one equi join, so no line is compared with more than one such stretch,
no window holds more than a block's marks or a file's blocks, and a file ten
times longer takes ten times the work. The table is keyed by an aggregation, so
Catalyst drops the join wherever a query needs none of its columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 128 lines share one row of a state table.
SHIFT = 7
KEY = ["file_path", "block"]


def as_stream(lines: DataFrame) -> DataFrame:
    """Streams as they are; frames that are numbered already (``line_number``
    instead of block and place) count as one block a file and keep their numbers."""
    if "ord" in lines.columns:
        return lines
    number = F.col("line_number").cast("long")
    return lines.select("file_path", F.lit(0).cast("long").alias("block"), number.alias("ord"), "value", number.alias("line_number"))


def state_table(scan: DataFrame, first: dict[str, Column] | None = None, anywhere: dict[str, Column] | None = None,
                carried: dict[str, Column] | None = None, marked: DataFrame | None = None) -> DataFrame:
    """The table of a stream's pre-pass ``scan`` (its rows with whatever columns
    the given expressions read). ``first`` and ``anywhere`` become file facts;
    ``carried`` columns are null on lines that do not change them and are read
    from ``marked``, which may leave such lines out (default: ``scan``)."""
    first, anywhere, carried = first or {}, anywhere or {}, carried or {}
    c = F.col

    def seen(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
        # evaluated once a line; the guard keeps filters on the columns from evaluating them again
        return df.select(*KEY, "ord", *[F.when(F.spark_partition_id() >= 0, x).alias(k) for k, x in cols.items()])

    # no column here that needs object buffers, so this aggregation stays a hash of the blocks
    blocks = seen(scan, first | anywhere).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_n"), F.min("ord").alias("_lo"), F.max("ord").alias("_hi"),
        *[F.min_by(k, F.when(c(k).isNotNull(), c("ord"))).alias(k) for k in first],
        *[F.max(F.coalesce(c(k), F.lit(False))).alias(k) for k in anywhere])
    if carried:
        marks = (seen(scan if marked is None else marked, carried).where(reduce(Column.__or__, [c(k).isNotNull() for k in carried]))
                 .select(*KEY, F.struct("ord", *carried).alias("_mark")))
        blocks = blocks.unionByName(marks, allowMissingColumns=True).groupBy(*KEY).agg(
            *[F.max(k).alias(k) for k in ("_n", "_lo", "_hi", *anywhere)], *[F.first(k, ignorenulls=True).alias(k) for k in first],
            F.sort_array(F.collect_list("_mark")).alias("_marks"))
    whole = Window.partitionBy("file_path").orderBy("block")
    before, all_ = whole.rowsBetween(Window.unboundedPreceding, -1), whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    facts = [*first, *anywhere]
    last = {k: F.try_element_at(F.filter("_marks", lambda s: s[k].isNotNull()), F.lit(-1))[k] for k in carried}
    blocks = blocks.select(
        *KEY, "_lo", "_hi", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - c("_lo") + 1).alias("_base"),
        *[F.first(k, ignorenulls=True).over(all_).alias(k) for k in first],
        *[F.max(k).over(all_).alias(k) for k in anywhere],
        *[F.last(x, ignorenulls=True).over(before).alias(f"_entry_{k}") for k, x in last.items()],
        *(["_marks"] if carried else []))
    same = [F.first(k).alias(k) for k in ["_base", *facts]]
    if not carried:
        return blocks.groupBy(*KEY).agg(*same)
    # the state at the block's start, then one mark after the other
    fields = blocks.schema["_marks"].dataType.elementType
    start = F.struct((c("_lo") - 1).alias("ord"), *[F.lit(None).cast(fields[k].dataType).alias(k) for k in carried])
    marks = blocks.select(*KEY, "_hi", "_base", *facts, *[f"_entry_{k}" for k in carried],
                          F.explode(F.concat(F.array(start), "_marks")).alias("_m"))
    inside = Window.partitionBy(*KEY).orderBy("_m.ord")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = marks.select(
        *KEY, "_base", *facts, c("_m.ord").alias("_from"),
        F.coalesce(F.lead("_m.ord").over(inside) - 1, c("_hi")).alias("_to"),
        *[F.coalesce(F.last(f"_m.{k}", ignorenulls=True).over(so_far), c(f"_entry_{k}")).alias(k) for k in carried])
    stretch = F.explode(F.sequence(F.shiftright("_from", SHIFT), F.shiftright(F.greatest("_from", "_to"), SHIFT))).alias("_stretch")
    return (parts.select(*KEY, "_base", *facts, F.struct("_from", *carried).alias("_s"), stretch)
            .groupBy(*KEY, "_stretch").agg(*same, F.sort_array(F.collect_list("_s")).alias("_states")))


def attach(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of the stream with ``line_number`` (unless they have one), the facts
    and the state at each row."""
    states = "_states" in table.columns
    keys = [*KEY, "_stretch"] if states else KEY
    if states:
        rows = rows.withColumn("_stretch", F.shiftright("ord", SHIFT))
    # the table is a small part of the stream: hashed a partition at a time, the wide rows need no sort
    out = rows.join(table.hint("shuffle_hash"), keys, "left")
    if "line_number" not in rows.columns:
        out = out.withColumn("line_number", F.col("ord") + F.col("_base"))
    if states:
        begun = F.filter("_states", lambda s: s["_from"] <= F.col("ord"))
        out = out.withColumn("_now", F.try_element_at(begun, F.lit(-1)))
        fields = table.schema["_states"].dataType.elementType.names
        out = out.select("*", *[F.col(f"_now.{k}").alias(k) for k in fields if k != "_from"])
    return out.drop("_now", "_states", "_base", "_stretch")


def not_blank(value: str = "value") -> Column:
    return F.col(value).rlike(r"(?U)\S")


def numbered(lines: DataFrame) -> DataFrame:
    """A stream's non-blank lines as ``(file_path, line_number, value)``."""
    if "ord" not in lines.columns:
        return lines
    return (attach(lines.where(not_blank()), state_table(lines.select(*KEY, "ord")))
            .select("file_path", "line_number", "value"))
