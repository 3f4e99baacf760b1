"""Connected components of an edge table, by alternating large and small stars:
every round links neighbours to the smallest node seen, so chains shrink by a
constant factor. Nodes are aggregated map-side; links of one hub meet in the
joins on it, whose skewed partitions adaptive execution splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import cut

MAX_ROUNDS = 60
#: Links that make a partition of their own: the short rounds at the end run on
#: few partitions, as every one of them costs files in each of the shuffles.
LINKS_A_PARTITION = 50_000


def _fitted(df: DataFrame, links: int) -> DataFrame:
    return df.coalesce(max(1, -(-links // LINKS_A_PARTITION)))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node
    that isn't its own root. Edges: two long columns in any order. Raises if the
    last of MAX_ROUNDS rounds still changed something."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = _state(e)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        n = before[0]
        e = _fitted(e, n)
        # Large star: larger neighbours of a node go to the smallest around it.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _fitted(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), n)
        e = _fitted(e.withColumnRenamed("u", "w").join(low.withColumnRenamed("u", "v"), "v")
                    .select(F.col("w").alias("u"), F.col("m").alias("v")), n)
        e = _fitted(e.distinct(), n)
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = _fitted(e.groupBy("u").agg(F.min("v").alias("m")), n)
        e = _fitted(e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), n).unionByName(low.select("u", F.col("m").alias("v")))
        e = cut(_fitted(e.filter("u <> v").distinct(), n))
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components still changed after {MAX_ROUNDS} rounds: {before[0]} links are left")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
