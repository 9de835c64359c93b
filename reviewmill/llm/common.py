"""Joins with hot keys, exact numbering and connected components for the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.plans.storage import cut

# A key that holds more than 1/HOT of all rows is joined by broadcast; there are fewer than HOT such keys.
HOT = 256
# Words are runs of anything but the six ASCII blanks.
BLANKS = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table, on all cores even where it is one small file."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def hot_join(big: DataFrame, small: DataFrame, on: str, weight: str, how: str = "inner") -> DataFrame:
    """Join ``big`` with ``small``, whose ``on`` is unique and whose ``weight`` is the key's number of rows.

    Rows of keys above 1/HOT of all weight meet a broadcast of fewer than HOT
    rows and never shuffle; the rest is an ordinary join.  ``big`` is read
    twice, so pass a written table.  ``how``: inner or left.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = small.where(F.col(weight) > F.lit(total / HOT))
    rest = small.where(~(F.col(weight) > F.lit(total / HOT)))
    first = big.join(F.broadcast(hot), on)
    cold = big.join(F.broadcast(hot.select(on)), on, "left_anti")
    return first.unionByName(cold.join(rest, on, how))


def numbered(df: DataFrame, group: list[str], order: list[str], tie: list[str], cells: int, name: str) -> DataFrame:
    """Gapless numbers from 0 within ``group``, in ``order``, without one task sorting a group.

    Rows are dealt into ``cells`` hash cells of ``tie`` inside each order value;
    only the cells' counts are summed up in order.  ``df`` is read twice.
    """
    split = df.withColumn("_cell", F.pmod(F.xxhash64(*tie), F.lit(cells)))
    keys = [*group, *order, "_cell"]
    counts = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy(*order, "_cell").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*keys).orderBy(*tie)
    return (
        split.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, keys)
        .withColumn(name, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_cell", "_start", "_rank")
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable over ``edges`` (a, b), both long.

    Alternating large and small stars; each round is written to the shared
    folder, so a lost executor repeats one round at most.  Only nodes with an
    edge appear.
    """
    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        # pairs: (u, v), u > v
        near = pairs
        if large:
            near = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = cut(near, "near")
        low = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("_w"))
        met = hot_join(near, cut(low, "low"), "u", "_w")
        if large:
            out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("u", F.col("m").alias("v"))
            )
        return cut(out.where("u <> v").distinct(), "stars")

    now = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = stars(stars(now, True), False)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
