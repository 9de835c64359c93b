"""Joins, ranks and lists that stay balanced when one key holds a large share
of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.plans.storage import cut

# Rows one salt of a hot key should hold.
ROWS_PER_SALT = 500_000
# Largest table, in rows, that is broadcast after counting it.
BROADCAST_ROWS = 200_000
# Tasks that share the tokens of one split of the texts.
TASKS_PER_SPLIT = 16


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after checking that it is small.

    The check reads at most ``max_rows + 1`` rows.  A larger table comes back
    unmarked and the join shuffles.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy work on a small table.

    A large scan has more splits than cores already and comes back unchanged.
    Only for tables just read from files, where asking for the splits is free.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def text_tasks(df: DataFrame) -> int:
    """Tasks for work in memory on the tokens of texts read from files."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_SPLIT * df.rdd.getNumPartitions())


def hot_keys(df: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(keys, _salts) of all keys that need splitting."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return (
        counts.where(F.col("_n") > rows_per_salt)
        .select(*keys, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts"))
    )


def join_skewed(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Equi-join whose left side may have hot keys.

    Rows of a hot key are spread over salts by a hash of the row and the few
    matching right rows are repeated once per salt, so each left row still
    meets each match exactly once: valid for inner, left, left_semi, left_anti.
    The left side is read twice, so pass a table, not a costly plan; joins on
    computed sides leave hot keys to the adaptive skew join.
    Rows with a null key match nothing; they are spread as well.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    hot = broadcast_if_small(hot_keys(big.where(_all_set(keys)), keys, rows_per_salt))
    plain = [f.name for f in big.schema if f.dataType.typeName() not in ("map", "variant")]
    spread = F.xxhash64(*plain)
    left = big.join(hot, keys, "left").withColumn(
        "_salt",
        F.when(~_all_set(keys), F.pmod(spread, F.lit(1024)))
        .when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")))
        .otherwise(0)
        .cast("int"),
    )
    right = small.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    out = left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"], how)
    return out.drop("_salt")


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def running_in_group(
    df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], parts: int | None = None
) -> DataFrame:
    """Running totals per key in ``order``, current row included.

    Rows are dealt to ranges of (keys, order), so a key of any size is cut into
    as many ranges as its rows fill, and no task ever sorts a whole hot group.
    Every range sums up its own rows.  Only a key that reaches over the edge
    between two ranges needs what came before, which is one row per edge: fewer
    rows than ranges are broadcast, whatever the data.  ``parts`` is the number
    of ranges, that of shuffle partitions if not given.
    """
    values = df.withColumns({f"_v_{name}": value for name, value in sums.items()})
    by = [*[F.col(k) for k in keys], F.col(order)]
    dealt = values.repartitionByRange(parts, *by) if parts else values.repartitionByRange(*by)
    # written, so that every use sees the same ranges
    placed = cut(dealt.withColumn("_b", F.spark_partition_id()), "ranges")
    totals = placed.groupBy(*keys, "_b").agg(*[F.sum(f"_v_{n}").alias(f"_p_{n}") for n in sums])
    inside = W.partitionBy(*keys).orderBy("_b")
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"), F.row_number().over(inside).alias("_nth"),
        *[F.coalesce(F.sum(f"_p_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
    ).where("_nth > 1")
    upto = W.partitionBy("_b", *keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = placed.select(*df.columns, "_b", *[F.sum(f"_v_{n}").over(upto).alias(f"_l_{n}") for n in sums])
    match = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b") == F.col("_kb")],
    )
    return local.join(F.broadcast(offsets), match, "left").select(
        *df.columns, *[(F.col(f"_l_{n}") + F.coalesce(f"_o_{n}", F.lit(0))).alias(n) for n in sums]
    )


def chunked_lists(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, chunk: int = 10_000
) -> DataFrame:
    """Per key, ``value`` in order as lists of at most ``chunk`` entries.

    One row per (keys, part); a group of up to ``chunk`` rows is one row with
    part 0, a longer one continues in parts 1, 2, ...
    """
    placed = running_in_group(
        df.select(*dict.fromkeys([*keys, order, value])), keys, order, {"_pos": F.lit(1)}
    )
    part = F.floor((F.col("_pos") - 1) / chunk).cast("int")
    entry = F.struct(F.col("_pos"), F.col(value).alias("v"))
    return (
        placed.groupBy(*keys, part.alias("part"))
        .agg(F.array_sort(F.collect_list(entry)).alias("_l"))
        .select(*keys, "part", F.transform("_l", lambda x: x["v"]).alias(name))
    )
