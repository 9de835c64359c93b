"""Record checks and the delete rules of the table constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.plans.skew import join_skewed


def with_reasons(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add ``reasons``: what keeps a row from fitting the rules, empty if nothing."""
    checks = []
    for name, kind in rules.items():
        missing = F.col(name).isNull()
        checks.append(F.when(missing, F.lit(f"{name}: missing")))
        if kind != df.schema[name].dataType.simpleString():
            bad = ~missing & F.col(name).try_cast(kind).isNull()
            checks.append(F.when(bad, F.lit(f"{name}: not {kind}")))
    return df.withColumn("reasons", F.array_compact(F.array(*checks)))


def validate(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows cast to the rules, rejected rows with reasons)."""
    checked = with_reasons(df, rules)
    valid = checked.where(F.size("reasons") == 0).drop("reasons")
    valid = valid.withColumns({n: F.col(n).cast(k) for n, k in rules.items()})
    return valid, checked.where(F.size("reasons") > 0)


def check_keys(df: DataFrame, pk: list[str], not_null: list[str]) -> DataFrame:
    """(rule, key, rows) per violation of the primary key and not-null rules."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in pk])
    repeated = (
        df.groupBy(*pk)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .select(F.lit("unique").alias("rule"), key.alias("key"), "rows")
    )
    if not not_null:
        return repeated
    # one scan for all columns
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(not_null)])
    each = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"_{i}").alias("rows")) for i, c in enumerate(not_null)])
    nulls = counts.select(F.lit("not null").alias("rule"), F.inline(each)).where("rows > 0")
    return repeated.unionByName(nulls)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    keys = parent.select(key).where(F.col(key).isNotNull()).distinct()
    return join_skewed(child.where(F.col(key).isNotNull()), keys, [key], "left_anti")


def delete_cascade(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows left after the rows of ``deleted`` are gone."""
    return join_skewed(child, deleted.select(key).distinct(), [key], "left_anti")


def delete_set_null(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """All child rows, with the key nulled where its parent is gone."""
    gone = deleted.select(key).distinct().withColumn("_gone", F.lit(True))
    joined = join_skewed(child, gone, [key], "left")
    return joined.select(
        *[
            F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == key else F.col(c)
            for c in child.columns
        ]
    )
