"""Runnable queries per operator over the test tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.plans.skew import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    # the text tables of the test data are one small file each
    return spread(df) if name in ("documents", "pages") else df


def _plain(df: DataFrame) -> DataFrame:
    """Integers as bigint and times as text, so both engines agree on types."""
    out = []
    for f in df.schema:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = c.cast("string")
        elif kind == "double":
            c = F.round(c, 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _plain(fn(spark, sf))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
