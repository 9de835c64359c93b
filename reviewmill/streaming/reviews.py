"""Incremental reading and upserting of reviews."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import schemas
from reviewmill.operators.ingest import build_users, first_per_key
from reviewmill.plans.storage import cut
from reviewmill.sources.tables import read_reviews, read_store, snapshot, touched, write_load


def stream_reviews(
    spark: SparkSession,
    path: str,
    schema: str,
    ts: str = "timestamp",
    glob: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """New rows of a folder of Parquet files.

    Review dates say nothing about arrival, so no row is late; repeated keys go
    when an epoch is stored (``append_epoch``, ``upsert_epoch``).
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def _marks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_k0``, ``_k1``, ...: the keys, texts as the 16 bytes of a digest."""
    kinds = dict(df.dtypes)
    return df.withColumns({f"_k{i}": F.unhex(F.md5(k)) if kinds[k] == "string" else F.col(k) for i, k in enumerate(keys)})


def _fresh(batch: DataFrame, keys: list[str], seq: str, stored: DataFrame) -> DataFrame:
    """The first row of every key that ``stored`` lacks.

    Rows are dealt by their marks once, for the choice and for the comparison;
    of what is stored only marks move, as every epoch compares with all of it.
    """
    marks = [f"_k{i}" for i in range(len(keys))]
    first = first_per_key(_marks(batch, keys), marks, seq)
    return first.join(_marks(stored.select(*keys), keys).select(*marks), marks, "left_anti").select(*batch.columns)


def append_epoch(batch: DataFrame, base: str, epoch: int, keys: list[str], seq: str, stream: str = "default") -> None:
    """Add the first row of every key that no earlier epoch stored to the table ``rows``; an epoch counts once."""
    spark = batch.sparkSession
    at = snapshot(spark, base)
    if epoch <= at.epochs.get(stream, -1):
        return
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
    stored = read_store(spark, base, "rows", at, touched(batch, keys[0]), schema)
    fresh = _fresh(batch, keys, seq, stored)
    write_load(spark, base, at, {"rows": fresh}, {"rows": keys[0]}, epoch=(stream, epoch))


def upsert_epoch(batch: DataFrame, base: str, epoch: int, seq: str = "seq", stream: str = "default") -> None:
    """Apply one micro-batch to the place, users and review tables.

    ``batch`` has the review columns, ``place_name`` and the order column.  Only
    reviews the store lacks count: their ratings join the place's mean and
    number, and their ids are added to the user's list as further parts; the
    parts that are there are not written again.  The commit
    that makes them visible also notes the epoch of its ``stream``: an epoch
    that died before it starts over from the last commit, one that comes again
    after it changes nothing.
    """
    spark = batch.sparkSession
    at = snapshot(spark, base)
    if epoch <= at.epochs.get(stream, -1):
        return
    stored = read_store(spark, base, "review", at, touched(batch, "review_id"))
    fresh = cut(_fresh(batch, ["review_id"], seq, stored), "fresh")
    mine = {"place": touched(fresh, "place_id"), "users": touched(fresh, "user_id")}

    old = read_store(spark, base, "place", at, mine["place"])
    new = fresh.groupBy("place_id").agg(
        F.min_by("place_name", seq).alias("_name"), F.sum("rating").alias("_sum"),
        F.count("rating").alias("_rated"), F.count(F.lit(1)).cast("int").alias("_n"),
    )
    count = F.coalesce("num_reviews", F.lit(0))
    total = F.coalesce(F.col("avg_rating") * count, F.lit(0.0)) + F.coalesce("_sum", F.lit(0.0))
    rated = count + F.coalesce("_rated", F.lit(0))
    empty = {"name": F.col("_name"), "category": F.lit(""), "address": F.lit(""), "url": F.lit(""), "lat": F.lit(0.0), "lng": F.lit(0.0)}
    known = old.withColumn("_old", F.lit(True)).join(new, "place_id", "full")
    values = {c: F.when(F.col("_old"), F.col(c)).otherwise(v) for c, v in empty.items()}
    values["avg_rating"] = F.when(F.col("_n").isNull(), F.col("avg_rating")).otherwise(total / F.nullif(rated, F.lit(0)))
    values["num_reviews"] = count + F.coalesce("_n", F.lit(0))
    places = known.select(*[values[c].alias(c) if c in values else F.col(c) for c in old.columns])

    lists = read_store(spark, base, "users", at, mine["users"])
    last = lists.groupBy("user_id").agg(F.max("part").alias("_part"), F.min_by("name", "part").alias("_name"))
    users = build_users(fresh, seq).join(last, "user_id", "left").withColumns({
        "part": (F.col("part") + F.coalesce(F.col("_part") + 1, F.lit(0))).cast("int"), "name": F.coalesce("_name", "name"),
    })
    columns = [c.split()[0] for c in schemas.REVIEW.split(", ")]
    tables = {"place": places, "users": users.select(*lists.columns), "review": fresh.select(*columns)}
    write_load(spark, base, at, tables, buckets=mine, epoch=(stream, epoch), adds=("users",))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint folder keeps for its query; an emptied folder gets another one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def stream_upsert(df: DataFrame, base: str, checkpoint: str, seq: str = "seq"):
    """Run the stream over everything available and return the finished query."""

    def apply(batch: DataFrame, epoch: int) -> None:
        upsert_epoch(batch, base, epoch, seq, _stream_id(batch.sparkSession, checkpoint))

    query = (
        df.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
