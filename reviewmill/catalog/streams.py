"""Loads and streams into a store, compared with the same result in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import schemas
from reviewmill.catalog import register, table
from reviewmill.catalog.ingest import uuid5_sql
from reviewmill.catalog.tables import alt_rows, scraped_rows
from reviewmill.functions.ids import uuid5
from reviewmill.plans import flows
from reviewmill.plans.storage import new_path
from reviewmill.sources.reviews import append_reviews
from reviewmill.sources.tables import read_reviews, read_store, read_table
from reviewmill.streaming import reviews as streaming


def _store_twice(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Events appended to a store in two overlapping loads."""
    path = new_path(spark, "stream-in")
    e = table(spark, sf, "events").select(
        uuid5(F.col("event_id").cast("string")).alias("review_id"), uuid5("event_type").alias("place_id"),
        F.col("event_type").alias("place_name"), uuid5(F.col("user_id").cast("string")).alias("user_id"),
        F.col("user_id").cast("string").alias("user_name"), F.col("value").alias("rating"), F.col("props").alias("text"),
        F.lit("").alias("language"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_id").alias("seq"),
    )
    append_reviews(e, path)
    append_reviews(e.where("place_name <> 'view'"), path)
    return path, e.schema.simpleString()[len("struct<") : -1].replace(":", " ")


@register(
    "r1_stream_reviews",
    f"SELECT {uuid5_sql('event_id::VARCHAR')} AS review_id, event_id AS seq, event_type AS place_name, round(value, 6) AS rating FROM events",
)
def r1(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = _store_twice(spark, sf)
    out = new_path(spark, "stream-out")
    rows = streaming.stream_reviews(spark, path, schema, files_per_trigger=1)
    query = (
        rows.writeStream.foreachBatch(lambda b, epoch: streaming.append_epoch(b, out, epoch, ["review_id"], "seq"))
        .option("checkpointLocation", new_path(spark, "stream-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_store(spark, out, "rows", schema=schema).select("review_id", "seq", "place_name", "rating")


@register(
    "r2_stream_upsert",
    f"""SELECT 'place' AS kind, {uuid5_sql('event_type')} AS id, event_type AS name, count(*) AS num_reviews,
 round(avg(value), 6) AS avg_rating, count(DISTINCT event_id) AS reviews, '' AS list FROM events GROUP BY event_type
UNION ALL SELECT 'user', {uuid5_sql('user_id::VARCHAR')}, user_id::VARCHAR, count(*), 0.0, count(DISTINCT event_id),
 md5(string_agg({uuid5_sql('event_id::VARCHAR')}, ',' ORDER BY {uuid5_sql('event_id::VARCHAR')})) FROM events GROUP BY user_id""",
)
def r2(spark: SparkSession, sf: str) -> DataFrame:
    """The place and user tables the stream built, with every user's list."""
    path, schema = _store_twice(spark, sf)
    base = new_path(spark, "tables")
    rows = streaming.stream_reviews(spark, path, schema, files_per_trigger=1)
    streaming.stream_upsert(rows, base, new_path(spark, "stream-ckpt"))
    stored = read_reviews(spark, base)
    per = stored.groupBy("place_id").agg(F.count_distinct("review_id").alias("reviews"))
    place = read_table(spark, f"{base}/place", schemas.PLACE).join(per, "place_id").select(
        F.lit("place").alias("kind"), F.col("place_id").alias("id"), "name", "num_reviews", "avg_rating", "reviews", F.lit("").alias("list")
    )
    ids = read_table(spark, f"{base}/users", schemas.USERS).select("user_id", "name", F.explode("reviews").alias("r"))
    users = ids.groupBy("user_id").agg(
        F.min("name").alias("name"), F.count("r").alias("num_reviews"), F.count_distinct("r").alias("reviews"),
        F.md5(F.array_join(F.array_sort(F.collect_list("r")), ",")).alias("list"),
    )
    return place.unionByName(users.select(
        F.lit("user").alias("kind"), F.col("user_id").alias("id"), "name", "num_reviews", F.lit(0.0).alias("avg_rating"), "reviews", "list"
    ))


def _stored(spark: SparkSession, base: str) -> DataFrame:
    """The three tables of a store as (kind, id, name, n, digest)."""
    place = read_store(spark, base, "place").select(
        F.lit("place").alias("kind"), F.col("place_id").alias("id"), "name", F.col("num_reviews").cast("bigint").alias("n"),
        F.concat_ws("|", "category", "address", F.round("avg_rating", 4).cast("decimal(20,4)")).alias("digest"),
    )
    users = read_store(spark, base, "users").select("user_id", "name", F.posexplode("reviews").alias("at", "r"), "part").groupBy("user_id").agg(
        F.min("name").alias("name"), F.count("r").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("r")), ",")).alias("digest")
    )
    review = read_store(spark, base, "review").select(
        F.lit("review").alias("kind"), F.col("review_id").alias("id"), F.col("user_name").alias("name"), F.col("rating").cast("bigint").alias("n"),
        F.md5("text").alias("digest"),
    )
    return place.unionByName(users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "name", "n", "digest")).unionByName(review)


@register(
    "flow_load_scraped",
    f"""SELECT 'place' AS kind, {uuid5_sql('source')} AS id, source AS name, arg_min(n_chars, doc_id)::BIGINT AS n,
 'Cafe|No. 1, ' || source || '|4.5000' AS digest FROM documents GROUP BY source
 UNION ALL SELECT 'user', {uuid5_sql('lang')}, lang, count(*), md5(string_agg({uuid5_sql('doc_id::VARCHAR')}, ',' ORDER BY {uuid5_sql('doc_id::VARCHAR')}))
 FROM documents GROUP BY lang
 UNION ALL SELECT 'review', {uuid5_sql('doc_id::VARCHAR')}, lang, length(lang), md5(text) FROM documents""",
)
def flow_load_scraped(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping loads of the scraped layout, the second complete; only its new reviews are added."""
    base = new_path(spark, "store")
    rows = scraped_rows(spark, sf).withColumn("seq", F.col("review_id").cast("bigint"))
    flows.load_scraped(rows.where("seq % 3 <> 0"), base)
    flows.load_scraped(rows, base)
    return _stored(spark, base)


@register(
    "flow_load_alt",
    f"""SELECT 'place' AS kind, {uuid5_sql('source')} AS id, source AS name, count(*) AS n,
 'taste ' || arg_min(lang, doc_id) || '||' || round(avg(n_chars / 100), 4)::DECIMAL(20, 4) AS digest FROM documents GROUP BY source
 UNION ALL SELECT 'user', {uuid5_sql('lang')}, lang, count(*), '' FROM (SELECT DISTINCT source, lang, text FROM documents) GROUP BY lang
 UNION ALL SELECT 'review', '', lang, count(DISTINCT text), md5(source) FROM documents GROUP BY source, lang""",
)
def flow_load_alt(spark: SparkSession, sf: str) -> DataFrame:
    """The second layout loaded twice under keys made of its content; repeated texts are one review."""
    base = new_path(spark, "store")
    rows = alt_rows(spark, sf).withColumn("seq", F.split("photo", "/")[1].cast("bigint"))
    for _ in range(2):
        flows.load_alt(rows, base, F.to_timestamp(F.lit("2026-01-01 00:00:00")), stable=True)
    place = _stored(spark, base).where("kind = 'place'")
    users = read_store(spark, base, "users").select("user_id", "name", F.explode("reviews").alias("r")).groupBy("user_id", "name").agg(
        F.count_distinct("r").alias("n")
    ).select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "name", "n", F.lit("").alias("digest"))
    names = read_store(spark, base, "place").select("place_id", F.md5("name").alias("digest"))
    review = read_store(spark, base, "review").join(names, "place_id").groupBy("digest", F.col("user_name").alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit("review").alias("kind"), F.lit("").alias("id"), "name", "n", "digest")
    return place.unionByName(users).unionByName(review)
