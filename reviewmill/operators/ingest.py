"""Review exports to place, users and review rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.functions.ids import stable_key, uuid4, uuid5
from reviewmill.functions.parse import coalesce_url, parse_relative_time, retrieval_date
from reviewmill.functions.text import nonblank
from reviewmill.plans.skew import chunked_lists, running_in_group


def to_reviews_scraped(df: DataFrame, *keep: str) -> DataFrame:
    """Scraped rows as review rows; ``keep`` names extra columns to carry."""
    return df.select(
        uuid5("review_id").alias("review_id"),
        uuid5("name").alias("place_id"),
        uuid5("author").alias("user_id"),
        F.col("author").alias("user_name"),
        F.col("review_rating").cast("double").alias("rating"),
        F.col("review_text").alias("text"),
        F.lit("").alias("language"),
        F.col("calculated_date").alias("timestamp"),
        *keep,
    )


def to_reviews_alt(
    df: DataFrame, loaded_at: Column | None = None, stable: bool = False, *keep: str
) -> DataFrame:
    """Rows of the second layout as review rows.

    The layout has no review id.  A random one makes a re-run insert the rows
    again; ``stable=True`` derives it from place, author and text instead.
    """
    key = stable_key("business_name", "author_name", "text") if stable else uuid4()
    return df.select(
        key.alias("review_id"),
        uuid5("business_name").alias("place_id"),
        uuid5("author_name").alias("user_id"),
        F.col("author_name").alias("user_name"),
        F.col("rating").cast("double").alias("rating"),
        "text",
        F.lit("en").alias("language"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("timestamp"),
        *keep,
    )


def drop_undated(df: DataFrame, date: str = "calculated_date") -> DataFrame:
    return df.where(F.col(date).isNotNull())


def drop_blank(df: DataFrame, c: str) -> DataFrame:
    return df.where(nonblank(c))


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First row of every key.

    Spark limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so a hot key sends one row per task, not all its rows.
    """
    w = W.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def cap_per_place(df: DataFrame, place: str, order: str, n: int = 10) -> DataFrame:
    """At most n reviews per place in page order, limited before the shuffle too."""
    w = W.partitionBy(place).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def limit_places(df: DataFrame, rank: str, n: int = 10) -> DataFrame:
    return df.orderBy(rank).limit(n)


def build_users(reviews: DataFrame, seq: str, chunk: int = 10_000) -> DataFrame:
    """(user_id, name, part, reviews): first name seen and review ids in order.

    A user has one row (part 0) until the list passes ``chunk`` ids; a longer
    list goes on in further parts so that no row grows without bound.
    """
    names = reviews.groupBy("user_id").agg(F.min_by("user_name", seq).alias("name"))
    lists = chunked_lists(reviews, ["user_id"], seq, "review_id", "reviews", chunk)
    return lists.join(names, "user_id").select("user_id", "name", "part", "reviews")


def build_places_scraped(df: DataFrame, seq: str) -> DataFrame:
    """Places of dated scraped rows; the first row gives every attribute."""
    first = first_per_key(drop_undated(df), ["name"], seq)
    return first.select(
        uuid5("name").alias("place_id"),
        "name",
        "category",
        "address",
        coalesce_url("website", "google_maps_url").alias("url"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lng").cast("double").alias("lng"),
        F.col("overall_rating").cast("double").alias("avg_rating"),
        F.col("review_count").cast("int").alias("num_reviews"),
    )


def build_places_alt(df: DataFrame, seq: str) -> DataFrame:
    """Places of the second layout; count and mean come from the rows."""
    grouped = df.groupBy(F.col("business_name").alias("name")).agg(
        F.min_by("rating_category", seq).alias("category"),
        F.avg("rating").alias("avg_rating"),
        F.count(F.lit(1)).cast("int").alias("num_reviews"),
    )
    return grouped.select(
        uuid5("name").alias("place_id"),
        "name",
        "category",
        F.lit("").alias("address"),
        F.lit("").alias("url"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lng"),
        "avg_rating",
        "num_reviews",
    )


def running_rating(df: DataFrame, place: str, rating: str, seq: str) -> DataFrame:
    """Running count and mean rating per place in row order."""
    totals = running_in_group(
        df, [place], seq, {"_sum": F.col(rating), "running_count": F.lit(1)}
    )
    return totals.withColumn("running_avg", F.col("_sum") / F.col("running_count")).drop("_sum")


def flatten_profiles(df: DataFrame, base: Column) -> DataFrame:
    """One row per review of a profile; profiles without reviews give none."""
    r = F.col("_r")
    return df.select("*", F.explode("reviews").alias("_r")).select(
        "name", "address", "category", "overall_rating", "review_count", "website",
        "google_maps_url", "lat", "lng",
        r["author_name"].alias("author"),
        r["rating"].alias("review_rating"),
        r["text"].alias("review_text"),
        r["relative_time"].alias("relative_time"),
        retrieval_date(base).alias("date_retrieved"),
        parse_relative_time(r["relative_time"], base).alias("calculated_date"),
        r["review_id"].alias("review_id"),
    )
