"""Review mapping, keys, tables, windows and label parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog import register, table
from reviewmill.catalog.tables import alt_rows, scraped_rows
from reviewmill.functions import ids, parse
from reviewmill.functions.text import ids_json
from reviewmill.operators import ingest
from reviewmill.plans.storage import cut


def uuid5_sql(x: str) -> str:
    h = f"sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode({x}))"
    return (
        f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"translate(substr({h},17,1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h},18,3) || '-' || substr({h},21,12))"
    )


@register(
    "p3_uuid5",
    f"SELECT doc_id, {uuid5_sql('source')} AS place_id, {uuid5_sql('text')} AS text_id FROM documents",
)
def p3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", ids.uuid5("source").alias("place_id"), ids.uuid5("text").alias("text_id")
    )


@register("p4_uuid4", "SELECT count(*) AS n, count(*) AS keys, count(*) AS version_4 FROM documents")
def p4(spark: SparkSession, sf: str) -> DataFrame:
    """Random keys, written before they are used twice: rows, distinct keys and keys of the right form."""
    k = cut(table(spark, sf, "documents").select("doc_id", ids.uuid4().alias("review_id")), "keys")
    form = F.col("review_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return k.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("review_id").alias("keys"), F.count_if(form).alias("version_4"))


_STABLE = "length(source) || ':' || source || '|' || length(lang) || ':' || lang || '|' || length(text) || ':' || text"


@register("p4_stable_key", f"SELECT doc_id, {uuid5_sql(f'({_STABLE})')} AS review_id FROM documents")
def p4_stable(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", ids.stable_key("source", "lang", "text").alias("review_id"))


@register(
    "p1_reviews_scraped",
    f"""SELECT {uuid5_sql('doc_id::VARCHAR')} AS review_id, {uuid5_sql('source')} AS place_id, {uuid5_sql('lang')} AS user_id,
 lang AS user_name, length(lang)::DOUBLE AS rating, md5(text) AS text_md5, '' AS language,
 '2025-12-11 20:32:56.603141' AS timestamp FROM documents""",
)
def p1(spark: SparkSession, sf: str) -> DataFrame:
    r = ingest.to_reviews_scraped(scraped_rows(spark, sf))
    return r.withColumn("text_md5", F.md5("text")).drop("text")


@register(
    "p2_reviews_alt",
    f"""SELECT {uuid5_sql('source')} AS place_id, {uuid5_sql('lang')} AS user_id, lang AS user_name,
 round(n_chars / 100, 6) AS rating, md5(text) AS text_md5, 'en' AS language, '2026-02-09 08:00:00.000000' AS timestamp FROM documents""",
)
def p2(spark: SparkSession, sf: str) -> DataFrame:
    loaded = F.to_timestamp(F.lit("2026-02-09 08:00:00"))
    r = ingest.to_reviews_alt(alt_rows(spark, sf), loaded, stable=True)
    return r.withColumn("text_md5", F.md5("text")).drop("text", "review_id")


@register("p5_drop_undated", "SELECT event_id FROM events WHERE event_type <> 'error'")
def p5(spark: SparkSession, sf: str) -> DataFrame:
    dated = table(spark, sf, "events").withColumn(
        "calculated_date", F.when(F.col("event_type") != "error", F.col("ts"))
    )
    return ingest.drop_undated(dated).select("event_id")


def event_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Events as reviews: the type is the place, the user the author."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("place_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws(" ", F.lit("user"), "user_id", "event_type").alias("user_name"),
        F.col("event_id").cast("string").alias("review_id"), F.col("value").alias("rating"),
    )


@register(
    "a1_build_users",
    """WITH e AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS part FROM events),
 n AS (SELECT user_id, arg_min('user ' || user_id || ' ' || event_type, event_id) AS name FROM events GROUP BY 1)
 SELECT e.user_id::VARCHAR AS user_id, name, part, '[' || string_agg('"' || event_id || '"', ',' ORDER BY event_id) || ']' AS reviews
 FROM e JOIN n ON e.user_id = n.user_id GROUP BY ALL""",
)
def a1(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of at most 20 ids, so that users have several parts; also C29."""
    users = ingest.build_users(event_reviews(spark, sf), "seq", chunk=20)
    return users.withColumn("reviews", ids_json("reviews"))


@register(
    "a2_places_scraped",
    f"""SELECT {uuid5_sql('name')} AS place_id, name, event_type AS category, 'addr ' || user_id AS address,
 'https://maps.example/' || event_id AS url, value AS lat, -value AS lng, value AS avg_rating, user_id AS num_reviews
 FROM (SELECT *, 'place ' || user_id AS name FROM events WHERE event_type <> 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)""",
)
def a2(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("place "), "user_id").alias("name"),
        F.col("event_type").alias("category"), F.concat(F.lit("addr "), "user_id").alias("address"),
        F.lit(" ").alias("website"), F.concat(F.lit("https://maps.example/"), "event_id").alias("google_maps_url"),
        F.col("value").alias("lat"), (-F.col("value")).alias("lng"), F.col("value").alias("overall_rating"),
        F.col("user_id").alias("review_count"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("calculated_date"),
    )
    return ingest.build_places_scraped(e, "seq")


@register(
    "a3_places_alt",
    f"""SELECT {uuid5_sql('name')} AS place_id, name, arg_min(event_type, event_id) AS category, '' AS address, '' AS url,
 0.0::DOUBLE AS lat, 0.0::DOUBLE AS lng, round(avg(value), 6) AS avg_rating, count(*) AS num_reviews
 FROM (SELECT *, 'place ' || user_id AS name FROM events) GROUP BY name""",
)
def a3(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("place "), "user_id").alias("business_name"),
        F.col("event_type").alias("rating_category"), F.col("value").alias("rating"),
    )
    return ingest.build_places_alt(e, "seq")


@register(
    "w1_first_per_key",
    "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1",
)
def w1(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return ingest.first_per_key(e, ["user_id", "event_type"], "event_id")


@register(
    "w2_cap_per_place",
    "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 10",
)
def w2(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.cap_per_place(table(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id", 10)


@register(
    "w3_running_rating",
    """SELECT event_id, event_type, count(*) OVER w AS running_count, round(avg(value) OVER w * count(*) OVER w, 3) AS running_sum FROM events
 WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
)
def w3(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    out = ingest.running_rating(e, "event_type", "value", "event_id")
    # a mean of two-decimal values can end exactly between two roundings, a sum cannot
    total = F.round(F.col("running_avg") * F.col("running_count"), 3)
    return out.select("event_id", "event_type", "running_count", total.alias("running_sum"))


@register(
    "t1_limit_places",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def t1(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rank = F.struct(-F.col("o_totalprice"), "o_orderkey")
    return ingest.limit_places(o.withColumn("rank", rank), "rank", 20).drop("rank")


@register(
    "a10_distinct_words",
    r"SELECT source, count(DISTINCT w) AS words FROM (SELECT source, unnest(string_split_regex(text, '\s+')) AS w FROM documents) WHERE w <> '' GROUP BY 1",
)
def a10(spark: SparkSession, sf: str) -> DataFrame:
    from reviewmill.functions.text import word_set

    flat = table(spark, sf, "documents").select("source", F.explode(word_set("text")).alias("w")).distinct()
    return flat.groupBy("source").agg(F.count("w").alias("words"))


_BASE = "2026-02-09 12:00:00"
_UNITS = "CASE event_type WHEN 'click' THEN 'minute' WHEN 'view' THEN 'hour' WHEN 'error' THEN 'month' WHEN 'purchase' THEN 'week' ELSE 'year' END"


@register(
    "e1_flatten_profiles",
    r"""WITH d AS (SELECT doc_id, source, lang, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
 FROM documents) SELECT source AS name, lang AS category, length(line) AS review_rating, md5(line) AS text_md5,
 '2026-02-09' AS date_retrieved, strftime(TIMESTAMP '2026-02-09 12:00:00' - to_days(n::INTEGER), '%Y-%m-%d %H:%M:%S.%f') AS calculated_date,
 doc_id || '-' || n AS review_id FROM d""",
)
def e1(spark: SparkSession, sf: str) -> DataFrame:
    """A document is a profile, its lines are the nested reviews."""
    d = table(spark, sf, "documents")
    nested = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            F.col("lang").alias("author_name"), F.length(x).alias("rating"), x.alias("text"),
            F.concat(i + 1, F.lit(" days ago")).alias("relative_time"),
            F.concat_ws("-", "doc_id", i + 1).alias("review_id"),
        ),
    )
    profiles = d.select(
        F.col("source").alias("name"), F.lit("").alias("address"), F.col("lang").alias("category"),
        F.lit(4.0).alias("overall_rating"), F.lit(1).alias("review_count"), F.lit("").alias("website"),
        F.lit("").alias("google_maps_url"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"), nested.alias("reviews"),
    )
    flat = ingest.flatten_profiles(profiles, F.to_timestamp(F.lit(_BASE)))
    return flat.select(
        "name", "category", "review_rating", F.md5("review_text").alias("text_md5"), "date_retrieved",
        "calculated_date", "review_id",
    )


@register(
    "c18_c19_relative_time",
    f"""WITH e AS (SELECT event_id, user_id, ts, floor(value)::BIGINT AS v, {_UNITS} AS u FROM events),
 l AS (SELECT *, CASE WHEN user_id < 20 THEN 'an ' || u || ' ago' WHEN user_id < 40 THEN 'a ' || u || ' ago' WHEN user_id < 60
 THEN 'Edited ' || v || ' ' || u || 's ago' WHEN user_id < 80 THEN 'A ' || u || ' ago' WHEN user_id < 100 THEN v || ' ' || upper(u) || 'S ago'
 WHEN user_id < 110 THEN 'yesterday' ELSE v || '  ' || u || 's  ago!' END AS label,
 CASE u WHEN 'minute' THEN 60 WHEN 'hour' THEN 3600 WHEN 'week' THEN 604800 WHEN 'month' THEN 2592000 ELSE 31536000 END AS s FROM e)
 SELECT event_id, strftime(ts, '%Y-%m-%d') AS retrieved, CASE WHEN user_id < 20 THEN NULL
 WHEN user_id < 40 THEN strftime(ts - to_seconds(s), '%Y-%m-%d %H:%M:%S.%f') WHEN user_id < 60 THEN strftime(ts - to_seconds(v*s), '%Y-%m-%d %H:%M:%S.%f')
 WHEN user_id < 110 THEN NULL ELSE strftime(ts - to_seconds(v*s), '%Y-%m-%d %H:%M:%S.%f') END AS at FROM l""",
)
def c18(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of every form, relative to the event's own time."""
    v = F.floor("value").cast("bigint").cast("string")
    e = table(spark, sf, "events").withColumn("u", F.expr(_UNITS))
    u = F.col("user_id")
    label = (
        F.when(u < 20, F.concat_ws(" ", F.lit("an"), "u", F.lit("ago")))
        .when(u < 40, F.concat_ws(" ", F.lit("a"), "u", F.lit("ago")))
        .when(u < 60, F.concat(F.lit("Edited "), v, F.lit(" "), "u", F.lit("s ago")))
        .when(u < 80, F.concat_ws(" ", F.lit("A"), "u", F.lit("ago")))
        .when(u < 100, F.concat(v, F.lit(" "), F.upper("u"), F.lit("S ago")))
        .when(u < 110, F.lit("yesterday"))
        .otherwise(F.concat(v, F.lit("  "), "u", F.lit("s  ago!")))
    )
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id", parse.retrieval_date(ts).alias("retrieved"), parse.parse_relative_time(label, ts).alias("at")
    )


@register(
    "c22_c26_labels",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE round(value, 6) END AS rating,
 CASE WHEN event_type = 'view' THEN NULL ELSE event_id * 1000 + 234 END AS n_reviews,
 CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS category, (user_id + 0.25)::DOUBLE AS lat, (-user_id - 0.5)::DOUBLE AS lng,
 user_id AS stars FROM events""",
)
def c22_c26(spark: SparkSession, sf: str) -> DataFrame:
    """Labels built from event columns, each with a form that must not parse."""
    e = table(spark, sf, "events")
    value = F.format_string("%.2f", "value")
    kind = F.col("event_type")
    rating = F.when(kind == "error", F.concat(value, F.lit(" stars"))).otherwise(F.concat(F.lit(" "), value))
    count = F.when(kind == "view", F.lit("no reviews yet")).otherwise(
        F.concat(F.regexp_replace(F.concat("event_id", F.lit("234")), r"(\d)(?=(\d{3})+$)", "$1,"), F.lit(" reviews"))
    )
    category = F.when(kind == "click", value).otherwise(F.concat(F.lit("  "), kind, F.lit(" ")))
    url = F.concat(F.lit("https://maps.example/data=!3d"), "user_id", F.lit(".25!4d-"), "user_id", F.lit(".5!16s"))
    stars = F.concat(F.lit("rated "), "user_id", F.lit(" stars of 500"))
    return e.select(
        "event_id", parse.parse_rating(rating).alias("rating"), parse.parse_review_count(count).alias("n_reviews"),
        parse.parse_category(category).alias("category"), parse.parse_lat(url).alias("lat"),
        parse.parse_lng(url).alias("lng"), parse.parse_stars(stars).alias("stars"),
    )
