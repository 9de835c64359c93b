"""Source, sink and integrity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog import register, table
from reviewmill.functions.parse import coalesce_url
from reviewmill.operators import ingest, integrity
from reviewmill.operators.pages import site_context
from reviewmill.plans.storage import new_path
from reviewmill.sources import context, pages, reviews, tables


def scraped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in the scraped layout: the source is the place, the language
    the author, the multi-line text the review."""
    d = table(spark, sf, "documents")
    return d.select(
        F.col("source").alias("name"), F.concat(F.lit("No. 1, "), "source").alias("address"),
        F.lit("Cafe").alias("category"), F.lit(4.5).alias("overall_rating"),
        F.col("n_chars").cast("int").alias("review_count"), F.lit(None).cast("string").alias("website"),
        F.concat(F.lit("https://maps.example/"), "source").alias("google_maps_url"),
        F.lit(1.25).alias("lat"), F.lit(103.5).alias("lng"), F.col("lang").alias("author"),
        F.length("lang").alias("review_rating"), F.col("text").alias("review_text"),
        F.lit("2 months ago").alias("relative_time"), F.to_date(F.lit("2026-02-09")).alias("date_retrieved"),
        F.to_timestamp(F.lit("2025-12-11 20:32:56.603141")).alias("calculated_date"),
        F.col("doc_id").cast("string").alias("review_id"),
    )


_SCRAPED_SQL = """SELECT doc_id::VARCHAR AS review_id, source AS name, 'No. 1, ' || source AS address, lang AS author,
 length(lang) AS review_rating, n_chars AS review_count, md5(text) AS text_md5,
 '2025-12-11 20:32:56.603141' AS calculated_date FROM documents"""


def _scraped_out(df: DataFrame) -> DataFrame:
    return df.select(
        "review_id", "name", "address", "author", "review_rating", "review_count",
        F.md5("review_text").alias("text_md5"), "calculated_date",
    )


@register("s1_read_scraped_csv", _SCRAPED_SQL)
def s1(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "scraped")
    writer = scraped_rows(spark, sf).write.option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return _scraped_out(reviews.read_scraped_reviews(spark, path))


@register("s5_append_reviews", _SCRAPED_SQL)
def s5(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends without a header line, read back as one store."""
    path = new_path(spark, "store")
    rows = scraped_rows(spark, sf)
    reviews.append_reviews(rows.where("author = 'en'"), path, "csv")
    reviews.append_reviews(rows.where("author <> 'en'"), path, "csv")
    return _scraped_out(reviews.read_scraped_reviews(spark, path, header=False))


def alt_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(
        F.col("source").alias("business_name"), F.col("lang").alias("author_name"), "text",
        F.concat(F.lit("photo/"), "doc_id").alias("photo"), (F.col("n_chars") / 100).alias("rating"),
        F.concat(F.lit("taste "), "lang").alias("rating_category"),
    )


@register(
    "s2_read_alt_csv",
    "SELECT source AS business_name, lang AS author_name, md5(text) AS text_md5, 'photo/' || doc_id AS photo, "
    "round(n_chars / 100, 6) AS rating, 'taste ' || lang AS rating_category FROM documents",
)
def s2(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "alt")
    writer = alt_rows(spark, sf).write.option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return reviews.read_alt_reviews(spark, path).select(
        "business_name", "author_name", F.md5("text").alias("text_md5"), "photo", "rating", "rating_category"
    )


@register("s3_read_pages", "SELECT page_id, url, md5(html) AS html_md5 FROM pages")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies as bytes with a stray byte in front and behind."""
    path = new_path(spark, "raw")
    bad = F.unhex(F.lit("ff"))
    body = F.concat(bad, F.encode("html", "UTF-8"), bad)
    table(spark, sf, "pages").select("page_id", "url", body.alias("html")).write.parquet(path)
    return pages.read_pages(spark, path).select("page_id", "url", F.md5("html").alias("html_md5"))


def _site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as accepted pages of one site per source."""
    base = F.concat(F.lit("https://"), "source", F.lit(".example/"))
    return table(spark, sf, "documents").select(
        base.alias("base_url"), F.col("doc_id").alias("page_id"), F.concat(base, "doc_id").alias("url"), "text"
    )


@register(
    "a8_site_context",
    """WITH p AS (SELECT 'https://' || source || '.example/' AS base_url, doc_id, text,
 (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS part FROM documents)
 SELECT base_url, part, string_agg(base_url || doc_id, ', ' ORDER BY doc_id) AS pages_scraped,
 md5(string_agg('--- Source: ' || base_url || doc_id || ' ---' || chr(10) || text, chr(10) || chr(10) ORDER BY doc_id))
 AS text_md5 FROM p GROUP BY ALL""",
)
def a8(spark: SparkSession, sf: str) -> DataFrame:
    """Also C30, the page list as text."""
    return site_context(_site_pages(spark, sf)).select(
        "base_url", "part", F.array_join("pages_scraped", ", ").alias("pages_scraped"),
        F.md5("combined_text").alias("text_md5"),
    )


@register(
    "s4_s6_context_texts",
    r"SELECT 'https://' || source || '.example/' AS base_url, 'https://' || source || '.example/' || doc_id AS page_url, "
    r"md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS text_md5 FROM documents",
)
def s4_s6(spark: SparkSession, sf: str) -> DataFrame:
    """Site files written, then read back by their source markers."""
    path = new_path(spark, "context")
    sites = site_context(_site_pages(spark, sf))
    slug = F.concat(F.regexp_extract("base_url", "//([^.]+)", 1), F.lit("_"), "part")
    context.write_context_texts(sites.withColumn("slug", slug), path)
    return context.read_context_texts(spark, path).select(
        "base_url", "page_url", F.md5("text").alias("text_md5")
    )


@register(
    "s9_articles",
    "SELECT replace(lower('Place ' || item_id), ' ', '_') AS slug, md5(text) AS text_md5 FROM benchmark",
)
def s9(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "articles")
    rows = table(spark, sf, "benchmark").select(F.concat(F.lit("Place "), "item_id").alias("query"), "text")
    # a blank article is not written
    blank = rows.select(F.concat("query", F.lit(" blank")).alias("query"), F.lit(" \n ").alias("text"))
    context.write_articles(rows.unionByName(blank), path)
    return context.read_texts(spark, path).select("slug", F.md5("text").alias("text_md5"))


def _stats(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("name"),
        F.avg("o_totalprice").alias("avg_rating"),
        F.count(F.lit(1)).alias("num_reviews"),
    )


@register(
    "s7_upsert",
    """WITH t AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS name, avg(o_totalprice) AS a, count(*) AS n
  FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1),
 b AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS name, avg(o_totalprice) AS a, count(*) AS n
  FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
 SELECT coalesce(t.o_custkey, b.o_custkey) AS o_custkey, coalesce(t.name, b.name) AS name,
 round(coalesce(b.a, t.a), 6) AS avg_rating, coalesce(b.n, t.n) AS num_reviews FROM t FULL JOIN b ON t.o_custkey = b.o_custkey""",
)
def s7(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders arrive as the batch; statistics change, the name stays."""
    o = table(spark, sf, "orders")
    return tables.upsert(
        _stats(o.where("o_orderstatus <> 'O'")), _stats(o.where("o_orderstatus = 'O'")),
        ["o_custkey"], ["avg_rating", "num_reviews"],
    )


@register(
    "s8_insert_new",
    """WITH t AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
 b AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
 u AS (SELECT * FROM t UNION ALL SELECT * FROM b WHERE o_custkey NOT IN (SELECT o_custkey FROM t))
 SELECT u.o_custkey, o_orderkey, o_orderstatus FROM u JOIN orders ON o_orderkey = k""",
)
def s8(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    done = ingest.first_per_key(o.where("o_orderstatus = 'F'"), ["o_custkey"], "o_orderkey")
    return tables.insert_new(done, o.where("o_orderstatus <> 'F'"), ["o_custkey"], "o_orderkey")


def _gone_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of one market region, as deleted places."""
    n = table(spark, sf, "nation").join(
        table(spark, sf, "region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return c.select(F.col("c_custkey").alias("o_custkey"))


_GONE = (
    "(SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON "
    "n_regionkey = r_regionkey WHERE r_name = 'ASIA')"
)


@register(
    "j10_delete_cascade",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN
 (SELECT o_orderkey FROM orders WHERE o_custkey IN {_GONE})""",
)
def j10(spark: SparkSession, sf: str) -> DataFrame:
    """Two levels: customers take their orders, orders take their lines."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    gone = _gone_customers(spark, sf)
    lost = orders.join(gone, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return integrity.delete_cascade(lines, lost, "l_orderkey")


@register(
    "j11_delete_set_null",
    f"SELECT o_orderkey, CASE WHEN o_custkey NOT IN {_GONE} THEN o_custkey END AS o_custkey, o_orderstatus FROM orders",
)
def j11(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return integrity.delete_set_null(orders, _gone_customers(spark, sf), "o_custkey")


@register(
    "j9_orphans",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def j9(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.orphans(
        table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id"
    )


@register(
    "p7_check_keys",
    """WITH d AS (SELECT d.*, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
 SELECT 'unique' AS rule, source || '|' || lang AS key, count(*) AS rows FROM d GROUP BY source, lang HAVING count(*) > 1
 UNION ALL SELECT 'not null', 'quality', count(*) FROM d WHERE quality IS NULL HAVING count(*) > 0
 UNION ALL SELECT 'not null', 'text', count(*) FROM d WHERE text IS NULL HAVING count(*) > 0""",
)
def p7(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return integrity.check_keys(d, ["source", "lang"], ["quality", "text"])


@register(
    "p6_validate",
    """WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE value::VARCHAR END AS rating,
  CASE WHEN user_id < 5 THEN NULL ELSE user_id END AS user_id FROM events),
 c AS (SELECT event_id, concat_ws('; ', CASE WHEN user_id IS NULL THEN 'user_id: missing' END,
  CASE WHEN TRY_CAST(rating AS DOUBLE) IS NULL THEN 'rating: not double' END) AS reasons, TRY_CAST(rating AS DOUBLE) AS rating FROM r)
 SELECT event_id, reasons = '' AS valid, reasons, CASE WHEN reasons = '' THEN round(rating, 6) END AS rating FROM c""",
)
def p6(spark: SparkSession, sf: str) -> DataFrame:
    """Some events lose their user or carry a rating that is not a number."""
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("rating"),
        F.when(F.col("user_id") >= 5, F.col("user_id").cast("string")).alias("user_id"),
    )
    valid, rejected = integrity.validate(rows, {"user_id": "string", "rating": "double"})
    good = valid.select("event_id", F.lit(True).alias("valid"), F.lit("").alias("reasons"), "rating")
    bad = rejected.select(
        "event_id", F.lit(False).alias("valid"), F.array_join("reasons", "; ").alias("reasons"),
        F.lit(None).cast("double").alias("rating"),
    )
    return good.unionByName(bad)


@register(
    "p8_coalesce_url",
    "SELECT page_id, CASE WHEN regexp_matches(url, '^http:') THEN url ELSE 'https://maps.example/' || page_id END AS url FROM pages",
)
def p8(spark: SparkSession, sf: str) -> DataFrame:
    """Secure addresses are blanked and so fall back to the map address."""
    website = F.when(F.col("url").startswith("http:"), F.col("url")).otherwise(F.lit("  "))
    return table(spark, sf, "pages").select(
        "page_id", coalesce_url(website, F.concat(F.lit("https://maps.example/"), "page_id")).alias("url")
    )
