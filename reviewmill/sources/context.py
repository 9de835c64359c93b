"""Context texts: packed rows per site part or article, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.text import nonblank, slug, trim_ws
from reviewmill.plans.storage import cut
from reviewmill.sources.tables import read_store, snapshot, touched, write_load

TEXTS = "slug string, value string"
RULE = "=" * 50
MARKER = r"--- Source: ([^\n]*?) ---"


def render_site(base_url, pages_text, combined):
    """The text layout of a site file: two header lines, rule, text, rule."""
    return F.concat(
        F.lit("BASE_URL: "), base_url,
        F.lit("\nPAGES_SCRAPED: "), pages_text,
        F.lit(f"\n\n{RULE}\n"), trim_ws(combined),
        F.lit(f"\n{RULE}\n"),
    )


def _put(rows: DataFrame, path: str) -> None:
    """Store (slug, value), in place of all older rows of the same slugs.

    The texts are packed rows of a store in buckets, so the number of folders
    does not follow the number of slugs, and a run that dies changes nothing.
    """
    spark = rows.sparkSession
    at = snapshot(spark, path)
    new = cut(rows, "texts")
    mine = touched(new, "slug")
    old = read_store(spark, path, "texts", at, mine, TEXTS)
    kept = old.join(new.select("slug").distinct(), "slug", "left_anti").select("slug", "value")
    write_load(spark, path, at, {"texts": kept.unionByName(new)}, {"texts": "slug"}, {"texts": mine})


def write_context_texts(df: DataFrame, path: str) -> None:
    """Store (slug, base_url, pages_scraped, combined_text) as site texts; a slug written before is replaced."""
    body = render_site(
        F.col("base_url"), F.array_join("pages_scraped", ", "), F.col("combined_text")
    )
    _put(df.select("slug", body.alias("value")), path)


def write_articles(df: DataFrame, path: str, query: str = "query", text: str = "text") -> None:
    """Store each non-blank article text under the slug of its query, in place of an older one."""
    _put(df.where(nonblank(text)).select(slug(query).alias("slug"), F.col(text).alias("value")), path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(slug, text) of a store of texts."""
    return read_store(spark, path, "texts", schema=TEXTS).select("slug", F.col("value").alias("text"))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """(slug, text) of plain text files, the slug being the file's name."""
    return spark.read.text(path, wholetext=True).select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("slug"), F.col("value").alias("text")
    )


def export_files(texts: DataFrame, path: str) -> None:
    """Write (slug, text) as a folder with a text file per slug, for tools that want files."""
    texts.select("slug", F.col("text").alias("value")).write.mode("overwrite").partitionBy("slug").text(path)


def read_context_texts(spark: SparkSession, path: str) -> DataFrame:
    """(slug, base_url, page_no, page_url, text) of a store of site texts, see ``site_pages``."""
    return site_pages(read_texts(spark, path))


def site_pages(files: DataFrame) -> DataFrame:
    """(slug, base_url, page_no, page_url, text) from (slug, text) in the site layout.

    A text without source markers gives one row with a null page address.
    """
    base = F.regexp_extract("text", r"^BASE_URL: ([^\n]*)", 1)
    body = F.regexp_replace("text", rf"(?s)^BASE_URL: .*?\n{RULE}\n|\n{RULE}\n*\z", "")
    parts = F.split(F.concat(F.lit("\n"), body), r"\n(?=--- Source: [^\n]*? ---\n)")
    parts = F.filter(parts, lambda p: trim_ws(p) != "")
    return (
        files.select("slug", F.nullif(base, F.lit("")).alias("base_url"), parts.alias("parts"))
        .select("slug", "base_url", F.posexplode_outer("parts").alias("page_no", "part"))
        .where(F.col("part").isNotNull())
        .select(
            "slug",
            "base_url",
            "page_no",
            F.nullif(F.regexp_extract("part", MARKER, 1), F.lit("")).alias("page_url"),
            trim_ws(F.regexp_replace("part", rf"^{MARKER}\n", "")).alias("text"),
        )
    )
