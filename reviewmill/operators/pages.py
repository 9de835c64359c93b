"""Site pages: candidate addresses, accepted page texts, one context per site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.pages import (
    html_main_text,
    is_accepted,
    is_binary_url,
    keep_lines,
    site_root,
)
from reviewmill.lexicons import SITE_PATHS
from reviewmill.plans.skew import chunked_lists
from reviewmill.plans.storage import cut


def candidate_urls(sites: DataFrame, url: str = "base_url") -> DataFrame:
    """(base_url, url): the address itself and the root with every known path."""
    root = site_root(url)
    paths = [F.concat(root, F.lit(f"/{p}")) for p in SITE_PATHS]
    every = F.array_distinct(F.array_compact(F.array(F.col(url), *paths)))
    return sites.select(url).distinct().select(F.col(url).alias("base_url"), F.explode(every).alias("url"))


def norm_url(c):
    """Address without fragment and trailing slash, for matching."""
    return F.regexp_replace(F.regexp_replace(c, r"#[^\n]*$", ""), r"/+$", "")


def select_site_pages(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """Fetched pages whose address is a candidate, each address once (the
    smallest page_id)."""
    first = pages.withColumn("_u", norm_url(F.col("url")))
    once = first.groupBy("_u").agg(F.min("page_id").alias("page_id"))
    wanted = once.join(urls.select(norm_url(F.col("url")).alias("_u")).distinct(), "_u", "left_semi")
    return pages.join(wanted.select("page_id"), "page_id", "left_semi")


def drop_binary_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.where(~is_binary_url(url))


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of the cleaned main texts, written once.

    A filter on the text would otherwise be pushed below the extraction and
    make it run twice.
    """
    return cut(
        pages.select("page_id", "url", keep_lines(html_main_text("html")).alias("text")), "page-texts"
    )


def accept_pages(texts: DataFrame) -> DataFrame:
    return texts.where(is_accepted("text"))


def site_context(accepted: DataFrame, pages_per_part: int = 10) -> DataFrame:
    """(base_url, part, pages_scraped, combined_text) per site.

    ``accepted`` has (base_url, page_id, url, text).  A site of more than
    ``pages_per_part`` pages, the crawl limit of one run, continues in further
    parts, so that no text grows without bound and no page is left out.
    """
    block = F.concat(F.lit("--- Source: "), "url", F.lit(" ---\n"), "text")
    parts = chunked_lists(
        accepted.withColumn("_page", F.struct("url", block.alias("block"))),
        ["base_url"], "page_id", "_page", "_pages", pages_per_part,
    )
    return parts.select(
        "base_url", "part",
        F.transform("_pages", lambda p: p["url"]).alias("pages_scraped"),
        F.array_join(F.transform("_pages", lambda p: p["block"]), "\n\n").alias("combined_text"),
    )
