"""Pages, context chunks, feature tables and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import lexicons
from reviewmill.catalog import register, table
from reviewmill.catalog.ingest import uuid5_sql
from reviewmill.catalog.text import WORDS, sql
from reviewmill.functions.pages import html_main_text, keep_lines, site_root
from reviewmill.lexicons import COOKIE_PHRASES, DROPPED_TAGS, ERROR_PHRASES, SITE_PATHS
from reviewmill.operators import context, features, pages, vectors
from reviewmill.plans import flows
from reviewmill.plans.storage import cut

# --- page text ------------------------------------------------------------

_ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "''", "&#39;": "''", "&copy;": "©",
    "&reg;": "®", "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…",
    "&eacute;": "é", "&egrave;": "è", "&agrave;": "à", "&ccedil;": "ç", "&uuml;": "ü", "&ouml;": "ö", "&auml;": "ä",
    "&szlig;": "ß", "&ntilde;": "ñ", "&euro;": "€", "&Eacute;": "É", "&#233;": "é", "&#x263A;": "☺", "&amp;": "&",
}
# every third page gets a div#content with divs in it in place of its article
_DIVS = [
    ("<article>", '<div class="a" id="content"><div>&#233;t&Eacute; &#x263A; &amp;lt;</div>'),
    ("</article>", "<div><div>inner</div> still inside</div></div><div>outside</div>"),
]


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    nested = F.col("html")
    for old, new in _DIVS:
        nested = F.replace(nested, F.lit(old), F.lit(new))
    return table(spark, sf, "pages").withColumn("html", F.when(F.col("page_id") % 3 == 0, nested).otherwise(F.col("html")))


_PAGES = "(SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN replace(replace(html, '{}', '{}'), '{}', '{}') ELSE html END AS html FROM pages)".format(
    *[x for pair in _DIVS for x in pair]
)


def _main_sql(src: str) -> str:
    x = f"regexp_replace({src}, '(?s)<!--.*?-->', '', 'g')"
    for tag in DROPPED_TAGS:
        x = f"regexp_replace({x}, '(?is)<{tag}(?:[\\s/][^>]*)?>.*?</{tag}\\s*>', chr(10), 'g')"
    return x


_DIV = r"(?i)</?div(?:[\s/][^>]*)?>"
_AFTER = r"""regexp_extract(h, '(?is)<div(?:\s[^>]*)?\sid\s*=\s*"content"[^>]*>(.*)', 1)"""
# the pieces between div tags up to the first tag where as many divs are closed as opened
_CONTENT = f"""array_to_string(string_split_regex({_AFTER}, '{_DIV}')[1 : list_position(
 list_transform(range(1, len(regexp_extract_all({_AFTER}, '{_DIV}')) + 1), lambda i: 1 + list_sum(list_transform(
 regexp_extract_all({_AFTER}, '{_DIV}')[1 : i], lambda t: CASE WHEN t[2] = '/' THEN -1 ELSE 1 END))), 0)], chr(10))"""
_ROOT = rf"""CASE WHEN regexp_matches(h, '(?is)<main(?:[\s/][^>]*)?>.*?</main\s*>') THEN regexp_extract(h, '(?is)<main(?:[\s/][^>]*)?>(.*?)</main\s*>', 1)
 WHEN regexp_matches(h, '(?is)<article(?:[\s/][^>]*)?>.*?</article\s*>') THEN regexp_extract(h, '(?is)<article(?:[\s/][^>]*)?>(.*?)</article\s*>', 1)
 WHEN regexp_matches(h, '(?is)<div(?:\s[^>]*)?\sid\s*=\s*"content"') THEN {_CONTENT}
 ELSE regexp_extract(h, '(?is)<body(?:[\s/][^>]*)?>(.*?)(?:</body\s*>|\z)', 1) END"""


def _unescape_sql(x: str) -> str:
    for name, char in _ENTITIES.items():
        x = f"replace({x}, '{name}', '{char}')"
    return x


_LINES = (
    r"list_filter(list_transform(string_split_regex(m, '\r\n|[\n\r]'), lambda x: regexp_replace(x, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')), "
    "lambda x: length(x) > 50" + "".join(f" AND NOT contains(lower(x), '{p}')" for p in COOKIE_PHRASES) + ")"
)
PAGE_TEXT = f"""main AS (SELECT page_id, url, {_unescape_sql("regexp_replace(r, '(?s)<[^>]+>', chr(10), 'g')")} AS m FROM
 (SELECT *, {_ROOT} AS r FROM (SELECT page_id, url, {_main_sql('html')} AS h FROM @pages))),
texts AS (SELECT page_id, url, array_to_string({_LINES}, chr(10)) AS text FROM main)"""
_ACCEPT = "length(text) >= 200" + "".join(f" AND NOT contains(lower(text), '{p}')" for p in ERROR_PHRASES)
PAGE_TEXT, _FLOW_TEXT = PAGE_TEXT.replace("@pages", _PAGES), PAGE_TEXT.replace("@pages", "site_pages")
ACCEPTED = f"{PAGE_TEXT}, accepted AS (SELECT * FROM texts WHERE {_ACCEPT})"


@register("c27_html_main_text", f"WITH {PAGE_TEXT} SELECT page_id, md5(m) AS text_md5, length(m) AS n FROM main")
def c27(spark: SparkSession, sf: str) -> DataFrame:
    t = _pages(spark, sf).select("page_id", html_main_text("html").alias("m"))
    return t.select("page_id", F.md5("m").alias("text_md5"), F.length("m").alias("n"))


@register("c28_keep_lines", f"WITH {PAGE_TEXT} SELECT page_id, md5(text) AS text_md5, length(text) AS n FROM texts")
def c28(spark: SparkSession, sf: str) -> DataFrame:
    t = _pages(spark, sf).select("page_id", keep_lines(html_main_text("html")).alias("t"))
    return t.select("page_id", F.md5("t").alias("text_md5"), F.length("t").alias("n"))


@register("p9_accept_pages", f"WITH {ACCEPTED} SELECT page_id, url FROM accepted")
def p9(spark: SparkSession, sf: str) -> DataFrame:
    return pages.accept_pages(pages.page_texts(_pages(spark, sf))).select("page_id", "url")


@register(
    "p11_drop_binary_urls",
    "SELECT page_id FROM (SELECT page_id, url, CASE WHEN contains(url, '#') THEN '.PDF' WHEN contains(url, '?') THEN '.html?a=.zip' ELSE '.docx' END AS e "
    "FROM pages) WHERE NOT contains(url, '#') AND contains(url, '?')",
)
def p11(spark: SparkSession, sf: str) -> DataFrame:
    """Every address gets a file ending, two of three kinds binary."""
    path = F.regexp_replace("url", "[?#].*$", "")
    ending = (
        F.when(F.col("url").contains("#"), F.lit(".PDF"))
        .when(F.col("url").contains("?"), F.lit(".html?a=.zip"))
        .otherwise(F.lit(".docx"))
    )
    rows = table(spark, sf, "pages").select("page_id", F.concat(path, ending).alias("url"))
    return pages.drop_binary_urls(rows).select("page_id")


_ROOTS = "(SELECT DISTINCT regexp_extract(url, '^https?://[^/?#]+') AS root FROM pages)"


@register(
    "c21_candidate_urls",
    f"""SELECT root || '/' AS base_url, root || '/' || p AS url FROM {_ROOTS}, (SELECT unnest([{', '.join(repr(p) for p in SITE_PATHS)}, '']) AS p)""",
)
def c21(spark: SparkSession, sf: str) -> DataFrame:
    sites = table(spark, sf, "pages").select(F.concat(site_root("url"), F.lit("/")).alias("base_url")).distinct()
    return pages.candidate_urls(sites)


@register(
    "j8_select_site_pages",
    r"""WITH n AS (SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS u FROM pages),
 want AS (SELECT DISTINCT regexp_replace(regexp_replace(regexp_replace(url, '\?.*$', ''), '#.*$', ''), '/+$', '') AS u FROM pages)
 SELECT min(page_id) AS page_id FROM n WHERE u IN (SELECT u FROM want) GROUP BY u""",
)
def j8(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates are the addresses without their query part."""
    p = table(spark, sf, "pages")
    wanted = p.select(F.concat(F.regexp_replace("url", r"\?.*$", ""), F.lit("/")).alias("url"))
    return pages.select_site_pages(p, wanted).select("page_id")


_PATHS = "[" + ", ".join(f"'{p}'" for p in SITE_PATHS) + "]"


@register(
    "flow_site_contexts",
    f"""WITH moved AS (SELECT page_id, html, regexp_extract(url, '^https?://[^/?#]+') AS root, regexp_extract(url, '^https?://[^/?#]+')
 || CASE WHEN page_id % 5 = 4 THEN '/blog' ELSE '/' || ({_PATHS})[page_id % {len(SITE_PATHS)} + 1] || CASE WHEN page_id % 2 = 0 THEN '/#top' ELSE '' END END AS url FROM {_PAGES}),
 site_pages AS (SELECT * FROM moved WHERE page_id % 5 <> 4 QUALIFY row_number() OVER (PARTITION BY regexp_replace(url, '/#top$', '') ORDER BY page_id) = 1),
 {_FLOW_TEXT}, accepted AS (SELECT * FROM texts WHERE {_ACCEPT}),
 o AS (SELECT regexp_extract(url, '^https?://[^/?#]+') || '/' AS root, * FROM accepted),
 p AS (SELECT *, (row_number() OVER (PARTITION BY root ORDER BY page_id) - 1) // 2 AS part FROM o)
 SELECT root AS base_url, part, string_agg(url, ', ' ORDER BY page_id) AS pages_scraped,
 md5(string_agg('--- Source: ' || url || ' ---' || chr(10) || text, chr(10) || chr(10) ORDER BY page_id)) AS text_md5 FROM p GROUP BY ALL""",
)
def flow_site_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """Raw pages to one context per site, two pages a part; the pages stand at known paths, some twice, some elsewhere."""
    root = site_root("url")
    path = F.get(F.array(*[F.lit(p) for p in SITE_PATHS]), (F.col("page_id") % len(SITE_PATHS)).cast("int"))
    known = F.concat(F.lit("/"), path, F.when(F.col("page_id") % 2 == 0, F.lit("/#top")).otherwise(F.lit("")))
    moved = _pages(spark, sf).withColumn("url", F.concat(root, F.when(F.col("page_id") % 5 == 4, F.lit("/blog")).otherwise(known)))
    sites = moved.select(F.concat(root, F.lit("/")).alias("base_url")).distinct()
    return flows.site_contexts(sites, moved, 2).select(
        "base_url", "part", F.array_join("pages_scraped", ", ").alias("pages_scraped"),
        F.md5("combined_text").alias("text_md5"),
    )


# --- articles and chunks --------------------------------------------------

_BARE = r"regexp_replace(w, '^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$', '', 'g')"


def forms_sql(src: str, cols: str, text: str = "text") -> str:
    """Distinct word forms, one row each."""
    return (
        f"(SELECT DISTINCT {cols}, t FROM (SELECT {cols}, {_BARE} AS t FROM (SELECT {cols}, "
        rf"unnest(string_split_regex(lower({text}), '\s+')) AS w FROM {src})) WHERE t <> '')"
    )


@register(
    "j12_best_article",
    f"""WITH post AS {forms_sql('documents', 'doc_id')}, total AS (SELECT count(*) AS n FROM documents),
 st AS (SELECT t, count(*) AS df FROM post GROUP BY t), q AS {forms_sql('benchmark', 'item_id')},
 s AS (SELECT item_id, doc_id, round(sum(ln(n / df::DOUBLE)), 6) AS score FROM q JOIN st USING (t) JOIN post USING (t), total GROUP BY ALL)
 SELECT item_id AS query_id, doc_id, score FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) = 1""",
)
def j12(spark: SparkSession, sf: str) -> DataFrame:
    """Also T2, the first hit per query."""
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return context.best_article(queries, table(spark, sf, "documents").select("doc_id", "text"))


# documents become articles: the first line a lead, every other line under a heading
_CHUNKS = rf"""lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS section_no FROM documents),
toks AS (SELECT *, list_filter(string_split_regex(line, '\s+'), lambda w: w <> '') AS t FROM lines),
chunks AS (SELECT doc_id, source, section_no, CASE WHEN section_no = 0 THEN '' ELSE 'Part ' || section_no END AS section_title,
 chunk_no, t[chunk_no * 50 + 1 : chunk_no * 50 + 50] AS c FROM (SELECT *, unnest(range((len(t) + 49) // 50)) AS chunk_no FROM toks)),
ctx AS (SELECT {uuid5_sql("'doc' || doc_id || '|' || section_no || '|' || chunk_no")} AS chunk_id, doc_id, source AS place_id, section_title,
 array_to_string(c, ' ') AS text_chunk, len(c) AS token_count FROM chunks)"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("== Part "), i, F.lit(" ==\n"), x)),
    )
    return table(spark, sf, "documents").select(
        F.concat(F.lit("doc"), "doc_id").alias("doc_name"), F.col("source").alias("place_id"),
        F.lit("article").alias("source_type"), F.array_join(lines, "\n").alias("text"),
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy(F.col("source").alias("place_id")).agg(
        F.concat(F.lit("Place "), F.first("source")).alias("name"), F.lit("common").alias("category"),
        F.lit("").alias("address"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lng"),
        F.avg("n_chars").alias("avg_rating"), F.count(F.lit(1)).cast("int").alias("num_reviews"),
    )


def chunk_rows(spark: SparkSession, sf: str) -> DataFrame:
    when = F.to_timestamp(F.lit("2026-02-09 12:00:00"))
    return context.context_chunks(articles(spark, sf), places(spark, sf), when, budget=50)


@register(
    "f11_context_chunks",
    f"""WITH {_CHUNKS}, pl AS (SELECT source, count(*) AS n, avg(n_chars) AS a FROM documents GROUP BY source)
 SELECT chunk_id, place_id, 'Place ' || place_id AS name, 'common' AS category, round(a, 6) AS avg_rating, n AS num_reviews,
 md5(text_chunk) AS text_md5, token_count, 'article' AS source_type, section_title, '2026-02-09 12:00:00.000000' AS retrieval_timestamp
 FROM ctx JOIN pl ON pl.source = ctx.place_id""",
)
def f11(spark: SparkSession, sf: str) -> DataFrame:
    """Also J13, place attributes on chunks."""
    return chunk_rows(spark, sf).select(
        "chunk_id", "place_id", "name", "category", "avg_rating", "num_reviews", F.md5("text_chunk").alias("text_md5"),
        "token_count", "source_type", "section_title", "retrieval_timestamp",
    )


# --- feature columns ------------------------------------------------------


@register(
    "f1_f3_f4_f6_counts",
    f"""SELECT doc_id, len(t) AS token_count, len(regexp_extract_all(x, '!')) AS exclamation_count, len(regexp_extract_all(x, '[🔥😀]')) AS emoji_count,
 round(CASE WHEN len(t) = 0 THEN 0.0 ELSE 1 - len(list_distinct(t))::DOUBLE / len(t) END, 6)::DOUBLE AS repetition_score
 FROM (SELECT doc_id, translate(text, ',xz', '!🔥😀') AS x, {sql(WORDS, text="translate(text, ',xz', '!🔥😀')")} AS t FROM documents)""",
)
def f1(spark: SparkSession, sf: str) -> DataFrame:
    """Commas become exclamation marks and two letters emoji."""
    d = table(spark, sf, "documents").select("doc_id", F.translate("text", ",xz", "!🔥😀").alias("x"))
    return d.select(
        "doc_id", features.token_count("x").alias("token_count"), features.exclamations("x").alias("exclamation_count"),
        features.emojis("x").alias("emoji_count"), features.repetition("x").alias("repetition_score"),
    )


# polarity and part of speech tables made from the documents' own words
def _words(spark: SparkSession, sf: str) -> DataFrame:
    from reviewmill.operators.aspects import distinct_words

    return cut(distinct_words(table(spark, sf, "documents"), [], "word"), "words")


def polarity_table(words: DataFrame) -> DataFrame:
    w = words.where("length(word) > 4")
    return w.select("word", F.when(F.col("word").startswith("t"), F.lit(0.5)).otherwise(F.lit(-0.25)).alias("score"))


def pos_table(words: DataFrame) -> DataFrame:
    w = words.where("length(word) > 2")
    kind = F.when(F.col("word").endswith("n"), F.lit("NN")).when(F.col("word").endswith("s"), F.lit("NNS"))
    return w.select("word", kind.when(F.col("word").endswith("e"), F.lit("VB")).otherwise(F.lit("JJ")).alias("pos"))


def token_features_sql(src: str, key: str, text: str) -> str:
    return f"""tk AS (SELECT {key}, unnest({sql(WORDS, text=text)}) AS tok FROM {src}),
cn AS (SELECT {key}, tok, count(*) AS n, regexp_replace(lower(tok), '^[^\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+$', '', 'g') AS word FROM tk GROUP BY {key}, tok),
tg AS (SELECT *, CASE WHEN length(word) > 4 THEN CASE WHEN starts_with(word, 't') THEN 0.5 ELSE -0.25 END END::DOUBLE AS score,
 CASE WHEN length(word) > 2 THEN CASE WHEN ends_with(word, 'n') THEN 'NN' WHEN ends_with(word, 's') THEN 'NNS' WHEN ends_with(word, 'e') THEN 'VB' ELSE 'JJ' END END AS pos FROM cn),
tf AS (SELECT {key}, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy_score,
 round(coalesce(sum(score * n) / sum(n) FILTER (score IS NOT NULL), 0), 6)::DOUBLE AS sentiment_polarity,
 round(coalesce(count(DISTINCT pos) / (sum(n) FILTER (pos IS NOT NULL))::DOUBLE, 0), 6)::DOUBLE AS pos_diversity,
 round(coalesce(sum(n) FILTER (pos LIKE 'NN%'), 0) / greatest(coalesce(sum(n) FILTER (pos LIKE 'VB%'), 0), 1)::DOUBLE, 6) AS noun_verb_ratio FROM tg GROUP BY {key})"""


@register(
    "f2_f5_f7_f8_tokens",
    f"WITH {token_features_sql('documents', 'doc_id', 'text')} SELECT * FROM tf",
)
def f2(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    words = _words(spark, sf)
    out = features.token_features(rows, polarity_table(words), pos_table(words))
    return out.withColumnRenamed("id", "doc_id")


_GROUND = f"""rw AS (SELECT doc_id, source, t FROM {forms_sql('documents', 'doc_id, source')}),
cw AS (SELECT chunk_id, place_id, t FROM {forms_sql('ctx', 'chunk_id, place_id', 'text_chunk')})"""


@register(
    "f10_grounding_reviews",
    f"""WITH b AS (SELECT *, 'p' || (turn // 2) AS place_id, conv_id || '-' || turn AS id FROM conversations),
 r AS (SELECT id, place_id, t FROM {forms_sql("(SELECT * FROM b WHERE role = 'user')", 'id, place_id')}),
 v AS (SELECT DISTINCT place_id, t FROM {forms_sql("(SELECT * FROM b WHERE role <> 'user')", 'place_id')})
 SELECT x.id, coalesce(g, 0.0) AS grounding_score FROM (SELECT id FROM b WHERE role = 'user') x LEFT JOIN
 (SELECT id, round(count(v.t) / count(r.t)::DOUBLE, 6) AS g FROM r LEFT JOIN v ON v.place_id = r.place_id AND v.t = r.t GROUP BY id) y ON x.id = y.id""",
)
def f10(spark: SparkSession, sf: str) -> DataFrame:
    """User turns against the assistant turns of the same turn pair."""
    b = table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.expr("concat('p', turn div 2)").alias("place_id"), "role", "text"
    )
    return features.grounding(b.where("role = 'user'"), b.where("role <> 'user'"))


# how many of four keywords occur; p is the text with its separators doubled
COVERED = "(" + " + ".join(
    rf"regexp_matches(p, '[^\p{{L}}\p{{N}}_]{w}[^\p{{L}}\p{{N}}_]')::INTEGER" for w in ("the", "of", "la", "de")
) + ")"


@register(
    "f11_context_features",
    f"""WITH {_CHUNKS}, {_GROUND}, vr AS (SELECT DISTINCT source, t FROM rw),
 g AS (SELECT c.chunk_id, count(v.t) / count(c.t)::DOUBLE AS grounding FROM cw c LEFT JOIN vr v ON v.source = c.place_id AND v.t = c.t GROUP BY 1),
 kw AS (SELECT chunk_id, ' ' || regexp_replace(lower(text_chunk), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g') || ' ' AS p FROM ctx)
 SELECT chunk_id, place_id, token_count, section_title, round(coalesce(grounding, 0), 6)::DOUBLE AS grounding_score,
 round({COVERED} / 4.0::DOUBLE, 6) AS coverage_score
 FROM ctx LEFT JOIN g USING (chunk_id) JOIN kw USING (chunk_id)""",
)
def f11_features(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks with coverage, and grounding in the reviews of their place."""
    chunks = cut(chunk_rows(spark, sf), "chunks")
    reviews = table(spark, sf, "documents").select(F.col("source").alias("place_id"), "text")
    words = lexicons.aspects(spark, {"common": ["the", "of", "la", "de"]})
    return features.context_features(chunks, reviews, words).select(
        "chunk_id", "place_id", "token_count", "section_title", "grounding_score", "coverage_score"
    )


@register(
    "f12_review_features",
    f"""WITH {_CHUNKS}, {_GROUND}, vc AS (SELECT DISTINCT place_id, t FROM cw),
 g AS (SELECT r.doc_id, count(v.t) / count(r.t)::DOUBLE AS g FROM rw r LEFT JOIN vc v ON v.place_id = r.source AND v.t = r.t GROUP BY 1),
 {token_features_sql('documents', 'doc_id', 'text')},
 c AS (SELECT doc_id, ' ' || regexp_replace(lower(text), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g') || ' ' AS p FROM documents)
 SELECT d.doc_id AS review_id, source AS place_id, lang AS user_id, entropy_score, sentiment_polarity, pos_diversity, noun_verb_ratio,
 round({COVERED} / 4.0::DOUBLE, 6) AS coverage_score,
 round(coalesce(g, 0), 6)::DOUBLE AS grounding_score, len({sql(WORDS)}) AS token_count, len(regexp_extract_all(text, '!')) AS exclamation_count,
 round(1 - len(list_distinct({sql(WORDS)}))::DOUBLE / len({sql(WORDS)}), 6)::DOUBLE AS repetition_score, md5(text) AS text_md5, 'documents' AS source,
 lang AS user_name, 4.0::DOUBLE AS rating, lang AS language, '2026-02-09 12:00:00.000000' AS timestamp, len(regexp_extract_all(text, '{features.EMOJI_CLASS}')) AS emoji_count
 FROM documents d JOIN tf USING (doc_id) JOIN g USING (doc_id) JOIN c USING (doc_id)""",
)
def f12(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    reviews = d.select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("place_id"), F.col("lang").alias("user_id"),
        F.col("lang").alias("user_name"), F.lit(4.0).alias("rating"), "text", F.col("lang").alias("language"),
        F.to_timestamp(F.lit("2026-02-09 12:00:00")).alias("timestamp"),
    )
    words = _words(spark, sf)
    out = features.review_features(
        reviews, places(spark, sf), cut(chunk_rows(spark, sf), "chunks"),
        lexicons.aspects(spark, {"common": ["the", "of", "la", "de"]}),
        polarity_table(words), pos_table(words), F.lit("documents"),
    )
    return out.select(
        "review_id", "place_id", "user_id", "entropy_score", "sentiment_polarity", "pos_diversity", "noun_verb_ratio",
        "coverage_score", "grounding_score", "token_count", "exclamation_count", "repetition_score",
        F.md5("text_chunk").alias("text_md5"), "source", "user_name", "rating", "language", "timestamp", "emoji_count",
    )


# --- vectors --------------------------------------------------------------


@register(
    "f13_check_vectors",
    """SELECT vec_id, problem FROM (SELECT vec_id, CASE WHEN label = 1 THEN 'length' WHEN label = 2 THEN 'null entry' WHEN label = 3 THEN 'not a number'
 WHEN label = 4 THEN 'missing' END AS problem FROM embeddings) WHERE problem IS NOT NULL""",
)
def f13(spark: SparkSession, sf: str) -> DataFrame:
    """Four labels have their vectors broken in four ways."""
    v, lab = F.col("embedding"), F.col("label")
    last = F.slice(v, 1, 63)
    broken = (
        F.when(lab == 1, last)
        .when(lab == 2, F.concat(last, F.array(F.lit(None).cast("float"))))
        .when(lab == 3, F.concat(last, F.array(F.lit(float("nan")).cast("float"))))
        .when(lab != 4, v)
    )
    rows = table(spark, sf, "embeddings").select("vec_id", broken.alias("vector"))
    return vectors.check_vectors(rows, "vector", 64).select("vec_id", "problem")


@register(
    "f13_unit_norm",
    "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) ** 0.5, 5)::DOUBLE AS before, 1.0::DOUBLE AS after FROM embeddings",
)
def f13_unit(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", vectors.unit("embedding").alias("u"))
    return rows.select(
        "vec_id", F.round(vectors.norm("embedding"), 5).alias("before"), F.round(vectors.norm("u"), 9).alias("after")
    )


@register(
    "t3_cosine_topk",
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
 q AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e)
  GROUP BY label, i) GROUP BY label),
 s AS (SELECT q.label::BIGINT AS query_id, vec_id, round(list_cosine_similarity(q.c, e.v), 6) AS score FROM q, e)
 SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 5""",
)
def t3(spark: SparkSession, sf: str) -> DataFrame:
    """The centroid of every label against all vectors."""
    e = table(spark, sf, "embeddings")
    cells = e.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg("x").alias("m"))
    queries = means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda c: c["m"]).alias("vector")
    )
    return vectors.cosine_topk(queries, e.select("vec_id", F.col("embedding").alias("vector")), 5)
