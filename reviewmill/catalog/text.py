"""Text queries: normalisation steps, tokens, spelling, language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog import register, table
from reviewmill.functions import text as T
from reviewmill.operators import language, spell
from reviewmill.operators.cleaning import clean
from reviewmill.plans.storage import cut

# SQL fragments; {t} is the text.
LOWER = "lower(coalesce({t},''))"
URLS = r"regexp_replace({t}, 'https?://\S+|www\.\S+', '', 'g')"
TAGS = r"regexp_replace({t}, '<[^\n]*?>', '', 'g')"
EMOJI = r"regexp_replace({t}, ':([a-z_]+):', '[\1] ', 'g')"
UNDERSCORE = "replace({t}, '_', ' ')"
WS = r"trim(regexp_replace({t}, '\s+', ' ', 'g'))"
PUNCT = r"regexp_replace({t}, '([!?.]){{2,}}', '\1', 'g')"
ASCII = r"regexp_replace({t}, '[^\x00-\x7F]', '', 'g')"
PUNCT_TOKENS = (
    r"array_to_string(list_filter(string_split_regex({t}, '\s+'), lambda w: w <> '' and "
    r"(regexp_matches(w, '[\p{{L}}\p{{N}}_]') or (starts_with(w,'[') and ends_with(w,']')))), ' ')"
)

WORDS = r"list_filter(string_split_regex({t}, '\s+'), lambda w: w <> '')"


def sql(*steps: str, text: str = "text") -> str:
    """Nest SQL steps, first step innermost."""
    for step in steps:
        text = step.format(t=text)
    return text


def _text_query(name: str, source: str, key: str, col: str, fn, expr: str) -> None:
    """Register a Column function over a whole text column; the text goes out
    as a digest plus its length."""

    @register(
        name,
        f"SELECT {key}, md5(o) AS out_md5, length(o) AS out_len "
        f"FROM (SELECT {key}, {expr} AS o FROM {source})",
    )
    def query(spark: SparkSession, sf: str) -> DataFrame:
        out = table(spark, sf, source).select(key, fn(F.col(col)).alias("o"))
        return out.select(key, F.md5("o").alias("out_md5"), F.length("o").alias("out_len"))


# keep a character unless it equals the two before it
SQUEEZE = (
    "array_to_string(list_transform(list_filter(list_zip("
    "string_split({t},''), list_concat([chr(0)], string_split({t},'')[:-2]), "
    "list_concat([chr(0),chr(0)], string_split({t},'')[:-3])), "
    "lambda z: z[1] = chr(10) or not (z[1]=z[2] and z[1]=z[3])), lambda z: z[1]), '')"
)

_text_query("c1_norm_case", "documents", "doc_id", "text", T.norm_case, sql(LOWER))
_text_query("c2_strip_urls", "pages", "page_id", "html", T.strip_urls, sql(URLS, text="html"))
_text_query("c3_strip_tags", "pages", "page_id", "html", T.strip_tags, sql(TAGS, text="html"))
_text_query("c4_squeeze", "documents", "doc_id", "text", T.squeeze, sql(SQUEEZE))


# letters that become emoji, and how those are spelled: pictures, a flag, a tone, joined ones with and without a tone
_EMOJI = [
    ("x", "🔥", ":fire:"), ("z", "😀", ":grinning_face:"), ("q", "🇸🇬", ":flag_sg:"), ("j", "👍🏿", ":thumbs_up_dark_skin_tone:"),
    ("k", "👩🏽‍🚀", ":woman_astronaut_medium_skin_tone:"), ("w", "👨‍👩‍👧", ":family_man_woman_girl:"), ("v", "❤️", ":red_heart:"),
]


def _with_emoji(c: Column) -> Column:
    for letter, emoji, _ in _EMOJI:
        c = F.replace(c, F.lit(letter), F.lit(emoji))
    return c


def _emoji_sql(x: str) -> str:
    letters = "".join(e[0] for e in _EMOJI)
    x = f"translate({x}, '{letters}', '{''.join(chr(0xE000 + i) for i in range(len(letters)))}')"
    for i, (_, _, name) in enumerate(_EMOJI):
        x = f"replace({x}, '{chr(0xE000 + i)}', '{name}')"
    return EMOJI.format(t=x)


_text_query(
    "c5_verbalize_emoji", "documents", "doc_id", "text",
    lambda c: T.verbalize_emoji(_with_emoji(F.concat(c, F.lit(" :ay_by: xxzqqjjkkww!")))),
    _emoji_sql("text || ' :ay_by: xxzqqjjkkww!'"),
)
_text_query(
    "c6_underscores", "documents", "doc_id", "text",
    lambda c: T.underscores(F.translate(c, ",", "_")),
    sql(UNDERSCORE, text="replace(text, ',', '_')"),
)
_text_query("c7_squash_ws", "documents", "doc_id", "text", T.squash_ws, sql(WS))
_text_query(
    "c8_squash_punct", "documents", "doc_id", "text",
    lambda c: T.squash_punct(F.translate(c, "\n, ", "!?.")),
    sql(PUNCT, text="translate(text, chr(10) || ', ', '!?.')"),
)
_text_query("c9_ascii_only", "documents", "doc_id", "text", T.ascii_only, sql(ASCII))
_text_query("c11_drop_punct_tokens", "documents", "doc_id", "text", T.drop_punct_tokens, sql(PUNCT_TOKENS))

CORE_SQL = sql(EMOJI, UNDERSCORE, WS, PUNCT, ASCII, text="sq")


def chain_sql(source: str, key: str, col: str, extra: str = "") -> str:
    low = sql(LOWER, URLS, TAGS, text=col)
    return (
        f"SELECT {key}, {extra} {CORE_SQL} AS core FROM (SELECT *, {sql(SQUEEZE, text='low')} AS sq "
        f"FROM (SELECT *, {low} AS low FROM {source}))"
    )


@register(
    "c13_clean_core",
    f"SELECT page_id, md5(c) AS out_md5, length(c) AS out_len FROM (SELECT page_id, "
    f"{sql(PUNCT_TOKENS, WS, text='core')} AS c FROM ({chain_sql('pages', 'page_id', 'html')}))",
)
def c13_clean_core(spark: SparkSession, sf: str) -> DataFrame:
    """The chain over raw pages, which hold URLs, tags, entities and marks."""
    rows = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))
    return clean(rows).select(
        F.col("id").alias("page_id"), F.md5("clean_text").alias("out_md5"),
        F.length("clean_text").alias("out_len"),
    )


@register(
    "c10_token_parts",
    r"SELECT prefix, core, suffix, count(*) AS n FROM (SELECT regexp_extract(w, '^([^\p{L}\p{N}_]*)', 1) "
    r"AS prefix, regexp_replace(w, '^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$', '', 'g') AS core, "
    r"regexp_extract(w, '([^\p{L}\p{N}_]*)$', 1) AS suffix FROM (SELECT unnest("
    + sql(WORDS)
    + ") AS w FROM documents)) GROUP BY ALL",
)
def c10_token_parts(spark: SparkSession, sf: str) -> DataFrame:
    toks = table(spark, sf, "documents").select(F.explode(T.tokens("text")).alias("w"))
    return toks.select(T.token_parts("w").alias("p")).groupBy(
        F.col("p.prefix").alias("prefix"), F.col("p.core").alias("core"), F.col("p.suffix").alias("suffix")
    ).agg(F.count(F.lit(1)).alias("n"))


@register(
    "c14_shingles",
    "SELECT doc_id, len(s) AS n, list_min(s) AS first_gram, list_max(s) AS last_gram, "
    "md5(array_to_string(list_sort(s), '|')) AS grams_md5 FROM (SELECT doc_id, CASE WHEN length(text) < 5 "
    "THEN [text] ELSE list_distinct(list_transform(range(1, length(text) - 3), lambda i: substr(text, i, 5))) "
    "END AS s FROM documents)",
)
def c14_shingles(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "documents").select("doc_id", F.sort_array(T.shingles("text")).alias("s"))
    return s.select(
        "doc_id", F.size("s").alias("n"), F.element_at("s", 1).alias("first_gram"),
        F.element_at("s", -1).alias("last_gram"), F.md5(F.array_join("s", "|")).alias("grams_md5"),
    )


@register(
    "c15_word_set",
    f"SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), ' ')) AS words_md5 FROM "
    f"(SELECT doc_id, list_distinct({sql(WORDS)}) AS s FROM documents)",
)
def c15_word_set(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "documents").select("doc_id", F.sort_array(T.word_set("text")).alias("s"))
    return s.select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", " ")).alias("words_md5"))


@register(
    "c16_overlap",
    f"""WITH w AS (SELECT conv_id, turn, list_distinct({sql(WORDS)}) AS s FROM conversations)
    SELECT a.conv_id, a.turn, round(CASE WHEN least(len(a.s), len(b.s)) = 0 THEN 0.0 ELSE
    len(list_intersect(a.s, b.s))::DOUBLE / least(len(a.s), len(b.s)) END, 6) AS overlap
    FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def c16_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn against the next one; also X3."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_next"))
    return turns.join(after, ["conv_id", "turn"]).select(
        "conv_id", "turn", T.overlap("text", "_next").alias("overlap")
    )


# doubling every separator lets neighbouring words match without sharing one
PADDED = r"regexp_replace(' ' || lower(text) || ' ', '([^\p{L}\p{N}_])', '\1\1', 'g')"


def keyword_count_sql(word: str, padded: str = PADDED) -> str:
    word = "".join(c if c.isalnum() or c == "_" else ("\\" + c) * 1 for c in word)
    # separators inside a keyword are doubled in the padded text
    word = word.replace("\\ ", "  ").replace("\\-", "--")
    return rf"len(regexp_extract_all({padded}, '[^\p{{L}}\p{{N}}_]{word}[^\p{{L}}\p{{N}}_]'))"


@register(
    "c17_count_keyword",
    f"SELECT doc_id, {keyword_count_sql('the')} AS n_the, {keyword_count_sql('of the')} AS n_of_the, "
    f"{keyword_count_sql('la')} AS n_la FROM documents",
)
def c17_count_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", T.count_keyword("text", "the").alias("n_the"),
        T.count_keyword("text", "of the").alias("n_of_the"), T.count_keyword("text", "la").alias("n_la"),
    )


@register(
    "c20_slug",
    "SELECT item_id, md5(replace(lower(text), ' ', '_')) AS slug_md5 FROM benchmark",
)
def c20_slug(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("item_id", F.md5(T.slug("text")).alias("slug_md5"))


@register(
    "p10_nonblank",
    r"SELECT conv_id, turn FROM conversations WHERE regexp_matches(regexp_replace(text, "
    r"CASE WHEN role = 'user' THEN '[^\s]' ELSE '[.]' END, '', 'g'), '\S')",
)
def p10_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    """User turns are stripped down to their whitespace and so must go."""
    gutted = F.when(F.col("role") == "user", F.regexp_replace("text", r"\S", "")).otherwise(
        F.regexp_replace("text", "[.]", "")
    )
    return table(spark, sf, "conversations").where(T.nonblank(gutted)).select("conv_id", "turn")


# --- spelling -------------------------------------------------------------

MIN_FREQ = 30
_TOKENS = f"""core AS ({chain_sql('documents', 'doc_id', 'text')}),
toks AS (SELECT doc_id, row_number() OVER () AS rn, w FROM (SELECT doc_id, unnest({sql(WORDS, text='core')}) AS w FROM core)
 WHERE regexp_matches(w, '[a-zA-Z0-9_]') OR (starts_with(w,'[') AND ends_with(w,']'))),
cores AS (SELECT word, count(*) AS freq FROM (SELECT regexp_replace(w, '^[^a-zA-Z0-9_]+|[^a-zA-Z0-9_]+$', '', 'g') AS word
 FROM toks) WHERE word <> '' GROUP BY word),
vocab AS (SELECT word, freq FROM cores WHERE freq >= {MIN_FREQ})"""

_NEAR = """unk AS (SELECT word FROM cores ANTI JOIN vocab USING (word) WHERE length(word) > 1
 AND NOT regexp_matches(word, '^[0-9.]+$')),
pairs AS (SELECT u.word, v.word AS candidate, v.freq, damerau_levenshtein(u.word, v.word) AS dist FROM unk u JOIN vocab v
 ON abs(length(u.word) - length(v.word)) <= 2 WHERE damerau_levenshtein(u.word, v.word) <= 2),
near AS (SELECT * FROM pairs QUALIFY dist = min(dist) OVER (PARTITION BY word))"""


def _cleaned_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return spell.distinct_tokens(docs.select(T.clean_core("text").alias("text")))


def _vocab(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All distinct cores, and the frequent ones as vocabulary."""
    words = cut(spell.distinct_cores(_cleaned_tokens(spark, sf)), "words")
    return words, words.where(F.col("freq") >= MIN_FREQ)


@register(
    "j5_vocabulary",
    f"WITH {_TOKENS} SELECT c.word, c.freq, v.word IS NOT NULL AS known FROM cores c LEFT JOIN (SELECT word FROM vocab) v ON c.word = v.word",
)
def j5_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    words, vocab = _vocab(spark, sf)
    return spell.known_tokens(words, vocab).withColumn("known", F.lit(True)).unionByName(
        spell.unknown_tokens(words, vocab).withColumn("known", F.lit(False))
    )


@register("j6_spell_candidates", f"WITH {_TOKENS}, {_NEAR} SELECT word, candidate, freq, dist FROM near")
def j6_spell_candidates(spark: SparkSession, sf: str) -> DataFrame:
    words, vocab = _vocab(spark, sf)
    unknown = cut(spell.repairable(spell.unknown_tokens(words, vocab)).select("word"), "unknown")
    return spell.spell_candidates(unknown, vocab)


_WIN = """win AS (SELECT word, arg_max(candidate, (freq, candidate)) AS fix, max(freq) / sum(freq)::DOUBLE AS share FROM near
 GROUP BY word HAVING max(freq) / sum(freq)::DOUBLE > 0.7)"""


@register(
    "a9_spell_winner",
    f"WITH {_TOKENS}, {_NEAR}, {_WIN} SELECT word, fix, round(share, 6) AS share FROM win",
)
def a9_spell_winner(spark: SparkSession, sf: str) -> DataFrame:
    words, vocab = _vocab(spark, sf)
    unknown = cut(spell.repairable(spell.unknown_tokens(words, vocab)).select("word"), "unknown")
    return spell.spell_winners(spell.spell_candidates(unknown, vocab))


@register(
    "c13_clean_spelled",
    f"""WITH {_TOKENS}, {_NEAR}, {_WIN},
 fixed AS (SELECT doc_id, rn, CASE WHEN fix IS NULL THEN w ELSE regexp_extract(w, '^([^a-zA-Z0-9_]*)', 1) || fix ||
 regexp_extract(w, '([^a-zA-Z0-9_]*)$', 1) END AS w FROM toks LEFT JOIN win
 ON regexp_replace(w, '^[^a-zA-Z0-9_]+|[^a-zA-Z0-9_]+$', '', 'g') = win.word)
 SELECT d.doc_id, md5(coalesce(t, '')) AS out_md5, length(coalesce(t, '')) AS out_len FROM documents d LEFT JOIN
 (SELECT doc_id, string_agg(w, ' ' ORDER BY rn) AS t FROM fixed GROUP BY doc_id) x ON d.doc_id = x.doc_id""",
)
def c13_clean_spelled(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain with repair; the vocabulary is the corpus's own."""
    _, vocab = _vocab(spark, sf)
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return clean(rows, "text", vocab).select(
        F.col("id").alias("doc_id"), F.md5("clean_text").alias("out_md5"),
        F.length("clean_text").alias("out_len"),
    )


@register(
    "c12_detect_language",
    """WITH g AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(text) - 1), lambda i: substr(lower(text), i, 3)))
 AS gram FROM documents),
 c AS (SELECT lang, gram, count(*) AS n FROM g GROUP BY ALL),
 m AS (SELECT lang, gram, n / (sum(n) OVER (PARTITION BY lang))::DOUBLE AS weight FROM c),
 s AS (SELECT doc_id, m.lang, round(sum(weight), 9) AS s FROM g JOIN m USING (gram) GROUP BY ALL)
 SELECT d.doc_id, coalesce(b.l, '') AS language FROM documents d LEFT JOIN
 (SELECT doc_id, arg_max(lang, (s, lang)) AS l FROM s GROUP BY doc_id) b USING (doc_id)""",
)
def c12_detect_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.language_model(docs.select("lang", "text"))
    found = language.detect_language(docs.select(F.col("doc_id").alias("id"), "text"), model)
    return found.select(F.col("id").alias("doc_id"), "language")
