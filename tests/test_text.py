import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import pages as P
from reviewmill.functions import parse
from reviewmill.functions import text as T
from reviewmill.operators import language, spell
from reviewmill.operators.cleaning import clean


def one(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.o for r in df.select("i", fn(F.col("c")).alias("o")).orderBy("i").collect()]


def test_normalisation_steps(spark):
    assert one(spark, T.norm_case, ["ABC É", None, ""]) == ["abc é", "", ""]
    assert one(spark, T.strip_urls, ["see https://x.y/z?a=1 now", "www.a.b c"]) == ["see  now", " c"]
    assert one(spark, T.strip_tags, ["a<b>c</b>d", "1 < 2\n3 > 2"]) == ["acd", "1 < 2\n3 > 2"]
    assert one(spark, T.squeeze, ["sooo", "10000", "a\n\n\n\nb", "aabb"]) == ["soo", "100", "a\n\n\n\nb", "aabb"]
    assert one(spark, T.verbalize_emoji, ["yum 🔥!", "❤️x", ":a_b: :A:", "plain"]) == [
        "yum [fire] !", "[red_heart] x", "[a_b]  :A:", "plain",
    ]
    assert one(spark, T.squash_ws, ["  a \t\n b c "]) == ["a b c"]
    assert one(spark, T.squash_punct, ["what?!", "wait...", "a!b"]) == ["what!", "wait.", "a!b"]
    assert one(spark, T.ascii_only, ["café 日本"]) == ["caf "]
    assert one(spark, T.drop_punct_tokens, ["a - b", "[!] ok", "..."]) == ["a b", "[!] ok", ""]


def test_token_parts_and_sets(spark):
    parts = one(spark, T.token_parts, ["(hi!)", "...", "a-b,"])
    assert [tuple(p) for p in parts] == [("(", "hi", "!)"), ("...", "", "..."), ("", "a-b", ",")]
    assert sorted(one(spark, T.shingles, ["abcdefg"])[0]) == ["abcde", "bcdef", "cdefg"]
    assert one(spark, T.shingles, ["abc", ""]) == [["abc"], [""]]
    df = spark.createDataFrame([("a b c d", "a b x"), ("", "a"), ("A a", "a")], "x string, y string")
    got = [r.o for r in df.select(T.overlap("x", "y").alias("o")).collect()]
    assert got == [pytest.approx(2 / 3), 0.0, 1.0]
    assert one(spark, lambda c: T.count_keyword(c, "check-in"), ["Check-in, check-ins; CHECK-IN"]) == [2]
    assert one(spark, T.nonblank, ["  \n", " x "]) == [False, True]


def test_relative_times(spark):
    base = datetime(2026, 2, 9, 12)
    labels = ["a day ago", "2 weeks ago", "Edited 5 months ago", "a year ago", "an hour ago", "A day ago",
              "3 Months ago", "soon", None, "90 minutes ago"]
    got = one(spark, lambda c: parse.parse_relative_time(c, F.lit(base)), labels)
    days = [(base - g).total_seconds() / 86400 if g else None for g in got]
    assert days == [1, 14, 150, 365, None, None, None, None, None, 0.0625]


def test_labels(spark):
    assert one(spark, parse.parse_rating, [" 4.5 ", "4.5 stars", "5.", None]) == [4.5, None, 5.0, None]
    assert one(spark, parse.parse_review_count, ["1,234 reviews", "1 review", "none"]) == [1234, 1, None]
    assert one(spark, parse.parse_category, [" Cafe ", "4.2", " "]) == ["Cafe", None, None]
    assert one(spark, parse.parse_lat, ["x!3d-1.5!4d+103.25!", "!3d1!4d2"]) == [-1.5, None]
    assert one(spark, parse.parse_stars, ["Rated 4 of 5 stars", "none"]) == [4, None]


LONG = "This line is certainly longer than fifty characters, so it stays in the text."


def test_emoji_are_taken_whole(spark):
    said = {
        "🇸🇬🇫🇷": "[flag_sg] [flag_fr] ", "👍🏽👍": ":thumbs_up_medium_skin_tone:".replace(":thumbs", "[thumbs")[:-1] + "] [thumbs_up] ",
        "👩🏽‍🚀": "[woman_astronaut_medium_skin_tone] ", "👨‍👩‍👧": "[family_man_woman_girl] ", "❤️": "[red_heart] ", "❤️‍🔥": "[heart_on_fire] ",
        "🏳️‍🌈": "[rainbow_flag] ", "5️⃣": ":keycap_5:", "🥟": "[dumpling] ", "🏃🏿‍♀️": "[woman_runner_dark_skin_tone] ",
        "👍🏼": ":thumbs_up_medium-light_skin_tone:", "🏽": "[medium_skin_tone] ", "🔥‍🍕": "[fire] [pizza] ", "é 5 # ‍": "é 5 # ‍", "": "", None: None,
    }
    assert one(spark, T.verbalize_emoji, list(said)) == list(said.values())
    own = one(spark, lambda c: T.verbalize_emoji(c, {"🔥": "hot", "^_^": "smile"}), ["🔥 ^_^ 🥟 👍🏽", "^^"])
    assert own == ["[hot]  [smile]  🥟 👍🏽", "^^"]


def test_page_text(spark):
    html = [
        f"<body><header>h</header><main><p>{LONG}</p><script>var x='</p>';</script><p>short</p></main>{LONG}</body>",
        f"<body><article><!-- {LONG} --><p>{LONG} &amp; &eacute;</p></article></body>",
        f"<body><div id='content'><p>{LONG}</p></div><p>{LONG} not</p></body>",
        f"<body><cookie-banner><p>{LONG}</p></cookie-banner><p>We use cookies to provide {LONG}</p><p>{LONG}</p>",
        "<p>no root</p>",
    ]
    got = one(spark, lambda c: P.keep_lines(P.html_main_text(c)), html)
    assert got == [LONG, LONG + " & é", LONG, LONG, ""]
    ok = one(spark, P.is_accepted, ["x" * 200, "x" * 199, "x" * 200 + "1404", "The page you requested was not found" * 9])
    assert ok == [True, False, False, False]
    raw = one(spark, P.decode_body, [bytearray(b"caf\xc3\xa9\xff!")], "binary")
    assert raw == ["café!"]
    assert one(spark, P.is_binary_url, ["http://a/b.PDF?x=1", "http://a/b?c=.pdf", "http://a/b.zip#t"]) == [True, False, True]
    assert one(spark, P.site_root, ["https://a.b:8080/c?d", "no url"]) == ["https://a.b:8080", None]


def test_page_roots_end_at_their_own_tag(spark):
    html = [
        "<body>x<div class=a><div id='content'>one<div>two<div>three</div>four</div>five</div>six</div></body>",
        "<body><div data-id='content'>no</div><nav>a<nav>b</nav>c</nav>text<cookie-banner>z<my-consent>q</my-consent></cookie-banner>tail",
        "<main>a<main-x>b</main-x><article>c</article></main>d", "<article>a<article>b</article>c</article>d<p>",
        "<body><script>if (a<b) '</div>'</script>keep<header>gone", "<DIV ID=\"content\">up<Div>in</DIV>per</div>x",
        "<body>" + "<div>deep " * 3000, None,
    ]
    got = [x.split() for x in one(spark, P.html_main_text, html)]
    assert got == [
        ["one", "two", "three", "four", "five"], ["no", "text", "tail"], ["a", "b", "c"], ["a", "b", "c"], ["keep"],
        ["up", "in", "per"], ["deep"] * 3000, [],
    ]
    import html as lib

    refs = [
        "a &amp;lt; b", "&copy; &copy x &#65;&#x41;&#150;&#0;&#xD800;&#99999999999;&nosuch; &AElig;&NotEqualTilde; & &; &#; end",
        "plain", "&frac12&eacute;", "&#00065;&#x1F600;", "&#x0000041;" + "&#1114112;",
    ]
    assert one(spark, P.unescape, refs) == [lib.unescape(x) for x in refs]


def test_spelling(spark):
    vocab = spark.createDataFrame(
        [("harbour", 9), ("ferry", 5), ("lantern", 4), ("from", 50), ("the", 20), ("form", 1)], "word string, freq bigint"
    )
    rows = spark.createDataFrame(
        [(1, "Te harbor ferrry frm (lantren)! 42 q"), (2, None), (3, "?? [x]"), (4, "wxyz")], "id bigint, text string"
    )
    got = {r.id: r.clean_text for r in clean(rows, "text", vocab).collect()}
    assert got == {1: "the harbour ferry from (lantern)! 42 q", 2: "", 3: "[x]", 4: "wxyz"}


def test_edit_distance_equals_brute_force(spark):
    import itertools

    words = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("ab", repeat=n)] + ["abc", "ca", "acb", "bca"]

    def edits(w):
        s = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        out = {l + r[1:] for l, r in s if r} | {l + r[1] + r[0] + r[2:] for l, r in s if len(r) > 1}
        return out | {l + c + r[1:] for l, r in s if r for c in "abc"} | {l + c + r for l, r in s for c in "abc"}

    one_off = {w: edits(w) for w in words}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    vocab = df.select("word", F.lit(1).cast("bigint").alias("freq"))
    got = {(r.word, r.candidate): r.dist for r in spell.spell_candidates(df, vocab).collect()}
    for w in words:
        near = {v: 1 for v in words if v != w and v in one_off[w]}
        if not near:
            near = {v: 2 for v in words if v != w and any(v in edits(e) for e in one_off[w])}
        assert {v: d for (x, v), d in got.items() if x == w} == near


def test_long_words_meet_in_segments(spark):
    """Two random edits of every kind, exchanges too, in words of any length, next to each other and far apart."""
    import random

    rng = random.Random(4)

    def edit(w):
        i = rng.randrange(len(w) - 1)
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + "q" + w[i:], w[:i] + "q" + w[i + 1 :], w[:i] + w[i + 1] + w[i] + w[i + 2 :]])

    words = ["".join(rng.choice("abcdef") for _ in range(n)) for n in [*range(12, 60), 300] for _ in range(3)]
    words.append("".join(rng.choice("abcdef") for _ in range(20_000)))
    asked = {edit(edit(w)): w for w in words}
    df = spark.createDataFrame([(w,) for w in asked], "word string")
    vocab = spark.createDataFrame([(w, 1) for w in words], "word string, freq bigint")
    got = {(r.word, r.candidate) for r in spell.spell_candidates(df, vocab).collect()}
    assert got == {(a, w) for a, w in asked.items() if a != w}


def test_keys_of_many_words_are_not_broadcast(spark, tmp_path, monkeypatch):
    """A small file of words holds some 60 keys a word; neither side goes through the driver."""
    monkeypatch.setattr(spell, "MAX_KEYS", 1000)
    rows = spark.range(2000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 9).alias("word"), F.lit(1).cast("bigint").alias("freq"))
    rows.write.parquet(str(tmp_path / "words"))
    words = spark.read.parquet(str(tmp_path / "words"))
    pairs = spell.key_pairs(words.select(F.concat(F.substring("word", 1, 8), F.lit("xy")).alias("word")), words)
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.where("substring(word, 1, 8) = substring(candidate, 1, 8)").count() >= 2000


def test_language(spark):
    rows = [("en", "the cat and the dog with the hat"), ("de", "der hund und die katze mit dem hut")]
    model = language.language_model(spark.createDataFrame(rows, "lang string, text string"))
    asked = spark.createDataFrame([(1, "the dog"), (2, "und der hund"), (3, "xq")], "id bigint, text string")
    assert {r.id: r.language for r in language.detect_language(asked, model).collect()} == {1: "en", 2: "de", 3: ""}


def test_ngrams_of_a_text_are_counted_where_it_lies(spark):
    """With a small model the texts are shuffled once and their n-grams never; the tasks follow the splits."""
    model = language.language_model(spark.createDataFrame([("en", "the cat"), ("de", "der hund")], "lang string, text string"))
    for splits in (5, 10):
        texts = spark.range(0, 10, 1, splits).select("id", F.lit("the cat").alias("text"))
        found = language.detect_language(texts, model)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(id#\d+L?, {splits * 16}\)", plan)
        assert not re.search(r"hashpartitioning\(id#\d+L?, gram", plan)
        assert {r.language for r in found.collect()} == {"en"}


def test_a_token_is_looked_at_once(spark):
    """Tokens are counted as they are; only distinct ones are taken apart, kept or dropped."""
    texts = spark.createDataFrame([(1, "a (a) b!! -- a"), (2, "b [x] a"), (3, None), (4, "")], "id bigint, text string")
    toks = spell.distinct_tokens(texts)
    assert {(r.token, r.core, r.n) for r in toks.collect()} == {("a", "a", 3), ("(a)", "a", 1), ("b!!", "b", 1), ("b", "b", 1), ("[x]", "x", 1)}
    assert {(r.word, r.freq) for r in spell.distinct_cores(toks).collect()} == {("a", 4), ("b", 2), ("x", 1)}
    plan = toks._jdf.queryExecution().optimizedPlan().toString().lower()
    occurrences = plan[plan.index("generate") :]
    assert "regexp_replace" in plan and "rlike" in plan and "regexp_replace" not in occurrences and "rlike" not in occurrences
    assert not re.search(r"(filter|project)[^\n]*rlike", plan[plan.index("aggregate") :])
