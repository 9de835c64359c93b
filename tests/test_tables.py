import random
import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill import lexicons, schemas
from reviewmill.operators import context, features, ingest, integrity, pages, vectors
from reviewmill.plans import flows, skew
from reviewmill.plans.storage import new_path
from reviewmill.sources import context as files
from reviewmill.sources import reviews as csv
from reviewmill.sources import tables
from reviewmill.streaming import reviews as streaming


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_skewed_equals_plain_join(spark, how):
    rng = random.Random(1)
    big = [(None if rng.random() < 0.1 else ("hot" if rng.random() < 0.5 else rng.choice("abcd")), i) for i in range(300)]
    left = spark.createDataFrame(big, "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("x", 4)], "k string, w int")
    key = lambda df: sorted(df.collect(), key=str)
    assert key(skew.join_skewed(left, right, ["k"], how, rows_per_salt=20)) == key(left.join(right, "k", how))
    assert skew.hot_keys(left, ["k"], 20).where("k = 'hot'").first()["_salts"] > 3


def test_running_and_lists_across_buckets(spark):
    rng = random.Random(2)
    data = [(rng.choice(["p", "p", "q"]), s, float(rng.randint(1, 5))) for s in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(data, "place string, seq bigint, rating double")
    got = {r.seq: (r.running_count, r.running_avg) for r in ingest.running_rating(df, "place", "rating", "seq").collect()}
    for p in "pq":
        seen = []
        for _, s, r in sorted(x for x in data if x[0] == p):
            seen.append(r)
            assert got[s] == (len(seen), pytest.approx(sum(seen) / len(seen)))
    lists = skew.chunked_lists(df, ["place"], "seq", "seq", "l", chunk=7)
    for p in "pq":
        parts = [r.l for r in lists.where(F.col("place") == p).orderBy("part").collect()]
        assert [x for part in parts for x in part] == sorted(s for q, s, _ in data if q == p)
        assert all(len(x) == 7 for x in parts[:-1])


SCRAPED = [
    ("Noodle Bar", "1 Road", "Cafe", 4.5, 10, None, "http://m/1", 1.0, 2.0, "Ann", 5, 'said "yes",\nthen left', "a day ago", None, datetime(2026, 1, 1), "r1"),
    ("Noodle Bar", "1 Road", "Cafe", 4.5, 10, None, "http://m/1", 1.0, 2.0, "Bob", 3, "fine", "x", None, None, "r2"),
    ("Noodle Bar", "other", "Bar", 1.0, 99, "http://w", "http://m/1", 1.0, 2.0, "Ann", 4, "good", "x", None, datetime(2026, 1, 2), "r3"),
    ("Tea Hut", "2 Road", "Cafe", 4.0, 5, " ", "http://m/2", 1.0, 2.0, "Ann", 4, " ok ", "x", None, datetime(2026, 1, 3), "r4"),
]


def test_scraped_flow_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame(SCRAPED, schemas.SCRAPED_REVIEW).coalesce(1)
    path = new_path(spark, "csv")
    csv.append_reviews(df, path, "csv")
    back = csv.read_scraped_reviews(spark, path, header=False)
    assert rows_of(back.select("review_id", "review_text")) == [(r[-1], r[11]) for r in SCRAPED]
    base = str(tmp_path / "db")
    rows = back.withColumn("seq", F.substring("review_id", 2, 5).cast("bigint"))
    for _ in range(2):
        flows.load_scraped(rows, base)
    review = tables.read_table(spark, f"{base}/review", schemas.REVIEW)
    assert review.count() == 3 and review.where("language = ''").count() == 3
    place = {r.name: r for r in tables.read_table(spark, f"{base}/place", schemas.PLACE).collect()}
    assert place["Noodle Bar"].address == "1 Road" and place["Noodle Bar"].url == "http://m/1"
    assert place["Tea Hut"].url == "http://m/2" and place["Tea Hut"].num_reviews == 5
    users = {r.name: len(r.reviews) for r in tables.read_table(spark, f"{base}/users", schemas.USERS).collect()}
    assert users == {"Ann": 3}
    assert tables.latest_version(spark, f"{base}/review") == 1
    assert integrity.orphans(review, place_df := tables.read_table(spark, f"{base}/place", schemas.PLACE), "place_id").count() == 0
    gone = place_df.where("name = 'Tea Hut'")
    assert integrity.delete_cascade(review, gone, "place_id").count() == 2
    assert integrity.delete_set_null(review, gone, "place_id").where("place_id is null").count() == 1


def test_alt_flow_with_random_and_stable_keys(spark, tmp_path):
    rows = spark.createDataFrame(
        [("B", "Ann", "x", "p", 4.0, "taste", 1), ("B", "Ann", "y", "p", 2.0, "menu", 2)], schemas.ALT_REVIEW + ", seq bigint"
    )
    for stable, want in ((False, 4), (True, 2)):
        base = str(tmp_path / f"db{stable}")
        flows.load_alt(rows, base, stable=stable)
        flows.load_alt(rows, base, stable=stable)
        assert tables.read_table(spark, f"{base}/review", schemas.REVIEW).count() == want
    place = tables.read_table(spark, f"{base}/place", schemas.PLACE).first()
    assert (place.category, place.avg_rating, place.num_reviews, place.lat) == ("taste", 3.0, 2, 0.0)


def test_upsert_keeps_and_replaces(spark):
    t = spark.createDataFrame([(1, "a", 1, ["x"]), (2, None, 2, ["y"])], "k int, name string, n int, l array<string>")
    b = spark.createDataFrame([(2, "z", None, ["q", "y"]), (3, "c", 3, ["w"])], t.schema)
    assert rows_of(tables.upsert(t, b, ["k"], ["n", "l"])) == [
        (1, "a", 1, ["x"]), (2, None, None, ["q", "y"]), (3, "c", 3, ["w"]),
    ]
    merged = tables.upsert(t, b, ["k"], ["l"], merge_lists=True)
    assert merged.where("k = 2").first()["l"] == ["y", "q"]


def test_validate_and_audit(spark):
    df = spark.createDataFrame([("a", "1.5"), ("b", "x"), (None, None), ("a", "2")], "id string, r string")
    good, bad = integrity.validate(df, {"id": "string", "r": "double"})
    assert rows_of(good) == [("a", 1.5), ("a", 2.0)]
    assert sorted(r.reasons for r in bad.collect()) == [["id: missing", "r: missing"], ["r: not double"]]
    assert rows_of(integrity.check_keys(df, ["id"], ["r"])) == [("not null", "r", 1), ("unique", "a", 2)]


def test_profiles_flatten(spark):
    rows = [("n", "a", "c", 4.0, 1, None, None, 0.0, 0.0, [("Ann", 5, "t", "2 days ago", "r1")]),
            ("m", "a", "c", 4.0, 1, None, None, 0.0, 0.0, [])]
    flat = ingest.flatten_profiles(spark.createDataFrame(rows, schemas.PROFILE), F.lit(datetime(2026, 2, 9)))
    r = flat.collect()
    assert len(r) == 1 and r[0].calculated_date == datetime(2026, 2, 7) and r[0].date_retrieved == "2026-02-09"
    many = spark.createDataFrame([("p", i) for i in range(30)] + [("q", 50)], "place string, seq int")
    assert ingest.cap_per_place(many, "place", "seq", 10).count() == 11


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"r{i}", f"p{i % 2}", f"u{i % 3}", f"User {i % 3}", float(i), "t", "", datetime(2026, 1, 1 + i), f"Place {i % 2}", i) for i in range(9)]
    schema = schemas.REVIEW + ", place_name string, seq bigint"
    store, base, ckpt = (str(tmp_path / n) for n in ("store", "db", "ckpt"))
    for part in (rows[:6], rows[4:]):
        csv.append_reviews(spark.createDataFrame(part, schema).coalesce(1), store)
        stream = spark.readStream.schema(schema).parquet(store)
        streaming.stream_upsert(stream, base, ckpt)
    assert rows_of(streaming.read_reviews(spark, base).select("review_id")) == [(f"r{i}",) for i in range(9)]
    place = {r.name: r.num_reviews for r in tables.read_table(spark, f"{base}/place", schemas.PLACE).collect()}
    assert place == {"Place 0": 5, "Place 1": 4}
    users = tables.read_table(spark, f"{base}/users", schemas.USERS).orderBy("user_id", "part").collect()
    assert [x for r in users if r.user_id == "u0" for x in r.reviews] == ["r0", "r3", "r6"]
    old = [("r0", "p0", "u0", "User 0", 9.0, "t", "", datetime(2019, 1, 1), "Place 0", 0), ("r90", "p0", "u0", "User 0", 8.0, "t", "", datetime(2019, 1, 1), "Place 0", 90)]
    for _ in range(2):  # an epoch run again, with a review known before and one years older
        streaming.upsert_epoch(spark.createDataFrame(old, schema), base, 7, stream="late")
        assert streaming.read_reviews(spark, base).count() == 10
        row = tables.read_table(spark, f"{base}/place", schemas.PLACE).where("place_id = 'p0'").first()
        assert (row.num_reviews, row.avg_rating) == (6, pytest.approx(28 / 6))


def test_batch_then_stream_and_shrinking_lists(spark, tmp_path):
    base = str(tmp_path / "both")
    tables.store_rows(
        base, review=spark.createDataFrame([("r1", "p", "u", "U", 1.0, "t", "", datetime(2020, 1, 1))], schemas.REVIEW),
        place=spark.createDataFrame([("p", "P", "", "", "", 0.0, 0.0, 1.0, 1)], schemas.PLACE),
    )
    new = [("r2", "p", "u", "U", 3.0, "t", "", datetime(2018, 1, 1), "P", 1)]
    streaming.upsert_epoch(spark.createDataFrame(new, schemas.REVIEW + ", place_name string, seq bigint"), base, 0)
    assert rows_of(streaming.read_reviews(spark, base).select("review_id")) == [("r1",), ("r2",)]
    row = tables.read_table(spark, f"{base}/place", schemas.PLACE).first()
    assert (row.num_reviews, row.avg_rating) == (2, 2.0)
    users = spark.createDataFrame([("u", "U", 0, ["a", "b"]), ("u", "U", 1, ["c"]), ("w", "W", 0, ["d"])], "user_id string, name string, part int, reviews array<string>")
    got = tables.replace_lists(users, users.where("part = 0 and user_id = 'u'").withColumn("reviews", F.array(F.lit("z"))))
    assert rows_of(got.select("user_id", "part", "reviews")) == [("u", 0, ["z"]), ("w", 0, ["d"])]


@pytest.mark.parametrize("block, tile", [(256, 1 << 23), (7, 200)])
def test_cosine_topk_equals_brute_force(spark, monkeypatch, block, tile):
    """More queries than a block and more vectors than a tile; repeated, zero, null and shorter vectors."""
    monkeypatch.setattr(vectors, "QUERY_BLOCK", block)
    monkeypatch.setattr(vectors, "TILE", tile)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(120, 8)).round(3)
    v[100:110] = v[3]
    v[110] = 0
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(500, None), (501, [1.0, None]), (502, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<float>")
    got = {(r.query_id, r.rank): r.vec_id for r in vectors.cosine_topk(df.withColumnRenamed("vec_id", "query_id"), df, 4).collect()}
    v = v.astype(np.float32).astype(float)
    size = np.linalg.norm(v, axis=1)[:, None]
    unit = v / np.where(size > 0, size, 1)
    for i in range(120):
        best = np.lexsort((np.arange(120), -np.round(unit @ unit[i], 6)))[:4]
        assert [got[i, r] for r in (1, 2, 3, 4)] == best.tolist()
    assert len(got) == 480 + 1 and got[502, 1] == 502


def test_many_queries_are_one_plan(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(1500, 4)))], "vec_id bigint, vector array<float>")
    got = vectors.cosine_topk(df.withColumnRenamed("vec_id", "query_id"), df, 2)
    assert got._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    assert got.where("rank = 1 and query_id = vec_id").count() == 1500 and got.count() == 3000


def test_one_key_with_all_rows_is_cut_as_finely_as_asked(spark):
    rng = random.Random(3)
    data = [("hot", s, rng.randint(1, 9)) for s in rng.sample(range(5000), 900)] + [(None, s, 1) for s in range(60)] + [("x", 7, 5)]
    df = spark.createDataFrame(data, "k string, seq bigint, v bigint")
    for parts in (1, 40, 700):
        got = {(r.k, r.seq): (r.n, r.total) for r in skew.running_in_group(df, ["k"], "seq", {"n": F.lit(1), "total": F.col("v")}, parts).collect()}
        for key in ("hot", None, "x"):
            n = total = 0
            for _, s, v in sorted((r for r in data if r[0] == key), key=lambda r: r[1]):
                n, total = n + 1, total + v
                assert got[key, s] == (n, total)
        assert len(got) == len(data)


def test_context_files_and_chunks(spark, tmp_path):
    long = "words " * 60
    html = f"<body><main><p>{long}</p></main></body>"
    raw = [(i, f"https://a.b/{p}", html) for i, p in enumerate(["", "about", "menu", "other"])]
    site = spark.createDataFrame([("https://a.b/",)], "base_url string")
    got = flows.site_contexts(site, spark.createDataFrame(raw, schemas.PAGES), pages_per_part=2)
    assert [(r.part, len(r.pages_scraped)) for r in got.orderBy("part").collect()] == [(0, 2), (1, 1)]
    out = str(tmp_path / "ctx")
    files.write_context_texts(got.withColumn("slug", F.concat(F.lit("a_"), "part")), out)
    files.write_context_texts(got.withColumn("slug", F.concat(F.lit("a_"), "part")), out)  # a second run replaces
    back = files.read_context_texts(spark, out).collect()
    assert len(back) == 3
    assert {(r.base_url, r.page_url) for r in back} == {("https://a.b/", f"https://a.b/{p}") for p in ("", "about", "menu")}
    assert all(r.text == long.strip() for r in back)
    doc = spark.createDataFrame(
        [("d", "p", "article", "Lead text here.\n== History ==\nborn in a b c d\n=== Deep ===\n\n--- Source: http://s/1 ---\nfrom site")],
        "doc_name string, place_id string, source_type string, text string",
    )
    chunks = [(r.section_title, r.source_url, r.text_chunk) for r in context.split_chunks(doc, 4).orderBy("section_no", "chunk_no").collect()]
    assert chunks == [
        ("", "", "Lead text here."), ("History", "", "born in a b"), ("History", "", "c d"), ("", "http://s/1", "from site"),
    ]
    assert pages.candidate_urls(site).count() == 14


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, "good good soup ran"), (2, "")], "id bigint, text string")
    tags = "word string, pos string"
    twice = spark.createDataFrame([("soup", "NN"), ("soup", "VB"), ("good", "JJ")], tags)
    two = features.token_features(spark.createDataFrame([(1, "book soup")], "id bigint, text string"), lexicons.polarity(spark), twice).first()
    assert (two.entropy_score, two.pos_diversity, two.noun_verb_ratio) == (1.0, 2.0, 1.0)
    pos = spark.createDataFrame([("soup", "NN"), ("ran", "VBD")], tags)
    got = {r.id: r for r in features.token_features(df, lexicons.polarity(spark), pos).collect()}
    assert got[1].entropy_score == pytest.approx(1.5) and got[1].sentiment_polarity == pytest.approx(0.7)
    assert (got[1].pos_diversity, got[1].noun_verb_ratio) == (1.0, 1.0)
    assert (got[2].entropy_score, got[2].noun_verb_ratio) == (0.0, 0.0)
    texts = spark.createDataFrame([(1, "p", "hot soup now"), (2, "q", "soup")], "id bigint, place_id string, text string")
    src = spark.createDataFrame([("p", "Soup, hot!")], "place_id string, text string")
    assert {r.id: r.grounding_score for r in features.grounding(texts, src).collect()} == {1: pytest.approx(2 / 3), 2: 0.0}
    found = df.select(features.exclamations(F.lit("a!!")).alias("x"), features.emojis(F.lit("🔥 ☕")).alias("e")).first()
    assert (found.x, found.e) == (2, 2)


def test_distinct_words_are_the_forms_of_all_texts(spark):
    from reviewmill.operators import aspects

    rows = [("p", "A, b 'A' --- b\tÉté"), ("q", "b."), (None, "x"), ("p", None), ("q", "")]
    df = spark.createDataFrame(rows, "place string, text string")
    want = {(r.place, w) for r in df.select("place", aspects.word_forms(F.col("text")).alias("w")).collect() for w in r.w or ()}
    got = [tuple(r) for r in aspects.distinct_words(df, ["place"], "word").collect()]
    assert set(got) == want and len(got) == len(want) == 5
    assert {r.word for r in aspects.distinct_words(df, [], "word").collect()} == {"a", "b", "été", "x"}


def test_grounding_of_texts_without_words_and_of_rare_and_frequent_ones(spark, monkeypatch):
    rows = [(1, "p", "!!! --- *"), (2, "p", "a B, c"), (3, "p", None), (4, None, "a"), (5, "p", ""), (6, "q", "a zz"), (2, "p", "a")]
    texts = spark.createDataFrame(rows, "id long, place_id string, text string")
    sources = spark.createDataFrame([("p", "A b"), ("p", "a ..."), ("q", None), (None, "a")], "place_id string, text string")
    for most in (200_000, 3, 1):  # all words are frequent, then some, then none
        monkeypatch.setattr(features, "BROADCAST_ROWS", most)
        got = {r.id: r.grounding_score for r in features.grounding(texts, sources).collect()}
        assert got == {1: 0.0, 2: 0.75, 3: 0.0, 4: 0.0, 5: 0.0, 6: 0.0}


def test_best_article(spark):
    docs = [(i, "common " + " ".join(f"w{i}_{j}" for j in range(3))) for i in range(20)]
    q = spark.createDataFrame([(1, "common w7_1 w7_2 w3_0"), (2, "common")], "query_id bigint, text string")
    got = context.best_article(q, spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((r.query_id, r.doc_id, r.score > 0) for r in got) == [(1, 7, True), (2, 0, False)]


def test_best_article_equals_the_full_sum(spark):
    """Random queries of rare and common words; most postings of common words are never opened."""
    import math
    from collections import Counter

    rng = random.Random(12)
    pool = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)]
    docs = {i: " ".join(rng.choices(pool, k=30)) for i in range(300)}
    asked = {i: " ".join(rng.choices(pool, k=rng.randint(1, 12))) for i in range(80)} | {900: "unheard", 901: "", 902: None}
    df = Counter(w for t in docs.values() for w in set(t.split()))
    want = {}
    for q, t in asked.items():
        words = [w for w in set((t or "").split()) if w in df]
        scores = {i: round(sum(math.log(300 / df[w]) for w in words if w in set(d.split())), 6) for i, d in docs.items() if set(d.split()) & set(words)}
        if scores:
            want[q] = min(scores.items(), key=lambda x: (-x[1], x[0]))
    q = spark.createDataFrame(list(asked.items()), "query_id bigint, text string")
    d = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r.query_id: (r.doc_id, r.score) for r in context.best_article(q, d).collect()}
    assert got.keys() == want.keys() and all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], abs=2e-6) for i in want)
    words = q.select("query_id", F.explode(F.array_distinct(F.split("text", " "))).alias("token"))
    stats = spark.createDataFrame(list(df.items()), "token string, df bigint")
    opened = {r.needed: r.n for r in context.weighed_words(words, stats, 300).join(stats, "token").groupBy("needed").agg(F.sum("df").alias("n")).collect()}
    assert opened[True] < 0.5 * opened[False]


def test_lexicon_of_any_size_and_deep_taxonomy(spark):
    from reviewmill.operators import aspects, cluster

    df = spark.createDataFrame([("s", 1, "w7 is c++ like, w2999 w7", "big"), ("s", 2, "w7", "none"), ("s", 3, None, "big")], "scope string, id bigint, text string, category string")
    words = [("big", f"w{i}") for i in range(3000)] + [("big", "c++")]
    lexicon = spark.createDataFrame(words, "category string, keyword string")
    large = {r.id: r.score for r in aspects.aspect_score(df, lexicon).collect()}
    small = {r.id: r.score for r in aspects.aspect_score(df, lexicon.where("keyword in ('w7', 'w2999', 'c++')")).collect()}
    assert large[1] == small[1] and large[2] == small[2] == pytest.approx(0.1) and large[1] >= 3.5
    chain = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(40)], "term string, parent string")
    assert cluster.hypernym_closure(chain).count() == 41 * 42 // 2


def test_row_order_follows_file_names(spark, tmp_path):
    from reviewmill.schemas import SCRAPED_REVIEW

    n = len(spark.createDataFrame([], SCRAPED_REVIEW).columns)
    for name, rows in (("a", ["x1", "x2"]), ("b", ["y" + "z" * 3000, "y2"])):
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(["h"] * n)] + [r + "," * (n - 1) for r in rows]) + "\n")
    got = flows.read_scraped_with_order(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r[0][:2] for r in got] == ["x1", "x2", "yz", "y2"]


def review(i, place="p", user="u", rating=3.0):
    return (f"r{i}", place, user, user.upper(), rating, "t", "", datetime(2020, 1, 1), place.upper(), i)


EPOCH = schemas.REVIEW + ", place_name string, seq bigint"


def scraped(*numbers):
    return [(f"P{i % 2}", "1 Road", "Cafe", 4.5, i, None, "http://m", 1.0, 2.0, f"U{i % 3}", 5, f"text {i}", "x", None, datetime(2026, 1, 1), f"r{i}", i) for i in numbers]


def state(spark, base):
    return [rows_of(tables.read_store(spark, base, t)) for t in ("place", "users", "review")]


def test_a_load_that_dies_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    """At every point of a load: what it wrote is not seen, and the next load makes good without losing a row."""
    schema = schemas.SCRAPED_REVIEW + ", seq bigint"
    whole = str(tmp_path / "whole")
    flows.load_scraped(spark.createDataFrame(scraped(0), schema), whole)
    flows.load_scraped(spark.createDataFrame(scraped(1, 2, 3, 4), schema), whole)
    commit = tables._commit
    for point in ("review", "commit"):
        base = str(tmp_path / point)
        flows.load_scraped(spark.createDataFrame(scraped(0), schema), base)
        before = state(spark, base)

        def die(*_):
            raise OSError("lost")

        monkeypatch.setattr(tables, "_commit", die)
        with pytest.raises(OSError):
            flows.load_scraped(spark.createDataFrame(scraped(1, 2, 9), schema), base)
        if point == "review":  # and the last table is there in part only
            import shutil

            shutil.rmtree(f"{base}/review/v=1/bucket={next(iter(tables._numbers(spark, f'{base}/review/v=1', 'bucket=')))}")
            (tmp_path / point / "review" / "v=1" / "_SUCCESS").unlink()
        monkeypatch.setattr(tables, "_commit", commit)
        assert state(spark, base) == before
        flows.load_scraped(spark.createDataFrame(scraped(1, 2, 3, 4), schema), base)
        assert state(spark, base) == state(spark, whole)


def test_an_epoch_adds_to_lists_and_moves_marks_of_stored_keys_only(spark, tmp_path):
    base = str(tmp_path / "db")
    batch = lambda *i: spark.createDataFrame([review(x, user="u0") for x in i], EPOCH)
    for epoch, ids in enumerate([(1, 2), (2, 3, 3), (4,), (1, 4)]):
        streaming.upsert_epoch(batch(*ids), base, epoch)
    listed = tables.snapshot(spark, base).tables["users"]
    assert [v for v in listed if v != -1] == [[0, 1, 2]]
    parts = tables.read_store(spark, base, "users").orderBy("part").collect()
    assert [(r.part, sorted(r.reviews)) for r in parts] == [(0, ["r1", "r2"]), (1, ["r3"]), (2, ["r4"])]
    # no earlier part is in a later load's files
    assert spark.read.parquet(f"{base}/users/v=2").count() == 1
    tables.store_rows(base, users=spark.createDataFrame([("u0", "N", 0, ["r9"])], schemas.USERS))
    assert [r.reviews for r in tables.read_store(spark, base, "users").collect()] == [["r9"]]
    rows, schema = [("a", None, 1, 1.0), ("a", 2, 0, 2.0), (None, 1, 3, 3.0), (None, 1, 2, 4.0), ("b", 2, 5, 5.0)], "k string, n long, seq long, x double"
    kept = str(tmp_path / "rows")
    for epoch in range(2):
        streaming.append_epoch(spark.createDataFrame(rows, schema), kept, epoch, ["k", "n"], "seq")
    got = sorted(r.x for r in tables.read_store(spark, kept, "rows", schema=schema).collect())
    assert got == [1.0, 1.0, 2.0, 4.0, 4.0, 5.0]  # keys with a null part equal no stored key


def test_an_epoch_counts_once(spark, tmp_path, monkeypatch):
    """Run again after its commit, or after it died before; tables of uneven age are no hindrance."""
    base = str(tmp_path / "db")
    batch = lambda *i: spark.createDataFrame([review(x, f"p{x % 2}", f"u{x % 3}") for x in i], EPOCH)
    tables.store_rows(base, place=spark.createDataFrame([("p0", "Old", "", "", "", 0.0, 0.0, 5.0, 1)], schemas.PLACE))
    streaming.upsert_epoch(batch(1, 2, 3), base, 0)
    commit = tables._commit

    def die(*_):
        raise OSError("lost")

    monkeypatch.setattr(tables, "_commit", die)
    with pytest.raises(OSError):
        streaming.upsert_epoch(batch(3, 4, 5, 6), base, 1)
    monkeypatch.setattr(tables, "_commit", commit)
    for _ in range(3):
        streaming.upsert_epoch(batch(3, 4, 5, 6), base, 1)
    assert rows_of(streaming.read_reviews(spark, base).select("review_id")) == [(f"r{i}",) for i in range(1, 7)]
    place = {r.place_id: (r.name, r.num_reviews) for r in tables.read_store(spark, base, "place").collect()}
    assert place == {"p0": ("Old", 4), "p1": ("P1", 3)}
    lists = {r.user_id: sorted(x for y in r.l for x in y) for r in tables.read_store(spark, base, "users").groupBy("user_id").agg(F.collect_list("reviews").alias("l")).collect()}
    assert lists == {"u0": ["r3", "r6"], "u1": ["r1", "r4"], "u2": ["r2", "r5"]}


def test_loads_that_overlap_do_not_both_commit(spark, tmp_path):
    base = str(tmp_path / "db")
    at = tables.store_rows(base, review=spark.createDataFrame([review(1)[:8]], schemas.REVIEW))
    tables.write_load(spark, base, at, {"review": spark.createDataFrame([review(2)[:8]], schemas.REVIEW)})
    with pytest.raises(RuntimeError):
        tables.write_load(spark, base, at, {"review": spark.createDataFrame([review(2)[:8]], schemas.REVIEW)})


def test_a_batch_reads_and_writes_its_buckets_only(spark, tmp_path):
    base = str(tmp_path / "db")
    many = spark.createDataFrame([(f"p{i}", f"P{i}", "", "", "", 0.0, 0.0, 1.0, 1) for i in range(500)], schemas.PLACE)
    tables.store_rows(base, place=many)
    streaming.upsert_epoch(spark.createDataFrame([review(1, "p7")], EPOCH), base, 0)
    at = tables.snapshot(spark, base)
    assert sorted(at.tables["place"])[-2:] == [0, 1] and tables.read_store(spark, base, "place").count() == 500
    read = tables.read_store(spark, base, "review", at, tables.touched(spark.createDataFrame([("r1",)], "review_id string"), "review_id"))
    assert read.count() == 1 and "bucket" in read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_looked_up_keywords_equal_patterns(spark, monkeypatch):
    """Several words, punctuation inside and at the ends, overlapping hits, other scripts, a text that repeats."""
    from reviewmill.operators import aspects

    rng = random.Random(8)
    parts = ["to", "be", "or", "c", "+", "++", "-", " ", " ", "  ", "é", "über", "_x", "9", ".", "\n", "日本"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["to to to to to", "", None, "C++x TO-BE"]
    words = {"".join(rng.choice(parts) for _ in range(rng.randint(1, 5))).strip("\n ") for _ in range(200)} | {"to to", "to-be", "c++", "+to"}
    rows = [("s", i, t, ["a", "b", "none"][i % 3]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "scope string, id bigint, text string, category string")
    lexicon = spark.createDataFrame([(c, w) for c in "ab" for w in sorted(words - {""})], "category string, keyword string")
    found = {}
    for limit in (10_000, 1):
        monkeypatch.setattr(aspects, "LITERALS", limit)
        found[limit] = {r.id: (r.known, sorted(map(tuple, r.hits))) for r in aspects.keyword_hits(df, lexicon).collect()}
    assert found[1] == found[10_000] and sum(len(h) for _, h in found[1].values()) > 100


def test_texts_of_many_slugs_take_few_folders(spark, tmp_path):
    """Slugs with any character; a second run replaces its own; plain files in and out."""
    path = str(tmp_path / "texts")
    many = spark.range(3000).select(F.concat(F.lit("Place / "), F.col("id").cast("string")).alias("query"), F.concat(F.lit("line\n"), "id", F.lit("\n")).alias("text"))
    files.write_articles(many, path)
    files.write_articles(many.limit(5).withColumn("text", F.lit("new")), path)
    got = files.read_texts(spark, path)
    assert got.count() == 3000 and got.where("text = 'new'").count() == 5 and got.where("text like 'line%\n'").count() == 2995
    assert len(list((tmp_path / "texts").rglob("bucket=*"))) <= 2 * tables.BUCKETS
    out = tmp_path / "files"
    files.export_files(got.where("text = 'new'"), str(out))
    assert len(list(out.glob("slug=*"))) == 5
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "tea_hut.txt").write_text("BASE_URL: http://t\nPAGES_SCRAPED: a\n\n" + files.RULE + "\n--- Source: http://t/a ---\nText\n" + files.RULE + "\n")
    (tmp_path / "raw" / "zoo.txt").write_text("Lead.\n== History ==\nOld.")
    rows = {r.slug: (r.base_url, r.page_url, r.text) for r in files.site_pages(files.read_text_files(spark, str(tmp_path / "raw"))).collect()}
    assert rows == {"tea_hut": ("http://t", "http://t/a", "Text"), "zoo": (None, None, "Lead.\n== History ==\nOld.")}


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path):
    """Blocks of a few hundred bytes: records with quoted line ends, quotes and commas over several of them."""
    import csv as lib

    rng = random.Random(9)
    rows = []
    for i in range(300):
        text = "".join(rng.choice(['a "word" ', "line\nend ", "x,y ", "\r\n", "é", "\n\n"]) for _ in range(rng.randint(0, 120)))
        rows.append([f"B{i}", f"U{i % 5}", f"t{text}.", "p", str(i), "taste"])
    with open(tmp_path / "big.csv", "w", newline="", encoding="utf-8-sig") as f:
        out = lib.writer(f)
        out.writerow(["business_name", "author_name", "text", "photo", "rating", "rating_category"])
        out.writerows(rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        assert spark.read.text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 100
        got = csv.read_alt_reviews(spark, str(tmp_path / "big.csv")).collect()
        order = [r.record[:3].strip('",B') for r in csv.read_records(spark, str(tmp_path / "big.csv")).orderBy("row").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.business_name, r.author_name, r.text, r.rating) for r in got) == sorted((r[0], r[1], r[2], float(r[4])) for r in rows)
    assert order[0].startswith("bus") and len(order) == 301 and order[1:4] == ["0", "1", "2"]


def test_tasks_of_token_counts_follow_the_texts(spark):
    """Tokens are counted in memory, so twice the texts are twice the tasks."""
    words = spark.createDataFrame([("a", 1.0, "NN")], "word string, score double, pos string")
    for splits in (10, 20):
        texts = spark.range(0, 40, 1, splits).select("id", F.lit("a b").alias("text"))
        out = features.token_features(texts, words.select("word", "score"), words.select("word", "pos"))
        assert f"hashpartitioning(id, {splits * 16})" in re.sub(r"#\d+L?", "", out._jdf.queryExecution().executedPlan().toString())
        assert out.where("sentiment_polarity = 1").count() == 40


def test_grounding_shuffles_numbers_and_not_words(spark, monkeypatch):
    """Rare words are looked up by a number each, whatever the id; words that share one get others."""
    plans, write = [], features.cut
    monkeypatch.setattr(features, "cut", lambda df, label="step": plans.append((label, df._jdf.queryExecution().optimizedPlan().toString())) or write(df, label))
    monkeypatch.setattr(features, "BROADCAST_ROWS", 1)
    texts = spark.createDataFrame([(f"key-{i}", "p", f"word{i} all other{i % 5}") for i in range(40)], "id string, place_id string, text string")
    sources = spark.createDataFrame([("p", "word1, word2 all other3"), ("q", "word4")], "place_id string, text string")
    number, salts = features._numbered, []
    monkeypatch.setattr(features, "_numbered", lambda words: salts.append(words.count()) or number(words))
    got = {r.id: r.grounding_score for r in features.grounding(texts, sources).collect()}
    assert got == {f"key-{i}": pytest.approx((1 + (i in (1, 2)) + (i % 5 == 3)) / 3) for i in range(40)} and salts == [46]
    assert [label for label, _ in plans].count("hits") == 2
    assert all("id#" not in plan.split("Aggregate")[0] and "token#" not in plan.split("Join")[0] for label, plan in plans if label == "hits")
