"""Queries 11 to 13 against their definitions, on given tables and on odd ones."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.llm import collisions, gram_index, ns_kmeans, queries

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def op(n):
    return queries.QUERIES[next(q for q in queries.QUERIES if q.startswith(f"op{n}_"))]


def table(spark, base, name, rows):
    """``rows`` as table ``name`` with extra columns whose names the operators use inside."""
    rows.select("*", *[F.lit(1).alias(c) for c in ("id", "key", "x", "near", "n", "v", "word", "size", "strip", "part")]).write.parquet(f"{base}/{name}.parquet")
    return base


def copies(seed=5):
    """Rows of jittered copies, exact copies and scaled copies around a few centres, and every odd vector."""
    rng = np.random.default_rng(seed)
    out, at = [], 0
    for size, label, noise in ((60, 1, 0.002), (30, 1, 0.015), (25, 2, 0.02), (1, 2, 0), (40, None, 0.001)):
        centre = rng.standard_normal(64)
        centre /= np.linalg.norm(centre)
        for k in range(size):
            v = centre + noise * rng.standard_normal(64)
            out.append((at, (v * (3.5 if k % 3 == 0 else 1)).astype(np.float32).tolist(), label))
            at += 1
    same = out[0][1]
    out += [(at + k, same, 1) for k in range(20)] + [(7, same, 1), (None, same, 1), (None, out[100][1], 2), (3, out[70][1], 1)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 64, [nan] * 64, [inf, *same[1:]], [None, *same[1:]], same[:63], same[:63], [3e38] * 64, [3e38] * 64, [-0.0, 1.0], [0.0, 1.0]]
    return out + [(1000 + k, v, 1) for k, v in enumerate(odd)]


def usable(v, label):
    return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def linked(rows, cosine=0.98):
    """Per row (n_links, component_id) by comparing all pairs."""
    ok = [k for k, (_, v, label) in enumerate(rows) if usable(v, label)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float)) for k in ok}
    near = {k: [j for j in ok if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= cosine] for k in ok}
    out = []
    for k, row in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((row[0], len(near.get(k, [])), min(ids) if ids else None))
    return collections.Counter(out)


@pytest.mark.parametrize("most", [collisions.MOST, 8])
def test_links_equal_all_pairs(spark, tmp_path, monkeypatch, most):
    """Also where strips are cut into many parts."""
    monkeypatch.setattr(collisions, "MOST", most)
    monkeypatch.setattr(collisions, "PAIRS", 500)
    rows = copies()
    got = op(11)(spark, table(spark, str(tmp_path), "embeddings", spark.createDataFrame(rows, VECTORS))).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in got) == linked(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_with_cells(spark):
    """The plan of large labels, on small ones; counts need no luck at this size."""
    rows = copies(9)
    plan = collisions.calibrate(50_000, 0.98)
    assert plan.parting > 3 and plan.least > 1
    got = collisions.near_vectors(spark.createDataFrame(rows, VECTORS), plan=plan).collect()
    assert collections.Counter((r.id, r.n_links, r.component_id) for r in got) == linked(rows)


def test_given_vectors(spark):
    rows = duckdb.sql(f"select vec_id, embedding, label from '{SF}/embeddings.parquet'").fetchall()
    got = op(11)(spark, SF).collect()
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in got) == linked(rows)


def test_calibration_reaches_its_recall():
    """Simulated pairs at the threshold pass, unrelated ones do not."""
    rng = np.random.default_rng(3)
    plan = collisions.calibrate(5_000, 0.98)
    a = collisions.unit(rng.standard_normal((4000, 32)))
    away = rng.standard_normal((4000, 32))
    away = collisions.unit(away - (away * a).sum(1, keepdims=True) * a)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * away
    sign = lambda x: collisions.signatures(list(x), ["a"] * len(x), plan)
    (ca, pa), (cb, pb), (co, po) = sign(a), sign(b), sign(away)
    reach = collisions.WINDOW * collisions.GRAIN
    count = lambda c, p: ((ca == c) & (abs(pa - p) <= reach)).sum(1)
    assert (count(cb, pb) >= plan.least).all() and (count(co, po) >= plan.least).mean() < 0.001


def words_of(rows):
    count = collections.Counter()
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(count):
    """Per word (form, root, n, n_near, form_n) by comparing all words."""
    form, near = {}, {}
    for w, n in count.items():
        near[w] = [x for x in count if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= 2 * n else None
    out = set()
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), form[w] and count[form[w]]))
    return out


def spelled(rows):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_of_given_documents(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = op(12)(spark, SF).collect()
    assert len(got) == len(spelled(got)) and spelled(got) == variants(words_of(rows))


def test_spelling_of_odd_documents(spark, tmp_path, monkeypatch):
    """Lists dealt to many keys, no gram or nearly every gram frequent, very long words and texts, ties and chains."""
    chain = " ".join(" ".join([w] * n) for w, n in (("abcdefgh", 64), ("abcdefg", 32), ("abcdef", 16), ("abcde", 3), ("bcdefg", 16), ("abcdXfg", 8)))
    family = " ".join(f"worda{a}{b} worda{a}{b} worda{a}{b} WORDA{a.upper()}{b}" for a in "abcdefghijé÷" for b in "abcdeöß")
    texts = [None, "", " \n", chain, family, "x" * 30_000 + " ", ("x" * 30_000 + " ") * 3, "y" * 29_999 + "z ", "éàüöß éàüöß éàüöß éàüö éàüöÀ éàüöÀ éàüöÀ", "Straße STRAße straße straSe straSe straSe"]
    rows = [(i % 7 if i % 3 else None, t) for i, t in enumerate(texts + [chain])]
    base = table(spark, str(tmp_path), "documents", spark.createDataFrame(rows, "doc_id long, text string"))
    want = variants(words_of(rows))
    assert len(want) > 60
    assert spelled(op(12)(spark, base).collect()) == want
    monkeypatch.setattr(gram_index, "LEAST_FREQUENT", 1)
    monkeypatch.setattr(gram_index, "LIST", 5)
    vocab = spark.createDataFrame(list(words_of(rows).items()), "word string, n long")
    pairs = gram_index.near_pairs(vocab, 5).collect()
    assert len(pairs) == len({(r.a, r.b) for r in pairs}) == sum(r[4] for r in want) / 2


_word = st.text("abécd", min_size=2, max_size=12)


@given(_word, st.integers(0, 12), st.sampled_from("abécd"), st.sampled_from("idr"), st.sets(st.text("abécd\x02\x03", min_size=2, max_size=4)))
def test_words_at_one_edit_share_the_bound(word, at, char, kind, often):
    at = min(at, len(word) - (kind != "i"))
    other = word[:at] + ("" if kind == "d" else char) + word[at + (kind != "i") :]
    a, b = (gram_index.decompose(w, dict.fromkeys(often, 9)) for w in (word, other))
    shared = sum((collections.Counter(g for _, g in a) & collections.Counter(g for _, g in b)).values())
    assert shared >= max(len(a) - gram_index.affected(a), len(b) - gram_index.affected(b))


def clustered(rows, k=40, rounds=5):
    """{(vec_id, cluster, distance)} and (centroids), each round over all pairs in whole numbers."""
    reach = 1 << 27
    kept = [
        (i, [int(max(-reach, min(reach, np.floor(256.0 * x)))) for x in v])
        for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = np.array([x for _, x in first], object).reshape(len(first), 64)
    x = np.array([x for _, x in kept], object).reshape(len(kept), 64)
    for r in range(rounds + 1):
        d = ((x[:, None].astype(np.int64) - centroids[None].astype(np.int64)) ** 2).sum(2)
        near = d.argmin(1)
        for c in range(len(centroids)) if r < rounds else ():
            if (near == c).any():
                centroids[c] = x[near == c].sum(0) // int((near == c).sum())
    return collections.Counter((i, int(c), int(q)) for (i, _), c, q in zip(kept, near, d.min(1), strict=True)), centroids


@pytest.mark.parametrize("which", ["given", "odd"])
def test_clusters_equal_full_scans(spark, tmp_path, which):
    rows, base = duckdb.sql(f"select vec_id, embedding, label from '{SF}/embeddings.parquet'").fetchall(), SF
    if which == "odd":
        rows = copies()
        base = table(spark, str(tmp_path), "embeddings", spark.createDataFrame(rows, VECTORS))
    want, centroids = clustered(rows)
    got = op(13)(spark, base).collect()
    assert collections.Counter((r.vec_id, r.cluster, r.distance) for r in got) == want
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = collections.Counter()
    for (_, c, q), n in want.items():
        per[c] += q * n
    assert all((r.centroid_sha256, r.cluster_inertia, r.inertia) == (marks[r.cluster], per[r.cluster], sum(per.values())) for r in got)


def test_bounds_spare_scans(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found, centroids = ns_kmeans.cluster(ns_kmeans.points(rows, "vec_id", "embedding"))
    n, scans = found.agg(F.count(F.lit(1)), F.sum("scans")).first()
    assert scans < 0.9 * n * 6 * len(centroids)


def test_assignment_under_loosened_bounds_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-200, 200, (300, 8))
    history = rng.integers(-200, 200, (1, 12, 8))
    near, d2, low, seen, _ = ns_kmeans.assign(x, history, None, None, None)
    for step in range(6):
        history = np.concatenate([history, history[-1:] + rng.integers(-40 >> step, (40 >> step) + 1, (1, 12, 8))])
        near, d2, low, seen, scans = ns_kmeans.assign(x, history, near, low, seen)
        full = ((x[:, None] - history[-1][None]) ** 2).sum(2)
        assert (near == full.argmin(1)).all() and (d2 == full.min(1)).all()
    assert scans.mean() < 12


def test_fewer_rows_than_centroids(spark, tmp_path):
    rows = [(i, [float(i)] * 64, 0) for i in range(3)]
    got = op(13)(spark, table(spark, str(tmp_path), "embeddings", spark.createDataFrame(rows, VECTORS))).collect()
    assert sorted((r.vec_id, r.distance, r.inertia) for r in got) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]


@pytest.mark.parametrize("n", [11, 12, 13])
def test_empty_table(spark, tmp_path, n):
    for t in ("documents", "embeddings"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert op(n)(spark, str(tmp_path)).count() == 0
