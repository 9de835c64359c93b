"""Queries 11 to 13 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import collisions, gram_index, ns_kmeans
from reviewmill.llm.common import read


def op11_near_vectors_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Links, components and representatives of the embeddings; unusable vectors stand alone, an empty table gives none."""
    return collisions.near_vectors(read(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_spelling_gram_index(spark: SparkSession, sf: str) -> DataFrame:
    """Spelling forms of all words of the documents; null and empty texts have none, repeated rows count each."""
    words = gram_index.occurrences(read(spark, sf, "documents"), "doc_id", "text")
    return gram_index.variants(gram_index.counted(words))


def op13_centroid_ns_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """40 clusters of the embeddings as integers, 5 rounds; equal vectors are equal rows, an empty table gives none."""
    found, centroids = ns_kmeans.cluster(ns_kmeans.points(read(spark, sf, "embeddings"), "vec_id", "embedding"))
    return ns_kmeans.described(found, centroids).select(
        F.col("id").alias("vec_id"), F.col("near").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _op13_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds written out one after the other."""
    parts = [f"""
        p as materialized (
            select vec_id, list_transform(embedding::double[], lambda v: floor(256 * v)::bigint) as x from embeddings
            where len(embedding) = 64 and len(list_filter(embedding::double[], lambda v: v is null or not isfinite(v))) = 0
        ), e as materialized (select vec_id, unnest(range(64)) as i, unnest(x) as x from p),
        c0 as materialized (
            select row_number() over (order by sha256('2:' || vec_id::varchar)) - 1 as c, x as y from p
            qualify row_number() over (order by sha256('2:' || vec_id::varchar)) <= {k}
        )"""]
    for r in range(rounds + 1):
        parts.append(f"""
        f{r} as materialized (select c, unnest(range(64)) as i, unnest(y) as y from c{r}),
        d{r} as materialized (
            select vec_id, c, sum((x - y) * (x - y))::bigint as d from e join f{r} using (i) group by vec_id, c
        ),
        a{r} as materialized (
            select vec_id, c, d from d{r} qualify row_number() over (partition by vec_id order by d, c) = 1
        )""")
        if r < rounds:
            parts.append(f"""
        m{r} as materialized (
            select c, i, sum(x)::bigint as s, count(*)::bigint as n
            from e join a{r} using (vec_id) group by c, i
        ),
        c{r + 1} as materialized (
            select o.c, coalesce(n.y, o.y) as y from c{r} o left join (
                select c, list(case when s >= 0 then s // n else -((-s + n - 1) // n) end order by i) as y from m{r} group by c
            ) n using (c)
        )""")
    return "with " + ",".join(parts) + f"""
    select vec_id, c::int as cluster, d as distance, sum(d) over (partition by c)::bigint as cluster_inertia,
        sum(d) over ()::bigint as inertia, sha256(array_to_string(y, ',')) as centroid_sha256
    from a{rounds} join c{rounds} using (c)"""


_OP11_SQL = """
with recursive v as (
    select vec_id, label, embedding::double[] as x from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding::double[], lambda e: e is null or not isfinite(e))) = 0
        and len(list_filter(embedding::double[], lambda e: e <> 0)) > 0
), w as (select vec_id, label, list_transform(x, lambda e: e / sqrt(list_inner_product(x, x))) as x from v),
near as (
    select a.vec_id as a, b.vec_id as b from w a join w b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x)
    where list_inner_product(a.x, b.x) >= 0.98
), walk as (
    select vec_id as node, vec_id as seen from embeddings
    union select walk.node, near.b from walk join near on walk.seen = near.a
), part as (select node, min(seen) as component_id from walk group by node)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings left join (select a, count(*) as n from near group by a) on a = vec_id join part on node = vec_id"""

_LETTERS = "A-Za-z\u00C0-\u00FF"

# crc32 by its table of 256 entries, over the UTF-8 bytes of code points up to 255
_OP12_SQL = f"""
with recursive crc as (
    select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), runs as (
    select doc_id, run, count(*) as times from (
        select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[{_LETTERS}]+')) as run from documents
    ) where length(run) >= 5 group by doc_id, run
), hashed as (
    select run, times, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
        string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
        lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [192 + unicode(c)::bigint // 64, 128 + unicode(c)::bigint % 64] end))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
    from runs, crc
), voc as (
    select word, sum(times)::bigint as n from (
        select case when h % 97 = 0 then run[: h % length(run)] || run[h % length(run) + 2 :] else run end as word, times from hashed
    ) where length(word) >= 5 group by word having sum(times) >= 3
), del as (
    select word, n, i, word[: i - 1] || word[i + 1 :] as d from (select word, n, unnest(range(1, length(word) + 1)) as i from voc)
), near as (
    select a.word, a.n, b.word as other, b.n as other_n from del a join del b on a.i = b.i and a.d = b.d and a.word <> b.word
    union select a.word, a.n, b.word, b.n from del a join voc b on a.d = b.word
    union select b.word, b.n, a.word, a.n from del a join voc b on a.d = b.word
), best as (
    select word, count(*) as n_near, first(other order by other_n desc, other) as other, max(other_n) as other_n from near group by word
), forms as (
    select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 2 * v.n then other end as form,
        case when other_n >= 2 * v.n then other_n end as form_n
    from voc v left join best using (word)
), chain as (
    select word, word as here, 0 as step from forms
    union all select c.word, f.form, step + 1 from chain c join forms f on c.here = f.word where f.form is not null
)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f
join (select word, arg_max(here, step) as root from chain group by word) c using (word)"""

QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op") and name[2].isdigit()}
SQL = {"op11_near_vectors_collisions": _OP11_SQL, "op12_spelling_gram_index": _OP12_SQL, "op13_centroid_ns_bounds": _op13_sql()}
