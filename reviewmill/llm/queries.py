"""One query per numbered operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import bpe, hnsw, mixing, outliers, queries_groups, secret_scan, sharding, simhash, subword, suffixes, toxicity
from reviewmill.llm.common import read
from reviewmill.plans.storage import cut

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_shard_label_propagation(spark: SparkSession, sf: str) -> DataFrame:
    """Shards 0 to 7 under the law ``rows``.

    Null and empty texts have size 1 and count as equal texts; null ids and repeated rows are rows of their own; an
    empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    rows = cut(read(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("text_key"),
    ), "documents")
    placed = sharding.shard_rows(rows, "doc_id", sharding.text_links(rows, "doc_id", "text_key"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every whole text and back.

    A null text is an empty one, without tokens; every row is a row, an empty table gives none.
    """
    import public_tokenizers as vocab

    docs = read(spark, sf, "documents").select("doc_id", F.col("text").alias("decoded"))
    # nothing else runs in these workers, so there is memory for larger tables
    return bpe.round_trip(docs, "decoded", vocab.path(VOCABULARY), vocab.PATTERN, memo=2.5).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_simhash_pivots(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints and components.

    Null and empty texts have fingerprint zero and link like any other; every row is a row, and a null id names a
    component only where it has no other id.
    """
    found = simhash.near_duplicates(read(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_toxicity_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    """Expected severity and grade of every text.

    Null and empty texts have no feature and get the severity of the cuts; equal texts are graded alike, an empty
    table gives no rows.
    """
    docs = read(spark, sf, "documents")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return toxicity.grade(docs.select("doc_id", "text"), "text", model).select("doc_id", "severity", "grade", "toxic")


def op5_quality_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and robust outliers.

    Null and empty texts have no words and fail the base rules; null languages and sources are groups of their own,
    small groups are judged with their language, or all; equal rows fare alike.
    """
    return outliers.rules(read(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.col("d2").alias("distance"),
    )


def op6_substring_suffix_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Words left after removing repeated windows.

    Null and empty texts have none; a null id is the smallest; equal ids with other texts are other documents, rows
    repeated whole the same one.
    """
    return suffixes.remove_repeats(read(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_quality_subword(spark: SparkSession, sf: str) -> DataFrame:
    """Quality scores.

    Null and empty texts are scored too, without features; equal texts score alike, null labels and ids are not
    learnt from, and a null id has no held_out.
    """
    docs = read(spark, sf, "documents")
    model = subword.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return subword.score(docs.select("doc_id", "text"), "text", model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_nearest_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest found neighbours of every hundredth vector.

    Unusable vectors and null ids take no part; rows of one id and vector are one, equal vectors are neighbours at
    distance zero; vectors of other lengths never meet.
    """
    vectors = hnsw.usable(read(spark, sf, "embeddings"), "vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.where("id % 100 = 0")).withColumnRenamed("id", "vec_id")


def op9_mix_hash_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Words taken per row.

    Null texts have size 0, null sources are a source of their own, sorted last; equal rows are taken alike; an
    empty table gives none.
    """
    return mixing.mix(read(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def secret_table(docs: DataFrame) -> list[float]:
    return secret_scan.train(secret_scan.labelled(docs, "doc_id", "text", 2000))


def op10_secrets_markov(spark: SparkSession, sf: str) -> DataFrame:
    """Secret spans of every text.

    Null texts are empty and have none; every row is a row, equal texts alike.
    """
    docs = read(spark, sf, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, "text", secret_table(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("op") and name[2].isdigit()} | queries_groups.QUERIES
SQL: dict[str, str] = dict(queries_groups.SQL)

_WORDS = r"[^\x20\x09-\x0D]+"

SQL["op9_mix_hash_thresholds"] = f"""
with recursive docs as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::bigint as size,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as h
    from documents
), src as (
    select source, sum(size)::bigint as source_size,
        ([3.0, 1.0, 2.0])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
    from docs group by source
), total as (select 1.5 * sum(source_size) as budget from src),
-- the level rises while sources are full: source s is full up to level 2 * size / w
fill as (
    select source, source_size, w, budget,
        coalesce(sum(2.0 * source_size) over (order by 2.0 * source_size / w, source rows between unbounded preceding and 1 preceding), 0) as held,
        sum(w) over (order by 2.0 * source_size / w, source rows between current row and unbounded following) as open
    from src, total
), level as (
    select arg_min((budget - held) / open, 2.0 * source_size / w) filter ((budget - held) / open <= 2.0 * source_size / w) as level
    from fill
),
goal as (
    select source, source_size, least(2.0 * source_size, level * w)::double as target from src, level
), parts as (
    select source, source_size, target, case when source_size > 0 then floor(target / source_size) else 0 end as whole from goal
), run as (
    select d.doc_id, d.size, d.h, p.*, target - whole * source_size as rest,
        sum(size) over (partition by d.source order by h) as upto,
        sum(size) over (partition by d.source, h) as here
    from docs d join parts p on d.source is not distinct from p.source
)
select doc_id, size, source_size, round(target, 6) as target,
    (size * (whole + case when upto <= rest and here > 0 then 1
        when upto - here > rest then 0
        when abs(upto - rest) < abs(upto - here - rest) then 1 else 0 end))::bigint as taken
from run
"""
