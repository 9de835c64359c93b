"""A corpus pipeline of five stages: ``run`` applies them to the table documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import bpe, mixing, queries, secret_scan, simhash, subword
from reviewmill.plans.storage import cut


def _new(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score 0.3 or more).

    Null and empty texts are scored like any other and go if the score is low;
    equal rows fare alike, null ids do not matter.
    """
    model = subword.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _new(docs, "_score")
    return subword.score(docs, "text", model, score).where(F.col(score) >= 0.3).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest id, null ids last.

    A row is named by its id and a hash of its text, so repeated ids with
    different texts are different rows; rows repeated whole leave one.  Null and
    empty texts have one fingerprint and leave one row.
    """
    key = _new(docs, "_key")
    keyed = docs.withColumn(key, F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")
    ))
    found = simhash.near_duplicates(keyed, key)
    kept = cut(found.where(F.col("id") == F.col("component")).groupBy("id").agg(F.count(F.lit(1)).alias("n")), "kept")
    wanted = kept.select(F.col("id.id").alias("_kept_id"), F.col("id.hash").alias("_kept_hash"))
    same = keyed["doc_id"].eqNullSafe(wanted["_kept_id"]) & (keyed[f"{key}.hash"] == wanted["_kept_hash"])
    out = keyed.join(wanted, same, "left_semi")
    if kept.where("n > 1").limit(1).count():
        out = out.dropDuplicates([key])
    return out.select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced in the text by [SECRET]; no row goes.

    Null and empty texts stay as they are, repeated rows are treated alike.
    """
    table = queries.secret_table(docs)
    base, spans = _new(docs, "_base"), _new(docs, "_spans")
    found = secret_scan.scan(docs, "text", table, base=base, spans=spans)
    clean = secret_scan.redact(F.col("text"), F.col(spans))
    return found.withColumn("text", clean).withColumn(
        "n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: not at all, once or twice.

    Null and empty texts have no words, so they neither fill nor exceed a
    target; null sources are one source, and rows of equal id, source and text
    are taken alike.
    """
    mixed = mixing.mix(docs).where("times > 0")
    taken = mixed.select(*[F.col(c).alias(f"_taken_{c}") for c in ("id", "source", "hash", "times")]).distinct()
    mark, copy, times = _new(docs, "_hash"), _new(docs, "_copy"), _new(docs, "_times")
    rows = docs.withColumn(mark, mixing.row_hash("doc_id", "text"))
    same = rows["doc_id"].eqNullSafe(taken["_taken_id"]) & rows["source"].eqNullSafe(taken["_taken_source"])
    met = rows.join(taken, same & (rows[mark] == taken["_taken_hash"]))
    kept = met.select(*[rows[c] for c in docs.columns], taken["_taken_times"].alias(times))
    return kept.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as token ids: doc_id, source, n_tokens, ids (little-endian unsigned 32-bit integers).

    Null and empty texts have no tokens; every row of the input is a row.
    """
    import public_tokenizers as vocab

    coded = bpe.encode(docs.select("doc_id", "source", "text"), "text", vocab.path(queries.VOCABULARY), vocab.PATTERN)
    return coded.select("doc_id", "source", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality), ("SimHash near-dedup", near_duplicates), ("secret scans", secrets),
    ("mixing sources to target weights", mixture), ("byte-level BPE encoding and decoding", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "stage")
    return docs
