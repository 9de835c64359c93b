"""Language of a text from character n-gram profiles learned from labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.plans.skew import broadcast_if_small, text_tasks
from reviewmill.plans.storage import cut


def char_ngrams(c: Column, n: int = 3) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))


def gram_counts(df: DataFrame, *keys: str, n: int = 3) -> DataFrame:
    flat = df.select(*keys, F.explode_outer(char_ngrams(F.col("text"), n)).alias("gram"))
    return flat.where(F.col("gram").isNotNull()).groupBy(*keys, "gram").agg(
        F.count(F.lit(1)).alias("n")
    )


def language_model(labelled: DataFrame, n: int = 3) -> DataFrame:
    """(lang, gram, weight): the n-grams of every language.

    The weight is the gram's share of the language's n-grams.  The counts leave
    the map side already summed.
    """
    counts = gram_counts(labelled.select("lang", "text"), "lang", n=n)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("_all"))
    return counts.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("_all")).alias("weight"))


def detect_language(df: DataFrame, model: DataFrame) -> DataFrame:
    """(id, language): the language whose profile covers the text best.

    A text's score for a language is the summed weight of its n-grams.  Texts are
    placed by id once and their n-grams counted there; a small model is broadcast,
    so the n-grams are never shuffled.  With a larger one the counts are.  A text
    without any known n-gram gets ``""``.
    """
    placed = df.select("id", "text").repartition(text_tasks(df), "id")
    grams = gram_counts(placed, "id").withColumnRenamed("n", "_times")
    # written, as its size is asked before it is used
    profiles = broadcast_if_small(cut(model, "model"))
    scored = (
        grams.join(profiles, "gram")
        .groupBy("id", "lang")
        .agg(F.round(F.sum(F.col("weight") * F.col("_times")), 9).alias("s"))
    )
    best = scored.groupBy("id").agg(F.max_by("lang", F.struct("s", "lang")).alias("language"))
    return df.select("id").join(best, "id", "left").select(
        "id", F.coalesce("language", F.lit("")).alias("language")
    )
