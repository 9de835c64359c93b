"""Quality rules: word statistics per text and robust multivariate outliers per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.llm.common import BLANKS, hot_join, let
from reviewmill.plans.storage import cut

MIN_GROUP = 200  # texts a group needs for its own estimate
GRID = 16  # steps per doubling of the squared distance
HALF = 0.75  # share of a group that the estimate rests on
CHI2_MEDIAN = {4: 3.3567, 5: 4.3515}  # medians of the chi-squared distribution by dimension


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Hashes of the windows are sorted with the window's place in their low bits,
    so equal windows become neighbours; the full hashes are compared then.
    """
    n = F.size(w)
    hashes = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(n + 1)).cast("int")) - 1

    def covered(h: Column, mask: Column) -> Column:
        packed = F.sort_array(F.transform(
            h, lambda x, i: x.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))
        ))

        def doubled(s: Column) -> Column:
            def same(x: Column, other: Column) -> Column:
                return F.coalesce(
                    (x.bitwiseOR(mask) == other.bitwiseOR(mask))
                    & (F.get(h, x.bitwiseAND(mask).cast("int")) == F.get(h, other.bitwiseAND(mask).cast("int"))),
                    F.lit(False),
                )

            twice = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
            places = F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(mask)))
            return let(places, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(3).cast("long"), F.coalesce(F.get(p, j + 1) - x, F.lit(3).cast("long")))),
                F.lit(0).cast("long"), lambda s, x: s + x,
            ))

        return let(packed, doubled)

    return F.when(n >= 3, let(hashes, lambda h: let(low, lambda mask: covered(h, mask)))).otherwise(F.lit(0).cast("long"))


def text_stats(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; null has no words."""
    t = F.coalesce(text, F.lit(""))
    core = F.btrim(t, F.lit(BLANKS))
    words = F.when(F.length(core) == 0, F.array().cast("array<string>")).otherwise(F.split(core, "[ \t-\r]+"))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^ \t-\r]"))
    of_words = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
    ))
    return let(of_words, lambda s: F.struct(
        s["n_words"].alias("n_words"), s["word_chars"].alias("word_chars"),
        F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        s["n_repeat_words"].alias("n_repeat_words"),
    ))


def vector() -> Column:
    """The statistics as five near-normal numbers: length, word length, symbols, repeated lines, repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return F.array(
        F.log(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n),
    )


# Variances are never taken below these: a group whose texts all agree in a statistic must not turn
# its first honest exception into an outlier.
FLOOR = (0.25, 0.01, 0.003, 0.003, 0.01)


def _moments(rows: DataFrame, chosen: Column, p: int) -> DataFrame:
    """(group, mean, inverse): mean and inverse covariance of the chosen rows of each group."""
    x = [F.when(chosen, F.get("x", F.lit(i))) for i in range(p)]
    sums = [F.avg(x[i]).alias(f"m{i}") for i in range(p)]
    sums += [F.covar_pop(x[i], x[j]).alias(f"c{i}{j}") for i in range(p) for j in range(i, p)]
    got = rows.groupBy("group").agg(F.count(F.lit(1)).alias("_n"), *sums)
    cell = lambda i, j: F.coalesce(F.col(f"c{min(i, j)}{max(i, j)}"), F.lit(0.0)) + (FLOOR[i] if i == j else 0.0)
    matrix = F.array(*[cell(i, j) for i in range(p) for j in range(p)])

    def sweep(m: Column, k: int) -> Column:
        def entry(at: Column) -> Column:
            i, j, d = F.floor(at / p).cast("int"), F.pmod(at, F.lit(p)), F.get(m, F.lit(k * p + k))
            ik, kj = F.get(m, i * p + k), F.get(m, k * p + j)
            return (
                F.when((i == k) & (j == k), -1 / d).when(i == k, kj / d).when(j == k, ik / d)
                .otherwise(F.get(m, at) - ik * kj / d)
            )

        swept = F.transform(F.sequence(F.lit(0), F.lit(p * p - 1)), entry)
        return let(swept, lambda s: sweep(s, k + 1)) if k < p - 1 else F.transform(swept, lambda v: -v)

    mean = F.array(*[F.coalesce(F.col(f"m{i}"), F.lit(0.0)) for i in range(p)])
    return got.select("group", "_n", mean.alias("mean"), let(matrix, lambda m: sweep(m, 0)).alias("inverse"))


def _distance(p: int) -> Column:
    d = [F.get("x", F.lit(i)) - F.get("mean", F.lit(i)) for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            total = total + d[i] * d[j] * F.get("inverse", F.lit(i * p + j)) * (1 if i == j else 2)
    return total


def _quantile(rows: DataFrame, share: float, name: str) -> DataFrame:
    """Per group the least grid step that at least ``share`` of its rows are on or under."""
    steps = rows.groupBy("group", "_step").agg(F.count(F.lit(1)).alias("_c"))
    w = W.partitionBy("group")
    upto = F.sum("_c").over(w.orderBy("_step"))
    return (
        steps.withColumn("_upto", upto).withColumn("_all", F.sum("_c").over(w))
        .where(F.col("_upto") >= share * F.col("_all")).groupBy("group").agg(F.min("_step").alias(name))
    )


def distances(rows: DataFrame, p: int, steps: int = 4) -> DataFrame:
    """``rows`` (group, x, ...) with ``d2``: squared Mahalanobis distance to the group's robust centre.

    Minimum covariance determinant by concentration: from mean and covariance
    of the whole group, each step keeps the HALF of the rows that are nearest and
    estimates anew, which can only lower the determinant.  The nearest part is
    found in a histogram of distances, never by sorting a group.  At the end the
    scale is set so that the group's median is that of a normal sample.
    """
    rows = cut(rows, "vectors")
    now = cut(_moments(rows, F.lit(True), p), "moments")
    for last in [False] * steps + [True]:
        far = hot_join(rows, now, "group", "_n").withColumn("d2", _distance(p)).withColumn(
            "_step", F.floor(F.log2(F.greatest("d2", F.lit(1e-6))) * GRID).cast("int")
        ).drop("mean", "inverse", "_n")
        if not last:
            far = cut(far.select("group", "x", "_step"), "far")
            edge = _quantile(far, HALF, "_edge").join(now.select("group", "_n"), "group")
            near = hot_join(far, cut(edge, "edge"), "group", "_n")
            now = cut(_moments(near, F.col("_step") <= F.col("_edge"), p), "moments")
    far = cut(far, "far")
    middle = cut(_quantile(far, 0.5, "_mid").join(now.select("group", "_n"), "group"), "middle")
    scale = F.pow(F.lit(2.0), (F.col("_mid") + 1) / GRID) / CHI2_MEDIAN[p]
    return hot_join(far, middle, "group", "_n").withColumn("d2", F.col("d2") / F.greatest(scale, F.lit(0.05))).drop(
        "_step", "_mid", "_n"
    )


def rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    cutoff: float = 150.0,
) -> DataFrame:
    """id, the statistics, base_failed, d2 and kept, one row per input row.

    base_failed: under 50 words, or over half of the words in repeated windows.
    The others are measured against their language and source, or only their
    language, or all, where a group has under MIN_GROUP texts; null languages
    and sources are groups of their own.  ``cutoff`` bounds the squared distance;
    it is far above the normal quantile, as honest texts have long tails.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c)), F.lit("n"))
    stats = docs.select(
        F.col(id_col).alias("id"), part(lang_col).alias("_lang"), part(source_col).alias("_source"),
        text_stats(F.col(text_col)).alias("s"),
    ).select("id", "_lang", F.concat_ws("\x1f", "_lang", "_source").alias("_fine"), "s.*")
    stats = stats.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    stats = cut(stats, "stats")
    fit = stats.where(~F.col("base_failed"))
    fine = fit.groupBy("_fine", "_lang").agg(F.count(F.lit(1)).alias("_n"))
    coarse = fine.groupBy("_lang").agg(F.sum("_n").alias("_l"))
    named = fine.join(coarse, "_lang").select(
        "_fine", "_n",
        F.when(F.col("_n") >= MIN_GROUP, F.col("_fine")).when(F.col("_l") >= MIN_GROUP, F.col("_lang"))
        .otherwise(F.lit("")).alias("group"),
    )
    placed = hot_join(fit, cut(named, "groups"), "_fine", "_n").drop("_n", "_fine", "_lang").withColumn("x", vector())
    out = distances(placed, 5).drop("group", "x").withColumn("kept", F.col("d2") <= cutoff)
    failed = stats.where("base_failed").drop("_fine", "_lang").withColumns(
        {"d2": F.lit(None).cast("double"), "kept": F.lit(False)}
    )
    return out.unionByName(failed)
