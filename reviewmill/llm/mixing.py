"""Mix sources to target weights by thresholds on a hash, found in nested histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.llm.common import hot_join
from reviewmill.plans.storage import cut

BITS = 60
STEP = 12  # bits of the hash that one histogram resolves


def n_words(text: Column) -> Column:
    """Runs of anything but the six ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \t-\r]+")), F.lit(0)).cast("long")


def row_hash(id_col: str, text_col: str) -> Column:
    """60 bits that depend on the id and the text only."""
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def ranked(sources: DataFrame, order: str) -> DataFrame:
    """``sources`` with ``rank`` from 0 in ``order``, nulls last, over range partitions instead of one sort."""
    parts = cut(
        sources.repartitionByRange(F.col(order).asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    below = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_below")
    )
    inside = F.row_number().over(W.partitionBy("_part").orderBy(F.col(order).asc_nulls_last()))
    return parts.withColumn("_in", inside).join(F.broadcast(below), "_part").withColumn(
        "rank", (F.col("_below") + F.col("_in") - 1).cast("long")
    ).drop("_part", "_in", "_below")


def targets(sources: DataFrame, budget: float, weights: tuple[float, ...], most: float) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: the budget shared by weight, none above ``most`` sizes.

    Weights repeat in code point order.  What a full source cannot take is
    shared again; the level rises until no further source is full, each step
    one sum over the sources.
    """
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    top = F.lit(float(most)) * F.col("source_size")
    known = cut(ranked(sources, "source").withColumn("_w", w), "sources")
    level, full = 0.0, -1
    while True:
        held = top <= F.lit(level) * F.col("_w")
        row = known.agg(
            F.coalesce(F.sum(F.when(held, top)), F.lit(0.0)), F.coalesce(F.sum(F.when(~held, F.col("_w"))), F.lit(0.0)),
            F.count(F.when(held, 1)),
        ).first()
        if row[2] == full or not row[1]:
            break
        full = row[2]
        level = max(level, (budget - row[0]) / row[1])
    target = F.least(top, F.lit(level) * F.col("_w")) if row[1] else top
    return known.withColumn("target", target.cast("double")).drop("_w", "rank")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
) -> DataFrame:
    """(id, source, size, hash, source_size, target, taken) per row.

    Every row is taken as often as its source's target holds the whole source;
    the rest goes to rows whose hash is under a threshold.  A histogram of words
    by (source, 12 bits of hash) finds the bucket the threshold falls in, and
    only that bucket is looked at again with the next 12 bits, until it holds
    one row or equal hashes; that row is taken if it brings the sum nearer.
    Nothing is sorted, and a larger budget takes all a smaller one took.  Null
    texts have size 0, null sources are a source of their own, sorted last;
    equal rows are taken alike, and an empty table gives no rows.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    rows = cut(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), name.alias("key"),
        n_words(F.col(text_col)).alias("size"), row_hash(id_col, text_col).alias("hash"),
    ), "sizes")
    per = cut(rows.groupBy("key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n")
    ), "persource")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets(per, share * total, weights, most).withColumn("_whole", whole).withColumn(
        "_rest", F.col("target") - F.col("_whole") * F.col("source_size")
    ).withColumn("_bucket", F.lit(0).cast("long")).withColumn("_below", F.lit(0).cast("long")).withColumn(
        "_in", F.col("source_size")
    ).withColumn("_many", F.lit(True))
    state = cut(state, "state")
    shift = BITS
    while shift > 0:
        shift -= STEP
        open_ = hot_join(rows, state.select("key", "_bucket", "_rest", "_below", "_n", "_many"), "key", "_n")
        edge = open_.where(F.col("_many") & (F.shiftright("hash", shift + STEP) == F.col("_bucket")))
        hist = edge.groupBy("key", "_rest", "_below", F.shiftright("hash", shift).alias("_to")).agg(
            F.sum("size").alias("_s"), F.min("hash").alias("_lo"), F.max("hash").alias("_hi")
        )
        order = W.partitionBy("key").orderBy("_to")
        upto = F.sum("_s").over(order)
        last = F.lead("_to").over(order).isNull()
        found = hist.withColumn("_upto", F.col("_below") + upto).withColumn("_last", last).where(
            ((F.col("_upto") >= F.col("_rest")) | F.col("_last")) & (F.col("_upto") - F.col("_s") <= F.col("_rest"))
        )
        found = found.groupBy("key").agg(F.min(F.struct("_to", "_upto", "_s", "_lo", "_hi")).alias("e"))
        state = state.join(found, "key", "left").select(
            "key", "source", "source_size", "target", "_n", "_whole", "_rest",
            F.coalesce("e._to", F.shiftleft("_bucket", STEP)).alias("_bucket"),
            F.coalesce(F.col("e._upto") - F.col("e._s"), F.col("_below")).alias("_below"),
            F.coalesce("e._s", "_in").alias("_in"),
            F.coalesce(F.col("e._lo"), F.col("_lo") if "_lo" in state.columns else F.lit(None)).alias("_lo"),
            F.coalesce(F.col("e._lo") != F.col("e._hi"), F.lit(False)).alias("_many"),
        )
        state = cut(state, "state")
        if not state.where("_many").limit(1).count():
            break
    # the edge bucket holds one hash: _lo; it is taken if that is nearer to the rest
    nearer = F.abs(F.col("_below") + F.col("_in") - F.col("_rest")) < F.abs(F.col("_below") - F.col("_rest"))
    marks = state.withColumn("_take", nearer).select("key", "source_size", "target", "_n", "_whole", "_lo", "_take")
    more = (F.col("hash") < F.col("_lo")) | ((F.col("hash") == F.col("_lo")) & F.col("_take"))
    times = F.col("_whole") + F.coalesce(more, F.lit(False)).cast("long")
    return hot_join(rows, cut(marks, "thresholds"), "key", "_n").select(
        "id", "source", "size", "hash", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"),
        times.cast("int").alias("times"),
    )
