"""Balanced label propagation: linked rows move to their neighbours' shards under quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import hot_join, numbered
from reviewmill.plans.storage import cut

CELLS = 64
ROWS_PER_CELL = 20_000


def _flows(wish: dict, load: list[int], cap: int) -> dict:
    """Rows that may go from shard a to b: as many as come back, and b's free room shared out by wish."""
    allow = {(a, b): min(n, wish.get((b, a), 0)) for (a, b), n in wish.items()}
    for b in range(len(load)):
        rest = {a: n - allow[(a, c)] for (a, c), n in wish.items() if c == b}
        room, asked = max(0, cap - load[b]), sum(rest.values())
        for a, n in rest.items():
            allow[(a, b)] += n if asked <= room else n * room // asked
    return allow


def propagate(rows: DataFrame, id_col: str, links: DataFrame, shards: int, rounds: int, slack: float) -> DataFrame:
    """(id, shard) of every id with a link, after ``rounds`` of label propagation.

    Every id starts in the shard of its hash.  In a round half of the linked
    ids (by hash, so that two neighbours do not swap for ever) ask for the
    shard most of their neighbours are in.  Wishes are summed by (from, to,
    gain, hash cell), a table of fixed size; the highest gains go first until
    the quota of the pair of shards is used up.  A shard never passes
    (1 + slack) times the mean number of rows.
    """
    edges = links.select(F.col("src").alias("a"), F.col("dst").alias("b")).where("a <> b")
    edges = cut(edges.union(edges.select("b", "a")).distinct(), "links")
    degree = edges.groupBy("a").agg(F.count(F.lit(1)).alias("_deg"))
    home = F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int")
    ids = rows.select(F.col(id_col).alias("_id"))
    at = {r[0]: r[1] for r in ids.groupBy(home.alias("s")).count().collect()}
    load = [at.get(s, 0) for s in range(shards)]
    cap = int((1 + slack) * sum(load) / shards) + 1
    weights = ids.groupBy("_id").agg(F.count(F.lit(1)).alias("_rows"))
    labels = cut(
        degree.withColumnRenamed("a", "_id").join(weights, "_id").withColumn("_shard", home), "labels"
    )
    votes_of = [F.count(F.when(F.col("_shard") == s, 1)).alias(f"_v{s}") for s in range(shards)]
    still = 0
    for r in range(rounds):
        near = labels.select(F.col("_id").alias("b"), "_shard", "_deg")
        votes = hot_join(edges, near, "b", "_deg").groupBy(F.col("a").alias("_id")).agg(*votes_of)
        asks = labels.join(votes, "_id").withColumn("_v", F.array(*[f"_v{s}" for s in range(shards)]))
        asks = (
            asks.withColumn("_best", (F.array_position("_v", F.array_max("_v")) - 1).cast("int"))
            .withColumn("_gain", F.array_max("_v") - F.get("_v", F.col("_shard")))
            .withColumn("_level", F.least(F.floor(F.log2(F.col("_gain") + 1)), F.lit(20)).cast("int"))
            .withColumn("_cell", F.pmod(F.xxhash64("_id", F.lit(r)), F.lit(2 * CELLS)).cast("int"))
            .select("_id", "_deg", "_rows", "_shard", "_best", "_gain", "_level", "_cell")
        )
        asks = cut(asks, "asks")
        wish = (
            asks.where((F.col("_gain") > 0) & (F.col("_cell") < CELLS))
            .groupBy("_shard", "_best", "_level", "_cell").agg(F.sum("_rows").alias("n"))
        ).collect()  # shards * shards * 21 * CELLS rows at most
        if not wish:
            still += 1
            if still == 3:
                break
            labels = asks.select("_id", "_deg", "_rows", "_shard")
            continue
        still = 0
        asked: dict = {}
        for w in wish:
            asked[(w[0], w[1])] = asked.get((w[0], w[1]), 0) + w["n"]
        left, go = _flows(asked, load, cap), []
        for w in sorted(wish, key=lambda w: (w[0], w[1], -w[2], w[3])):
            if w["n"] <= left[(w[0], w[1])]:
                left[(w[0], w[1])] -= w["n"]
                load[w[0]] -= w["n"]
                load[w[1]] += w["n"]
                go.append((w[0], w[1], w[2], w[3], True))
        moves = asks.sparkSession.createDataFrame(
            go, "_shard int, _best int, _level int, _cell int, _go boolean"
        )
        moved = asks.join(F.broadcast(moves), ["_shard", "_best", "_level", "_cell"], "left")
        labels = moved.select(
            "_id", "_deg", "_rows",
            F.when(F.col("_go") & (F.col("_gain") > 0), F.col("_best")).otherwise(F.col("_shard")).alias("_shard"),
        )
        labels = cut(labels, "labels")
    return labels.select(F.col("_id").alias("id"), F.col("_shard").alias("shard"))


def shard_rows(
    rows: DataFrame, id_col: str, links: DataFrame, shards: int = 8, rounds: int = 8, slack: float = 0.05
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; shard sizes differ by one row at most.

    ``links`` (src, dst) names ids that should stay together.  After label
    propagation each shard numbers its rows, linked ones first; what exceeds
    its exact share (mostly rows without links) fills the holes of the other
    shards, by arithmetic on the numbers.  Null and unlinked ids follow their
    hash; repeated ids follow one label and get a slot each.  An empty table
    gives no rows.  ``rows`` is read several times: pass a written table.
    """
    labels = propagate(rows, id_col, links, shards, rounds, slack)
    named = labels.select(F.col("id").alias(id_col), F.col("shard").alias("_label"))
    total = rows.count()
    placed = rows.join(named, id_col, "left").withColumn(
        "_s", F.coalesce("_label", F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int"))
    ).withColumn("_loose", F.col("_label").isNull().cast("int"))
    placed = cut(placed.drop("_label"), "placed")
    cells = max(1, total // (shards * ROWS_PER_CELL))
    tie = [id_col, *[c for c in rows.columns if c != id_col]]
    slots = numbered(placed, ["_s"], ["_loose"], tie, cells, "_slot")
    got = {r[0]: r[1] for r in placed.groupBy("_s").count().collect()}
    count = [got.get(s, 0) for s in range(shards)]
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    over, filled, spill, ends = [], [], 0, 0
    for s in range(shards):
        over.append(spill)
        spill += max(0, count[s] - quota[s])
        ends += max(0, quota[s] - count[s])
        filled.append(ends)  # holes up to shard s
    long = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    extra = F.col("_slot") - F.get(long(quota), F.col("_s"))
    hole = F.get(long(over), F.col("_s")) + extra
    target = F.lit(shards - 1)
    for s in reversed(range(shards)):
        target = F.when(hole < filled[s], s).otherwise(target)
    starts = long([count[s] - (filled[s - 1] if s else 0) for s in range(shards)])
    return (
        slots.withColumn("shard", F.when(extra < 0, F.col("_s")).otherwise(target).cast("int"))
        .withColumn(
            "slot", F.when(extra < 0, F.col("_slot")).otherwise(F.get(starts, F.col("shard")) + hole).cast("long")
        )
        .drop("_s", "_loose", "_slot")
    )


def text_links(rows: DataFrame, id_col: str, key: str) -> DataFrame:
    """Links from every id to the smallest id with the same ``key``: a star per group, never all its pairs."""
    groups = rows.where(F.col(id_col).isNotNull()).groupBy(key).agg(
        F.min(id_col).alias("_hub"), F.max(id_col).alias("_last"), F.count(F.lit(1)).alias("_w")
    )
    hubs = cut(groups.where("_hub <> _last").drop("_last"), "hubs")
    return hot_join(rows.select(key, id_col), hubs, key, "_w").select(
        F.col(id_col).alias("src"), F.col("_hub").alias("dst")
    ).where("src <> dst")
