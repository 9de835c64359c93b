"""Vector columns: contract check and exact cosine neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Queries that travel packed: 256 x 768 doubles are 1.5 MB.
QUERY_BLOCK = 256
# Numbers of a tile of vectors, 64 MB as doubles.
TILE = 1 << 23


def vector_problem(c: str, size: int) -> Column:
    """Why a vector breaks the contract, null when it does not."""
    v = F.col(c)
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(F.size(v) != size, F.lit("length"))
        .when(F.exists(v, lambda x: x.isNull()), F.lit("null entry"))
        .when(F.exists(v, lambda x: F.isnan(x)), F.lit("not a number"))
    )


def check_vectors(df: DataFrame, c: str, size: int) -> DataFrame:
    """Rows whose vector breaks the contract, with the reason."""
    return df.withColumn("problem", vector_problem(c, size)).where("problem is not null")


def norm(c: str) -> Column:
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(c: str) -> Column:
    """The vector scaled to length one; a zero vector stays."""
    n = norm(c)
    return F.when(
        n > 0, F.transform(c, lambda x: x.cast("double") / n)
    ).otherwise(F.transform(c, lambda x: x.cast("double")))


def _best(names: list[int], asked: np.ndarray, ids: np.ndarray, units: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best rows of a tile per query: highest score of six digits, then smallest id."""
    out: list[tuple[int, int, float]] = []
    for low in range(0, len(names), 64):
        score = asked[low : low + 64] @ units.T
        shown = np.round(score, 6)
        n = min(k, len(ids))
        floor = -np.partition(-shown, n - 1, axis=1)[:, n - 1]
        for q, name in enumerate(names[low : low + 64]):
            at = np.flatnonzero(shown[q] >= floor[q])
            at = at[np.lexsort((ids[at], -shown[q, at]))[:n]]
            out.extend((name, int(ids[i]), float(score[q, i])) for i in at)
    columns = list(zip(*out, strict=True)) or [[], [], []]
    kinds = [pa.int64(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])


def _score_tiles(k: int):
    """Per tile, its vectors first and then block after block of queries; a closure so that it travels by value."""

    def run(batches):
        tile, held, names, units = None, [], [], None
        for batch in batches:
            columns = [batch.column(c) for c in ("dims", "tile", "vec_id", "v", "block")]
            for row in range(batch.num_rows):
                here = (columns[0][row].as_py(), columns[1][row].as_py())
                if here != tile:
                    tile, held, names, units = here, [], [], None
                if not columns[4][row].is_valid:
                    held.append(columns[3][row].values.to_numpy(zero_copy_only=False))
                    names.append(columns[2][row].as_py())
                    continue
                if not held:
                    continue
                if units is None:
                    units = np.stack(held)
                    size = np.linalg.norm(units, axis=1)
                    units /= np.where(size > 0, size, 1.0)[:, None]
                    ids = np.array(names, np.int64)
                block = columns[4][row].as_py()
                yield _best([q["query_id"] for q in block], np.array([q["v"] for q in block], float), ids, units, k)

    return run


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, vec_id, score, rank): the k nearest vectors of every query.

    Exact, and one plan whatever the number of queries.  Vectors are dealt to
    tiles of TILE numbers, which each fit a task; packed blocks of QUERY_BLOCK
    queries visit every tile and leave with k rows of it, so neither side passes
    the driver and what is ranked at the end is k rows per query and tile.
    ``queries`` has (query_id, vector), ``vectors`` (vec_id, vector).  Vectors
    that are null or hold a null meet nobody, nor do vectors of other lengths.
    """
    whole = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    have = vectors.select("vec_id", F.col("vector").cast("array<double>").alias("v")).where(whole).withColumn("dims", F.size("v"))
    numbers, asked = have.agg(F.sum("dims")).first()[0] or 0, queries.count()
    tiles, blocks = max(1, -(-numbers // TILE)), max(1, -(-asked // QUERY_BLOCK))
    packed = (
        queries.select("query_id", unit("vector").alias("v")).where(whole).withColumn("dims", F.size("v"))
        .groupBy("dims", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("_b"))
        .agg(F.collect_list(F.struct("query_id", "v")).alias("block"))
    )
    rows = have.select(
        "dims", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int").alias("tile"), F.col("vec_id").cast("bigint"), "v",
        F.lit(None).cast(packed.schema["block"].dataType).alias("block"),
    ).unionByName(packed.select(
        "dims", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.lit(None).cast("bigint").alias("vec_id"),
        F.lit(None).cast("array<double>").alias("v"), "block",
    ))
    dealt = rows.repartition("dims", "tile").sortWithinPartitions("dims", "tile", F.col("vec_id").asc_nulls_last())
    found = dealt.mapInArrow(_score_tiles(k), "query_id bigint, vec_id bigint, score double")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    )
