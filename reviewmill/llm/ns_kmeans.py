"""Centroid clustering of integer vectors, exact assignments under ns-bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.plans.storage import cut, discard

# Components beyond this are held at it, so that every squared distance fits 64 bits.
REACH = 1 << 27
# Slack that rounding of roots and stored bounds may cost.
SLACK = 1e-6
SALTS = 256
_STATE = [
    T.StructField("near", T.IntegerType()), T.StructField("before", T.IntegerType()), T.StructField("distance", T.LongType()),
    T.StructField("low", T.ArrayType(T.FloatType())), T.StructField("seen", T.ArrayType(T.ByteType())), T.StructField("scans", T.LongType()),
]


def points(vectors: DataFrame, id_col: str, vector_col: str, dims: int = 64, scale: int = 256) -> DataFrame:
    """(id, x) of the vectors with ``dims`` finite components: x = floor(scale * component), held within REACH."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    grid = lambda x: F.greatest(F.least(F.floor(x * float(scale)), F.lit(REACH)), F.lit(-REACH)).cast("int")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where((F.size("v") == dims) & ~F.exists("v", odd)).select("id", F.transform("v", grid).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int = 2) -> np.ndarray:
    """The ``k`` rows of smallest sha256 of ``seed:id`` in that order, ties by components; at most k rows are read back."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    best = rows.select(mark.alias("mark"), "x").orderBy("mark", "x").limit(k).collect()
    return np.array([r["x"] for r in best], np.int64) if best else np.zeros((0, 0), np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c``; floats only where they hold every sum."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def assign(
    x: np.ndarray, history: np.ndarray, near: np.ndarray | None, low: np.ndarray | None, seen: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(near, distance, low, seen, scans) of the rows against the newest centroids, ``history[-1]``.

    ``low[i, j]`` bounds row i's distance to centroid j as it stood in round
    ``seen[i, j]``.  It is loosened by the norm of the centroid's whole way
    since that round, history[-1][j] - history[seen][j], which is never longer
    than the sum of the steps between.  Centroids whose bound does not exceed
    the exact distance to the present one are measured again.
    """
    now, last = history[-1], len(history) - 1
    n, k = len(x), len(now)
    if near is None:
        d2 = squared(x, now)
        near, scans = d2.argmin(1), np.full(n, k, np.int64)
        low, seen = np.sqrt(d2) * (1 - SLACK), np.full((n, k), last, np.int8)
        return near, d2[np.arange(n), near], low.astype(np.float32), seen, scans
    way = np.sqrt(((now[None] - history).astype(float) ** 2).sum(2)) * (1 + SLACK)
    rows = np.arange(n)
    own = ((x - now[near]) ** 2).sum(1)
    fail = low - way[seen, np.arange(k)[None, :]] <= (np.sqrt(own) * (1 + SLACK))[:, None]
    fail[rows, near] = False
    d2 = np.full((n, k), np.iinfo(np.int64).max)
    d2[rows, near] = own
    low, seen = low.copy(), seen.copy()
    i, j = np.nonzero(fail)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        d2[a, b] = ((x[a] - now[b]) ** 2).sum(1)
    fail[rows, near] = True
    low[fail] = np.sqrt(d2[fail]) * (1 - SLACK)
    seen[fail] = last
    near = d2.argmin(1)
    return near, d2[rows, near], low, seen, fail.sum(1)


def _round(state: DataFrame, history: np.ndarray) -> DataFrame:
    """``state`` after an assignment to the newest centroids; one pass, no shuffle."""
    kept = ["id", "x"]
    first = len(history) == 1
    fields = T.StructType([*(state.schema[c] for c in kept), *_STATE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = history.shape[1]
        for b in batches:
            if not b.num_rows:
                continue
            grid = lambda c, kind: b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(kind)  # noqa: B023, E731
            flat = lambda c: b.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            x = grid("x", np.int64)
            old = None if first else flat("near").astype(np.int64)
            near, d2, low, seen, scans = assign(x, history, old, *((None, None) if first else (grid("low", np.float32), grid("seen", np.int8))))
            if not first:
                scans = scans + flat("scans")
            ends = pa.array(np.arange(0, len(x) * k + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in kept), pa.array(near.astype(np.int32)),
                    pa.array((np.full(len(x), -1) if first else old).astype(np.int32)), pa.array(d2),
                    pa.ListArray.from_arrays(ends, pa.array(low.ravel())), pa.ListArray.from_arrays(ends, pa.array(seen.ravel())),
                    pa.array(scans.astype(np.int64)),
                ],
                fields.fieldNames(),
            )

    return cut(state.mapInArrow(run, fields), "assigned")


def _moves(state: DataFrame, dims: int) -> list:
    """(cluster, rows, component sums) over the rows that changed cluster, those that left counted negative."""
    moved = state.where("near <> before")
    both = F.array(
        F.struct(F.col("near").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("before").alias("c"), F.lit(-1).alias("sign"))
    )
    each = moved.select("x", F.pmod(F.xxhash64("x"), F.lit(SALTS)).alias("salt"), F.inline(both)).where("c >= 0")
    part = each.groupBy("c", "salt").agg(
        F.sum("sign").alias("n"), *[F.sum(F.get("x", F.lit(i)).cast("long") * F.col("sign")).alias(f"s{i}") for i in range(dims)]
    )
    wide = part.groupBy("c").agg(F.sum("n"), *[F.sum(F.col(f"s{i}").cast("decimal(20,0)")) for i in range(dims)])
    return wide.collect()


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """((id, x, near, distance, scans), centroids) after ``rounds`` updates and a last assignment.

    ``rows`` is (id, x) as ``points`` gives it.  Every round is one pass that
    reads a row with its bounds and writes them on, so a lost executor repeats
    its own part of one round; only the rows that changed cluster are summed,
    and the driver keeps k sums of ``dims`` numbers, as exact integers.  Empty
    clusters keep their centroid.  Repeated rows count each, null ids hash as
    empty; fewer than k rows give as many centroids as rows, and none an empty
    table.
    """
    state = cut(rows, "points")
    start = first_centroids(state, k, seed)
    if not len(start):
        none = state.withColumns({"near": F.lit(0), "distance": F.lit(0).cast("long"), "scans": F.lit(0).cast("long")})
        return none, start
    history, dims = start[None], start.shape[1]
    sums = [[0] * dims for _ in start]
    sizes = [0] * len(start)
    for done in range(rounds + 1):
        after = _round(state, history)
        discard(state)
        state = after
        if done == rounds:
            break
        for c, n, *parts in _moves(state, dims):
            sizes[c] += n
            sums[c] = [a + int(b) for a, b in zip(sums[c], parts, strict=True)]
        now = [[a // n for a in s] if n else list(old) for s, n, old in zip(sums, sizes, history[-1].tolist(), strict=True)]
        history = np.concatenate([history, np.array(now, np.int64)[None]])
    return state.select("id", "x", "near", "distance", "scans"), history[-1]


def described(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with cluster_inertia, inertia and the sha256 of the row's centroid; one row per cluster passes the driver."""
    per = {r["near"]: r["s"] for r in found.groupBy("near").agg(F.sum("distance").alias("s")).collect()}
    rows = [
        (i, per.get(i, 0), sum(per.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    each = found.sparkSession.createDataFrame(rows, "near int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "near")
