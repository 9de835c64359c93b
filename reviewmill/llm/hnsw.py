"""Approximate nearest neighbours: a small-world graph per shard, shard results merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.plans.storage import cut

SHARD_ROWS = 8192
BLOCK = 256


class Graph:
    """A hierarchical navigable small world over the rows of ``vectors``.

    Nodes are ordered by falling level, so layer l holds the nodes 0..size[l]-1
    and its links are one flat array of ``size[l] * width`` node numbers, -1
    where there is none.  Layers are built from the top; nodes join a layer in
    blocks that search it together.
    """

    def __init__(self, vectors: np.ndarray, links: int = 16, beam: int = 80, seed: int = 7):
        n = len(vectors)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
        self.order = np.argsort(-level, kind="stable")
        # centred and in doubles, and distances by differences: near vectors far from zero must not cancel out
        self.centre = vectors.mean(axis=0) if n else np.zeros(vectors.shape[1])
        self.data = np.ascontiguousarray(vectors[self.order] - self.centre, float)
        level = level[self.order]
        top = int(level[0]) if n else 0
        self.size = [int((level >= i).sum()) for i in range(top + 1)]
        self.width = [2 * links] + [links] * top
        self.flat = [np.full(s * w, -1, np.int32) for s, w in zip(self.size, self.width, strict=True)]
        self.links, self.beam = links, beam
        for layer in range(top, -1, -1):
            self._build(layer)

    def _near(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its own list of nodes."""
        gap = self.data[ids]
        gap -= q[:, None, :]
        return np.einsum("bkd,bkd->bk", gap, gap)

    def _search(self, layer: int, q: np.ndarray, entry: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances), nearest first, -1 where fewer; ``entry``: a node per query."""
        grid = self.flat[layer].reshape(-1, self.width[layer])
        b = len(q)
        ids, dist = np.full((b, beam), -1, np.int32), np.full((b, beam), np.inf)
        ids[:, 0], dist[:, 0] = entry, self._near(q, entry[:, None])[:, 0]
        open_ = np.zeros((b, beam), bool)
        open_[:, 0] = True
        seen = np.zeros((b, len(grid)), bool)
        seen[np.arange(b), entry] = True
        wide = min(wide, beam)
        live = np.arange(b)
        while len(live):
            rank = np.where(open_[live], dist[live], np.inf)
            pick = np.argpartition(rank, wide - 1, axis=1)[:, :wide]
            some = np.isfinite(np.take_along_axis(rank, pick, 1))
            keep = some.any(axis=1)
            live, pick, some = live[keep], pick[keep], some[keep]
            if not len(live):
                break
            rows = live[:, None]
            open_[rows, pick] = False
            nb = np.where(some[:, :, None], grid[ids[rows, pick]], -1).reshape(len(live), -1)
            nb.sort(axis=1)
            fresh = nb >= 0
            fresh[:, 1:] &= nb[:, 1:] != nb[:, :-1]
            fresh &= ~seen[rows, nb]
            seen[np.broadcast_to(rows, nb.shape)[fresh], nb[fresh]] = True
            far = np.where(fresh, self._near(q[live], np.maximum(nb, 0)), np.inf)
            all_d = np.concatenate([dist[live], far], axis=1)
            all_i = np.concatenate([ids[live], nb], axis=1)
            all_o = np.concatenate([open_[live], fresh], axis=1)
            best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            dist[live], ids[live], open_[live] = (np.take_along_axis(x, best, 1) for x in (all_d, all_i, all_o))
        by = np.argsort(dist, axis=1, kind="stable")
        dist, ids = np.take_along_axis(dist, by, 1), np.take_along_axis(ids, by, 1)
        return np.where(np.isfinite(dist), ids, -1), dist

    def _select(self, ids: np.ndarray, dist: np.ndarray, width: int) -> np.ndarray:
        """Of each row's candidates (nearest first) those nearer to it than to any chosen before; then the nearest rest."""
        data = self.data[np.maximum(ids, 0)]
        data -= data[:, :1]  # candidates lie close together
        norm = np.einsum("bkd,bkd->bk", data, data)
        between = norm[:, :, None] + norm[:, None, :] - 2 * data @ data.transpose(0, 2, 1)
        taken = np.zeros(ids.shape, bool)
        least = np.full(ids.shape, np.inf)
        count = np.zeros(len(ids), int)
        for k in range(ids.shape[1]):
            ok = (ids[:, k] >= 0) & (dist[:, k] < least[:, k]) & (count < width)
            taken[:, k] = ok
            count += ok
            least[ok] = np.minimum(least[ok], between[ok, :, k])
        rank = np.where(ids < 0, 2, np.where(taken, 0, 1)) * (ids.shape[1] + 1) + np.arange(ids.shape[1])
        best = np.argsort(rank, axis=1)[:, :width]
        out = np.take_along_axis(ids, best, 1)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out

    def _build(self, layer: int) -> None:
        n, width = self.size[layer], self.width[layer]
        grid = self.flat[layer].reshape(n, width)
        above = self.size[layer + 1] if layer + 1 < len(self.size) else 0
        done = 0
        while done < n:
            block = np.arange(done, min(n, done + max(1, min(BLOCK, done or 32))))
            q = self.data[block]
            near_zero = q - q.mean(axis=0)
            norm = np.einsum("nd,nd->n", near_zero, near_zero)
            inner = norm[None, :] + norm[:, None] - 2 * near_zero @ near_zero.T
            np.fill_diagonal(inner, np.inf)
            k = min(self.links, len(block) - 1)
            near = np.argsort(inner, axis=1, kind="stable")[:, :k]
            ids, dist = block[near].astype(np.int32), np.take_along_axis(inner, near, 1)
            if done:
                entry = self._descend(q, layer) if above and done >= above else np.zeros(len(block), np.int32)
                far_i, far_d = self._search(layer, q, entry, self.beam)
                ids, dist = np.concatenate([far_i, ids], axis=1), np.concatenate([far_d, dist], axis=1)
            by = np.argsort(dist, axis=1, kind="stable")[:, : self.beam]
            ids, dist = np.take_along_axis(ids, by, 1), np.take_along_axis(dist, by, 1)
            chosen = self._select(ids, dist, self.links)
            grid[block, : self.links] = chosen
            done = int(block[-1]) + 1
            self._back(grid, block, chosen)

    def _back(self, grid: np.ndarray, block: np.ndarray, chosen: np.ndarray) -> None:
        """Links from the chosen nodes back to the block; a full list is chosen anew."""
        src, dst = np.repeat(block, chosen.shape[1]), chosen.ravel()
        src, dst = src[dst >= 0].astype(np.int32), dst[dst >= 0]
        have = (grid[dst] == src[:, None]).any(axis=1)
        src, dst = src[~have], dst[~have]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        if not len(nodes):
            return
        more = np.full((len(nodes), int(count.max())), -1, np.int32)
        more[np.repeat(np.arange(len(nodes)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
        for low in range(0, len(nodes), 1024):
            part = nodes[low : low + 1024]
            ids = np.concatenate([grid[part], more[low : low + 1024]], axis=1)
            dist = np.where(ids >= 0, self._near(self.data[part], np.maximum(ids, 0)), np.inf)
            by = np.argsort(dist, axis=1, kind="stable")[:, : grid.shape[1] + 16]
            ids, dist = np.take_along_axis(ids, by, 1), np.take_along_axis(dist, by, 1)
            room = (ids >= 0).sum(axis=1) <= grid.shape[1]
            grid[part[room]] = ids[room, : grid.shape[1]] if ids.shape[1] >= grid.shape[1] else -1
            if not room.all():
                grid[part[~room]] = self._select(ids[~room], dist[~room], grid.shape[1])

    def _descend(self, q: np.ndarray, layer: int) -> np.ndarray:
        entry = np.zeros(len(q), np.int32)
        for up in range(len(self.size) - 1, layer, -1):
            entry = self._search(up, q, entry, 1)[0][:, 0]
        return entry

    def search(self, q: np.ndarray, k: int, beam: int) -> np.ndarray:
        """Row numbers of about the ``k`` nearest vectors of each query, -1 where fewer."""
        q = np.ascontiguousarray(q, float) - self.centre
        out = [np.zeros((0, k), np.int64)]
        for low in range(0, len(q), BLOCK):
            part = q[low : low + BLOCK]
            ids = self._search(0, part, self._descend(part, 0), max(beam, k))[0][:, :k]
            out.append(np.where(ids >= 0, self.order[np.maximum(ids, 0)], -1))
        return np.concatenate(out)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with v an array of doubles; null ids and vectors null, zero or with a null or non-finite entry go."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        .where(~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    )


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, beam: int = 128
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found per query, its own id left out.

    ``vectors`` and ``queries``: (id, v) as ``usable`` gives them.  Equal vectors
    are one node that carries its k + 1 smallest ids, which is all a query can
    need of them.  Nodes are dealt to shards of about ``shard_rows`` by hash; a
    task builds a shard's graph, then takes the queries batch by batch.  Scores
    are Euclidean distances of the given vectors in double precision, ties go to
    the smaller id.  Vectors of another length never meet.
    """
    w = W.partitionBy("v").orderBy("id")
    few = vectors.dropDuplicates(["id", "v"]).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
    nodes = cut(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select(
        F.size("v").alias("dims"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(None).cast("long").alias("query"), "ids", "v",
    )
    asked = queries.dropDuplicates(["id", "v"]).select(
        F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.col("id").alias("query"), F.lit(None).cast(nodes.schema["ids"].dataType).alias("ids"), "v",
    )
    both = dealt.unionByName(asked).repartition(F.col("dims"), F.col("shard")).sortWithinPartitions("dims", "shard", F.col("query").asc_nulls_first(), F.col("ids")[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, graph, rows, ids, data = None, None, [], [], None
        for b in batches:
            dims, shard = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shard) != 0)) + 1
            for low, high in zip([0, *edges], [*edges, b.num_rows], strict=True):
                part = b.slice(low, high - low)
                if not part.num_rows:
                    continue
                if here != (now := (int(dims[low]), int(shard[low]))):
                    here, graph, rows, ids = now, None, [], []
                values = part.column(4).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                asking = part.column(2).is_valid().to_numpy(zero_copy_only=False)
                if (~asking).any():
                    rows.append(values[~asking])
                    ids += part.column(3).filter(pa.array(~asking)).to_pylist()
                if asking.any() and ids:
                    if graph is None:
                        data = np.concatenate(rows)
                        graph = Graph(data)
                    q, qid = values[asking], part.column(2).drop_null().to_pylist()
                    yield answers(q, qid, graph.search(q, k + 1, beam), data, ids)

    def answers(q, qid, found, data, ids) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        for j, own in enumerate(qid):
            at = found[j][found[j] >= 0]
            score = np.sqrt(((data[at] - q[j]) ** 2).sum(axis=1))
            hits = sorted((s, i) for s, node in zip(score.tolist(), at, strict=True) for i in ids[node] if i != own)[:k]
            out[0].extend([own] * len(hits))
            out[1].extend(i for _, i in hits)
            out[2].extend(s for s, _ in hits)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
            ["query_id", "id", "score"],
        )

    hits = both.mapInArrow(run, "query_id long, id long, score double")
    first = W.partitionBy("query_id").orderBy("score", "id")
    return hits.withColumn("rank", F.row_number().over(first).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score"
    )
