"""Near-duplicate vectors by counting collisions in windows of sorted one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, exp, log, pi, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm.common import components, hot_join
from reviewmill.llm.grams import mix
from reviewmill.plans.skew import broadcast_if_small
from reviewmill.plans.storage import cut, discard

# All lengths below are in units of the greatest distance that links two unit vectors.
WINDOW = 2.5  # half a query's window on the projection that is sorted
STRIP = 4 * WINDOW  # a sorted line is cut into strips of this length
CELL = 10.0  # width of the cells on the projections that part the lines
GRAIN = 64  # steps of a stored projection
LINE = 1000  # rows of one label that a line should hold
MISS = 1e-6  # chance that a pair at the threshold does not pass
FALSE = 0.1  # unrelated partners of a row that may pass, if vectors point anywhere
MOST = 4096  # rows of a strip compared in one place
PAIRS = 1 << 17  # pairs held as arrays at a time


class Plan(NamedTuple):
    """``tables`` projections, each sorted inside cells of ``parting`` others; pairs need ``least`` collisions."""

    parting: int
    tables: int
    least: int
    reach: float

    @property
    def scanned(self) -> int:
        """Tables of which one at least must show a pair that collides ``least`` times."""
        return self.tables - self.least + 1


def _inside(width: float, far: float) -> float:
    """Chance that two projections ``far`` apart (standard deviation) lie within ``width``."""
    return erf(width / far / sqrt(2))


def _same_cell(width: float, far: float) -> float:
    """Chance that they share a cell of ``width`` whose edges lie anywhere."""
    r = width / far
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def _tail(n: int, p: float, least: int) -> float:
    """Chance of ``least`` or more successes."""
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(least, n + 1))


def calibrate(rows: int, cosine: float) -> Plan:
    """The tables and the count for labels of up to ``rows`` rows.

    Projections of a pair on a random normal direction differ by a normal
    number whose deviation is the pair's distance, so the chances are exact.
    The count is the largest that a pair at the threshold reaches but for
    ``MISS``; tables are added until unrelated pairs hardly reach it.
    """
    reach = sqrt(2 - 2 * cosine)
    apart = sqrt(2) / reach
    parting = max(0, ceil(log(max(1, rows / LINE)) / -log(_same_cell(CELL, apart))))
    near = _same_cell(CELL, 1) ** parting * _inside(WINDOW, 1)
    other = _same_cell(CELL, apart) ** parting * _inside(WINDOW, apart)
    tables = 4
    while True:
        missed, least = 0.0, 0
        while (missed := missed + comb(tables, least) * near**least * (1 - near) ** (tables - least)) <= MISS:
            least += 1
        if least and rows * _tail(tables, other, least) <= FALSE:
            return Plan(parting, tables, least, reach)
        tables += 2


def _directions(plan: Plan, dims: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([11, dims])
    return rng.standard_normal((dims, plan.tables, plan.parting + 1)), rng.random((plan.tables, plan.parting))


def signatures(vectors: list[np.ndarray], labels: list[str], plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(cells, places), a row per vector and a column per table."""
    cells = np.zeros((len(vectors), plan.tables), np.int32)
    places = np.zeros((len(vectors), plan.tables), np.int32)
    sizes = np.array([len(v) for v in vectors])
    for dims in np.unique(sizes):
        at = np.flatnonzero(sizes == dims)
        lines, edges = _directions(plan, int(dims))
        x = unit(np.stack([vectors[i] for i in at]))
        p = np.einsum("nd,dtk->ntk", x, lines, optimize=True) / plan.reach
        grid = np.floor(p[:, :, :-1] / CELL + edges).astype(np.int64).astype(np.uint64)
        h = np.array([xxhash.xxh64_intdigest(labels[i].encode("utf-8", "surrogatepass"), int(dims)) for i in at], np.uint64)
        h = mix(h[:, None] + np.arange(1, plan.tables + 1, dtype=np.uint64))
        for k in range(plan.parting):
            h = mix(h ^ (grid[:, :, k] + np.uint64(k + 1)))
        cells[at] = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
        places[at] = np.clip(np.floor(p[:, :, -1] * GRAIN), -(1 << 30), 1 << 30)
    return cells, places


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so no square leaves the range of doubles."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sign(classes: DataFrame, plan: Plan) -> DataFrame:
    """``classes`` with their signature: cells, then places, as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = [np.asarray(v, float) for v in b.column("v").to_pylist()]
            cells, places = signatures(vectors, b.column("label").to_pylist(), plan)
            packed = [row.tobytes() for row in np.concatenate([cells, places], axis=1).astype("<i4")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packed, pa.binary())], [*b.schema.names, "sig"])

    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, T.StructField("sig", T.BinaryType())]))


def _unpack(sig: pa.ChunkedArray | pa.Array, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(sig.to_pylist()), "<i4").reshape(-1, 2, plan.tables)
    return raw[:, 0], raw[:, 1]


def _strips(signed: DataFrame, plan: Plan, carry: bool) -> DataFrame:
    """(strip, line, home, key[, sig]): rows in their strip of every scanned table, and once more as guests.

    A strip takes as guests the rows of the next one that a window from inside
    it can reach.
    """
    strip, window = int(STRIP * GRAIN), int(WINDOW * GRAIN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cells, places = _unpack(b.column("sig"), plan)
            rows = np.arange(b.num_rows)
            for t in range(plan.scanned):
                number = places[:, t] // strip
                guest = places[:, t] - number * strip <= window
                at = np.concatenate([rows, rows[guest]])
                home = np.concatenate([np.ones(len(rows), bool), np.zeros(int(guest.sum()), bool)])
                number = np.concatenate([number, number[guest] - 1])
                h = mix(mix(cells[at, t].astype(np.int64).astype(np.uint64) + np.uint64(t << 40)) ^ number.astype(np.int64).astype(np.uint64))
                out = [pa.array(h.view(np.int64)), pa.array(np.full(len(at), t, np.int32)), pa.array(home), b.column("key").take(pa.array(at))]
                yield pa.RecordBatch.from_arrays([*out, *([b.column("sig").take(pa.array(at))] if carry else [])], names)

    names = ["strip", "line", "home", "key", *(["sig"] if carry else [])]
    kind = "strip long, line int, home boolean, key long" + (", sig binary" if carry else "")
    return signed.select("key", "sig").mapInArrow(run, kind)


def _dealt(strips: DataFrame, hot: DataFrame) -> DataFrame:
    """``strips`` with the ``place`` that compares them; strips in ``hot`` are cut into parts, each two of which meet."""
    parts = F.coalesce("parts", F.lit(1))
    cut_up = strips.join(broadcast_if_small(hot), "strip", "left").withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))
    met = cut_up.withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
    place = F.xxhash64("strip", F.least("part", "_other"), F.greatest("part", "_other"))
    return met.withColumns({"place": place, "across": F.col("part") != F.col("_other")}).drop("strip", "parts", "_other")


def _whole(batches: Iterator[pa.RecordBatch], least: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole places, about ``least`` rows or one place each; rows come sorted by place."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size < least:
            continue
        table = pa.Table.from_batches(held)
        place = table.column("place").to_numpy()
        last = int(np.searchsorted(place, place[-1], "left"))
        if last:
            yield table.slice(0, last)
        held = table.slice(last).to_batches()
        size = table.num_rows - last
    if size:
        yield pa.Table.from_batches(held)


def _candidates(table: pa.Table, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs that pass, each pair only in the first table that shows it.

    Rows are sorted along their line; a row's window reaches over the rows
    behind it, so that every pair is met from its earlier row.
    """
    cells, places = _unpack(table.column("sig"), plan)
    line, part = (table.column(c).to_numpy() for c in ("line", "part"))
    home, across = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("home", "across"))
    where = places[np.arange(len(line)), line]
    _, place = np.unique(table.column("place").to_numpy(), return_inverse=True)
    order = np.lexsort((where, place))
    sorted_at = place[order].astype(np.int64) * (1 << 33) + where[order]
    reach = int(WINDOW * GRAIN)
    count = np.searchsorted(sorted_at, sorted_at + reach, "right") - np.arange(len(order)) - 1
    total = np.concatenate([[0], np.cumsum(count)])
    low = 0
    while low < len(order):
        high = max(low + 1, int(np.searchsorted(total, total[low] + PAIRS, "right")) - 1)
        n = count[low:high]
        i = np.repeat(np.arange(low, high), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(total[low:high] - total[low], n)
        i, j = order[i], order[j]
        fit = (home[i] | home[j]) & (across[i] == (part[i] != part[j]))
        i, j = i[fit], j[fit]
        hit = (cells[i] == cells[j]) & (np.abs(places[i] - places[j]) <= reach)
        fit = (hit.argmax(1) == line[i]) & (hit.sum(1) >= plan.least)
        if fit.any():
            yield i[fit], j[fit]
        low = high


_DEALT = "line int, home boolean, key long, part int, place long, across boolean"


def _passing(dealt: DataFrame, plan: Plan) -> DataFrame:
    """The rows of ``dealt`` that some pair of their place needs, without the signature."""
    names = [c.split()[0] for c in _DEALT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches):
            used = np.zeros(table.num_rows, bool)
            for i, j in _candidates(table, plan):
                used[i] = used[j] = True
            yield from table.select(names).filter(pa.array(used)).combine_chunks().to_batches()

    sorted_ = dealt.repartition("place").sortWithinPartitions("place")
    return sorted_.select(*names, "sig").mapInArrow(run, _DEALT)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the least node it hangs together with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for side in (x, y):
            np.minimum.at(new, side, low)
            np.minimum.at(new, root[side], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def _verified(rows: DataFrame, plan: Plan, cosine: float) -> DataFrame:
    """(a, links, b): per place and row the number of linked vectors, or a star edge a - b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches):
            key, n = table.column("key").to_numpy(), table.column("n").to_numpy()
            vectors = table.column("v").combine_chunks()
            starts = vectors.offsets.to_numpy()
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(float)
            size = np.diff(starts)
            label = pc.dictionary_encode(table.column("label").combine_chunks()).indices.to_numpy()
            links = np.zeros(table.num_rows, np.int64)
            edges: list[tuple[np.ndarray, np.ndarray]] = []
            units = np.zeros((table.num_rows, int(size.max(initial=0))))
            for dims in np.unique(size):
                at = np.flatnonzero(size == dims)
                units[at, :dims] = unit(flat[starts[at][:, None] + np.arange(dims)])
            for i, j in _candidates(table, plan):
                same = (label[i] == label[j]) & (size[i] == size[j])
                i, j = i[same], j[same]
                near = np.concatenate([
                    np.einsum("pd,pd->p", units[i[s : s + 8192]], units[j[s : s + 8192]]) for s in range(0, len(i) or 1, 8192)
                ]) >= cosine
                i, j = i[near], j[near]
                if len(i):
                    np.add.at(links, i, n[j])
                    np.add.at(links, j, n[i])
                    edges.append(_stars(key[i], key[j]))
            some = np.flatnonzero(links)
            a = np.concatenate([key[some], *[e[0] for e in edges]])
            b = np.concatenate([np.zeros(len(some), np.int64), *[e[1] for e in edges]])
            alone = np.arange(len(a)) < len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(np.where(alone, np.concatenate([links[some], np.zeros(len(a) - len(some), np.int64)]), 0)), pa.array(b, mask=alone)],
                ["a", "links", "b"],
            )

    sorted_ = rows.repartition("place").sortWithinPartitions("place")
    return sorted_.mapInArrow(run, "a long, links long, b long")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98,
    plan: Plan | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``vectors``.

    Rows of equal, not null label whose cosine is ``cosine`` or more are linked.
    A pair's collisions are counted over all tables where it first shows, on the
    signatures; only rows of passing pairs travel on with their vectors, and the
    cosine decides.  A pair at the threshold is missed with a chance under MISS
    per pair, a nearer one more rarely.  Equal vectors of a label are one class,
    counted by its size, and no list of pairs is ever written: places give
    numbers of links per row and star edges.

    Null vectors, null labels, zero vectors and those with null or non-finite
    components link with nothing and are their own component, as are vectors of
    other lengths among each other.  Repeated ids stay rows of their own; a null
    id is never the smallest of a component that holds another.
    """
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kind = vectors.schema[vector_col].dataType
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("_v"),
        F.col(vector_col).cast("array<double>").alias("_d"),
    )
    usable = F.col("label").isNotNull() & F.col("_d").isNotNull() & ~F.exists("_d", odd) & F.exists("_d", lambda x: x != 0)
    v = F.transform("_v", lambda x: x + F.lit(0).cast(kind.elementType))  # no negative zeros
    vk = F.concat(*[F.lower(F.hex(F.xxhash64(F.lit(s), "label", v))) for s in (0, 1)])
    rows = cut(rows.withColumn("ok", F.coalesce(usable, F.lit(False))).select(
        "id", F.when(F.col("ok"), F.col("label")).alias("label"), F.when(F.col("ok"), v).alias("v"), F.when(F.col("ok"), vk).alias("vk")
    ), "vectors")
    made = rows.where("vk is not null").groupBy("vk").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least")
    )
    classes = cut(made.withColumn("key", F.monotonically_increasing_id()), "classes")
    if plan is None:
        most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        plan = calibrate(most, cosine)
    signed = cut(_sign(classes.select("key", "label", "v", "n"), plan), "signed")
    per = _strips(signed, plan, False).groupBy("strip").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MOST)
    hot = cut(per.select("strip", F.ceil(F.col("_n") / MOST).cast("int").alias("parts")), "hot")
    needed = cut(_passing(_dealt(_strips(signed, plan, True), hot), plan), "needed")
    found = cut(_verified(needed.join(signed, "key"), plan, cosine), "links")
    discard(signed, hot, needed)
    links = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("_links"))
    roots = components(found.where("b is not null").select("a", "b").distinct()).withColumnRenamed("node", "key")
    joined = cut(
        classes.select("key", "vk", "n", "least").join(links, "key", "left").join(roots, "key", "left").select(
            "vk", "n", "least", (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root"),
        ), "joined",
    )
    least = cut(joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_w")), "least")
    result = cut(hot_join(joined, least, "root", "_w").select("vk", "n", "n_links", "component_id"), "result")
    linked = hot_join(rows.where("vk is not null").select("id", "vk"), result, "vk", "n").select("id", "n_links", "component_id")
    alone = rows.where("vk is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
