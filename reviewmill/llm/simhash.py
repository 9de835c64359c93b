"""SimHash fingerprints, linked at a few differing bits by means of pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import components, hot_join
from reviewmill.plans.storage import cut

# Buckets of up to this many fingerprints compare their pairs; larger ones meet at one-bit neighbours.
PAIR_BUCKET = 64
PIVOTS = 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a whole text; no words: 0."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    last = max(1, len(parts) - words + 1)
    if last == 1:
        return xxhash.xxh64_intdigest(b" ".join(parts), seed)
    line, at = b" ".join(parts), 0
    starts = [0]
    for w in parts:
        at += len(w) + 1
        starts.append(at)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, last, 1 << 16):  # bounded memory for any text
        high = min(last, low + (1 << 16))
        h = np.fromiter(
            (digest(line[starts[i] : starts[i + words] - 1], seed) for i in range(low, high)), np.uint64, high - low
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(ones * 2 > last, bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = 3) -> DataFrame:
    """(id, fp): one row per document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter(
                (fingerprint(t.as_py(), words) for t in b.column(1)), np.uint64, b.num_rows
            ).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long")


def _blocks(max_bits: int) -> list[int]:
    """Masks that split 64 bits into max_bits + 3 blocks."""
    n = max_bits + 3
    edges = [round(i * 64 / n) for i in range(n + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivot_table(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, dist): Hamming distances of every block of a fingerprint to the same block of each pivot.

    Pivots are fixed pseudo-random references; ``dist[b]`` is an array of
    PIVOTS small numbers.  The sum over blocks is the distance to the pivot.
    """
    pivots = [_signed(xxhash.xxh64_intdigest(f"pivot {i}", 7)) for i in range(PIVOTS)]
    blocks = [_signed(m) for m in _blocks(max_bits)]
    dist = F.array(*[
        F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(m))).cast("tinyint") for p in pivots])
        for m in blocks
    ])
    return fps.select("fp", dist.alias("dist"))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) edges whose components are those of all pairs of at most ``max_bits`` differing bits.

    Two such fingerprints agree in at least three of max_bits + 3 blocks, so
    their block distances to every pivot agree there: these rows of the table
    are the candidate key.  A candidate pair is discarded when its distances to
    any pivot differ by more than ``max_bits`` (triangle inequality) and
    verified by counting bits.  A bucket over PAIR_BUCKET does not list its
    pairs; with two bits its members meet at the fingerprints one bit away, which
    joins exactly the pairs at distance two or less (the node in between may be
    no document).  With another ``max_bits`` large buckets are compared
    in full.  ``fps``: distinct column fp.
    """
    blocks = max_bits + 3
    table = cut(pivot_table(fps, max_bits), "pivots")
    sets = list(combinations(range(blocks), 3))
    keys = F.array(*[
        F.xxhash64(F.lit(i), *[F.col("dist")[b] for b in s]) for i, s in enumerate(sets)
    ])
    total = F.transform(
        F.sequence(F.lit(0), F.lit(PIVOTS - 1)),
        lambda p: F.aggregate("dist", F.lit(0), lambda s, d: s + F.get(d, p).cast("int")).cast("tinyint"),
    )
    rows = table.select("fp", total.alias("far"), F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = cut(rows, "keyed")
    met = cut(hot_join(rows, cut(sizes, "sizes"), "key", "_n"), "buckets")
    few = met if max_bits != 2 else met.where(F.col("_n") <= PAIR_BUCKET)
    x, y = few.alias("x"), few.alias("y")
    near = F.aggregate(
        F.zip_with("x.far", "y.far", lambda p, q: F.abs(p.cast("int") - q)), F.lit(0),
        lambda most, d: F.greatest(most, d),
    )
    pairs = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")))
        .where(near <= max_bits)
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .distinct()
    )
    if max_bits != 2:
        return pairs
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    steps = (
        met.where(F.col("_n") > PAIR_BUCKET).select("fp").distinct()
        .select("fp", F.explode(flips).alias("bit"))
        .select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("bit")).alias("b"))
    )
    shared = steps.groupBy("b").agg(F.min("a").alias("first"), F.max("a").alias("last")).where("first <> last")
    hubs = steps.join(shared.select("b"), "b").select("a", "b")
    return pairs.union(hubs)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over linked fingerprints.

    One row per input row.  Null and empty texts have fingerprint zero and link
    like any other.  Null ids take part but never name a component unless all
    its ids are null; equal texts share a fingerprint and need no pair.
    """
    marks = cut(fingerprints(docs, id_col, text_col, words), "fingerprints")
    known = marks.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("_w"))
    known = cut(known, "known")
    roots = components(cut(links(known.select("fp"), max_bits), "bits")).select(
        F.col("node").alias("fp"), "root"
    )
    classes = cut(known.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("_c"))
    named = hot_join(classes, cut(least, "least"), "root", "_c").select("fp", "component", "_w")
    return hot_join(marks, cut(named, "named"), "fp", "_w").select("id", "fp", "component")
