"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import grams

BUCKETS = 1 << 18
LENGTHS = (3, 4)


def features(points: np.ndarray, doc: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document number) of every word and of every n-gram inside " word ", repeats included."""
    gap = grams.blanks(points)
    starts, ends = grams.spans(gap)
    ids, docs = [grams.span_hash(points, starts, ends) % np.uint64(buckets)], [doc[starts]]
    for n in LENGTHS:
        h = grams.gram_hash(points, n)
        inside = ~gap[1 : 1 + len(h)]
        for k in range(2, n - 1):
            inside &= ~gap[k : k + len(h)]
        at = np.flatnonzero(inside)
        ids.append(h[at] % np.uint64(buckets))
        docs.append(doc[at + 1])
    return np.concatenate(ids).astype(np.int64), np.concatenate(docs)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dims
    weights: np.ndarray  # dims x classes
    bias: np.ndarray

    def per_bucket(self) -> np.ndarray:
        """What a feature adds to logit 1 minus logit 0, before averaging: the softmax only needs this."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)

    def scores(self, texts: list[str | None], share: np.ndarray | None = None) -> np.ndarray:
        """Probability of class 1 of whole texts; an empty text gets that of the bias."""
        share = self.per_bucket() if share is None else share
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for where, parts in grams.slices(texts):
            ids, docs = features(*grams.codes(where, parts), len(share))
            total += np.bincount(docs, share[ids], len(texts))
            count += np.bincount(docs, minlength=len(texts))
        logit = total / np.maximum(count, 1) + self.bias[1] - self.bias[0]
        return 1 / (1 + np.exp(-logit))


def train(
    texts: list[str | None], labels: list[int], buckets: int = BUCKETS, dims: int = 8, epochs: int = 6,
    rate: float = 30.0, seed: int = 1,
) -> Model:
    """Stochastic gradient descent over documents, the rate falling to zero.

    The gradient of a feature is that of the mean, so it carries the feature's
    share of the document; hence the large rate.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dims, 1 / dims, (buckets, dims)).astype(np.float32)
    weights, bias = np.zeros((dims, 2), np.float32), np.zeros(2, np.float32)
    rows = []
    for text in texts:
        seen = np.zeros(0, np.int64)
        for where, parts in grams.slices([text]):
            seen = np.concatenate([seen, features(*grams.codes(where, parts), buckets)[0]])
        ids, n = np.unique(seen, return_counts=True)
        rows.append((ids.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, share = rows[i]
            now = 1 - done / steps
            done += 1
            mean = share @ vectors[ids]
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            down = weights @ p
            weights -= 0.2 * now * np.outer(mean, p)
            bias -= 0.05 * now * p
            vectors[ids] -= rate * now * np.outer(share, down)
    return Model(vectors, weights, bias)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, rows: int) -> list:
    """At most ``rows`` labelled texts, those of the smallest hashed ids, brought to the driver for training.

    Only labels are ranked; ``rows`` ids are broadcast to pick the texts.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col).agg(
        F.min(label).cast("int").alias("_label")
    )
    picked = known.orderBy(F.xxhash64(id_col), id_col).limit(rows)
    texts = docs.select(id_col, text_col).join(F.broadcast(picked), id_col)
    got = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "_label").collect()
    got.sort(key=lambda r: (r["id"], r["text"] or ""))  # the same order on every run
    return got


def score(docs: DataFrame, text_col: str, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the probability of class 1 in ``out`` (replaced if there already)."""
    share, bias = model.per_bucket(), model.bias
    sent = docs.sparkSession.sparkContext.broadcast((share, bias))
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c != out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, bias = sent.value
        light = Model(np.zeros((0, 0)), np.zeros((0, 2)), bias)
        for b in batches:
            values = light.scores(b.column(text_col).to_pylist(), share)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values)], [*b.schema.names, out])

    schema = kept.limit(0).withColumn(out, F.lit(0.0)).schema
    return kept.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 5000) -> Model:
    """Train on at most ``rows`` labelled documents outside the held-out fifth (crc32 of the id modulo 5 is 0)."""
    seen = labels.where(F.crc32(F.col(id_col).cast("string")) % 5 != 0)
    got = sample(docs, seen, id_col, text_col, "quality", rows)
    return train([r["text"] for r in got], [r["_label"] for r in got])
