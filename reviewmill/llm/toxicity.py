"""Toxicity grades by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.llm import grams
from reviewmill.llm.subword import sample

BUCKETS = 1 << 20
PREFIXES = (4, 5)


def features(points: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document number) of lower-case words and of their first letters, repeats included."""
    gap = ~grams.letters(points)
    gap[0] = gap[-1] = True
    starts, ends = grams.spans(gap)
    out = [grams.span_hash(points, starts, ends) * np.uint64(3)]
    for i, n in enumerate(PREFIXES):
        longer = ends - starts > n
        h = grams.span_hash(points, starts, np.minimum(ends, starts + n)) * np.uint64(3) + np.uint64(i + 1)
        out.append(h[longer])
        starts_doc = doc[starts]
        out.append(starts_doc[longer])
    ids = np.concatenate([out[0], *out[1::2]]) % np.uint64(BUCKETS)
    docs = np.concatenate([doc[starts], *out[2::2]])
    return ids.astype(np.int64), docs


def distinct(texts: list[str | None], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document number, bucket) of whole texts; ``keep``: only buckets where it is not zero."""
    pairs = [np.zeros(0, np.int64)]
    for where, parts in grams.slices([(t or "").lower() for t in texts]):
        ids, docs = features(*grams.codes(where, parts))
        if keep is not None:
            at = keep[ids] != 0
            ids, docs = ids[at], docs[at]
        pairs.append(np.unique(docs * BUCKETS + ids))
    both = np.unique(np.concatenate(pairs))
    return both // BUCKETS, both % BUCKETS


@dataclass
class Model:
    weights: np.ndarray  # one per bucket, shared by all thresholds
    cuts: np.ndarray  # ascending: P(grade > j) = sigmoid(x . w - cuts[j])

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > j) per text and threshold."""
        doc, ids = distinct(texts, self.weights)
        total = np.bincount(doc, self.weights[ids], len(texts))
        return 1 / (1 + np.exp(-(total[:, None] - self.cuts[None, :])))


def train(
    texts: list[str | None], grades: np.ndarray, epochs: int = 8, rate: float = 0.5, shrink: float = 1e-3,
    seed: int = 1,
) -> Model:
    """Minibatch AdaGrad on the ordinal log-likelihood with an L1 proximal step, which keeps weights sparse.

    The cuts are a first value and positive steps, so they stay ordered.
    """
    grades = np.asarray(grades)
    top = max(1, int(grades.max(initial=0)))
    doc, ids = distinct(texts)
    used, at = np.unique(ids, return_inverse=True)
    seen = np.bincount(at, minlength=len(used))
    rare = seen[at] < 5  # a word of a few documents says nothing general
    doc, at = doc[~rare], at[~rare]
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    rng = np.random.default_rng(seed)
    w, gw = np.zeros(len(used)), np.full(len(used), 1e-6)
    first, steps = 1.0, np.ones(top - 1)
    g1, gs = 1e-6, np.full(top - 1, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), 64):
            batch = order[low : low + 64]
            cols = np.concatenate([at[starts[i] : starts[i + 1]] for i in batch])
            row = np.repeat(np.arange(len(batch)), [starts[i + 1] - starts[i] for i in batch])
            z = np.bincount(row, w[cols], len(batch))
            cuts = np.concatenate([[first], first + np.cumsum(steps)])
            y = grades[batch]
            # P(y) = S(upper - z) - S(lower - z); its log's slope in z is S(upper - z) + S(lower - z) - 1, negated
            upper = np.where(y < top, cuts[np.minimum(y, top - 1)], np.inf)
            lower = np.where(y > 0, cuts[np.maximum(y - 1, 0)], -np.inf)
            with np.errstate(over="ignore"):
                su, sl = 1 / (1 + np.exp(z - upper)), 1 / (1 + np.exp(z - lower))
            p = np.maximum(su - sl, 1e-9)
            du, dl = su * (1 - su) / p, sl * (1 - sl) / p
            dz = (du - dl) / len(batch)  # slope of the loss in z
            grad = np.bincount(cols, dz[row], len(w))
            hit = np.unique(cols)
            gw[hit] += grad[hit] ** 2
            speed = rate / np.sqrt(gw[hit])
            moved = w[hit] - speed * grad[hit]
            w[hit] = np.sign(moved) * np.maximum(0, np.abs(moved) - speed * shrink)
            dcut = np.zeros(top)
            np.add.at(dcut, y[y < top], -du[y < top] / len(batch))
            np.add.at(dcut, y[y > 0] - 1, dl[y > 0] / len(batch))
            g1 += dcut.sum() ** 2
            first -= rate * dcut.sum() / np.sqrt(g1)
            for j in range(top - 1):
                d = dcut[j + 1 :].sum()
                gs[j] += d**2
                steps[j] = max(0.05, steps[j] - rate * d / np.sqrt(gs[j]))
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = np.where(np.abs(w) < 1e-3, 0, w)
    return Model(weights, np.concatenate([[first], first + np.cumsum(steps)]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = 6000) -> Model:
    """Grades 0, 1, 2 from binary labels on at most ``rows`` labelled documents.

    Toxic documents are split at the median of how strongly a first, binary fit
    of the same model speaks for them; the second fit learns both thresholds.
    """
    got = sample(docs, labels, id_col, text_col, "toxic", rows)
    texts, toxic = [r["text"] for r in got], np.array([r["_label"] for r in got], np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model(np.zeros(BUCKETS, np.float32), np.array([3.0, 4.0]) if not toxic.any() else np.array([-3.0, 3.0]))
    force = train(texts, toxic).above(texts)[:, 0]
    middle = np.median(force[toxic == 1])
    return train(texts, toxic + ((toxic == 1) & (force > middle)))


def grade(docs: DataFrame, text_col: str, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` with severity (expected grade), grade (most likely) and toxic (P(grade > 0) >= ``least``).

    Null and empty texts have no feature and get the severity of the cuts.
    Columns of these names are replaced.
    """
    names = ["severity", "grade", "toxic"]
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in names])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above = sent.value.above(b.column(text_col).to_pylist())
            full = np.hstack([np.ones((b.num_rows, 1)), above, np.zeros((b.num_rows, 1))])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(above.sum(axis=1)), pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1).astype(np.int32)),
                 pa.array(above[:, 0] >= least)],
                [*b.schema.names, *names],
            )

    fields = [T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))
