"""Exact removal of repeated word runs by prefix-partitioned, depth-limited suffix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import grams
from reviewmill.llm.common import hot_join
from reviewmill.llm.mixing import ranked
from reviewmill.plans.storage import cut, discard

PREFIX = 8  # words of the first prefix
PIECE = 10_000  # rows sent on together
GROUP = 4096  # suffixes of a prefix that one tree may hold; beyond it the prefix is lengthened


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchors(texts: list[bytes], depth: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor, first window, last window, prefix hash) over whole texts.

    Of the PREFIX-word sequences in a window of ``depth`` words the one with the
    least hash (leftmost on a tie) is its anchor, so equal windows anywhere
    have equal anchors at the same place inside.  Neighbouring windows with the
    same anchor come as one row; places count words of the text.
    """
    n_texts = len(texts)
    joined = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    size = np.array([len(t) + 1 for t in texts])
    begin = np.concatenate([[1], 1 + np.cumsum(size)])[:n_texts]
    starts, ends = grams.spans(grams.blanks(joined))
    doc = np.searchsorted(begin, starts, "right") - 1
    base = np.searchsorted(starts, begin)
    windows = len(starts) - depth + 1
    none = np.zeros(0, np.int64)
    if windows <= 0:
        return none, none, none, none, none.astype(np.uint64)
    x = grams.span_hash(joined, starts, ends)
    g = grams.gram_hash(x, PREFIX)
    best, at = g[:windows].copy(), np.arange(windows)
    for k in range(1, depth - PREFIX + 1):
        later = g[k : k + windows]
        less = later < best
        best = np.where(less, later, best)
        at = np.where(less, np.arange(k, k + windows), at)
    inside = np.flatnonzero(doc[:windows] == doc[depth - 1 :])
    a = at[inside]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (inside[1:] != inside[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(a) - 1]]) if len(first) else first
    d = doc[a[first]]
    zero = base[d]
    return d, a[first] - zero, inside[first] - zero, inside[last] - zero, g[a[first]]


def _chunks(ids: Iterable, texts: Iterable, size: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    now, parts, total = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        now.append(i)
        parts.append(_bytes(t))
        total += len(parts[-1])
        if total >= size:
            yield now, parts
            now, parts, total = [], [], 0
    if now:
        yield now, parts


def _prefixes(docs: DataFrame, depth: int) -> DataFrame:
    """(key, id, pos): the anchors of all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _chunks(b.column(0).to_pylist(), b.column(1)
                                      .to_pylist()):
                d, a, _, _, key = anchors(texts, depth)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.array(ids, np.int64)[d]), pa.array(a.astype(np.int32))],
                    ["key", "id", "pos"],
                )

    return docs.mapInArrow(run, "key long, id long, pos int")


def _suffixes(docs: DataFrame, depth: int) -> DataFrame:
    """(key, id, pos, off, wins, words): the text around the anchors named in ``at``; ``wins`` windows begin in it.

    A prefix shared by at most GROUP anchors sends one row with all windows of
    the anchor; a more frequent one is lengthened to the whole window, so each
    window becomes a group of its own.
    """

    kinds = [("key", pa.int64()), ("id", pa.int64()), ("pos", pa.int32()), ("off", pa.int32()), ("wins", pa.int32()), ("words", pa.binary())]

    def batch(cols: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds, strict=True)], [n for n, _ in kinds])

    def columns(i: int, raw: bytes, found: list[np.ndarray], at: np.ndarray, n: np.ndarray) -> Iterator[list[list]]:
        """The columns of one text's rows, at most PIECE places at a time."""
        words = raw.split()
        line = b" ".join(words)
        edge = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        cut_out = lambda first, end: [line[x:y] for x, y in zip(edge[first].tolist(), (edge[end] - 1).tolist(), strict=True)]
        anchor, low, high, key = found
        for first in range(0, len(at), PIECE):
            pos, often = at[first : first + PIECE], n[first : first + PIECE] > GROUP
            place = np.minimum(np.searchsorted(anchor, pos), len(anchor) - 1)
            here = anchor[place] == pos  # else the id is on a row with another text
            p = place[here & ~often]
            lo, hi = low[p], high[p]
            yield [key[p].tolist(), [i] * len(p), anchor[p].tolist(), (anchor[p] - lo).tolist(), (hi - lo + 1).tolist(), cut_out(lo, hi + depth)]
            for q in place[here & often]:
                w = np.arange(low[q], high[q] + 1)
                lines = cut_out(w, w + depth)
                ones = [1] * len(w)
                yield [[xxhash.xxh64_intdigest(x, 1) - (1 << 63) for x in lines], [i] * len(w), w.tolist(), [0] * len(w), ones, lines]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = b.column("id").to_pylist(), b.column("at")
            edge = lists.offsets.to_numpy()
            pos, n = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "n"))
            out: list[list] = [[] for _ in kinds]
            for rows, texts in _chunks(range(b.num_rows), (t.as_py() for t in b.column("text")), 1 << 18):
                doc, *found = anchors(texts, depth)
                found[-1] = found[-1].view(np.int64)
                own = np.searchsorted(doc, np.arange(len(texts) + 1))
                for k, (row, raw) in enumerate(zip(rows, texts, strict=True)):
                    if own[k] == own[k + 1]:
                        continue
                    its = slice(edge[row], edge[row + 1])
                    for cols in columns(ids[row], raw, [x[own[k] : own[k + 1]] for x in found], pos[its], n[its]):
                        for whole, more in zip(out, cols, strict=True):
                            whole += more
                        if len(out[0]) > PIECE:
                            yield batch(out)
                            out = [[] for _ in kinds]
            yield batch(out)

    return docs.mapInArrow(run, "key long, id long, pos int, off int, wins int, words binary")


def shared_words(a: bytes, b: bytes) -> int:
    """Words that two suffixes have in common from their start; a blank ends every word, the last one too."""
    if b.startswith(a) or a.startswith(b):
        return min(a, b, key=len).count(b" ")
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return a.count(b" ", 0, int(differ[0]) if len(differ) else n)


def deep_nodes(suffixes: list[bytes], heads: list[int], depth: int) -> list[tuple[int, int, int]]:
    """(words, first, end) of the internal nodes at ``depth`` words or deeper over sorted suffixes.

    ``heads`` are the lengths of the first ``depth`` words, blank included.  The
    suffix tree is never built: a stack over the common beginnings of neighbours
    opens a node where they grow and closes it where they shrink.  Every node is
    a maximal repeat to the right, with the suffixes first to end - 1 as its
    leaves; nodes come after those below them.
    """
    nodes, stack = [], []
    for i in range(1, len(suffixes) + 1):
        common = 0
        if i < len(suffixes) and suffixes[i].startswith(suffixes[i - 1][: heads[i - 1]]):
            common = shared_words(suffixes[i - 1], suffixes[i])
        start = i - 1
        while stack and stack[-1][0] > common:
            words, start = stack.pop()
            nodes.append((words, start, i))
        if common >= depth and (not stack or stack[-1][0] < common):
            stack.append((common, start))
    return nodes


def tree_repeats(group: list[tuple], depth: int) -> list[int]:
    """For each (words, off, id, pos) of a prefix: bits of the windows that start earlier elsewhere.

    Windows are equal if their suffixes are leaves below one internal node of
    ``depth`` words or more.  Of the leaves of every topmost such node all but
    the earliest are marked.
    """
    masks = [0] * len(group)
    if len(group) == 1 and group[0][0].count(b" ") < depth:
        return masks
    suffixes = []
    for r, (line, off, i, pos) in enumerate(group):
        starts = [0, *accumulate(len(word) + 1 for word in line.split(b" "))]
        ends = starts[1:]
        line += b" "
        for w in range(len(ends) - depth + 1):
            suffixes.append((line[starts[w] :], i, pos - off + w, r, w, ends[w + depth - 1] - starts[w]))
    suffixes.sort()
    upto = len(suffixes)
    for _, first, end in reversed(deep_nodes([s[0] for s in suffixes], [s[5] for s in suffixes], depth)):
        if end > upto:  # below a node seen already
            continue
        upto = first
        leaves = suffixes[first:end]
        early = min(leaves, key=lambda s: s[1:3])
        for s in leaves:
            if s is not early:
                masks[s[3]] |= 1 << s[4]
    return masks


def _trees(texts: DataFrame, depth: int) -> DataFrame:
    """(ck, mask) of each distinct text; rows of a prefix come together, a tree holds one prefix at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("key", "ck", "words", "off", "id", "pos")), strict=True)

        cks, masks = [], []
        for _, group in groupby(lines(), key=lambda r: r[0]):
            members = list(group)
            cks += [m[1] for m in members]
            masks += tree_repeats([m[2:] for m in members], depth)
            if len(cks) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(cks, pa.binary()), pa.array(masks, pa.int64())], ["ck", "mask"])
                cks, masks = [], []
        yield pa.RecordBatch.from_arrays([pa.array(cks, pa.binary()), pa.array(masks, pa.int64())], ["ck", "mask"])

    dealt = texts.repartition("key").sortWithinPartitions("key")
    return dealt.select("key", "ck", "words", "off", "id", "pos").mapInArrow(run, "ck binary, mask long")


def repeated_windows(docs: DataFrame, depth: int = 20) -> DataFrame:
    """(id, starts): per document the first words of the windows of ``depth`` words that also start earlier.

    ``docs``: id (long), text.  ``starts`` is an array of (at, mask): bit w of
    mask names the window at word at + w.  Earlier is a smaller id, or a smaller
    place in the same text.
    """
    found = cut(_prefixes(docs, depth), "prefixes")
    counts = cut(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    at = cut(hot_join(found, counts, "key", "n").groupBy("id").agg(F.collect_set(F.struct("pos", "n")).alias("at")), "places")
    discard(found, counts)
    shared = cut(_suffixes(docs.join(at, "id"), depth).withColumn(
        "ck", F.unhex(F.md5(F.concat("words", F.lit(b" "), F.col("off").cast("string").cast("binary"))))
    ), "suffixes")
    discard(at)
    firsts = shared.groupBy("key", "ck").agg(
        F.min(F.struct("id", "pos")).alias("first"), F.count(F.lit(1)).alias("n"),
        F.any_value("words").alias("words"), F.any_value("off").alias("off"),
    )
    firsts = cut(firsts.select("key", "ck", "n", "words", "off", "first.*"), "distinct")
    discard()
    trees = cut(_trees(firsts, depth), "trees")
    discard()
    known = cut(firsts.select("ck", "n", F.col("id").alias("_id"), F.col("pos").alias("_pos")).join(trees, "ck"), "masks")
    discard(firsts, trees)
    each = shared.select("ck", "id", "pos", "off", F.col("wins").alias("_wins"))
    met = hot_join(each, known, "ck", "n")
    is_first = (F.col("id") == F.col("_id")) & (F.col("pos") == F.col("_pos"))
    full = F.expr("shiftleft(1L, _wins) - 1L")
    marks = cut(
        met.withColumn("mask", F.when(is_first, F.col("mask")).otherwise(full)).where("mask <> 0")
        .groupBy("id").agg(F.collect_set(F.struct((F.col("pos") - F.col("off")).alias("at"), "mask")).alias("starts")), "marks"
    )
    discard(shared, known)
    return marks


def _documents(given: DataFrame) -> DataFrame:
    """(id, own, text) with an ``id`` per document: the own id, or a number in its order where ids repeat with other texts."""
    marked = given.withColumn("_tk", F.xxhash64("text"))
    twice = marked.groupBy("own").agg((F.min("_tk") != F.max("_tk")).alias("twice")).where("twice")
    if not twice.limit(1).count():
        return given.withColumn("id", F.col("own"))
    names = marked.select("own", "_tk").distinct().withColumn("_by", F.struct("own", "_tk"))
    numbers = ranked(names, "_by").select("own", "_tk", F.col("rank").alias("id"))
    return cut(marked.join(numbers, ["own", "_tk"]).drop("_tk"), "documents")


def covered(at: int, mask: int, depth: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the words under the windows that a mask names, those of neighbouring bits as one."""
    while mask:
        least = mask & -mask
        upper = mask + least  # a carry in place of the lowest run of ones
        first = at + least.bit_length() - 1
        yield first, first + ((upper & -upper) // least).bit_length() - 2 + depth
        mask &= upper


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 20) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the words left, joined by one blank) and repeats.

    ``repeats`` lists the maximal removed runs as (start, end) in words, end
    exclusive.  Null texts have no words; texts under ``depth`` words lose
    none.  A null id counts as the smallest.  Rows that repeat an id and text
    are one document, so neither makes the other lose words; rows of one id with
    different texts are different documents, in the order of a hash of the text.
    """
    least = F.lit(-(1 << 63)).cast("long")
    given = docs.select(F.coalesce(F.col(id_col).cast("long"), least).alias("own"), F.col(text_col).alias("text"))
    named = _documents(given)
    marks = repeated_windows(named.select("id", "text"), depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), kind]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["id", "n_words", "n_removed", "kept", "repeats"],
            )

        for b in batches:
            done: list[tuple] = []
            size = 0
            lists = b.column("starts")
            edge, known = lists.offsets.to_numpy(), lists.is_valid().to_pylist()
            at_all, masks = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "mask"))
            for row in range(b.num_rows):
                i, text = (b.column(c)[row].as_py() for c in ("id", "text"))
                its = slice(edge[row], edge[row + 1] if known[row] else edge[row])
                words = _bytes(text).split()
                n, runs = len(words), []
                for begin, end in sorted(
                    x for at, mask in zip(at_all[its].tolist(), masks[its].tolist(), strict=True) for x in covered(at, mask, depth)
                ):
                    end = min(end, n)
                    if runs and begin <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    elif begin < n:
                        runs.append([begin, end])
                left, at = [], 0
                for begin, end in runs:
                    left += words[at:begin]
                    at = end
                left += words[at:]
                kept = b" ".join(left).decode("utf-8", "replace")
                done.append((i, n, n - len(left), kept, [{"start": s, "end": e} for s, e in runs]))
                size += len(kept)
                if size >= 4 << 20 or row + 1 == b.num_rows:
                    yield batch(done)
                    done, size = [], 0

    out = named.join(marks, "id", "left").select(F.col("own").alias("id"), "text", "starts").mapInArrow(
        run, "id long, n_words long, n_removed long, kept string, repeats array<struct<start:int,end:int>>"
    )
    return out.withColumn("id", F.when(F.col("id") != least, F.col("id")))


def brute(rows: list[tuple[int, str | None]], depth: int = 20) -> dict[int, tuple[int, int, str]]:
    """The definition, for tests: id -> (words, removed, sha256 of what is left)."""
    seen: set[tuple] = set()
    out = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = _bytes(text).split()
        gone: set[int] = set()
        for at in range(len(words) - depth + 1):
            window = tuple(words[at : at + depth])
            if window in seen:
                gone.update(range(at, at + depth))
            seen.add(window)
        left = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(left).hexdigest())
    return out
