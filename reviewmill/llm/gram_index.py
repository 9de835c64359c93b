"""Spelling variants of words, found through an index of variable-length grams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.plans.skew import broadcast_if_small
from reviewmill.plans.storage import cut, discard

RUN = "[A-Za-zÀ-ÿ]"
# Lengths of grams in code points.
SHORTEST, LONGEST = 2, 5
# Most grams that may be called frequent; the frequency asked for rises with the vocabulary to keep to it.
FREQUENT = 100_000
LEAST_FREQUENT = 16
# Words of a list that one join key may hold before the list is dealt to several.
LIST = 2_000
# Outside the alphabet, so a gram at the edge of a word is no gram of its inside.
BEFORE, AFTER = "\x02", "\x03"


def occurrences(docs: DataFrame, id_col: str, text_col: str, least: int = 5, every: int = 97) -> DataFrame:
    """(word): the runs of letters of whole texts with A-Z in lower case, one row per occurrence.

    With h the crc32 of ``<id>:<run>``, runs where ``every`` divides h lose the
    code point h % length.  Results under ``least`` code points go.  Null texts
    have no words, a null id is written as nothing.
    """
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(low, F.lit(f"{RUN}{{{least},}}"), F.lit(0))).alias("_run"),
    )
    h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    at = (F.col("_h") % F.length("_run")).cast("int")
    less = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    word = F.when(F.col("_h") % every == 0, less).otherwise(F.col("_run"))
    return runs.withColumn("_h", h).select(word.alias("word")).where(F.length("word") >= least)


def counted(words: DataFrame, least: int = 3) -> DataFrame:
    """(word, n) of the words with at least ``least`` occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def padded(word: Column) -> Column:
    return F.concat(F.lit(BEFORE * (LONGEST - 1)), word, F.lit(AFTER * (LONGEST - 1)))


def frequent_grams(vocab: DataFrame) -> dict[str, int]:
    """Occurrences in the vocabulary of the grams that are frequent, FREQUENT at most.

    The beginnings of a frequent gram are frequent too.  With G grams of one
    length a gram must occur more than G * lengths / FREQUENT times, which
    bounds the dictionary by arithmetic.
    """
    size = vocab.agg(F.coalesce(F.sum(F.length("word") + (LONGEST - 1)), F.lit(0))).first()[0]
    lengths = LONGEST - SHORTEST + 1
    least = max(LEAST_FREQUENT, -(-size * lengths // FREQUENT))
    places = F.sequence(F.lit(1), F.length("word") + (LONGEST - 1))
    grams = F.flatten(F.transform(places, lambda p: F.transform(
        F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda q: F.substring(F.col("_long"), p, q)
    )))
    found = vocab.select("word", padded(F.col("word")).alias("_long")).select(F.explode(grams).alias("gram"))
    return dict(map(tuple, found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).collect()))


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """(place, gram): at every place the shortest gram that is not frequent, LONGEST code points at most."""
    text = BEFORE * (LONGEST - 1) + word + AFTER * (LONGEST - 1)
    out = []
    for p in range(len(word) + LONGEST - 1):
        q = SHORTEST
        while q < LONGEST and text[p : p + q] in frequent:
            q += 1
        out.append((p, text[p : p + q]))
    return out


def affected(grams: list[tuple[int, str]], edits: int = 1) -> int:
    """Most grams that ``edits`` changes of one code point can change.

    A gram depends on its own code points only, so a change at a place touches
    the grams that cover it, and an insertion those on both its sides.
    """
    cover = [0] * (len(grams) + LONGEST + 1)
    for p, g in grams:
        for i in range(p, p + len(g)):
            cover[i] += 1
    return min(len(grams), sum(sorted(cover, reverse=True)[:edits]))


def _postings(vocab: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(word, n, size, gram, place, elements, bound), one row per list that has to be merged for the word.

    Two words at one edit share all but the affected grams of either, in one
    order and at places that differ by the edit at most.  So among any
    ``affected + 1`` grams of each, rarest first, there is a common one: only
    those are listed.  ``elements`` are all grams, a second occurrence being an
    element of its own.
    """
    known = vocab.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = known.value
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int32()]
        names = ["word", "n", "size", "gram", "place", "elements", "bound"]
        for b in batches:
            out: list[list] = [[] for _ in kinds]
            for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
                grams = decompose(word, often)
                times: dict[str, int] = {}
                elements = set()
                for _, g in grams:
                    times[g] = times.get(g, 0) + 1
                    elements.add(xxhash.xxh32_intdigest(g.encode(), times[g]) - (1 << 31))
                reach = affected(grams)
                rarest = sorted((often.get(g, 0), xxhash.xxh64_intdigest(g.encode()), p) for p, g in grams)[: reach + 1]
                every = list(elements)
                # elements of one number count once, so they must not be asked for twice
                bound = len(every) - reach
                for _, g, p in rarest:
                    for col, value in zip(out, (word, n, len(word), g - (1 << 63), p, every, bound), strict=True):
                        col.append(value)
                if len(out[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return vocab.select("word", "n").mapInArrow(
        run, "word string, n long, size int, gram long, place int, elements array<int>, bound int"
    )


def near_pairs(vocab: DataFrame, list_size: int = LIST) -> DataFrame:
    """(a, n_a, b, n_b): every two words of (word, n) that differ by one inserted, deleted or replaced code point, once.

    Lists are split by length and place: words of one length share a gram at one
    place, a word one longer has it there or one place on.  A list of more than
    ``list_size`` words is dealt on its first side to several keys, and its
    second side repeated for each.  Candidates must share as many elements as
    the larger of their two bounds and are then compared exactly.
    """
    lists = cut(_postings(vocab, frequent_grams(vocab)), "lists")
    key = lambda size, place: F.xxhash64("gram", size, place)
    left = lists.withColumn("key", key(F.col("size"), F.col("place")))
    long = left.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > list_size)
    parts = cut(long.select("key", F.ceil(F.col("_n") / list_size).cast("int").alias("parts")), "parts")
    known = broadcast_if_small(parts)
    count = F.coalesce("parts", F.lit(1))
    left = left.join(known, "key", "left").select(
        "key", F.pmod(F.xxhash64("word"), count).cast("int").alias("part"), F.col("word").alias("a"),
        F.col("n").alias("n_a"), F.col("elements").alias("_ea"), F.col("bound").alias("_ba"),
    )
    shorter = F.col("size") - 1
    keys = [key(F.col("size"), F.col("place")), key(shorter, F.col("place")), key(shorter, F.col("place") - 1)]
    right = lists.select("*", F.posexplode(F.array(*keys)).alias("_way", "key")).join(known, "key", "left").select(
        "key", F.explode(F.sequence(F.lit(0), count - 1)).alias("part"), F.col("word").alias("b"), F.col("n").alias("n_b"),
        F.col("elements").alias("_eb"), F.col("bound").alias("_bb"), (F.col("_way") == 0).alias("_same"),
    )
    met = left.join(right, ["key", "part"]).where(~F.col("_same") | (F.col("a") < F.col("b")))
    shared = F.size(F.array_intersect("_ea", "_eb")) >= F.greatest("_ba", "_bb")
    verified = met.where(shared).where(F.levenshtein("a", "b", 1) == 1)
    out = cut(verified.select("a", "n_a", "b", "n_b").distinct(), "near")
    discard(lists, parts)
    return out


def variants(vocab: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of (word, n).

    ``form`` is the near word of largest n, ties to the first in code points, if
    that n is at least twice the word's.  ``root`` follows forms to the last:
    as n doubles at each step there are under 64, and pointers that double
    their reach meet the end in six rounds.
    """
    vocab = cut(vocab, "vocabulary")
    pairs = near_pairs(vocab)
    side = lambda x, y: pairs.select(F.col(x).alias("word"), F.col(f"n_{x}").alias("_n"), F.col(y).alias("to"), F.col(f"n_{y}").alias("to_n"))
    each = side("a", "b").unionByName(side("b", "a")).groupBy("word", "_n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("to_n")).alias("less"), "to")).alias("_best")
    )
    best = cut(each.select(
        "word", "n_near", F.when(-F.col("_best.less") >= 2 * F.col("_n"), F.col("_best.to")).alias("form"),
        (-F.col("_best.less")).alias("form_n"),
    ), "forms")
    roots = best.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = cut(roots, "roots")
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if not ahead.join(further, "root", "left_semi").limit(1).count():
            break
        roots = ahead.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return (
        vocab.join(best, "word", "left").join(ahead, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"),
        )
    )
