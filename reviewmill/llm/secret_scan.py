"""Secrets in text: fixed patterns, and strings that look random to character Markov models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import let

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run is 18 or more characters or no match at all
HEX = r"[0-9a-f]{16,}"
# What the Markov models look at, and what they learn from.
CANDIDATE = r"[A-Za-z0-9][A-Za-z0-9+/_-]{14,}[A-Za-z0-9]"
TOKEN = r"[A-Za-z0-9][A-Za-z0-9+/_-]{6,}[A-Za-z0-9]"
CODES = 128
SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string>>"


def matches(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """All matches as spans in code points, end exclusive: summed lengths of matches and of what is between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return let(gaps, lambda g: F.aggregate(
            F.sequence(F.lit(0), F.size(m) - 1),
            F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("out")),
            lambda s, i: let(s["at"] + F.length(F.get(g, i)), lambda start: let(start + F.length(F.get(m, i)), lambda end: F.struct(
                end.alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"),
                    F.get(m, i).alias("value"),
                ))).cast(SPAN).alias("out"),
            ))),
            lambda s: s["out"],
        ))

    return let(found, lambda m: F.when(F.size(m) > 0, place(m)).otherwise(F.array().cast(SPAN)))


def base_spans(text: Column) -> Column:
    """Assignments with a value of 12 or more characters, access keys, hexadecimal runs; by start, then kind."""
    assign = F.filter(
        matches(text, ASSIGN, "assign", 0), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 12
    )
    return F.array_sort(F.concat(assign, matches(text, ACCESS, "access", 1), matches(text, HEX, "hex", 2)))


def codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.ascii(c))


def labelled(docs: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(token, label) from at most ``rows`` documents, those of the smallest hashed ids.

    Label 1: values the base patterns find; 0: other tokens of eight or more characters.
    """
    ids = docs.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(id_col), id_col).limit(rows)
    texts = docs.select(id_col, text_col).join(F.broadcast(ids), id_col).select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    value = lambda s: F.when(s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGN, 1)).otherwise(s["value"])
    secrets = texts.select(F.explode(F.transform(base_spans(F.col("t")), value)).alias("token"), F.lit(1).alias("label"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = texts.select(F.explode(F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0))).alias("token"), F.lit(0).alias("label"))
    return secrets.union(plain)


def train(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratios random / ordinary of each step between two characters (CODES * CODES values).

    Counts of character pairs per label are summed by Spark, over at most
    2 * CODES * CODES keys.  A class without samples counts as uniform.
    """
    pairs = samples.select("label", codes(F.col("token")).alias("c")).select(
        "label", F.explode(F.arrays_zip(F.col("c").alias("a"), F.slice("c", 2, F.size("c")).alias("b"))).alias("p")
    ).where("p.a < 128 and p.b < 128")
    got = pairs.groupBy("label", "p.a", "p.b").count().collect()
    count = {(r[0], r[1], r[2]): r[3] for r in got}
    seen: dict = {}
    for (label, a, _), n in count.items():
        seen[(label, a)] = seen.get((label, a), 0) + n
    width = 64 * smooth
    step = lambda label, a, b: math.log((count.get((label, a, b), 0) + smooth) / (seen.get((label, a), 0) + width))
    return [step(1, a, b) - step(0, a, b) for a in range(CODES) for b in range(CODES)]


def random_looking(value: Column, table: list[float], per_step: float, in_all: float) -> Column:
    """Whether the token is likelier random: ratio at least ``in_all`` and ``per_step`` times its steps."""
    ratios = F.array(*[F.lit(float(x)) for x in table])
    total = let(codes(value), lambda c: F.aggregate(
        F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0),
        lambda s, i: s + F.coalesce(F.get(ratios, F.get(c, i - 1) * CODES + F.get(c, i)), F.lit(0.0)),
    ))
    return let(total, lambda t: (t >= in_all) & (t >= per_step * (F.length(value) - 1)))


def scan(
    docs: DataFrame, text_col: str, table: list[float], per_step: float = 0.6, in_all: float = 14.0,
    base: str = "base", spans: str = "spans",
) -> DataFrame:
    """``docs`` with arrays of spans: ``base`` (fixed patterns) and ``spans`` (those and kind markov).

    A markov span is a candidate run the models call random and that overlaps no
    base span.  Null texts are empty; columns of these names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    both = let(text, lambda t: let(base_spans(t), lambda fixed: F.struct(
        fixed.alias("b"),
        F.array_sort(F.concat(fixed, F.filter(
            matches(t, CANDIDATE, "markov", 3),
            lambda s: ~F.exists(fixed, lambda f: (f["start"] < s["end"]) & (s["start"] < f["end"]))
            & random_looking(s["value"], table, per_step, in_all),
        ))).alias("a"),
    )))
    kept = docs.drop(base, spans, "_both")
    return kept.withColumn("_both", both).withColumns({base: F.col("_both.b"), spans: F.col("_both.a")}).drop("_both")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``; no span: unchanged, null stays."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    joined = F.aggregate(
        spans, start,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(
                x["start"] >= s["at"],
                F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark)),
            ).otherwise(s["out"]).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, joined).otherwise(text)
