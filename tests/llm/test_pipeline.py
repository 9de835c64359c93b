"""The stages on odd tables: null ids and texts, repeated rows, clashing columns, no rows."""

import collections

import pytest

pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASH = ["_score", "_key", "_hash", "_base", "_spans", "_copy", "_times", "times", "id", "size", "score", "ids", "n_tokens"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    none = lambda c, t: F.lit(None).cast(t)
    rows = docs.unionByName(docs.limit(5)).unionByName(docs.limit(4).withColumn("doc_id", none("doc_id", "long")))
    rows = rows.unionByName(docs.limit(3).withColumn("text", none("text", "string"))).unionByName(docs.limit(3).withColumn("text", F.lit("")))
    rows = rows.unionByName(docs.limit(2).withColumn("source", none("source", "string"))).unionByName(docs.limit(2).withColumn("text", F.lit("other text")))
    return rows.withColumns({c: F.lit(i) for i, c in enumerate(CLASH)})


def counted(df):
    return collections.Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, odd, name):
    got = STAGES[name](spark, odd, SF)
    if name.startswith("byte"):
        assert got.count() == odd.count() and got.where("n_tokens is null").count() == 0
        return
    assert got.columns == odd.columns
    before, after = counted(odd), counted(got)
    if name == "secret scans":
        assert got.count() == odd.count()
        assert after.keys() - before.keys() <= {r for r in after if "[SECRET]" in (r[odd.columns.index("text")] or "")}
        return
    assert after.keys() <= before.keys()
    if name == "quality classifier":
        assert all(n == before[r] for r, n in after.items())
    elif name == "SimHash near-dedup":
        assert all(n == 1 for n in after.values())
        texts = [r[odd.columns.index("text")] for r in after]
        assert len(set(texts)) == len(texts) and sum(not t for t in texts) == 1
    else:
        assert all(n <= 2 * before[r] for r, n in after.items())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_no_rows(spark, odd, name):
    assert STAGES[name](spark, odd.limit(0), SF).count() == 0
