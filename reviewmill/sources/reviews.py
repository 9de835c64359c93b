"""Review exports as CSV, and the append-only review store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill import schemas
from reviewmill.plans.skew import broadcast_if_small
from reviewmill.plans.storage import cut


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, row, record): the records of CSV files in file order from row 0, quoted line ends inside them kept.

    Files are read as lines, so one file is read by as many tasks as it has
    blocks.  A line begins a record where the quotes before it in the file are
    even in number.  Every block counts its quotes, and its record starts for
    both cases, on its own; one row per block then says which case it is, how
    many records came before, and which record reaches into it.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    inside = W.partitionBy("file", "block").orderBy("at")
    odd = F.coalesce(F.sum("quotes").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2
    local = cut(lines.withColumn("odd", odd.cast("int")), "lines")
    blocks = local.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.count_if(F.col("odd") == 0).alias("even"), F.count_if(F.col("odd") == 1).alias("uneven")
    )
    order = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.withColumn("flip", (F.coalesce(F.sum("quotes").over(order), F.lit(0)) % 2).cast("int"))
    before = before.withColumn("starts", F.when(F.col("flip") == 0, F.col("even")).otherwise(F.col("uneven")))
    numbered = cut(
        before.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "flip", F.coalesce(F.sum("starts").over(order), F.lit(0)).alias("_first")),
        "blocks",
    )
    placed = local.join(broadcast_if_small(numbered), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    starts = (F.col("odd") == F.col("flip")).cast("int")
    # a line that starts nothing belongs to the record before it, also to one of an earlier block
    row = F.col("_first") + F.sum(starts).over(inside.rowsBetween(W.unboundedPreceding, 0)) - 1
    pieces = placed.withColumn("row", row).groupBy("file", "row").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("_l"))
    text = F.array_join(F.transform("_l", lambda x: x["value"]), "\n")
    clean = F.regexp_replace(text, r"\r\z", "")
    return pieces.select("file", "row", F.when(F.col("row") == 0, F.regexp_replace(clean, r"\A\ufeff", "")).otherwise(clean).alias("record"))


def _read_csv(spark: SparkSession, path: str, schema: str, header: bool, ordered: bool = False) -> DataFrame:
    """Rows of CSV files, and with ``ordered`` their ``_file`` and ``_row``; empty lines are no rows."""
    options = {"escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "multiLine": "true"}
    records = read_records(spark, path).where(F.col("record") != "")
    if header:
        records = records.where("row > 0")
    where = [F.col("file").alias("_file"), F.col("row").alias("_row")] if ordered else []
    return records.select(F.from_csv("record", F.lit(schema), options).alias("r"), *where).select("r.*", *(["_file", "_row"] if ordered else []))


def read_scraped_reviews(spark: SparkSession, path: str, header: bool = True, ordered: bool = False) -> DataFrame:
    return _read_csv(spark, path, schemas.SCRAPED_REVIEW, header, ordered)


def read_alt_reviews(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return _read_csv(spark, path, schemas.ALT_REVIEW, header)


def append_reviews(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add flattened reviews to the store; CSV files carry no header line."""
    writer = df.write.mode("append")
    if fmt == "csv":
        # the writer trims fields unless told not to
        writer.option("header", False).option("escape", '"').option(
            "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
        ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        writer.format(fmt).save(path)
