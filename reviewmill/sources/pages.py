"""Raw pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.pages import decode_body


def read_pages(spark: SparkSession, path: str, body: str = "html") -> DataFrame:
    """(page_id, url, html); a binary body is decoded, bad bytes dropped."""
    df = spark.read.parquet(path)
    if df.schema[body].dataType.typeName() == "binary":
        df = df.withColumn(body, decode_body(body))
    return df.select("page_id", "url", F.col(body).alias("html"))
