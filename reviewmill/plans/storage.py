"""Where intermediate tables go, and how a long lineage is cut.

Executors can be lost at any time, so nothing here relies on executor-local
blocks: an intermediate result is written as Parquet into the shared folder the
cluster names in ``spark.checkpoint.dir`` and read back.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    A session that names none gets a temporary one only when it runs inside a
    single machine; on a cluster that is an error rather than a guess.
    """
    named = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_KEY} to a folder every executor can reach")
    named = tempfile.mkdtemp(prefix="reviewmill-")
    spark.conf.set(_KEY, named)
    return named


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    The shuffle files of the write go when it ends; Spark alone would keep them
    until the driver happens to collect its garbage, beside those of the next.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``cut`` wrote, once all that was made of them is written as well.

    Spark drops the shuffle files of finished plans when the driver collects
    its garbage; a driver with little to do is asked to here.
    """
    spark = SparkSession.active()
    time.sleep(1)  # the listeners told of a write's end hold its plan a moment longer
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.java.lang.System.gc()
