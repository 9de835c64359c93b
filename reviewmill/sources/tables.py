"""Tables that loads change together, on plain Parquet.

A store is a folder of tables whose rows are dealt to BUCKETS by a hash of
their key.  A load writes the buckets it changes under its own number,
``<table>/v=<number>/bucket=<bucket>``, and then one commit record that names,
per table and bucket, the number to read.  Readers follow the newest record
only, so a load that dies half way changes nothing; the next one takes the same
number and overwrites what is left of it.  A table in ``GROWING`` only takes new
rows: its numbers hold what their loads added, and it is all numbers up to the
record's.  A load may also add rows to buckets of another table; the record then
lists all numbers to read for them.  Loads of one store come one after the other; of two that overlap the
second fails when it commits.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import schemas
from reviewmill.operators.ingest import first_per_key

KEYS = {"place": "place_id", "users": "user_id", "review": "review_id"}
SCHEMAS = {"place": schemas.PLACE, "users": schemas.USERS, "review": schemas.REVIEW}
GROWING = {"review", "rows"}
BUCKETS = 64


class Snapshot(NamedTuple):
    """What a commit record says; ``epochs`` holds the last epoch applied per stream."""

    version: int
    tables: dict[str, list[int | list[int]]]
    epochs: dict[str, int]


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    update_cols: list[str],
    merge_lists: bool = False,
) -> DataFrame:
    """Rows of both sides; on a key in both, ``update_cols`` come from the batch.

    Both sides must be unique on ``keys``, which also rules out hot keys here.
    With ``merge_lists`` an updated array keeps the old entries in front.
    """
    t, b = target.alias("t"), batch.alias("b")
    match = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    out = []
    for field in target.schema:
        c = field.name
        old, new = F.col(f"t.{c}"), F.col(f"b.{c}")
        if c in keys:
            out.append(F.coalesce(old, new).alias(c))
        elif c not in update_cols:
            # an unchanged column of an existing row stays, also when it is null
            out.append(F.when(F.col("t._old").isNotNull(), old).otherwise(new).alias(c))
        elif merge_lists and field.dataType.typeName() == "array":
            both = F.array_distinct(F.concat(F.coalesce(old, F.array()), F.coalesce(new, F.array())))
            out.append(both.alias(c))
        else:
            out.append(F.when(F.col("b._new").isNotNull(), new).otherwise(old).alias(c))
    marked_t = target.withColumn("_old", F.lit(True)).alias("t")
    marked_b = batch.withColumn("_new", F.lit(True)).alias("b")
    return marked_t.join(marked_b, match, "full").select(*out)


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first batch row of every key the target lacks, in the target's columns."""
    fresh = first_per_key(batch, keys, order).select(*target.columns)
    return fresh.join(target.select(*keys), keys, "left_anti").select(*target.columns)


def replace_lists(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Users of ``batch`` with all their parts in place of all their old ones; a known user keeps the name."""
    names = old.groupBy("user_id").agg(F.min_by("name", "part").alias("_name"))
    new = batch.join(names, "user_id", "left").withColumn("name", F.coalesce("_name", "name")).select(*old.columns)
    return old.join(batch.select("user_id").distinct(), "user_id", "left_anti").select(*old.columns).unionByName(new)


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Target plus the first batch row of every key the target lacks."""
    return target.unionByName(new_rows(target, batch, keys, order))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, prefix: str, done: str | None = None) -> list[int]:
    """Numbers of the entries ``<prefix><number>`` of a folder, of those that hold ``done`` if given."""
    jvm, fs = _fs(spark, path)
    root = jvm.org.apache.hadoop.fs.Path(path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(prefix) and name[len(prefix) :].isdigit():
            if done is None or fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), done)):
                found.append(int(name[len(prefix) :]))
    return found


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest completely written version folder of a table, -1 when there is none."""
    return max(_numbers(spark, path, "v=", "_SUCCESS"), default=-1)


def snapshot(spark: SparkSession, base: str) -> Snapshot:
    """The newest commit record of a store; version -1 before the first."""
    newest = max(_numbers(spark, f"{base}/commits", "c"), default=-1)
    if newest < 0:
        return Snapshot(-1, {}, {})
    said = json.loads(spark.read.text(f"{base}/commits/c{newest}", wholetext=True).first()[0])
    return Snapshot(newest, said["tables"], said["epochs"])


def _commit(spark: SparkSession, base: str, new: Snapshot) -> None:
    """Write the record aside and rename it, so it is there whole or not at all."""
    jvm, fs = _fs(spark, base)
    place = jvm.org.apache.hadoop.fs.Path
    aside, to = place(f"{base}/commits/_new-{uuid.uuid4().hex}"), place(f"{base}/commits/c{new.version}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({"tables": new.tables, "epochs": new.epochs}).encode()))
    out.close()
    if fs.exists(to) or not fs.rename(aside, to):
        fs.delete(aside, False)
        raise RuntimeError(f"another load has committed version {new.version} of {base}")


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def touched(df: DataFrame, key: str) -> list[int]:
    """The buckets that hold a row of ``df``, BUCKETS at most."""
    return sorted(r[0] for r in df.select(bucket(key)).distinct().collect())


def _listed(said: int | list[int]) -> list[int]:
    """The numbers that a record names for a bucket; -1 stands for none."""
    return [v for v in (said if isinstance(said, list) else [said]) if v >= 0]


def read_store(
    spark: SparkSession, base: str, table: str, at: Snapshot | None = None, buckets: list[int] | None = None, schema: str | None = None
) -> DataFrame:
    """A table as the newest (or the given) record has it; ``buckets`` limits what is read."""
    at = snapshot(spark, base) if at is None else at
    schema = schema or SCHEMAS[table]
    wanted = set(range(BUCKETS)) if buckets is None else set(buckets)
    if table in GROWING:
        if at.version < 0 or not _numbers(spark, f"{base}/{table}", "v="):
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(f"{schema}, v int, bucket int").parquet(f"{base}/{table}").where(F.col("v") <= at.version)
        return (rows if buckets is None else rows.where(F.col("bucket").isin(sorted(wanted)))).drop("v", "bucket")
    numbers = [(b, v) for b, said in enumerate(at.tables.get(table, [])) for v in _listed(said) if b in wanted]
    paths = [f"{base}/{table}/v={v}/bucket={b}" for b, v in numbers]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_load(
    spark: SparkSession, base: str, at: Snapshot, tables: dict[str, DataFrame], keys: dict[str, str] = KEYS,
    buckets: dict[str, list[int]] | None = None, epoch: tuple[str, int] | None = None, adds: tuple[str, ...] = (),
) -> Snapshot:
    """Write ``tables`` as the load after ``at`` and commit them together.

    A table that is not growing gives the whole new content of its ``buckets``
    (of all buckets it has rows in, if not named); one in ``adds`` gives rows to
    add to what its buckets hold.
    """
    version = at.version + 1
    state = dict(at.tables)
    for name, df in tables.items():
        dealt = df.withColumn("bucket", bucket(keys[name])).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/{name}/v={version}")
        if name not in GROWING:
            mine = _numbers(spark, f"{base}/{name}/v={version}", "bucket=")
            old = state.get(name, [-1] * BUCKETS)
            if name in adds:
                state[name] = [[*_listed(v), version] if b in mine else v for b, v in enumerate(old)]
                continue
            state[name] = [version if b in mine else -1 if b in (buckets or {}).get(name, []) else v for b, v in enumerate(old)]
    epochs = at.epochs if epoch is None else {**at.epochs, epoch[0]: epoch[1]}
    new = Snapshot(version, state, epochs)
    _commit(spark, base, new)
    return new


def store_rows(base: str, **tables: DataFrame) -> Snapshot:
    """Replace the given tables of a store (add to growing ones) in one load."""
    spark = next(iter(tables.values())).sparkSession
    every = {name: list(range(BUCKETS)) for name in tables}
    return write_load(spark, base, snapshot(spark, base), tables, buckets=every)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of a store by its folder, empty when it does not exist yet; without records, its newest complete version."""
    base, name = path.rstrip("/").rsplit("/", 1)
    at = snapshot(spark, base)
    if at.version >= 0:
        return read_store(spark, base, name, at, schema=schema)
    version = latest_version(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/v={version}") if version >= 0 else spark.createDataFrame([], schema)


def read_reviews(spark: SparkSession, base: str) -> DataFrame:
    return read_store(spark, base, "review")


def write_version(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write the next version (or the given one, again if it was cut short) of a table that stands alone."""
    if version is None:
        version = latest_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return version
