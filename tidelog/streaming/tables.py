"""Tables that a stream keeps up to date: one row per key, merged batch by batch.

    <root>/bucket=.../generation=0|1/*.parquet

A key's bucket is a function of the key. A batch reads the buckets it has keys
of, merges, and writes them whole; other buckets are neither read nor written.
Every bucket has two generations, and a batch writes the one that does not
hold the bucket's state before it. So Spark's dynamic partition overwrite never
replaces what the same batch reads, a batch that failed half way finds the
state it started from when it runs again, and running it again changes
nothing. Stored rows are at most twice the keys.

A table belongs to one checkpoint, whose batch numbers order its generations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources import store

BUCKETS = 64
#: With more buckets to write, rows are dealt by bucket first: one more exchange,
#: but no file of every bucket from every task.
DIRECT_BUCKETS = 8
#: Days whose minutes share a bucket.
PERIOD_DAYS = 30
PLACED = "batch_id bigint, bucket int, generation int"


class OtherCheckpoint(RuntimeError):
    """The table was written by a stream that has another checkpoint."""


def hash_bucket(*keys: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def period_bucket(moment: str) -> Column:
    """For keys that are moments: a batch of recent ones touches a bucket or two."""
    return F.floor(F.unix_date(F.col(moment).cast("date")) / PERIOD_DAYS).cast("int")


def held(
    spark: SparkSession,
    root: str,
    schema: str,
    before: int | None = None,
    buckets: list[int] | None = None,
) -> DataFrame:
    """The rows as they are, or were before a batch, of some buckets or all."""
    rows = store.read_or_empty(spark, root, f"{schema}, {PLACED}")
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    newest = rows.groupBy("bucket").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(newest, ["bucket", "batch_id"])  # as many rows as buckets


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The table's rows; empty before the first batch."""
    return held(spark, root, schema).drop("batch_id", "bucket", "generation")


def check_checkpoint(spark: SparkSession, root: str, schema: str, batch_id: int) -> None:
    """Refuse to start a table over with another stream's first batch."""
    if batch_id == 0:
        rows = store.read_or_empty(spark, root, f"{schema}, {PLACED}")
        if not rows.where("batch_id > 0").isEmpty():
            raise OtherCheckpoint(f"{root} has later batches: give a new checkpoint a new path")


def touched(changes: DataFrame) -> list[int]:
    """The buckets that a batch has keys of."""
    return sorted(r.bucket for r in changes.select("bucket").distinct().collect())


def put(
    rows: DataFrame, current: DataFrame, root: str, batch_id: int, buckets: int | None = None
) -> None:
    """Write whole buckets; ``current`` is what the batch found in them.

    ``buckets`` is how many there are, if known: few are written from where
    their rows are.
    """
    other = current.select("bucket", (1 - F.col("generation")).alias("generation")).distinct()
    placed = (
        rows.join(F.broadcast(other), "bucket", "left")
        .withColumn("generation", F.coalesce("generation", F.lit(0)))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    )
    if buckets is None or buckets > DIRECT_BUCKETS:
        placed = placed.hint("rebalance", "bucket")
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", store.COMPRESSION)
        .partitionBy("bucket", "generation")
        .parquet(root)
    )


def plain(current: DataFrame) -> DataFrame:
    """Rows as ``held`` gives them, with their bucket, ready to be merged."""
    return current.drop("batch_id", "generation")
