"""One envelope stream into two stores, each by a query of its own.

The hot query appends VARIANT rows every few seconds. The cold query appends
text rows every minute, each micro-batch a snapshot, and keeps the refused
records. Both replay from their checkpoints; a replayed micro-batch overwrites
what its first attempt wrote.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.sums import running_total
from tidelog.functions.times import ts, utc_now
from tidelog.operators import envelope as E
from tidelog.sources import store
from tidelog.sources.snapshots import summarised

# Pace of the two consumers and life of refused records.
HOT_TRIGGER = {"processingTime": "5 seconds"}
COLD_TRIGGER = {"processingTime": "60 seconds"}
QUARANTINE_KEEP = timedelta(days=7)

ENVELOPES = "arrival_id string, data string"


def envelope_stream(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: str = ENVELOPES,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Envelopes arriving as files, at most so many files or bytes a batch.

    Any other stream with a payload column will do instead, such as a Kafka
    topic read with ``startingOffsets=latest`` and ``maxOffsetsPerTrigger``.
    """
    reader = spark.readStream.format(format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


@contextmanager
def adaptive(stream_session: SparkSession):
    """Adaptive execution for what a sink does with its batch.

    Spark turns it off in the session of a stream with state, whose own plan is
    made before the sink is called. That session is the stream's alone.
    """
    setting = "spark.sql.adaptive.enabled"
    before = stream_session.conf.get(setting)
    stream_session.conf.set(setting, "true")
    try:
        yield
    finally:
        stream_session.conf.set(setting, before)


def start_hot(
    envelopes: DataFrame,
    root: str,
    checkpoint: str,
    data: str = "data",
    trigger: dict | None = None,
    once_within: str | None = None,
):
    """Append accepted events to the hot store.

    The query's progress reports ``ingest.processed`` and ``ingest.skipped``.
    ``once_within`` (such as "2 days") leaves out an event delivered again
    within that time of its first arrival, whatever the store still holds: the
    state keeps the keys of that time, and a watermark on arrival lets older
    ones go. Without it copies stay in the log, where they change no current
    state. For many keys, run the session with Spark's RocksDB state store.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            store.append_batch(batch, root, store.leaf_of(batch, batch_id))

    decoded = E.decode(envelopes, data).observe("ingest", *E.counters())
    events = E.accepted(decoded)
    if once_within is not None:
        events = (
            events.withColumn("arrived", F.col("ingested_at").cast("timestamp"))
            .withWatermark("arrived", once_within)
            .dropDuplicatesWithinWatermark(["event_key"])
            .drop("arrived")
        )
    return (
        events.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or HOT_TRIGGER))
        .start()
    )


def start_cold(
    envelopes: DataFrame,
    root: str,
    quarantine: str,
    checkpoint: str,
    data: str = "data",
    trigger: dict | None = None,
):
    """Append accepted events to the archive and refused ones to quarantine."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            leaf = store.leaf_of(batch, batch_id)
            snapshot_id = next_snapshot(batch.sparkSession, root, leaf)
            write_quarantine(batch, quarantine, leaf)
            rows = E.archived(E.accepted(batch)).withColumn(
                "snapshot_id", F.lit(snapshot_id).cast("bigint")
            )
            store.append_batch(rows, root, leaf)
            commit_snapshot(batch.sparkSession, root, snapshot_id, rows.count(), leaf)
        finally:
            batch.unpersist()

    decoded = E.decode(envelopes.withColumn("raw", F.col(data)), data)
    return (
        decoded.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or COLD_TRIGGER))
        .start()
    )


COMMITS = "snapshot_id bigint, committed_at timestamp_ntz, added bigint, leaf bigint"


def next_snapshot(spark: SparkSession, root: str, leaf: int) -> int:
    """The id a batch commits under: one more than any before it, whichever
    stream that came from, or its own if it has committed already.

    Streams that commit at the same moment may take the same id, which is then
    one snapshot with the rows of both.
    """
    commits = store.read_or_empty(spark, f"{root}/snapshots", COMMITS)
    own = F.when(F.col("leaf") == leaf, F.col("snapshot_id"))
    newest, again = commits.agg(F.max("snapshot_id"), F.max(own)).first()
    return again or (newest or 0) + 1


def commit_snapshot(
    spark: SparkSession, root: str, snapshot_id: int, added: int, leaf: int | None = None
) -> None:
    """Record what a batch added; the same batch again replaces its record."""
    place = snapshot_id if leaf is None else leaf
    commit = spark.range(1).select(
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        ts(utc_now()).alias("committed_at"),
        F.lit(added).cast("bigint").alias("added"),
    )
    commit.coalesce(1).write.mode("overwrite").parquet(f"{root}/snapshots/leaf={place}")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The history of all streams that write the archive; a snapshot's total
    is what it and all before it added."""
    commits = store.read_or_empty(spark, f"{root}/snapshots", COMMITS)
    added = commits.groupBy("snapshot_id").agg(
        F.max("committed_at").alias("committed_at"), F.sum("added").alias("added")
    )
    return summarised(running_total(added, "snapshot_id", "added", "total"))


def write_quarantine(decoded: DataFrame, path: str, batch_id: int) -> None:
    """Keep refused records as they came, by reason and arrival date."""
    refused = decoded.where(F.col("reason").isNotNull())
    (
        refused.select("raw", "ingested_at", "reason")
        .withColumn("arrival_date", F.col("ingested_at").cast("date"))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reason", "arrival_date", "batch_id")
        .parquet(path)
    )


def read_quarantine(
    spark: SparkSession, path: str, today: date | None = None, keep: timedelta = QUARANTINE_KEEP
) -> DataFrame:
    """Refused records that have not expired."""
    oldest = (today or utc_now().date()) - keep
    records = store.read_or_empty(
        spark,
        path,
        "raw string, ingested_at timestamp_ntz, reason string, arrival_date date, batch_id bigint",
    )
    return records.where(F.col("arrival_date") >= F.lit(oldest.isoformat()).cast("date")).drop(
        "batch_id"
    )
