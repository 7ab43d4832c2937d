"""Live answers kept up to date by a stream of log rows.

Every answer is a table of one row per key (``streaming.tables``). Aggregates
are partial before the exchange, so a hot key reaches its row as one row per
task.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import payload as P
from tidelog.functions.numbers import dollars
from tidelog.functions.times import floor_to, ts
from tidelog.plans.business import HOUR
from tidelog.plans.health import latency_ms
from tidelog.schemas import ORDERS, SOLD, STATE_SPECS
from tidelog.streaming import tables
from tidelog.streaming.ingest import adaptive

#: What decides which of a key's events is the latest, before its payload.
ORDER = ("commit_timestamp", "is_delete", "operation", "event_key")
STATE = (
    "source_table string, record_id string, commit_timestamp timestamp_ntz, is_delete boolean,"
    " operation string, event_key string, event_data string, ingested_at timestamp_ntz"
)
VOLUME = "minute timestamp_ntz, source_table string, events bigint"
LATENCY = f"{VOLUME}, total_latency_ms bigint, max_latency_ms bigint"
ORDER_STATE = (
    "record_id string, commit_timestamp timestamp_ntz, is_delete boolean, operation string,"
    " event_key binary, ingested_at timestamp_ntz, status string, total_cents bigint"
)
#: What a row's batch has changed; not read by the batches after it.
BEFORE = "moved boolean, old_minute timestamp_ntz, old_cents bigint"
SALES = "minute timestamp_ntz, orders bigint, total_cents bigint, changed_by bigint"


def _start(stream: DataFrame, sink: Callable, checkpoint: str, trigger: dict, mode: str):
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _newest(rows: DataFrame, keys: tuple[str, ...], schema: str) -> DataFrame:
    """The latest event of each key, deletes among them."""
    names = [column.split()[0] for column in schema.split(", ")]
    rest = [*ORDER, *(name for name in names if name not in (*keys, *ORDER))]
    return (
        rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("newest")).select(*keys, "newest.*")
    )


def start_state(
    log: DataFrame, path: str, checkpoint: str, trigger: dict, buckets: int = tables.BUCKETS
):
    """Keep the latest event of every key of a log stream, tombstones included.

    No watermark: an event late by any time still finds its key. ``buckets``
    stays what it was at a table's first start; a batch rewrites the buckets
    it touches.
    """
    keys = ("source_table", "record_id")
    rows = log.withColumn("event_data", P.as_text(log))
    rows = rows.withColumn("is_delete", F.col("operation") == "d")
    bucket = tables.hash_bucket(*keys, buckets=buckets)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables.check_checkpoint(spark, path, STATE, batch_id)
        changes = _newest(batch, keys, STATE).withColumn("bucket", bucket).persist()
        try:
            found = tables.touched(changes)
            current = tables.held(spark, path, STATE, batch_id, found)
            both = tables.plain(current).unionByName(changes)
            merged = _newest(both, keys, STATE).withColumn("bucket", bucket)
            tables.put(merged, current, path, batch_id)
        finally:
            changes.unpersist()

    return _start(rows, sink, checkpoint, trigger, "append")


def read_state_log(spark: SparkSession, path: str) -> DataFrame:
    """The state a stream keeps, one row per key: a log whose current state is
    the stream's, to be passed to ``current_state``."""
    return tables.read(spark, path, STATE).drop("is_delete")


def _replacing(path: str, schema: str, *keys: str) -> Callable:
    """A sink whose rows replace those of their keys, a minute among them."""
    bucket = tables.period_bucket("minute")

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            tables.check_checkpoint(spark, path, schema, batch_id)
            changes = batch.withColumn("bucket", bucket).persist()
            try:
                found = tables.touched(changes)
                if found:
                    current = tables.held(spark, path, schema, batch_id, found)
                    kept = tables.plain(current).join(changes.select(*keys), list(keys), "left_anti")
                    tables.put(kept.unionByName(changes), current, path, batch_id)
            finally:
                changes.unpersist()

    return sink


def start_volume(
    log: DataFrame, path: str, checkpoint: str, trigger: dict, late: str | None = None
):
    """Events per ingest minute and source table.

    The number of state partitions is the session's
    ``spark.sql.shuffle.partitions`` at a query's first start.
    """
    counted = (
        _watermarked(log, late)
        .groupBy(F.window("arrived", "1 minute"), "source_table")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("minute"), "source_table", "events"
        )
    )
    sink = _replacing(path, VOLUME, "minute", "source_table")
    return _start(counted, sink, checkpoint, trigger, "update")


def read_volume(spark: SparkSession, path: str) -> DataFrame:
    return tables.read(spark, path, VOLUME)


def start_filled_volume(
    log: DataFrame,
    beats: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict,
    late: str,
    expected: tuple[str, ...] = tuple(spec.source_table for spec in STATE_SPECS),
):
    """``start_volume`` with a zero row for every minute an expected table was
    silent, to be read by ``read_volume``.

    ``beats`` is a stream of moments ``beat_at``, at least one a minute, such
    as Spark's rate source. A beat counts as no event of each expected table.
    Log and beats pass one watermark: a minute is written once, when it closes
    ``late`` after the newest of both, also while no table has any event. So
    the state holds open minutes only, and a log that lags behind the beats by
    more than ``late`` loses what comes after. Tables that are not expected
    have rows for the minutes of their events.
    """
    nothing = beats.select(
        F.col("beat_at").cast("timestamp").alias("arrived"),
        F.explode(F.array(*map(F.lit, expected))).alias("source_table"),
        F.lit(0).cast("bigint").alias("n"),
    )
    events = log.select(
        F.col("ingested_at").cast("timestamp").alias("arrived"),
        "source_table",
        F.lit(1).cast("bigint").alias("n"),
    )
    counted = (
        nothing.unionByName(events)
        .withWatermark("arrived", late)
        .groupBy(F.window("arrived", "1 minute"), "source_table")
        .agg(F.sum("n").alias("events"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("minute"), "source_table", "events"
        )
    )
    sink = _replacing(path, VOLUME, "minute", "source_table")
    return _start(counted, sink, checkpoint, trigger, "append")


def start_latency(
    log: DataFrame, path: str, checkpoint: str, trigger: dict, late: str | None = None
):
    """Commit-to-ingest latency per ingest minute and source table."""
    delay = latency_ms()
    measured = (
        _watermarked(log, late)
        .groupBy(F.window("arrived", "1 minute"), "source_table")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(delay).alias("total_latency_ms"),
            F.max(delay).alias("max_latency_ms"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("minute"),
            "source_table",
            "events",
            "total_latency_ms",
            "max_latency_ms",
        )
    )
    sink = _replacing(path, LATENCY, "minute", "source_table")
    return _start(measured, sink, checkpoint, trigger, "update")


def read_latency(spark: SparkSession, path: str) -> DataFrame:
    return tables.read(spark, path, LATENCY)


def _watermarked(log: DataFrame, late: str | None) -> DataFrame:
    """With ``late``, windows close that long after the newest arrival, and a
    row arriving later is not counted. Without it every row counts, and the
    state keeps one row per minute and table."""
    arrived = log.withColumn("arrived", F.col("ingested_at").cast("timestamp"))
    return arrived if late is None else arrived.withWatermark("arrived", late)


# Sales per minute, maintained with retraction.


def start_sales(
    log: DataFrame, path: str, checkpoint: str, trigger: dict, buckets: int = tables.BUCKETS
):
    """Sold orders and cents per minute of their last change, batch by batch.

    Buckets that a batch has orders of are merged with it in one exchange, which
    gives each order's state and what it contributed before. That is taken out
    of its old minute, what it contributes now is put into its new one, and
    orders whose contribution did not move change nothing. Only buckets that
    hold such a minute are written, and ``changed_by`` names the batch that
    last changed a minute. Events may come in any order, late by any time, and
    more than once.
    """
    orders_path, minutes_path = f"{path}/orders", f"{path}/minutes"
    orders = log.where(F.col("source_table") == ORDERS.source_table)
    value = P.as_variant(orders)
    fields = dict(ORDERS.fields)
    rows = orders.select(
        "record_id",
        "commit_timestamp",
        (F.col("operation") == "d").alias("is_delete"),
        "operation",
        "event_key",
        "ingested_at",
        *(P.field(value, name, fields[name]).alias(name) for name in ("status", "total_cents")),
    )
    bucket = tables.hash_bucket("record_id", buckets=buckets)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            tables.check_checkpoint(spark, orders_path, ORDER_STATE, batch_id)
            found = tables.touched(batch.select(bucket.alias("bucket")))
            current = tables.held(spark, orders_path, ORDER_STATE, batch_id, found)
            state = _merged(tables.plain(current).drop("bucket"), batch)
            placed = state.withColumn("bucket", bucket)
            tables.put(placed, current, orders_path, batch_id, len(found))
            written = tables.held(
                spark, orders_path, f"{ORDER_STATE}, {BEFORE}", batch_id + 1, found
            )
            _move(spark, minutes_path, batch_id, written.where("moved"))

    return _start(rows, sink, checkpoint, trigger, "append")


def _contribution() -> Column:
    """The minute and cents of a sold order, NULL for any other."""
    return F.when(
        ~F.col("is_delete") & F.col("status").isin(*SOLD),
        F.struct(
            floor_to("minute", F.col("commit_timestamp")).alias("minute"),
            F.coalesce("total_cents", F.lit(0)).alias("cents"),
        ),
    )


def _merged(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The newest event of each key, whether that moved what the key
    contributes, and if so what it contributed before."""
    nothing = F.lit(None).cast("struct<minute: timestamp_ntz, cents: bigint>")
    both = state.withColumn("before", _contribution()).unionByName(
        batch.withColumn("event_key", P.short_key("event_key")).withColumn("before", nothing)
    )
    rest = [*ORDER, "ingested_at", "status", "total_cents"]
    newest = both.groupBy("record_id").agg(
        F.max(F.struct(*rest)).alias("newest"), F.max("before").alias("before")
    )
    moved = ~F.col("before").eqNullSafe(_contribution())
    return (
        newest.select("record_id", "newest.*", "before")
        .withColumn("moved", moved)
        .withColumn("old_minute", F.when(F.col("moved"), F.col("before.minute")))
        .withColumn("old_cents", F.when(F.col("moved"), F.col("before.cents")))
        .drop("before")
    )


def _move(spark: SparkSession, path: str, batch_id: int, changed: DataFrame) -> None:
    bucket = tables.period_bucket("minute")
    sums = [F.sum(c).alias(c) for c in ("orders", "total_cents")]
    old = F.struct(F.col("old_minute").alias("minute"), F.col("old_cents").alias("cents"))
    pair = changed.select(old.alias("before"), _contribution().alias("after"))
    sides = F.array(
        *(
            F.struct(
                F.col(f"{side}.minute").alias("minute"),
                F.lit(sign).cast("bigint").alias("orders"),
                (sign * F.col(f"{side}.cents")).alias("total_cents"),
            )
            for side, sign in (("before", -1), ("after", 1))
        )
    )
    moved = (
        pair.select(F.inline(sides))
        .where("minute is not null")
        .groupBy("minute")
        .agg(*sums)
        .where("orders <> 0 or total_cents <> 0")
        .select("*", F.lit(batch_id).cast("bigint").alias("changed_by"), bucket.alias("bucket"))
        .persist()
    )
    try:
        found = tables.touched(moved)
        if found:
            current = tables.held(spark, path, SALES, batch_id, found)
            # minutes that have lost their last order stay, with zeros
            merged = (
                tables.plain(current)
                .unionByName(moved)
                .groupBy("minute", "bucket")
                .agg(*sums, F.max("changed_by").alias("changed_by"))
            )
            tables.put(merged, current, path, batch_id)
    finally:
        moved.unpersist()


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """All minutes that have sold orders now."""
    return tables.read(spark, f"{path}/minutes", SALES).where("orders > 0")


def live_sales_velocity(
    minutes: DataFrame, as_of: datetime, lookback: timedelta = HOUR
) -> DataFrame:
    """``business.sales_velocity`` from the maintained minutes. The first
    minute is whole, also where the lookback starts within it."""
    return (
        minutes.where(F.col("minute") >= floor_to("minute", ts(as_of - lookback)))
        .select("minute", "orders", dollars(F.col("total_cents")).alias("revenue_dollars"))
        .orderBy(F.desc("minute"))
    )
