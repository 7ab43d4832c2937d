"""Questions about the pipeline itself, asked of the event log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.numbers import ratio
from tidelog.functions.times import day, floor_to, millis_between, ts
from tidelog.schemas import STATE_SPECS


def _ingested_since(log: DataFrame, moment: datetime) -> DataFrame:
    """Of a stored log, only the days of arrival since then are opened."""
    if "ingest_date" in log.columns:
        log = log.where(F.col("ingest_date") >= day(moment))
    return log.where(F.col("ingested_at") >= ts(moment))


def latency_ms() -> Column:
    return millis_between(F.col("commit_timestamp"), F.col("ingested_at"))


def propagation_latency(
    log: DataFrame, as_of: datetime, lookback: timedelta = timedelta(minutes=5)
) -> DataFrame:
    """Commit-to-ingest latency per source table."""
    delay = latency_ms()
    return (
        _ingested_since(log, as_of - lookback)
        .groupBy("source_table")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg(delay).alias("avg_latency_ms"),
            F.max(delay).alias("max_latency_ms"),
        )
        .orderBy(F.desc("events"), "source_table")
    )


def event_volume(
    log: DataFrame, as_of: datetime, lookback: timedelta = timedelta(hours=1)
) -> DataFrame:
    """Events per ingest minute and source table, newest first."""
    return (
        _per_minute(_ingested_since(log, as_of - lookback))
        .orderBy(F.desc("minute"), "source_table")
    )


def _per_minute(log: DataFrame) -> DataFrame:
    return log.groupBy(
        floor_to("minute", F.col("ingested_at")).alias("minute"), "source_table"
    ).agg(F.count(F.lit(1)).alias("events"))


def gap_filled_volume(
    log: DataFrame,
    as_of: datetime,
    lookback: timedelta = timedelta(hours=1),
    tables: tuple[str, ...] = tuple(spec.source_table for spec in STATE_SPECS),
) -> DataFrame:
    """``event_volume`` with a zero row for every minute a table was silent.

    Minutes come from the window's bounds, tables from the argument and the
    counted rows, so a table silent all the time has its rows too. The
    calendar has as many rows as the answer and no log row is copied.
    """
    counted = _per_minute(_ingested_since(log, as_of - lookback))
    first = floor_to("minute", ts(as_of - lookback))
    last = floor_to("minute", ts(as_of))
    minutes = F.explode(F.sequence(first, last, F.expr("interval 1 minute")))
    expected = log.sparkSession.createDataFrame([(t,) for t in tables], "source_table string")
    calendar = counted.select("source_table").union(expected).distinct().select(
        "source_table", minutes.alias("minute")
    )
    return (
        calendar.join(counted, ["minute", "source_table"], "left")
        .select("minute", "source_table", F.coalesce("events", F.lit(0)).alias("events"))
        .orderBy(F.desc("minute"), "source_table")
    )


def events_by_table(log: DataFrame) -> DataFrame:
    return log.groupBy("source_table").agg(F.count(F.lit(1)).alias("events"))


def events_by_store(unified: DataFrame) -> DataFrame:
    return unified.groupBy("source_store").agg(F.count(F.lit(1)).alias("events"))


def store_extents(hot: DataFrame, cold: DataFrame) -> DataFrame:
    """Row count and commit-time range of each store."""

    def extent(log: DataFrame, store: str) -> DataFrame:
        at = F.col("commit_timestamp")
        return log.agg(
            F.lit(store).alias("store"),
            F.count(F.lit(1)).alias("n"),
            F.min(at).alias("oldest"),
            F.max(at).alias("newest"),
        )

    return extent(hot, "hot").union(extent(cold, "cold")).orderBy("store")


def drop_rate(decoded: DataFrame, at: Column, width: str = "1 hour") -> DataFrame:
    """Quarantined share of decoded records per window of the time column ``at``."""
    return (
        decoded.groupBy(F.window(at.cast("timestamp"), width)["start"].alias("start"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("reason").alias("dropped"),
        )
        .select(
            F.col("start").cast("timestamp_ntz").alias("window_start"),
            "records",
            "dropped",
            ratio(F.col("dropped"), F.col("records"), 4).alias("drop_rate"),
        )
        .orderBy("window_start")
    )


def drop_alarm(rates: DataFrame, limit: float) -> DataFrame:
    """The windows whose dropped share is above ``limit``."""
    return rates.where(F.col("drop_rate") > limit)
