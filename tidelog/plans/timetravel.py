"""Archive questions pinned to a snapshot or to a commit time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import payload as P
from tidelog.operators.state import live_rows, until
from tidelog.sources.snapshots import at_timestamp, at_version


def snapshots(snapshot_log: DataFrame) -> DataFrame:
    """The snapshot history, oldest first."""
    return snapshot_log.select(
        "committed_at",
        "snapshot_id",
        "operation",
        F.col("summary")["total-records"].cast("bigint").alias("total_records"),
    ).orderBy("committed_at", "snapshot_id")


def count_at_version(archive: DataFrame, snapshot_log: DataFrame, snapshot_id: int) -> DataFrame:
    pinned = at_version(archive, snapshot_log, snapshot_id)
    return pinned.agg(F.count(F.lit(1)).alias("rows_at_snapshot"))


def count_at_timestamp(archive: DataFrame, snapshot_log: DataFrame, moment: datetime) -> DataFrame:
    pinned = at_timestamp(archive, snapshot_log, moment)
    return pinned.agg(F.count(F.lit(1)).alias("rows_at_timestamp"))


def status_mix(log: DataFrame, source_table: str = "orders") -> DataFrame:
    """Live keys of one table per status; one row per key, so events = orders."""
    live = live_rows(log.where(F.col("source_table") == source_table))
    return (
        live.select("record_id", P.field(P.as_variant(live), "status", "string").alias("status"))
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("record_id").alias("orders"),
        )
        .orderBy("status")
    )


def status_mix_at_version(
    archive: DataFrame, snapshot_log: DataFrame, snapshot_id: int, source_table: str = "orders"
) -> DataFrame:
    return status_mix(at_version(archive, snapshot_log, snapshot_id), source_table)


def status_mix_as_of(
    archive: DataFrame, moment: datetime, source_table: str = "orders"
) -> DataFrame:
    """By commit time instead of snapshot: a late older event changes the answer."""
    return status_mix(until(archive, moment), source_table)
