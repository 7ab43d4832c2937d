"""Retention: prune the hot log once the archive holds what is pruned.

The cutoff is computed once from ``as_of`` and used by the gate and the
rewrite alike. ``gate="count"`` asks only that the archive has anything older
than the cutoff; ``gate="strict"`` asks for every row about to go.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.times import second_floor, ts, utc_now
from tidelog.operators.state import before, since
from tidelog.operators.unify import RETENTION
from tidelog.sources.store import drop_before, read_hot
from tidelog.streaming.alarms import check_alarm


#: Parts of a day that the strict gate compares by their sums.
HASH_RANGES = 64


class ArchiveEmptyError(RuntimeError):
    """The archive has no row older than the cutoff."""


class ArchiveIncompleteError(RuntimeError):
    """Some rows older than the cutoff are not in the archive."""


def cutoff_at(as_of: datetime, retention: timedelta = RETENTION) -> datetime:
    """The pinned cutoff, in whole seconds."""
    return second_floor(as_of - retention)


def cutoff_text(cutoff: datetime) -> str:
    return cutoff.strftime("%Y-%m-%d %H:%M:%S")


def archived_before(cold: DataFrame, cutoff: datetime) -> DataFrame:
    """How many archive rows are older than the cutoff."""
    return before(cold, cutoff).agg(F.count(F.lit(1)).alias("n"))


def kept_rows(hot: DataFrame, cutoff: datetime) -> DataFrame:
    return since(hot, cutoff)


def _placed(log: DataFrame) -> DataFrame:
    """Adds the day and the hash range that an event and its copies share."""
    day = F.col("commit_date") if "commit_date" in log.columns else F.col("commit_timestamp")
    part = F.pmod(F.xxhash64("event_key"), F.lit(HASH_RANGES)).cast("int")
    return log.withColumn("gate_day", day.cast("date")).withColumn("gate_range", part)


PLACE = ["gate_day", "gate_range"]


def _checksums(placed: DataFrame, suffix: str) -> DataFrame:
    """Order-free sums per day and hash range: rows, and both halves of a hash."""
    key = F.xxhash64(F.lit("gate"), F.col("event_key"))
    return placed.groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias(f"n_{suffix}"),
        F.sum(key.bitwiseAND(F.lit((1 << 32) - 1))).alias(f"low_{suffix}"),
        F.sum(F.shiftrightunsigned(key, 32)).alias(f"high_{suffix}"),
    )


def uncovered_rows(hot: DataFrame, cold: DataFrame, cutoff: datetime) -> DataFrame:
    """Hot rows older than the cutoff that the archive does not hold.

    Both stores are summed per day and hash range, on the hot store's days
    only; a copy has the commit time of its event. Where the sums agree, both
    hold the same events, but for a chance of 2^-64. Keys are compared, and
    shuffled, only in the ranges where they differ; when none does, adaptive
    execution drops the comparison before it starts. The ranges that differ
    are broadcast: at most ``HASH_RANGES`` rows a day.
    """
    doomed, archived = _placed(before(hot, cutoff)), _placed(before(cold, cutoff))
    days = doomed.select("gate_day").distinct()
    archived = archived.join(F.broadcast(days), "gate_day", "left_semi")
    both = _checksums(doomed, "hot").join(_checksums(archived, "cold"), PLACE, "left")
    equal = F.lit(True)
    for name in ("n", "low", "high"):
        equal = equal & F.col(f"{name}_hot").eqNullSafe(F.col(f"{name}_cold"))
    differing = F.broadcast(both.where(~equal).select(*PLACE))
    covered = archived.join(differing, PLACE, "left_semi").select("event_key").distinct()
    return (
        doomed.join(differing, PLACE, "left_semi")
        .join(covered, "event_key", "left_anti")
        .select(*hot.columns)
    )


def prune_report(hot: DataFrame, cutoff: datetime) -> DataFrame:
    """One row: what a prune at the cutoff removes and leaves, in one pass."""
    at = F.col("commit_timestamp")
    kept = at >= ts(cutoff)
    return hot.agg(
        ts(cutoff).alias("cutoff"),
        F.count(F.lit(1)).alias("rows_before"),
        F.min(at).alias("oldest_before"),
        F.count_if(~kept).alias("rows_deleted"),
        F.count_if(kept).alias("rows_after"),
        F.min(F.when(kept, at)).alias("oldest_after"),
    )


def check_archive(hot: DataFrame, cold: DataFrame, cutoff: datetime, gate: str = "count") -> None:
    """Raise unless the archive allows a prune at the cutoff."""
    if gate not in ("count", "strict"):
        raise ValueError(f"unknown gate: {gate}")
    if before(cold, cutoff).isEmpty():
        raise ArchiveEmptyError(f"the archive has no rows older than {cutoff_text(cutoff)}")
    if gate == "strict":
        missing = uncovered_rows(hot, cold, cutoff).count()
        if missing:
            raise ArchiveIncompleteError(
                f"{missing} rows older than {cutoff_text(cutoff)} are not in the archive"
            )


def prune(
    spark: SparkSession,
    hot_root: str,
    cold: DataFrame,
    as_of: datetime | None = None,
    retention: timedelta = RETENTION,
    gate: str = "count",
    alarm: str | None = None,
) -> DataFrame:
    """Drop rows older than the cutoff from the hot store.

    Days before the cutoff's drop out as whole partitions, later days are left
    as they are. Returns the one-row report. When the gate refuses, it raises
    and the store is as it was. ``alarm`` names the folder of a
    ``streaming.alarms.DropAlarm``: while that is up, nothing is dropped either,
    as the archive may miss what was refused.
    """
    if alarm is not None:
        check_alarm(spark, alarm)
    cutoff = cutoff_at(utc_now() if as_of is None else as_of, retention)
    hot = read_hot(spark, hot_root)
    check_archive(hot, cold, cutoff, gate)
    report = prune_report(hot, cutoff)
    outcome = spark.createDataFrame(report.collect(), report.schema)
    drop_before(hot, hot_root, cutoff)
    return outcome
