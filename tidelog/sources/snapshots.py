"""Snapshots of the append-only archive.

Every archive row carries the id of the commit that added it, and ids grow
with each commit, so the archive at a snapshot is the rows up to its id: a
filter that reaches the scan, with no copy of any data. In a stored archive
ranges of ids are partitions, and the filter prunes them.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.sums import running_total
from tidelog.functions.times import ts
from tidelog.sources.store import snapshot_range

KEEP_UNREFERENCED = timedelta(days=3)


def snapshot_log(archive: DataFrame) -> DataFrame:
    """The history an archive's rows imply, one row per commit."""
    commits = archive.groupBy("snapshot_id").agg(
        F.max("ingested_at").alias("committed_at"),
        F.count(F.lit(1)).alias("added"),
    )
    return summarised(running_total(commits, "snapshot_id", "added", "total"))


def summarised(commits: DataFrame) -> DataFrame:
    """Commit rows ``(snapshot_id, committed_at, added, total)`` as history rows."""
    return commits.select(
        F.col("snapshot_id").cast("bigint").alias("snapshot_id"),
        F.col("committed_at"),
        F.lit("append").alias("operation"),
        F.create_map(
            F.lit("added-records"),
            F.col("added").cast("string"),
            F.lit("total-records"),
            F.col("total").cast("string"),
        ).alias("summary"),
    )


def at_version(archive: DataFrame, history: DataFrame, snapshot_id: int) -> DataFrame:
    """Archive rows as of one snapshot of its history.

    The id is looked up by a subquery of the plan; an unknown or expired one
    fails when the query runs.
    """
    return _up_to(
        archive, history.where(F.col("snapshot_id") == snapshot_id), f"no snapshot {snapshot_id}"
    )


def at_timestamp(archive: DataFrame, history: DataFrame, moment: datetime) -> DataFrame:
    """Archive rows as of the snapshot that was current at ``moment``; fails
    when the query runs if there was none."""
    earlier = history.where(F.col("committed_at") <= ts(moment))
    return _up_to(archive, earlier, f"no snapshot at or before {moment}")


def _up_to(archive: DataFrame, found: DataFrame, otherwise: str) -> DataFrame:
    """Rows up to the newest of the snapshots in ``found``. A stored archive
    opens only the ranges up to it."""
    newest = found.agg(
        F.coalesce(F.max("snapshot_id"), F.raise_error(F.lit(otherwise))).alias("newest")
    ).scalar()
    if "snapshot_range" in archive.columns:
        archive = archive.where(F.col("snapshot_range") <= snapshot_range(newest))
    return archive.where(F.col("snapshot_id") <= newest)


def expire_snapshots(
    history: DataFrame, as_of: datetime, keep: timedelta = KEEP_UNREFERENCED
) -> DataFrame:
    """History without snapshots older than ``keep``; the newest always stays.

    The archive is append-only, so every row of an expired snapshot is still
    part of the newer ones: only the handle goes, never data.
    """
    newest = history.agg(F.max("snapshot_id")).scalar()
    return history.where(
        (F.col("committed_at") >= ts(as_of - keep)) | (F.col("snapshot_id") == newest)
    )
