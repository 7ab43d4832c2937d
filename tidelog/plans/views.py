"""All views at once, for questions asked in SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidelog.functions.times import utc_now
from tidelog.operators.state import create_views
from tidelog.operators.unify import RETENTION, unified_log
from tidelog.schemas import STATE_SPECS
from tidelog.sources import store


def register_views(
    hot: DataFrame,
    cold: DataFrame | None = None,
    as_of: datetime | None = None,
    retention: timedelta = RETENTION,
    mode: str = "split",
) -> None:
    """Temporary views over the logs and the state they imply.

    ``cdc_events`` and ``<table>_current`` read the hot log; with an archive,
    ``cdc_events_archive``, ``cdc_events_all`` and ``<table>_unified`` read
    both. Files and the boundary between the stores are those of the moment
    the views are made: over stored logs, use ``refresh_views``.
    """
    hot.createOrReplaceTempView("cdc_events")
    create_views(hot, STATE_SPECS)
    if cold is None:
        return
    cold.createOrReplaceTempView("cdc_events_archive")
    now = utc_now() if as_of is None else as_of
    unified_log(hot, cold, now, retention, mode).createOrReplaceTempView("cdc_events_all")
    text = unified_log(hot, cold, now, retention, mode, payload="stored", copies=True)
    create_views(text, STATE_SPECS, "unified", carry=("source_store",))


def refresh_views(
    spark: SparkSession,
    hot_root: str,
    cold_root: str | None = None,
    as_of: datetime | None = None,
    retention: timedelta = RETENTION,
    mode: str = "split",
) -> None:
    """Make the views anew over two stored logs, with their newest version,
    files and the boundary at ``as_of`` (now). Reads nothing but file names.

    Call it before a round of questions, and after a prune: a view keeps the
    files it was made with.
    """
    cold = None if cold_root is None else store.read_cold(spark, cold_root)
    register_views(store.read_hot(spark, hot_root), cold, as_of, retention, mode)
