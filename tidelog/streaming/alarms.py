"""An alarm on the share of refused records, raised while a stream runs.

``DropAlarm`` listens to the progress of queries whose records are counted by
``envelope.counters`` under a name. Each batch adds its counters to a sliding
window; the alarm is up while the window's share of refused records is above
the limit. Windows are kept in a folder, so a restarted driver goes on with
the window it had. What is kept is one row per batch of the window.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.sources.store import path_exists

# Width of the window and share of refused records tolerated.
WINDOW = timedelta(hours=1)
LIMIT = 0.01

BATCHES = (
    "query string, batch bigint, at timestamp_ntz, processed bigint, skipped bigint,"
    " window_processed bigint, window_skipped bigint, alarm boolean"
)


class IngestAlarm(RuntimeError):
    """Records are being refused at a rate above the limit."""


class DropAlarm(StreamingQueryListener):
    """Register with ``spark.streams.addListener``.

    ``on_change`` is called with the batch's row, a dict, whenever the alarm
    goes up or down. A window with fewer than ``min_records`` raises nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        limit: float = LIMIT,
        window: timedelta = WINDOW,
        min_records: int = 1,
        on_change: Callable[[dict], None] | None = None,
        name: str = "ingest",
    ):
        self._spark, self._path, self._limit, self._window = spark, path, limit, window
        self._min_records, self._on_change, self._name = min_records, on_change, name
        kept = read_batches(spark, path).collect()
        self._rows: dict[tuple[str, int], dict] = {(r.query, r.batch): r.asDict() for r in kept}
        self._writes = 0

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counted = progress.observedMetrics.get(self._name)
        if counted is not None and progress.numInputRows:
            self._note(
                str(progress.id), progress.batchId, progress.timestamp, counted["processed"], counted["skipped"]
            )

    def settle(self, query) -> None:
        """Take in the progress of a query that has ended, whose last events
        may not have been delivered yet. Batches known already are passed over."""
        for progress in query.recentProgress:
            counted = progress["observedMetrics"].get(self._name)
            if counted is not None and progress["numInputRows"]:
                self._note(
                    str(progress["id"]), progress["batchId"], progress["timestamp"],
                    counted["processed"], counted["skipped"],
                )

    def _note(self, query: str, batch: int, at: str, processed: int, skipped: int) -> None:
        if (query, batch) in self._rows:
            return
        moment = datetime.fromisoformat(at.replace("Z", "")).replace(tzinfo=None)
        was_up = self.up(query)
        others = [
            r for r in self._rows.values() if r["query"] == query and r["at"] > moment - self._window
        ]
        row = {"query": query, "batch": batch, "at": moment, "processed": processed}
        row |= {"skipped": skipped, "window_processed": processed, "window_skipped": skipped}
        for other in others:
            row["window_processed"] += other["processed"]
            row["window_skipped"] += other["skipped"]
        records = row["window_processed"] + row["window_skipped"]
        row["alarm"] = records >= self._min_records and row["window_skipped"] > self._limit * records
        self._rows[query, batch] = row
        newest = max(r["at"] for r in self._rows.values())
        self._rows = {k: r for k, r in self._rows.items() if r["at"] > newest - self._window}
        self._save()
        if row["alarm"] != was_up:
            logging.getLogger(__name__).warning("refused records: %s", row)
            if self._on_change is not None:
                self._on_change(row)

    def up(self, query: str) -> bool:
        """Whether the alarm is up for a query, by its newest batch."""
        rows = [r for r in self._rows.values() if r["query"] == query]
        return bool(rows) and max(rows, key=lambda r: r["batch"])["alarm"]

    def _save(self) -> None:
        """Write the window to the two places in turn: one is always whole."""
        rows = [tuple(r.values()) for r in self._rows.values()]
        frame = self._spark.createDataFrame(rows, BATCHES).coalesce(1)
        frame.write.mode("overwrite").json(f"{self._path}/copy={self._writes % 2}")
        self._writes += 1


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The window's batches, one row each, with the sums of the window they saw."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], BATCHES)
    rows = spark.read.schema(BATCHES).json(path).drop("copy")
    return rows.dropDuplicates(["query", "batch"])


def check_alarm(spark: SparkSession, path: str) -> None:
    """Raise while the alarm of any query is up: jobs that delete wait for it."""
    newest = read_batches(spark, path).groupBy("query").agg(F.max_by("alarm", "batch").alias("up"))
    if not newest.where("up").isEmpty():
        raise IngestAlarm(f"the alarm kept in {path} is up")
