"""One log over the hot and the cold store."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import payload as P
from tidelog.operators.state import before, since

RETENTION = timedelta(hours=24)


def unified_log(
    hot: DataFrame,
    cold: DataFrame,
    as_of: datetime,
    retention: timedelta = RETENTION,
    mode: str = "split",
    payload: str = "variant",
    copies: bool = False,
) -> DataFrame:
    """Hot and cold events in one shape, tagged with the store they come from.

    ``mode="split"`` takes recent events from hot and older ones from cold, so
    nothing is scanned twice; an event only in the other store is not seen.
    ``mode="full"`` takes everything from both stores, and merges the copies of
    an event unless ``copies`` is set.

    ``payload="stored"`` leaves archived payloads as text in a column of their
    own. State built on it parses only the rows that survive the ranking.
    """
    if mode not in ("split", "full"):
        raise ValueError(f"unknown mode: {mode}")
    if mode == "split":
        boundary = as_of - retention
        hot, cold = since(hot, boundary), before(cold, boundary)
    shape = _as_stored if payload == "stored" else _as_variant
    both = _tagged(hot, shape(hot), "hot").unionByName(_tagged(cold, shape(cold), "cold"))
    if mode == "full" and not copies:
        return one_copy(both)
    return both


def _as_variant(log: DataFrame) -> list[Column]:
    return [P.as_variant(log).alias("event_data")]


def _as_stored(log: DataFrame) -> list[Column]:
    value, text = F.lit(None).cast("variant"), F.lit(None).cast("string")
    if P.is_text(log):
        text = F.col("event_data")
    else:
        value = F.col("event_data")
    return [value.alias("event_data"), text.alias(P.TEXT_BESIDE)]


def _tagged(log: DataFrame, payload: list[Column], store: str) -> DataFrame:
    return log.select(
        "event_key",
        "source_table",
        "operation",
        "record_id",
        *payload,
        "commit_timestamp",
        "ingested_at",
        F.lit(store).alias("source_store"),
    )


def one_copy(log: DataFrame) -> DataFrame:
    """One row per event, the copy that arrived last.

    Copies are cut to one per map task before the exchange (a row_number
    filtered to 1), so an event redelivered very often does not gather.
    """
    order = [F.desc("ingested_at")]
    if "source_store" in log.columns:
        order.append(F.desc("source_store"))
    window = Window.partitionBy("event_key").orderBy(*order)
    return log.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")
