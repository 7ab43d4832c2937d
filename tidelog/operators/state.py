"""Current and point-in-time state: the latest event per key, deletes dropped.

The ranking is a row_number filtered to 1, which Catalyst plans as a group
limit on both sides of the exchange: every map task keeps one row per key, so
a key that holds a third of the log adds one row per map task to the shuffle.
Rows are ranked by (source_table, record_id), never by record_id alone: a join
on the state's key then has its own exchange, and adaptive execution can split
a hot key there.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import payload as P
from tidelog.functions.times import day, ts
from tidelog.schemas import TableSpec

KEY = ("source_table", "record_id")


def since(log: DataFrame, moment: datetime) -> DataFrame:
    """Events committed at or after ``moment``, pruning date partitions."""
    if "commit_date" in log.columns:
        log = log.where(F.col("commit_date") >= day(moment))
    return log.where(F.col("commit_timestamp") >= ts(moment))


def before(log: DataFrame, moment: datetime) -> DataFrame:
    """Events committed before ``moment``, pruning date partitions."""
    if "commit_date" in log.columns:
        log = log.where(F.col("commit_date") <= day(moment))
    return log.where(F.col("commit_timestamp") < ts(moment))


def until(log: DataFrame, moment: datetime) -> DataFrame:
    """Events committed at or before ``moment``, pruning date partitions."""
    if "commit_date" in log.columns:
        log = log.where(F.col("commit_date") <= day(moment))
    return log.where(F.col("commit_timestamp") <= ts(moment))


def latest_first(log: DataFrame) -> list[Column]:
    """A total order: content decides before arrival, a delete before any upsert.

    Between different rows of one commit time and operation the content hash
    decides. Arrival columns only choose among identical copies, so redelivery
    and tiering cannot change which content wins. The hash is read, not
    computed: writing a VARIANT out as text for every row of a log costs more
    than the rest of the ranking.
    """
    order = [
        F.desc("commit_timestamp"),
        (F.col("operation") == "d").desc(),
        F.desc("operation"),
        F.desc("event_key"),
        F.desc("ingested_at"),
    ]
    if "source_store" in log.columns:
        order.append(F.desc("source_store"))
    return order


def latest_rows(log: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """The latest event of every key, tombstones included."""
    log = P.with_event_key(log)
    window = Window.partitionBy(*key).orderBy(*latest_first(log))
    return log.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")


def live_rows(log: DataFrame) -> DataFrame:
    """The latest event of every key whose latest event is not a delete."""
    return latest_rows(log).where(F.col("operation") != "d")


def current_state(
    log: DataFrame,
    spec: TableSpec,
    changed_since: datetime | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One typed row per live key of one source table.

    ``changed_since`` returns only rows last changed at or after that moment.
    It cuts the log before the ranking: a key's latest event passes the bound
    exactly when the key has any event that does. An upper bound has no such
    form; use ``state_as_of`` for that. The fields of a VARIANT payload are taken
    before the ranking; text is parsed after it, for the rows that stay.
    """
    events = log.where(F.col("source_table") == spec.source_table)
    if changed_since is not None:
        events = since(events, changed_since)
    parsing = P.needs_parsing(events)
    events = P.with_event_key(events)
    if "event_key" not in carry:
        events = events.withColumn("event_key", P.short_key("event_key"))
    payload = F.col("event_data")
    fields = [P.field(payload, name, type_).alias(f"field_{name}") for name, type_ in spec.fields]
    if not parsing:
        # taken before the ranking: what a question asks for crosses the
        # exchange, and not the whole payload
        kept = {*KEY, "commit_timestamp", "operation", "event_key", "ingested_at", "source_store"}
        events = events.select(*(c for c in events.columns if c in kept.union(carry)), *fields)
    live = live_rows(events)
    if parsing:
        parsed = P.as_variant(live).alias("event_data")
        live = P.computed_once(live, "record_id", "commit_timestamp", parsed, *carry)
        live = live.select("record_id", "commit_timestamp", *fields, *carry)
    return live.select(
        F.col("record_id").alias(spec.key),
        *(F.col(f"field_{name}").alias(name) for name, _ in spec.fields),
        F.col("commit_timestamp").alias("last_change_at"),
        *carry,
    )


def naming(log: DataFrame, spec: TableSpec, field: str, wanted: DataFrame) -> DataFrame:
    """The events of keys that any event gives one of the ``wanted`` values.

    ``wanted`` has one column, named like the payload's field. A key whose
    current value is wanted has such an event, so current state built on this
    holds every row that a join on the field needs, and only the events of
    those keys are ranked, their deletes among them.
    """
    events = log.where(F.col("source_table") == spec.source_table)
    value = P.field(P.as_variant(events), field, dict(spec.fields)[field])
    keys = (
        events.where(F.col("operation") != "d")
        .select("record_id", value.alias(field))
        .join(wanted, field, "left_semi")
        .select("record_id")
        .distinct()
    )
    return events.join(keys, "record_id", "left_semi")


def state_as_of(
    log: DataFrame, spec: TableSpec, moment: datetime, carry: tuple[str, ...] = ()
) -> DataFrame:
    """State as it stood at ``moment``: later events are cut before the ranking."""
    return current_state(until(log, moment), spec, carry=carry)


def create_views(log: DataFrame, specs, suffix: str = "current", carry: tuple[str, ...] = ()):
    """Temporary views ``<table>_<suffix>`` for use from SQL."""
    for spec in specs:
        current_state(log, spec, carry=carry).createOrReplaceTempView(
            f"{spec.source_table}_{suffix}"
        )
