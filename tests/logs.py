"""Hand-made event logs."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidelog.functions.payload import with_event_key

BASE = datetime(2024, 1, 1)


def at(minutes) -> datetime:
    return BASE + timedelta(minutes=minutes)


def log(spark, *events, table="orders", text=False):
    """Events as (operation, record id, minute, status[, arrival minute])."""
    rows = []
    for operation, record, minute, status, *arrival in events:
        arrived = at(arrival[0] if arrival else minute)
        body = f'{{"id":"{record}"}}'
        if status is not None:
            body = f'{{"id":"{record}","status":"{status}","total_cents":100}}'
        rows.append((table, operation, record, body, at(minute), arrived))
    schema = (
        "source_table string, operation string, record_id string, event_data string,"
        " commit_timestamp timestamp_ntz, ingested_at timestamp_ntz"
    )
    made = spark.createDataFrame(rows, schema)
    if not text:
        made = made.withColumn("event_data", F.parse_json("event_data"))
    return with_event_key(made)
