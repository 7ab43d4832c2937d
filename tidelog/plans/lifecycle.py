"""Audit of status changes along the order lifecycle."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import payload as P
from tidelog.functions.numbers import ratio
from tidelog.functions.times import floor_to, ts
from tidelog.schemas import ORDERS

# The steps the order lifecycle allows.
ALLOWED_STEPS = (
    "new>pending",
    "pending>paid",
    "paid>shipped",
    "paid>cancelled",
    "shipped>delivered",
)


def status_steps(
    log: DataFrame, source_table: str = ORDERS.source_table, bucket: str = "hour"
) -> DataFrame:
    """Each status change with the status before it, redelivered copies merged.

    A key's history is split by time bucket: inside a bucket a step is known
    from the rows of (key, bucket); only the first row of each bucket goes on
    to a window over the whole key. A key with very many events is thereby
    spread over as many tasks as it has buckets.
    """
    rows = log.where(F.col("source_table") == source_table)
    payload_status = P.field(P.as_variant(rows), "status", "string")
    status = F.when(F.col("operation") == "d", "deleted").otherwise(
        F.coalesce(payload_status, F.lit("unknown"))
    )
    changes = (
        rows.select("record_id", "commit_timestamp", "operation", status.alias("to_status"))
        .distinct()
        .withColumn("bucket", floor_to(bucket, F.col("commit_timestamp")))
    )
    per_bucket = Window.partitionBy("record_id", "bucket")
    ordered = per_bucket.orderBy(
        "commit_timestamp", F.col("operation") == "d", "operation", "to_status"
    )
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = changes.select(
        "record_id",
        "bucket",
        "commit_timestamp",
        "to_status",
        F.lag("to_status").over(ordered).alias("from_status"),
        F.last("to_status").over(whole).alias("last_status"),
    )
    # a status is never NULL, so only a bucket's first row has none before it
    inside = placed.where(F.col("from_status").isNotNull())
    first = placed.where(F.col("from_status").isNull()).withColumn(
        "from_status",
        F.coalesce(
            F.lag("last_status").over(Window.partitionBy("record_id").orderBy("bucket")),
            F.lit("new"),
        ),
    )
    columns = ["record_id", "commit_timestamp", "from_status", "to_status"]
    return inside.select(*columns).union(first.select(*columns))


def lifecycle_audit(log: DataFrame) -> DataFrame:
    """How often each status step was taken and whether the lifecycle allows it.

    A delete may follow any status; a repeated status is an ordinary update.
    """
    step = F.concat_ws(">", "from_status", "to_status")
    allowed = (
        step.isin(*ALLOWED_STEPS)
        | (F.col("to_status") == "deleted")
        | (F.col("from_status") == F.col("to_status"))
    )
    return (
        status_steps(log)
        .groupBy("from_status", "to_status")
        .agg(F.count(F.lit(1)).alias("steps"))
        .withColumn("allowed", F.when(allowed, 1).otherwise(0))
        .orderBy("from_status", "to_status")
    )


def lifecycle_rates(
    orders: DataFrame, as_of: datetime, idle: timedelta = timedelta(minutes=30)
) -> DataFrame:
    """Share of orders left pending past ``idle``, and of paid ones cancelled since."""
    pending = (F.col("status") == "pending") & (F.col("last_change_at") <= ts(as_of - idle))
    counted = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(pending).alias("abandoned"),
        F.count_if(F.col("status") != "pending").alias("paid"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled"),
    )
    return counted.select(
        "*",
        ratio(F.col("abandoned"), F.col("orders"), 4).alias("abandon_rate"),
        ratio(F.col("cancelled"), F.col("paid"), 4).alias("cancel_rate"),
    )
