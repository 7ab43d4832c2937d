"""Change envelopes to log rows, with a reason for every record refused.

All steps are built-in expressions over one column of base64 text or bytes;
a bad record is a row with a reason, never a failed batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import payload as P
from tidelog.functions.times import from_epoch_ms, ts
from tidelog.session import configure

# The accepted operations and the member that carries the row.
ROW_MEMBER = {"c": "after", "d": "before"}
DEFAULT_TABLE = "unknown"

# Years 1 to 9999, what a timestamp column can hold.
MIN_MS, MAX_MS = -62_135_596_800_000, 253_402_300_799_999

DECODED = (
    "reason",
    "source_table",
    "operation",
    "record_id",
    "event_data",
    "commit_timestamp",
    "ingested_at",
)

def decode(
    records: DataFrame,
    data: str = "data",
    ops: dict[str, str] | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Parse envelopes and judge each one.

    The result keeps the input's columns but ``data`` and adds ``reason``
    (NULL when accepted), ``source_table``, ``operation``, ``record_id``,
    ``event_data`` (VARIANT), ``commit_timestamp`` and ``ingested_at``, which
    is one value for the whole batch. ``ops`` maps accepted operations to the
    envelope member with the row; add ``{"u": "after"}`` when updates come as
    an operation of their own.
    """
    configure(records.sparkSession)
    members = ROW_MEMBER if ops is None else ops
    taken = set(records.columns) & set(DECODED)
    if taken - {data}:
        raise ValueError(f"rename the input columns {sorted(taken)}: decode adds them")
    kept = [F.col(name) for name in records.columns if name != data]

    parsed = records.select(*kept, _json(records, data).alias("v"))

    op = F.try_variant_get("v", F.lit("$.op"), "string")
    # an operation that is not text, such as {"op": 1}, is not an accepted one
    op_is_text = F.schema_of_variant(F.try_variant_get("v", F.lit("$.op"), "variant")) == "STRING"
    row = F.lit(None).cast("variant")
    for name, member in members.items():
        image = F.try_variant_get("v", F.lit(f"$.{member}"), "variant")
        row = F.when(op == name, image).otherwise(row)
    opened = parsed.select(
        *kept,
        "v",
        F.schema_of_variant("v").alias("shape"),
        F.when(op_is_text & op.isin(*members), op).alias("operation"),
        row.alias("event_data"),
    )

    opened = opened.select(
        *kept,
        "shape",
        "operation",
        "event_data",
        F.schema_of_variant("event_data").alias("row_shape"),
        P.field(F.col("event_data"), "id", "string").alias("record_id"),
        F.try_variant_get("v", F.lit("$.source.table"), "string").alias("named_table"),
        F.try_variant_get("v", F.lit("$.ts_ms"), "string").alias("ts_text"),
    )
    ms = F.col("ts_text").try_cast("bigint")
    opened = opened.withColumn("ts_ms", F.when(ms.between(MIN_MS, MAX_MS), ms))

    reason = (
        F.when(F.col("shape").isNull(), "undecodable")
        .when(~F.col("shape").startswith("OBJECT"), "not_object")
        .when(F.col("operation").isNull(), "unknown_op")
        .when(_is_empty(F.col("event_data"), F.col("row_shape")), "empty_row")
        .when(~F.col("row_shape").startswith("OBJECT"), "row_not_object")
        .when(F.col("record_id").isNull(), "missing_id")
        .when(F.col("ts_text").isNull(), "missing_ts")
        .when(F.col("ts_ms").isNull(), "bad_ts")
    )
    arrival = (
        F.current_timestamp().cast("timestamp_ntz") if ingested_at is None else ts(ingested_at)
    )
    return P.computed_once(
        opened,
        *kept,
        reason.alias("reason"),
        F.coalesce("named_table", F.lit(DEFAULT_TABLE)).alias("source_table"),
        "operation",
        "record_id",
        "event_data",
        from_epoch_ms(F.col("ts_ms")).alias("commit_timestamp"),
        arrival.alias("ingested_at"),
    )


def _json(records: DataFrame, data: str) -> Column:
    """The envelope as VARIANT; NULL for bad base64, UTF-8 or JSON."""
    column = F.col(data)
    if not isinstance(records.schema[data].dataType, T.BinaryType):
        column = F.try_to_binary(column, F.lit("base64"))
    return F.try_parse_json(F.try_validate_utf8(column.cast("string")))


def _is_empty(row: Column, shape: Column) -> Column:
    """No row, or a JSON value that holds nothing."""
    bare = F.to_json(row).isin("[]", '""', "0", "0.0", "-0.0", "false")
    return row.isNull() | shape.isin("VOID", "OBJECT<>") | (~shape.startswith("OBJECT") & bare)


def accepted(decoded: DataFrame) -> DataFrame:
    """Hot log rows of the accepted records."""
    rows = decoded.where(F.col("reason").isNull())
    key = P.event_key(
        F.col("source_table"),
        F.col("operation"),
        F.col("record_id"),
        F.col("commit_timestamp"),
        F.to_json("event_data"),
    )
    return rows.select(
        key.alias("event_key"),
        "source_table",
        "operation",
        "record_id",
        "event_data",
        "commit_timestamp",
        "ingested_at",
    )


def archived(log: DataFrame) -> DataFrame:
    """Hot log rows in the archive's form: the payload as canonical text."""
    return log.withColumn("event_data", F.to_json("event_data"))


def dispositions(decoded: DataFrame, id_column: str) -> DataFrame:
    """One verdict per input record, with the record's own id."""
    return decoded.select(
        F.col(id_column),
        F.when(F.col("reason").isNull(), "Ok").otherwise("Dropped").alias("result"),
        "reason",
    )


def counters() -> list[Column]:
    """Batch counters, for ``DataFrame.observe`` or an aggregate."""
    return [
        F.count_if(F.col("reason").isNull()).alias("processed"),
        F.count("reason").alias("skipped"),
    ]


def reason_counts(decoded: DataFrame) -> DataFrame:
    return (
        decoded.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy("reason")
    )
