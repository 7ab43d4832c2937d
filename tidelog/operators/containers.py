"""Records that arrive in containers, and the replies to them.

A container is one JSON text with an array of records. ``unwrap`` gives one
row per record, with the record's place in its container; ``answer`` encodes
the accepted rows anew; ``replies`` makes one reply per container, with its
records in the container's order. A container that cannot be opened is refused
whole, with a reason, and its neighbours go on.

The array is taken apart by ``variant_explode`` as a lateral table function,
so a container is parsed once and its records stay VARIANT until they are
read. All of a container's records are in the task that read it, so partial
aggregates put the reply together there and one row a container is sent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.times import epoch_us
from tidelog.session import configure


@dataclass(frozen=True)
class Form:
    """Where a container keeps its records, and a record its parts."""

    records: str
    data: str
    record_id: str | None = None


# The members of the two kinds of containers.
STREAM = Form("Records", "kinesis.data")
DELIVERY = Form("records", "data", "recordId")
OK, DROPPED = "Ok", "Dropped"

ADDED = ("delivery", "position", "arrival_id", "data")


def _member(value: str, path: str, type_: str) -> Column:
    return F.try_variant_get(F.col(value), F.lit(f"$.{path}"), type_)


def _opened(containers: DataFrame, body: str, form: Form) -> DataFrame:
    """Adds ``items``, the array as VARIANT, and ``refusal``."""
    configure(containers.sparkSession)
    text = F.try_validate_utf8(F.col(body).cast("string"))
    parsed = containers.withColumn("contents", F.try_parse_json(text)).withColumn(
        "items", _member("contents", form.records, "variant")
    )
    shape = F.schema_of_variant("contents")
    refusal = (
        F.when(shape.isNull(), "undecodable")
        .when(~shape.startswith("OBJECT"), "not_object")
        .when(
            F.col("items").isNotNull() & ~F.schema_of_variant("items").startswith("ARRAY"),
            "not_array",
        )
    )
    if form.record_id is not None:
        records = F.col("items").try_cast("array<variant>")
        path = F.lit(f"$.{form.record_id}")
        nameless = F.exists(records, lambda r: F.try_variant_get(r, path, "string").isNull())
        refusal = refusal.when(nameless, "missing_record_id")
    return parsed.withColumn("refusal", refusal)


def unwrap(containers: DataFrame, body: str = "body", form: Form = DELIVERY) -> DataFrame:
    """One row per record of every container that can be opened.

    Keeps the containers' columns but ``body`` and adds ``delivery``, which
    tells copies of one container apart (null in a stream, where replies are
    made of each batch by itself), ``position``, from 0, ``arrival_id``,
    the record's own id (null where the form has none), and ``data``, the
    record's payload as base64 text, null where it is missing. A container
    without the array has no records, and neither has one with an empty array.
    """
    taken = (set(containers.columns) - {body}) & set(ADDED)
    if taken:
        raise ValueError(f"rename the containers' columns {sorted(taken)}: unwrap adds them")
    kept = [c for c in containers.columns if c != body]
    number = F.lit(None).cast("bigint")
    if not containers.isStreaming:
        number = F.monotonically_increasing_id()
    numbered = containers.withColumn("delivery", number)
    opened = _opened(numbered, body, form).where("refusal is null and items is not null")
    record = opened.sparkSession.tvf.variant_explode(F.col("items").outer())
    arrival = F.lit(None).cast("string")
    if form.record_id is not None:
        arrival = _member("value", form.record_id, "string")
    return opened.lateralJoin(record).select(
        *kept,
        "delivery",
        F.col("pos").alias("position"),
        arrival.alias("arrival_id"),
        _member("value", form.data, "string").alias("data"),
    )


def refused(containers: DataFrame, body: str = "body", form: Form = DELIVERY) -> DataFrame:
    """The containers that cannot be opened, as they came, and why."""
    opened = _opened(containers, body, form).where("refusal is not null")
    return opened.select(*containers.columns, F.col("refusal").alias("reason"))


def answer(decoded: DataFrame) -> DataFrame:
    """Adds ``result`` and ``data`` to decoded records: the accepted row as one
    line of JSON in base64, times in microseconds, its payload as text."""
    row = F.struct(
        "source_table",
        "operation",
        "record_id",
        F.to_json("event_data").alias("event_data"),
        epoch_us(F.col("commit_timestamp")).alias("commit_timestamp"),
        epoch_us(F.col("ingested_at")).alias("ingested_at"),
    )
    line = F.concat(F.to_json(row), F.lit("\n"))
    good = F.col("reason").isNull()
    return decoded.withColumn("result", F.when(good, OK).otherwise(DROPPED)).withColumn(
        "data", F.when(good, F.base64(line.cast("binary")))
    )


def replies(answered: DataFrame, *container: str, form: Form = DELIVERY) -> DataFrame:
    """One reply per container, in the column ``reply``.

    ``container`` names the columns to keep, which are the same for all of a
    container's records. A container without records has no row here.
    """
    record = F.struct(
        "position",
        F.struct(F.col("arrival_id").alias(form.record_id), "result", "data").alias("record"),
    )
    in_order = F.transform(F.array_sort(F.collect_list(record)), lambda r: r["record"])
    return (
        answered.groupBy("delivery", *container)
        .agg(in_order.alias("in_order"))
        .select(*container, F.to_json(F.struct(F.col("in_order").alias(form.records))).alias("reply"))
    )
