"""Event logs derived from the given star and event tables.

Every binding is one scan of its main table: the events of a row are built as
an array and exploded, with the redelivered copy exploded from the same row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import payload as P
from tidelog.functions.times import epoch_ms, from_epoch_ms, plus, ts
from tidelog.operators.containers import DELIVERY, Form
from tidelog.session import configure, scratch_dir

# Fixed values of the bindings.
STAR_AS_OF = datetime(2001, 8, 1, 12, 0, 0)
EVENTS_AS_OF = datetime(2024, 1, 31, 0, 0, 0)
FIRST_CUSTOMER = datetime(1995, 1, 1)
PAYMENT_METHODS = ("card", "paypal", "applepay", "googlepay")
NATIONS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _change(table_name: str, at: Column, operation: str, **overrides: Column) -> Column:
    columns = {name: value.alias(name) for name, value in overrides.items()}
    return F.struct(
        F.lit(table_name).alias("source_table"),
        F.lit(operation).alias("operation"),
        at.alias("at"),
        *columns.values(),
    )


#: The payload's canonical text beside a derived log, for its archive.
CANONICAL = "canonical_text"


def _log(rows: DataFrame, number: Column, record: Column, changes: Column, row: dict[str, Column]):
    """Explode the changes of each row into log rows, redelivering some."""
    exploded = (
        rows.withColumn("number", number)
        .withColumn("record_id", record.cast("string"))
        .withColumn("change", F.explode(changes))
        .where(F.col("change").isNotNull())
        .where(F.col("change.at") <= ts(STAR_AS_OF))
    )
    # members in name order, as canonical text has them; computed once, used
    # for the text behind the event key and for the payload
    members = {"id": F.col("record_id"), "created_at": _iso(F.col("first_at")), **row}
    number = F.col("number")
    copies = F.when(number % 31 == 3, F.array(F.lit(0), F.lit(5))).otherwise(F.array(F.lit(0)))
    computed = exploded.select(
        F.col("change.source_table").alias("source_table"),
        F.col("change.operation").alias("operation"),
        "record_id",
        F.col("change.at").alias("commit_timestamp"),
        plus(F.col("change.at"), number % 7919, "millisecond").alias("arrived"),
        *(members[name].alias(f"member_{name}") for name in sorted(members)),
        F.explode(copies).alias("resent"),
    )
    key_only = F.struct(F.col("record_id").alias("id"))
    full = F.struct(*(F.col(f"member_{name}").alias(name) for name in sorted(members)))
    deleted = F.col("operation") == "d"
    options = {"ignoreNullFields": "false"}
    text = F.when(deleted, F.to_json(key_only)).otherwise(F.to_json(full, options))
    key = P.event_key(
        F.col("source_table"),
        F.col("operation"),
        F.col("record_id"),
        F.col("commit_timestamp"),
        text,
    )
    return computed.select(
        key.alias("event_key"),
        "source_table",
        "operation",
        "record_id",
        F.when(deleted, F.to_variant_object(key_only))
        .otherwise(F.to_variant_object(full))
        .alias("event_data"),
        "commit_timestamp",
        plus(F.col("arrived"), F.col("resent"), "second").alias("ingested_at"),
        text.alias(CANONICAL),
    )


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    first = plus(ts(FIRST_CUSTOMER), (key * 37) % 2400, "day")
    rows = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            "c_name",
            F.col("n_name").alias("country"),
            first.alias("first_at"),
        )
    )
    at = F.col("first_at")
    changes = F.array(
        _change("customers", at, "c", full_name=F.col("c_name")),
        F.when(
            key % 7 == 0,
            _change(
                "customers", plus(at, 30, "day"), "c", full_name=F.upper(F.col("c_name"))
            ),
        ),
        F.when(
            key % 97 == 5,
            _change("customers", plus(at, 60, "day"), "d", full_name=F.col("c_name")),
        ),
    )
    body = {
        "email": F.concat(F.lower(F.col("c_name")), F.lit("@example.com")),
        "full_name": F.col("change.full_name"),
        "country": F.col("country"),
        "updated_at": _iso(F.col("change.at")),
    }
    return _log(rows, key, key, changes, body)


def product_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    digits = key.cast("string")
    rows = table(spark, sf_dir, "part").withColumn("first_at", ts(FIRST_CUSTOMER))
    body = {
        "sku": F.concat(F.lit("SKU-"), _padded(digits, 5)),
        "name": F.col("p_name"),
        "category": F.col("p_type"),
        "price_cents": cents(F.col("p_retailprice")),
        "stock_qty": ((key * 37) % 200).cast("int"),
        "updated_at": _iso(F.col("change.at")),
    }
    changes = F.array(_change("products", F.col("first_at"), "c"))
    return _log(rows, key, key, changes, body)


def _padded(digits: Column, width: int) -> Column:
    """Zero-padded to a width; longer text stays whole."""
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def order_time(orderdate: Column, orderkey: Column) -> Column:
    return plus(orderdate, orderkey % 86400, "second")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key = F.col("o_orderkey")
    rows = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(
            nation,
            (F.col("c_nationkey") + key % 3) % NATIONS == F.col("n_nationkey"),
        )
        .withColumn("first_at", order_time(F.col("o_orderdate"), key))
    )
    at = F.col("first_at")
    method = F.element_at(
        F.array(*(F.lit(m) for m in PAYMENT_METHODS)), (key % 4 + 1).cast("int")
    )

    def step(moment: Column, status: str) -> Column:
        paid_by = F.lit(None).cast("string") if status == "pending" else method
        return _change("orders", moment, "c", status=F.lit(status), payment_method=paid_by)

    kept = key % 10 != 0
    settled = kept & F.col("o_orderstatus").isin("O", "F")
    cancelled = key % 20 == 1
    changes = F.array(
        step(at, "pending"),
        F.when(kept, step(plus(at, 1, "hour"), "paid")),
        F.when(settled & cancelled, step(plus(at, 1, "day"), "cancelled")),
        F.when(settled & ~cancelled, step(plus(at, 1, "day"), "shipped")),
        F.when(
            kept & (F.col("o_orderstatus") == "F") & ~cancelled,
            step(plus(at, 3, "day"), "delivered"),
        ),
        F.when(
            key % 50 == 7,
            _change(
                "orders",
                plus(at, 5, "day"),
                "d",
                status=F.lit("deleted"),
                payment_method=method,
            ),
        ),
    )
    body = {
        "customer_id": F.col("o_custkey").cast("string"),
        "total_cents": cents(F.col("o_totalprice")),
        "status": F.col("change.status"),
        "payment_method": F.col("change.payment_method"),
        "ship_country": F.col("n_name"),
        "updated_at": _iso(F.col("change.at")),
    }
    return _log(rows, key, key, changes, body)


def order_item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    key = F.col("l_orderkey")
    rows = (
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_extendedprice",
        )
        .join(orders, key == F.col("o_orderkey"))
        .withColumn("first_at", order_time(F.col("o_orderdate"), key))
    )
    record = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    body = {
        "order_id": key.cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price_cents": F.round(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast(
            "bigint"
        ),
    }
    changes = F.array(_change("order_items", F.col("first_at"), "c"))
    return _log(rows, key, record, changes, body)


STAR_LOGS = {
    "customers": customer_log,
    "products": product_log,
    "orders": order_log,
    "order_items": order_item_log,
}


#: Logs written out once, by table folder and name; ``materialise`` fills it.
_WRITTEN: dict[tuple[str, str], str] = {}
FILES = 16


def materialise(spark: SparkSession, sf_dir: str) -> None:
    """Write the logs of a table folder to files once, by commit time, so that
    questions read a log instead of deriving it first."""
    logs = {name: make(spark, sf_dir).drop(CANONICAL) for name, make in STAR_LOGS.items()}
    logs["events"] = _event_log(spark, sf_dir)
    logs["archive"] = archived(logs["events"])
    for name, log in logs.items():
        path = scratch_dir(spark, name)
        by_time = log.repartitionByRange(FILES, "commit_timestamp")
        by_time.sortWithinPartitions("commit_timestamp").write.parquet(path)
        _WRITTEN[sf_dir, name] = path


def _written(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    path = _WRITTEN.get((sf_dir, name))
    return None if path is None else configure(spark).read.parquet(path)


def star_log(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """One log of the named source tables, or of all four."""
    logs = []
    for name in tables or STAR_LOGS:
        written = _written(spark, sf_dir, name)
        made = STAR_LOGS[name](spark, sf_dir).drop(CANONICAL)
        logs.append(made if written is None else written)
    log = logs[0]
    for other in logs[1:]:
        log = log.unionByName(other)
    return log


def star_archive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table's log with its payload as text, as an archive has it."""
    written = _written(spark, sf_dir, name)
    if written is not None:
        return written.withColumn("event_data", F.to_json("event_data"))
    log = STAR_LOGS[name](spark, sf_dir)
    return log.withColumn("event_data", F.col(CANONICAL)).drop(CANONICAL)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as changes of one ``users`` table, one state per user."""
    user = F.col("user_id")
    row = F.struct(
        user.alias("id"),
        F.col("event_type").alias("status"),
        "value",
        "props",
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.lit("users").alias("source_table"),
        F.when(F.col("event_type") == "error", "d").otherwise("c").alias("operation"),
        user.cast("string").alias("record_id"),
        F.to_json(row).alias("row_json"),
        F.col("ts").alias("commit_timestamp"),
        plus(F.col("ts"), F.col("event_id") % 7919, "millisecond").alias("ingested_at"),
    )


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table's log with ``event_id``."""
    rows = event_rows(spark, sf_dir).select(
        "event_id",
        "source_table",
        "operation",
        "record_id",
        F.parse_json("row_json").alias("event_data"),
        "commit_timestamp",
        "ingested_at",
    )
    return P.with_event_key(rows)


def archived(log: DataFrame) -> DataFrame:
    """A log of the event table as its archive has it."""
    return log.withColumn("event_data", F.to_json("event_data")).withColumn(
        "snapshot_id", snapshot_day(F.col("commit_timestamp"))
    )


def _kept(rows: DataFrame, keep: str | None) -> DataFrame:
    return (rows if keep is None else rows.where(keep)).drop("event_id")


def event_log(spark: SparkSession, sf_dir: str, keep: str | None = None) -> DataFrame:
    """Hot log of the event table; ``keep`` is a condition on the events a store holds."""
    written = _written(spark, sf_dir, "events")
    return _kept(_event_log(spark, sf_dir) if written is None else written, keep)


def event_archive(spark: SparkSession, sf_dir: str, keep: str | None = None) -> DataFrame:
    """Archive of the event table: text payload, one snapshot per commit day."""
    written = _written(spark, sf_dir, "archive")
    return _kept(archived(_event_log(spark, sf_dir)) if written is None else written, keep)


def snapshot_day(moment: Column) -> Column:
    first = F.lit("2024-01-01").cast("date")
    return (F.date_diff(moment.cast("date"), first) + 1).cast("bigint")


def repeated_log(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    """The event log so many times over: each copy a day's fraction later, of
    its own users, so that all events differ."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("copy")
    rows = event_log(spark, sf_dir).drop("event_key").select("*", copy)
    moved = F.col("copy") * 7
    return P.with_event_key(
        rows.withColumn("record_id", F.concat_ws("-", "record_id", "copy"))
        .withColumn("commit_timestamp", plus(F.col("commit_timestamp"), moved, "millisecond"))
        .withColumn("ingested_at", plus(F.col("ingested_at"), moved, "millisecond"))
        .drop("copy")
    )


def event_envelopes(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """The event table as base64 change envelopes ``(arrival_id, data)``.

    With ``faults`` some records are damaged, each by its own rule, so that
    every reject reason has rows.
    """
    rows = event_rows(spark, sf_dir)
    row = F.col("row_json")
    at = epoch_ms(F.col("commit_timestamp")).cast("string")
    image = F.when(F.col("operation") == "d", "before").otherwise("after")
    op, row_text, ms, tail = F.col("operation"), row, at, F.lit("}")
    number = F.col("event_id")
    if faults:
        op = F.when(number % 101 == 1, "x").otherwise(op)
        row_text = (
            F.when(number % 101 == 2, "{}")
            .when(number % 101 == 3, "null")
            .when(number % 101 == 4, '"text"')
            .when(number % 101 == 5, '{"status":"view"}')
            .when(number % 101 == 6, '{"id":null}')
            .otherwise(row)
        )
        ms = F.when(number % 101 == 7, "null").when(number % 101 == 8, "5.7").otherwise(at)
        tail = F.when(number % 101 == 9, "").otherwise("}")
    text = F.concat(
        F.lit('{"op":"'), op, F.lit('","'), image, F.lit('":'), row_text,
        F.lit(',"source":{"table":"'), F.col("source_table"),
        F.lit('"},"ts_ms":'), ms, tail,
    )
    data = F.base64(text.cast("binary"))
    if faults:
        data = (
            F.when(number % 101 == 10, "@@@")
            .when(number % 101 == 11, F.base64(F.lit("[1]").cast("binary")))
            .otherwise(data)
        )
    return rows.select(F.col("event_id").cast("string").alias("arrival_id"), data.alias("data"))


# Records a container holds, and which containers are damaged.
CONTAINER_RECORDS = 100
TORN, NO_ARRAY, NAMELESS = 5, 7, 9


def event_containers(
    spark: SparkSession, sf_dir: str, form: Form = DELIVERY, faults: bool = True
) -> DataFrame:
    """The event table's envelopes in containers ``(container_id, body)``.

    With ``faults`` records are damaged as in ``event_envelopes``, and of every
    13 containers one is torn, one holds no array and one has a record without
    an id, where the form has ids.
    """
    number = F.col("arrival_id").cast("bigint")
    container = F.floor(number / CONTAINER_RECORDS).cast("bigint")
    nameless = (container % 13 == NAMELESS) & (number % CONTAINER_RECORDS == 50)
    record = F.col("data")
    for name in reversed(form.data.split(".")):
        record = F.struct(record.alias(name))
    if form.record_id is not None:
        given = F.when(F.lit(faults) & nameless, None).otherwise(F.col("arrival_id"))
        record = F.struct(given.alias(form.record_id), *(record[c] for c in form.data.split(".")[:1]))
    grouped = (
        event_envelopes(spark, sf_dir, faults)
        .select(container.alias("container_id"), F.struct(number.alias("n"), record.alias("r")).alias("r"))
        .groupBy("container_id")
        .agg(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["r"]).alias("records"))
    )
    body = F.to_json(F.struct(F.col("records").alias(form.records)))
    if faults:
        kind = F.col("container_id") % 13
        body = (
            F.when(kind == TORN, F.substring(body, 1, 100))
            .when(kind == NO_ARRAY, F.lit(f'{{"{form.records}":{{}}}}'))
            .otherwise(body)
        )
    return grouped.select("container_id", body.alias("body"))
