from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.compare import DATA
from tests.logs import at
from tests.logs import log as hand_made
from tidelog.functions.times import epoch_ms, from_epoch_ms, from_epoch_us
from tidelog.operators import tiering
from tidelog.plans import health
from tidelog.plans.views import refresh_views, register_views
from tidelog.schemas import SOURCE_TABLES
from tidelog.sources import bindings, store, tables

SF_DIR = f"{DATA}/sf0.001"
YEAR = timedelta(days=365)


@pytest.fixture(scope="module")
def log(spark):
    log = bindings.star_log(spark, SF_DIR)
    archive = log.withColumn("event_data", F.to_json("event_data"))
    register_views(log, archive, bindings.STAR_AS_OF, YEAR)
    return log


def test_all_views_exist(spark, log):
    names = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert {"cdc_events", "cdc_events_all", "cdc_events_archive"} <= names
    for table in SOURCE_TABLES:
        assert {f"{table}_current", f"{table}_unified"} <= names


def test_unified_views_hold_what_the_current_views_hold(spark, log):
    for table in SOURCE_TABLES:
        current = sorted(spark.table(f"{table}_current").collect())
        unified = spark.table(f"{table}_unified")
        assert {r.source_store for r in unified.select("source_store").collect()} <= {"hot", "cold"}
        assert sorted(unified.drop("source_store").collect()) == current


@pytest.fixture
def small(spark):
    """Six orders: two old ones only in the archive, one deleted, one changed."""
    old = [("c", "a", 1, "pending"), ("c", "b", 2, "paid")]
    new = [
        ("c", "c", 2000, "pending"),
        ("c", "c", 2010, "shipped"),
        ("c", "d", 2020, "paid"),
        ("d", "e", 2030, None),
        ("c", "f", 2040, "paid"),
    ]
    hot = hand_made(spark, *new)
    cold = hand_made(spark, *old, *new, text=True)
    register_views(hot, cold, at(60 * 48))
    return hot


def test_status_counts_asked_of_the_current_view(spark, small):
    counted = spark.sql(
        "SELECT status, count(*), max(total_cents) FROM orders_current GROUP BY ALL ORDER BY ALL"
    )
    assert [tuple(r) for r in counted.collect()] == [("paid", 2, 100), ("shipped", 1, 100)]


def test_keys_by_store_asked_of_the_unified_view(spark, small):
    listed = spark.sql(
        "SELECT source_store, array_sort(collect_list(order_id)) FROM orders_unified"
        " GROUP BY ALL ORDER BY ALL"
    )
    assert [tuple(r) for r in listed.collect()] == [("cold", ["a", "b"]), ("hot", ["c", "d", "f"])]


def test_refreshed_views_follow_appends_and_prunes(spark, tmp_path):
    hot, cold = str(tmp_path / "hot"), str(tmp_path / "cold")

    def send(batch, *events):
        store.append_batch(hand_made(spark, *events), hot, batch)
        archived = hand_made(spark, *events, text=True)
        store.append_batch(archived.withColumn("snapshot_id", F.lit(batch + 1)), cold, batch)

    def keys(view):
        return sorted(r.order_id for r in spark.table(view).select("order_id").collect())

    send(0, *[("c", f"k{n}", 60 * n, "paid") for n in range(10)])
    refresh_views(spark, hot, cold, at(60 * 12))
    assert len(keys("orders_current")) == 10
    send(1, *[("c", f"l{n}", 60 * (40 + n), "paid") for n in range(10)])
    refresh_views(spark, hot, cold, at(60 * 50))
    assert len(keys("orders_current")) == len(keys("orders_unified")) == 20
    tiering.prune(spark, hot, store.read_cold(spark, cold), at(60 * 68), gate="strict")
    refresh_views(spark, hot, cold, at(60 * 68))
    assert len(keys("orders_current")) == 6
    assert len(keys("orders_unified")) == spark.table("cdc_events_all").count() == 20


def test_payload_path_in_sql(spark, log):
    log.createOrReplaceTempView("cdc_events")
    counted = spark.sql(
        "SELECT try_variant_get(event_data, '$.status', 'string') AS status, COUNT(*) AS n"
        " FROM cdc_events WHERE source_table = 'orders' AND operation <> 'd' GROUP BY 1"
    )
    assert {r.status for r in counted.collect()} == {
        "pending", "paid", "shipped", "delivered", "cancelled",
    }


def test_source_tables_read_with_their_schema(spark, tmp_path):
    made = spark.range(3).select(
        F.col("id").cast("string").alias("id"),
        F.lit("e").alias("email"),
        F.lit("n").alias("full_name"),
        F.lit("DE").alias("country"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )
    made.write.parquet(str(tmp_path / "customers"))
    customers = tables.read_table(spark, str(tmp_path), "customers")
    assert tables.sample(customers, 2).count() == 2
    assert customers.columns == [c.split()[0] for c in SOURCE_TABLES["customers"].split(", ")]


def test_epoch_forms_agree(spark):
    moment = F.lit(1780615647656)
    row = spark.range(1).select(
        from_epoch_ms(moment).alias("ms"), from_epoch_us(moment * 1000).alias("us")
    )
    row = row.withColumn("back", epoch_ms(F.col("ms"))).first()
    assert row.ms == row.us == datetime(2026, 6, 4, 23, 27, 27, 656000)
    assert row.back == 1780615647656


def test_drop_alarm(spark):
    decoded = spark.createDataFrame(
        [(None, datetime(2024, 1, 1, 0, n)) for n in range(9)]
        + [("bad_ts", datetime(2024, 1, 1, 0, 30)), ("bad_ts", datetime(2024, 1, 1, 1, 30))],
        "reason string, at timestamp_ntz",
    )
    rates = health.drop_rate(decoded, F.col("at"))
    assert [(r.records, r.dropped, r.drop_rate) for r in rates.collect()] == [
        (10, 1, 0.1),
        (1, 1, 1.0),
    ]
    assert [r.window_start.hour for r in health.drop_alarm(rates, 0.1).collect()] == [1]
