"""Plans and skew: what must hold when the data is a thousand times larger."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.compare import DATA
from tests.logs import log
from tests.test_queries import LAZY
from tidelog.catalog import QUERIES
from tidelog.operators.state import current_state
from tidelog.operators.unify import one_copy
from tidelog.plans.business import top_products
from tidelog.plans.lifecycle import status_steps
from tidelog.schemas import ORDER_ITEMS, ORDERS
from tidelog.session import scratch_dir

SF_DIR = f"{DATA}/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Treat the tables as too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_pair_joins_no_unchecked_broadcast(large, name):
    text = plan(QUERIES[name](large, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text, operator
    # the only forced broadcasts are bounded: nations, and days with their hash ranges
    hashed = re.findall(r"BroadcastHashJoin \[.*", text)
    assert all("n_nationkey" in line or "gate_day" in line for line in hashed)


def test_ranking_is_limited_before_the_exchange(spark):
    text = plan(current_state(log(spark, ("c", "a", 1, "paid")), ORDERS))
    top, bottom = text.split("Exchange hashpartitioning(source_table", 1)
    assert "Final" in top and "WindowGroupLimit" in top
    assert "WindowGroupLimit" in bottom and "Partial" in bottom


def shuffled_rows(df) -> int:
    """Rows written to the first exchange above the scan."""
    df.collect()
    root = df._jdf.queryExecution().executedPlan()
    stages = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name == "ShuffleQueryStageExec":
            stages.append(node.shuffle().metrics().apply("shuffleRecordsWritten").value())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(root)
    return stages[0]


def test_a_hot_key_crosses_the_exchange_once_per_task(spark, tmp_path):
    path = str(tmp_path / "log")
    hot = [("c", "hot", n % 9, f"s{n % 3}", n) for n in range(3000)]
    cold = [("c", f"k{n}", n % 9, "paid") for n in range(100)]
    log(spark, *hot, *cold).repartition(4).write.parquet(path)
    events = spark.read.parquet(path)
    tasks = events.rdd.getNumPartitions()
    assert shuffled_rows(current_state(events, ORDERS)) <= 100 + tasks
    copies = log(spark, *[("c", "a", 1, "paid", n) for n in range(3000)]).repartition(4)
    copies.write.parquet(str(tmp_path / "copies"))
    assert shuffled_rows(one_copy(spark.read.parquet(str(tmp_path / "copies")))) <= tasks


def test_a_hot_order_is_split_in_the_join(large, tmp_path):
    """A third of all items belong to one order."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",  # of 8 partitions
    }
    before = {k: large.conf.get(k) for k in settings}
    for k, v in settings.items():
        large.conf.set(k, v)
    try:
        rows = large.range(0, 60000, numPartitions=6)
        body = F.struct(
            F.when(F.col("id") % 3 == 0, "7")
            .otherwise((F.col("id") % 4000).cast("string"))
            .alias("order_id"),
            (F.col("id") % 50).cast("string").alias("product_id"),
            F.lit(1).alias("quantity"),
            F.lit(10).alias("unit_price_cents"),
        )
        moment = F.lit("2024-01-01").cast("timestamp_ntz")

        def written(df, table, name):
            df.select(
                F.sha2(F.col("id").cast("string"), 256).alias("event_key"),
                F.lit(table).alias("source_table"),
                F.lit("c").alias("operation"),
                F.col("id").cast("string").alias("record_id"),
                F.to_variant_object(F.col("body")).alias("event_data"),
                moment.alias("commit_timestamp"),
                moment.alias("ingested_at"),
            ).write.parquet(str(tmp_path / name))
            return large.read.parquet(str(tmp_path / name))

        items = written(rows.withColumn("body", body), "order_items", "items")
        order = F.struct(F.lit("paid").alias("status"))
        orders = written(
            large.range(0, 4000, numPartitions=3).withColumn("body", order), "orders", "orders"
        )
        products = large.range(50).select(
            F.col("id").cast("string").alias("product_id"),
            F.concat(F.lit("p"), F.col("id")).alias("name"),
            F.lit("c").alias("category"),
        )
        sold = top_products(
            current_state(items, ORDER_ITEMS),
            products,
            current_state(orders, ORDERS),
            datetime(2024, 1, 1, 1),
            k=100,
        )
        assert sum(r.units_sold for r in sold.collect()) == 60000
        assert "SortMergeJoin(skew=true) [order_id" in plan(sold)
    finally:
        for k, v in before.items():
            large.conf.set(k, v)


def test_status_steps_split_a_long_history(spark):
    history = [("c", "a", n * 7, f"s{n}") for n in range(60)] + [("c", "b", 5, "s0")]
    steps = status_steps(log(spark, *history, *history[:10]), bucket="hour").collect()
    a = sorted((r.commit_timestamp, r.from_status, r.to_status) for r in steps if r.record_id == "a")
    assert [s[1:] for s in a] == [
        ("new" if n == 0 else f"s{n - 1}", f"s{n}") for n in range(60)
    ]
    assert [r.from_status for r in steps if r.record_id == "b"] == ["new"]


def test_scratch_folder_follows_the_shared_setting(spark):
    class Session:
        def __init__(self, **settings):
            self.settings = settings
            self.conf = self

        def get(self, key, default=None):
            return self.settings.get(key, default)

    shared = Session(**{"spark.checkpoint.dir": "hdfs://shared/ck/", "spark.master": "yarn"})
    assert scratch_dir(shared, "x").startswith("hdfs://shared/ck/x-")
    with pytest.raises(RuntimeError):
        scratch_dir(Session(**{"spark.master": "yarn"}), "x")
    assert scratch_dir(Session(**{"spark.master": "local[8]"}), "x")
