"""Sales, fraud, inventory, cart and lifetime-value questions.

Each takes current-state DataFrames and ``as_of``, the moment the question is
asked; lookbacks default to the live dashboard's windows. Pass states built
with ``changed_since=as_of - lookback`` to read only the recent log.

Joins run on rows already reduced to what the answer needs. Sums per key are
formed before a join to a dimension, so one hot product or customer reaches
the join as one row.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.numbers import dollars, percent, ratio
from tidelog.functions.times import day_floor, floor_to, minutes_between, ts
from tidelog.schemas import SOLD

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def _sold(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status").isin(*SOLD))


def _changed_since(state: DataFrame, moment: datetime) -> DataFrame:
    return state.where(F.col("last_change_at") >= ts(moment))


def sold_since(orders: DataFrame, moment: datetime) -> DataFrame:
    """Ids of sold orders changed since a moment; ``state.naming`` finds their items."""
    return _changed_since(_sold(orders), moment).select("order_id")


def sales_velocity(orders: DataFrame, as_of: datetime, lookback: timedelta = HOUR) -> DataFrame:
    """Sold orders and revenue per minute of their last change, newest first."""
    return (
        _changed_since(_sold(orders), as_of - lookback)
        .groupBy(floor_to("minute", F.col("last_change_at")).alias("minute"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            dollars(F.sum("total_cents")).alias("revenue_dollars"),
        )
        .orderBy(F.desc("minute"))
    )


def top_products(
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    as_of: datetime,
    k: int = 20,
    lookback: timedelta | None = None,
) -> DataFrame:
    """The ``k`` best-selling products of today, or of the ``lookback``."""
    start = day_floor(as_of) if lookback is None else as_of - lookback
    sold = _changed_since(_sold(orders), start).select("order_id")
    per_product = (
        items.select("order_id", "product_id", "quantity", "unit_price_cents")
        .join(sold, "order_id")
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum(F.col("quantity") * F.col("unit_price_cents")).alias("cents"),
        )
    )
    return (
        per_product.join(products.select("product_id", "name", "category"), "product_id")
        .groupBy("name", "category")
        .agg(
            F.sum("units").alias("units_sold"),
            dollars(F.sum("cents")).alias("revenue_dollars"),
        )
        .orderBy(F.desc("units_sold"), "name", "category")
        .limit(k)
    )


def conversion_funnel(orders: DataFrame, as_of: datetime, lookback: timedelta = DAY) -> DataFrame:
    """How recently changed orders spread over the lifecycle states."""
    per_status = (
        _changed_since(orders, as_of - lookback)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("orders"), dollars(F.sum("total_cents")).alias("dollars"))
    )
    return with_share(per_status, F.col("orders"), "pct_of_total").orderBy(
        F.desc("orders"), "status"
    )


def with_share(grouped: DataFrame, count: Column, name: str) -> DataFrame:
    """Each group's percentage of the total count.

    The window has no partition key, so give it grouped rows of a short list,
    such as one row per status.
    """
    total = F.sum(count).over(Window.partitionBy())
    return grouped.withColumn(name, percent(count, total))


def high_value_new_customers(
    orders: DataFrame,
    customers: DataFrame,
    as_of: datetime,
    min_cents: int = 50_000,
    order_lookback: timedelta = HOUR,
    customer_lookback: timedelta = DAY,
) -> DataFrame:
    """Large paid orders of customers whose record changed recently."""
    recent = _changed_since(customers, as_of - customer_lookback).select(
        "customer_id", F.col("last_change_at").alias("signed_up_at")
    )
    large = _changed_since(orders, as_of - order_lookback).where(
        (F.col("status") == "paid") & (F.col("total_cents") >= min_cents)
    )
    return (
        large.select("order_id", "customer_id", "total_cents", "ship_country", "last_change_at")
        .join(recent, "customer_id")
        .orderBy(F.desc("total_cents"), "order_id")
        .select(
            "order_id",
            "customer_id",
            dollars(F.col("total_cents")).alias("dollars"),
            "ship_country",
            "signed_up_at",
            "last_change_at",
        )
    )


def order_bursts(
    orders: DataFrame, as_of: datetime, min_orders: int = 5, lookback: timedelta = HOUR
) -> DataFrame:
    """Customers with many orders in the window, and the countries shipped to.

    Orders are first summed per customer and country, so a customer with a
    third of all orders arrives as one row per country.
    """
    per_country = (
        _changed_since(orders, as_of - lookback)
        .groupBy("customer_id", "ship_country")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_cents").alias("cents"))
    )
    return (
        per_country.groupBy("customer_id")
        .agg(
            F.sum("n").alias("orders_last_hour"),
            dollars(F.sum("cents")).alias("dollars"),
            listed("ship_country").alias("countries"),
        )
        .where(F.col("orders_last_hour") >= min_orders)
        .orderBy(F.desc("orders_last_hour"), "customer_id")
    )


def listed(column: str, separator: str = ",") -> Column:
    """Distinct values in order, as one separated string."""
    return F.expr(
        f"listagg(distinct {column}, '{separator}') within group (order by {column})"
    )


def quantity_sold(items: DataFrame, orders: DataFrame, name: str) -> DataFrame:
    """Quantity per product over the given orders."""
    return (
        items.select("order_id", "product_id", "quantity")
        .join(orders.select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias(name))
    )


def demand_surge(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    as_of: datetime,
    factor: float = 2,
    min_qty: int = 5,
    lookback: timedelta = HOUR,
    baseline: timedelta = DAY,
    baseline_units: int = 24,
) -> DataFrame:
    """Products selling faster in the lookback than in the window before it.

    ``baseline_units`` is the number of lookbacks the baseline holds. Both
    windows are summed in one pass over the items joined to their orders.
    """
    recent_start = as_of - lookback
    recent = F.col("last_change_at") >= ts(recent_start)
    sold = _changed_since(_sold(orders), recent_start - baseline).select(
        "order_id", recent.alias("recent")
    )
    quantity = F.col("quantity")
    per_product = (
        items.select("order_id", "product_id", "quantity")
        .join(sold, "order_id")
        .groupBy("product_id")
        .agg(
            F.sum(F.when(F.col("recent"), quantity)).alias("last_hour"),
            F.sum(F.when(~F.col("recent"), quantity)).alias("baseline_qty"),
        )
    )
    per_unit = F.col("baseline_qty").cast("double") / F.lit(float(baseline_units))
    return (
        per_product.where(F.col("last_hour") >= min_qty)
        .where(F.col("last_hour") > factor * per_unit)
        .join(products.select("product_id", "sku", "name", "stock_qty"), "product_id")
        .select(
            "sku",
            "name",
            F.col("stock_qty").alias("current_stock"),
            per_unit.alias("baseline_per_hr"),
            "last_hour",
            ratio(F.col("last_hour") * baseline_units, F.col("baseline_qty")).alias(
                "surge_multiplier"
            ),
        )
        .orderBy(F.desc("surge_multiplier"), "sku")
    )


def low_stock(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    as_of: datetime,
    lookback: timedelta = HOUR,
) -> DataFrame:
    """Products whose stock is below what the lookback sold."""
    recent = _changed_since(_sold(orders), as_of - lookback)
    velocity = quantity_sold(items, recent, "hourly_rate")
    return (
        products.select("product_id", "sku", "name", F.col("stock_qty").alias("current_stock"))
        .join(velocity, "product_id")
        .where(F.col("current_stock") < F.col("hourly_rate"))
        .select(
            "sku",
            "name",
            "current_stock",
            "hourly_rate",
            ratio(F.col("current_stock"), F.col("hourly_rate")).alias("hours_of_inventory"),
        )
        .orderBy("hours_of_inventory", "sku")
    )


def abandoned_carts(
    orders: DataFrame,
    customers: DataFrame,
    as_of: datetime,
    k: int = 100,
    idle: timedelta = timedelta(minutes=30),
    lookback: timedelta = DAY,
) -> DataFrame:
    """The ``k`` largest orders pending for at least ``idle``."""
    pending = _changed_since(orders, as_of - lookback).where(
        (F.col("status") == "pending") & (F.col("last_change_at") <= ts(as_of - idle))
    )
    return (
        pending.select("order_id", "customer_id", "total_cents", "last_change_at")
        .join(customers.select("customer_id", "email", "full_name"), "customer_id")
        .orderBy(F.desc("total_cents"), "order_id")
        .limit(k)
        .select(
            "order_id",
            "email",
            "full_name",
            dollars(F.col("total_cents")).alias("dollars"),
            F.col("last_change_at").alias("placed_at"),
            minutes_between(F.col("last_change_at"), ts(as_of)).alias("minutes_pending"),
        )
    )


def ltv_by_country(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, orders and revenue per country; customers without orders count.

    Both states hold one row per key, so distinct customers and orders are
    plain counts once orders are summed per customer.
    """
    per_customer = (
        _sold(orders)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("total_cents").alias("priced"),
            F.sum("total_cents").alias("cents"),
        )
    )
    cents = F.sum("cents")
    return (
        customers.select("customer_id", "country")
        .join(per_customer, "customer_id", "left")
        .groupBy("country")
        .agg(
            F.count("customer_id").alias("customers"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orders"),
            dollars(cents).alias("gross_revenue_dollars"),
            dollars(cents.cast("double") / F.nullif(F.sum("priced"), F.lit(0))).alias(
                "avg_order_value_dollars"
            ),
        )
        .orderBy(F.desc_nulls_last("gross_revenue_dollars"), "country")
    )
