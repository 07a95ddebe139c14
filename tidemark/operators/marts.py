"""Gold marts and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant, is_open
from tidemark.operators.conform import renamed
from tidemark.operators.keysets import own_exchange
from tidemark.operators.lookups import latest_per_key

# Landed stock-holding columns and their mart names.
HOLDING = {
    "Stock Item Key": "stock_item_key",
    "Quantity On Hand": "quantity_on_hand",
    "Bin Location": "bin_location",
    "Last Stocktake Quantity": "last_stocktake_quantity",
    "Last Cost Price": "last_cost_price",
    "Reorder Level": "reorder_level",
    "Target Stock Level": "target_stock_level",
}


def mart_daily_sales(fact: DataFrame, date: DataFrame, item: DataFrame) -> DataFrame:
    """Sales by day and stock item.

    The fact is summed to (day, item) before it meets the dimensions, so it is shuffled once, as
    partial sums. The second grouping merges what a repeated dimension row would split; it reuses the
    partitioning of the first where the dimensions are broadcast.
    """
    daily = fact.groupBy("invoice_date_key", "stock_item_key").agg(
        F.sum("quantity").alias("q"),
        F.sum("total_including_tax").alias("g"),
        F.sum("profit").alias("p"),
        F.count("*").alias("n"),
    )
    days = date.select(F.col("date_key").alias("invoice_date_key"))
    items = item.select("stock_item_key", "stock_item_id", "stock_item_name")
    return (
        daily.join(days, "invoice_date_key")
        .join(items, "stock_item_key")
        .groupBy("invoice_date_key", "stock_item_key", "stock_item_id", "stock_item_name")
        .agg(
            F.sum("q").alias("quantity_sold"),
            F.sum("g").alias("gross_revenue"),
            F.sum("p").alias("profit"),
            F.sum("n").alias("transaction_count"),
        )
        .withColumnRenamed("invoice_date_key", "sale_date")
    )


def mart_stock_movements(
    item: DataFrame, holding: DataFrame, tie_breakers: tuple[str, ...] = ("Bin Location",)
) -> DataFrame:
    """Every stock item with its latest holding; items without stock keep NULLs."""
    needed = ["Stock Item Key", "Quantity On Hand", "Quantity Allocated", "Last Edited When"]
    columns = [*needed, *(c for c in tie_breakers if c not in needed)]
    newest = [F.col(f"`{c}`").desc() for c in ("Last Edited When", *tie_breakers)]
    latest = latest_per_key(
        holding.select(*(f"`{c}`" for c in columns)), ["Stock Item Key"], newest
    ).select(
        F.col("`Stock Item Key`").alias("stock_item_key"),
        F.col("`Quantity On Hand`").alias("quantity_on_hand"),
        F.col("`Quantity Allocated`").alias("quantity_allocated"),
    )
    return item.join(latest, "stock_item_key", "left").select(
        "stock_item_key",
        "stock_item_id",
        "stock_item_name",
        "brand",
        "size",
        "lead_time_days",
        "quantity_on_hand",
        "quantity_allocated",
        (F.col("quantity_on_hand") - F.col("quantity_allocated")).alias("quantity_available"),
    )


def mart_customer_current(customer: DataFrame, city: DataFrame) -> DataFrame:
    """Current customers with the current row of their city.

    The city dimension keeps every version of a city under one id. Joining all of them would repeat a
    customer once per version, so only the open city row is joined.
    """
    cities = city.filter(is_open(F.col("valid_to"))).select(
        "city_id", "city_name", "state_province", "country"
    )
    return (
        customer.filter(F.col("is_current"))
        .join(cities, "city_id", "left")
        .select(
            "customer_key",
            "customer_id",
            "customer_name",
            "bill_to_customer_id",
            "category",
            "buying_group_id",
            "city_id",
            "city_name",
            "state_province",
            "country",
        )
    )


def mart_city_dimension(city: DataFrame) -> DataFrame:
    return city.select(
        "city_key",
        "city_id",
        "city_name",
        "state_province",
        "country",
        "latest_population",
        "valid_from",
        "valid_to",
    )


def mart_stock_holding(bronze: DataFrame, as_of: Instant) -> DataFrame:
    return bronze.select(*renamed(HOLDING), instant(as_of).alias("as_of_ts"))


def top_items(mart: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best-selling named items; ties go to the name that sorts first."""
    return (
        mart.filter(F.col("stock_item_name").isNotNull())
        .groupBy("stock_item_name")
        .agg(
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("profit").alias("profit"),
            F.sum("quantity_sold").alias("quantity_sold"),
        )
        .orderBy(F.desc("gross_revenue"), "stock_item_name")
        .limit(n)
    )


def customers_by_country(mart: DataFrame) -> DataFrame:
    return (
        mart.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "country")
    )


def sample_fact(fact: DataFrame, key: str | Column = "Sale Key", n: int = 1000) -> DataFrame:
    """The first ``n`` facts by key, as the fixture export takes them."""
    order = key if isinstance(key, Column) else F.col(f"`{key}`")
    return fact.orderBy(order).limit(n)
