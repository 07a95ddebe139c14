"""Silver: conformed dimensions, the fact and its orphans.

The rename tables are fixed values: left the landed column, right the conformed one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant_like, is_open
from tidemark.operators.keysets import key_set

CITY = {
    "City Key": "city_key",
    "WWI City ID": "city_id",
    "City": "city_name",
    "State Province": "state_province",
    "Country": "country",
    "Latest Recorded Population": "latest_population",
    "Valid From": "valid_from",
    "Valid To": "valid_to",
}
STOCK_ITEM = {
    "Stock Item Key": "stock_item_key",
    "WWI Stock Item ID": "stock_item_id",
    "Stock Item": "stock_item_name",
    "Brand": "brand",
    "Size": "size",
    "Lead Time Days": "lead_time_days",
    "Valid From": "valid_from",
    "Valid To": "valid_to",
}
DATE = {
    "Date": "date_key",
    "Day Number": "day_number",
    "Day": "day_name",
    "Month": "month_name",
    "Calendar Year": "calendar_year",
    "Calendar Month Number": "calendar_month_number",
    "Calendar Quarter": "calendar_quarter",
}
CUSTOMER = {
    "Customer Key": "customer_key",
    "WWI Customer ID": "customer_id",
    "Customer": "customer_name",
    "Bill To Customer": "bill_to_customer_id",
    "Category": "category",
    "Buying Group": "buying_group_id",
    "City": "city_id",
    "Valid From": "valid_from",
    "Valid To": "valid_to",
}
SALE = {
    "Sale Key": "sale_key",
    "Invoice Date Key": "invoice_date_key",
    "Customer Key": "customer_key",
    "Stock Item Key": "stock_item_key",
    "Quantity": "quantity",
    "Unit Price": "unit_price",
    "Total Including Tax": "total_including_tax",
    "Profit": "profit",
    "WWI Invoice ID": "wwi_invoice_id",
    "WWI Customer ID": "wwi_customer_id",
    "WWI Stock Item ID": "wwi_stock_item_id",
}
ORPHAN_REASONS = ("customer_and_stock_unmatched", "customer_unmatched", "stock_unmatched")


def renamed(columns: Mapping[str, str]) -> list[Column]:
    return [F.col(f"`{old}`").alias(new) for old, new in columns.items()]


def dim_city(bronze: DataFrame) -> DataFrame:
    return bronze.select(renamed(CITY))


def dim_stock_item(bronze: DataFrame) -> DataFrame:
    return bronze.select(renamed(STOCK_ITEM))


def dim_date(bronze: DataFrame) -> DataFrame:
    return bronze.select(renamed(DATE))


def split_future(df: DataFrame, column: str, as_of: Instant) -> tuple[DataFrame, DataFrame]:
    """Rows valid by ``as_of`` and rows dated after it; a NULL date is in neither."""
    limit = instant_like(df, column, as_of)
    started = F.col(f"`{column}`")
    return df.filter(started <= limit), df.filter(started > limit)


def undated(df: DataFrame, column: str) -> DataFrame:
    """The rows that ``split_future`` leaves out of both sides, for reporting."""
    return df.filter(F.col(f"`{column}`").isNull())


def dim_customer_scd2(bronze: DataFrame, as_of: Instant) -> DataFrame:
    admitted, _ = split_future(bronze, "Valid From", as_of)
    return admitted.select(
        *renamed(CUSTOMER), is_open(F.col("`Valid To`")).alias("is_current")
    )


def fact_sale(bronze: DataFrame, customer: DataFrame, item: DataFrame) -> DataFrame:
    """Facts whose customer and stock item are both known.

    Only the key of each dimension is read. Which side is broadcast is left to the size statistics;
    past the limit the joins are sort-merge and AQE splits a hot key on the fact side.
    """
    customers = customer.select(F.col("customer_key").alias("Customer Key"))
    items = item.select(F.col("stock_item_key").alias("Stock Item Key"))
    return (
        bronze.select(*(f"`{c}`" for c in SALE))
        .join(customers, "Customer Key")
        .join(items, "Stock Item Key")
        .select(renamed(SALE))
    )


def fact_orphans(bronze: DataFrame, customer: DataFrame, item: DataFrame) -> DataFrame:
    """Facts missing a dimension row, each once and with its reason.

    The dimension keys are made distinct first, so a duplicated key cannot repeat an orphan.
    """
    known_customers = key_set(
        customer.select(F.col("customer_key").alias("Customer Key")), "has_customer"
    )
    known_items = key_set(item.select(F.col("stock_item_key").alias("Stock Item Key")), "has_item")
    no_customer, no_item = F.col("has_customer").isNull(), F.col("has_item").isNull()
    both, customer_only, item_only = ORPHAN_REASONS
    return (
        bronze.select("`Sale Key`", "`Customer Key`", "`Stock Item Key`")
        .join(known_customers, "Customer Key", "left")
        .join(known_items, "Stock Item Key", "left")
        .filter(no_customer | no_item)
        .select(
            F.col("`Sale Key`").alias("sale_key"),
            F.col("`Customer Key`").alias("customer_key"),
            F.col("`Stock Item Key`").alias("stock_item_key"),
            F.when(no_customer & no_item, both)
            .when(no_customer, customer_only)
            .otherwise(item_only)
            .alias("orphan_reason"),
        )
    )
