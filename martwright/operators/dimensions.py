"""Dimension builders: date, customer (first version), employee, product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.calendar import (
    calendar_year,
    date_key,
    fiscal_month,
    fiscal_quarter,
    fiscal_year,
    month_name,
)
from martwright.operators.keys import dense_key, with_leading_key

# The open validity range of a first customer version.
OPEN_START = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)

CUSTOMER_ATTRIBUTES = [
    "customer_id",
    "customer_name",
    "customer_category",
    "buying_group",
    "city",
    "state_province",
    "country",
    "sales_territory",
]


def dim_date(orders: DataFrame, invoices: DataFrame) -> DataFrame:
    """One row per day from the earliest to the latest order or invoice date.

    least(min, min) / greatest(max, max) of the two date columns equal the
    min / max over their union: one aggregate (partial on every partition);
    the spine holds one row per calendar day.
    """
    dates = orders.select(F.col("order_date").alias("d")).unionByName(
        invoices.select(F.col("invoice_date").alias("d"))
    )
    bounds = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        month_name(d).alias("month_name"),
        calendar_year(d).alias("calendar_year"),
        fiscal_month(d).alias("fiscal_month"),
        fiscal_quarter(d).alias("fiscal_quarter"),
        fiscal_year(d).alias("fiscal_year"),
    )


def customer_snapshot(
    customers: DataFrame,
    categories: DataFrame,
    buying_groups: DataFrame,
    cities: DataFrame,
    states: DataFrame,
    countries: DataFrame,
    category_id: F.Column | None = None,
) -> DataFrame:
    """Customer attributes resolved through the lookups (snowflake chain).

    ``category_id`` optionally replaces the customer's category id (used to
    build a changed snapshot)."""
    c = customers
    if category_id is not None:
        c = c.withColumn("customer_category_id", category_id)
    cat = categories.select(
        "customer_category_id", F.col("customer_category_name").alias("customer_category")
    )
    grp = buying_groups.select("buying_group_id", F.col("buying_group_name").alias("buying_group"))
    city = cities.select(
        F.col("city_id").alias("delivery_city_id"), F.col("city_name").alias("city"), "state_province_id"
    )
    state = states.select(
        "state_province_id",
        F.col("state_province_name").alias("state_province"),
        "country_id",
        "sales_territory",
    )
    country = countries.select("country_id", F.col("country_name").alias("country"))
    joined = (
        c.join(cat, "customer_category_id")
        .join(grp, "buying_group_id", "left")
        .join(city, "delivery_city_id")
        .join(state, "state_province_id")
        .join(country, "country_id")
    )
    return joined.select(*CUSTOMER_ATTRIBUTES)


def dim_customer_initial(snapshot: DataFrame) -> DataFrame:
    """First version of every customer: open range, current, dense key by id."""
    versions = snapshot.select(
        *CUSTOMER_ATTRIBUTES,
        F.lit(OPEN_START).alias("effective_start_date"),
        F.lit(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )
    return with_leading_key(dense_key(versions, ["customer_id"], "customer_key"), "customer_key")


def dim_employee(people: DataFrame) -> DataFrame:
    """Salespeople only, dense key by person id."""
    sales = people.where(F.col("is_salesperson")).select(
        "person_id", F.col("full_name").alias("employee_name")
    )
    return with_leading_key(dense_key(sales, ["person_id"], "employee_key"), "employee_key")


def first_group(bridge: DataFrame) -> DataFrame:
    """The lowest group id of every item in a many-to-many bridge."""
    return bridge.groupBy("stock_item_id").agg(F.min("stock_group_id").alias("stock_group_id"))


def dim_product(items: DataFrame, bridge: DataFrame, groups: DataFrame) -> DataFrame:
    """Products with their lowest-id group as category (null without group)."""
    product = (
        items.select("stock_item_id", F.col("stock_item_name").alias("product_name"), "brand")
        .join(first_group(bridge), "stock_item_id", "left")
        .join(
            groups.select("stock_group_id", F.col("stock_group_name").alias("product_category")),
            "stock_group_id",
            "left",
        )
        .select("stock_item_id", "product_name", "product_category", "brand")
    )
    return with_leading_key(dense_key(product, ["stock_item_id"], "product_key"), "product_key")
