"""The ten business questions over the star schema.

Shapes chosen for scale:

* facts are aggregated by the dimension key first (partial aggregation on
  every map task), and only the much smaller per-key result is joined to the
  dimension attributes (Q1-Q4, Q10);
* rankings use ``orderBy().limit()`` (TakeOrderedAndProject: k rows per
  task travel, not the table) or a rank filter per group, which Spark turns
  into a WindowGroupLimit before the exchange;
* the three geography levels of Q4 are one GROUPING SETS aggregate over one
  scan, not three;
* every ranking has a deterministic tie-breaker (natural key columns) and
  explicit null placement, so results do not depend on task order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions.money import money_sum, qty_sum, ratio_percent
from martwright.operators.joins import join_checked

# Labels written by the reference.
TOP_BY_SALES = "Top by sales"
TOP_BY_PROFIT = "Top by profit"
LEVEL_TERRITORY = "Territory"
LEVEL_STATE = "State/Province"
LEVEL_CITY = "City"
HISTORY_SEPARATOR = " -> "


def _sales_by(fact_sale: DataFrame, key: str) -> DataFrame:
    return fact_sale.groupBy(key).agg(
        F.sum("sales").alias("_sales"),
        F.sum("profit").alias("_profit"),
        F.sum("invoiced_quantity").alias("_qty"),
    )


def q01_monthly_sales(fact_sale: DataFrame, dim_date: DataFrame) -> DataFrame:
    by_day = _sales_by(fact_sale, "date_key")
    joined = by_day.join(dim_date, "date_key")
    out = joined.groupBy("calendar_year", "month_name", "fiscal_year", "fiscal_quarter").agg(
        money_sum("_sales").alias("sales"),
        qty_sum("_qty").alias("quantity_sold"),
        money_sum("_profit").alias("profit"),
        F.min("date_key").alias("_first_day"),
    )
    return out.orderBy(F.asc_nulls_last("calendar_year"), "_first_day").drop("_first_day")


def q02_top_products(fact_sale: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    by_product = _sales_by(fact_sale, "product_key")
    totals = (
        by_product.join(dim_product, "product_key")
        .groupBy("product_category", "product_name")
        .agg(money_sum("_sales").alias("sales"), money_sum("_profit").alias("profit"))
    )
    ties = [F.asc_nulls_last("product_category"), F.asc_nulls_last("product_name")]
    by_sales = totals.orderBy(F.desc_nulls_last("sales"), *ties).limit(k)
    by_profit = totals.orderBy(F.desc_nulls_last("profit"), *ties).limit(k)
    cols = ["ranking", "product_category", "product_name", "sales", "profit"]
    out = by_sales.select(F.lit(TOP_BY_SALES).alias("ranking"), *cols[1:]).unionByName(
        by_profit.select(F.lit(TOP_BY_PROFIT).alias("ranking"), *cols[1:])
    )
    return out.orderBy("ranking", F.desc_nulls_last("sales"), *ties)


def q03_top_customers(fact_sale: DataFrame, dim_customer: DataFrame, k: int = 20) -> DataFrame:
    by_version = _sales_by(fact_sale, "customer_key")
    totals = (
        by_version.join(dim_customer, "customer_key")
        .groupBy("customer_id", "customer_name", "customer_category")
        .agg(money_sum("_sales").alias("revenue"))
    )
    top = totals.orderBy(
        F.desc_nulls_last("revenue"),
        F.asc_nulls_last("customer_id"),
        F.asc_nulls_last("customer_category"),
    ).limit(k)
    return top.select("customer_name", "customer_category", "revenue")


def q04_geography_top10(fact_sale: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    by_version = _sales_by(fact_sale, "customer_key")
    joined = by_version.join(
        dim_customer.select("customer_key", "sales_territory", "state_province", "city"),
        "customer_key",
    )
    levels = joined.groupingSets(
        [["sales_territory"], ["state_province"], ["city"]],
        "sales_territory",
        "state_province",
        "city",
    ).agg(
        money_sum("_sales").alias("sales"),
        money_sum("_profit").alias("profit"),
        F.grouping_id().alias("_gid"),
    )
    # grouping_id bit order: territory (4), state (2), city (1); a set bit
    # means the column is aggregated away.
    gid = F.col("_gid")
    named = levels.select(
        F.when(gid == 3, F.lit(LEVEL_TERRITORY))
        .when(gid == 5, F.lit(LEVEL_STATE))
        .otherwise(F.lit(LEVEL_CITY))
        .alias("level"),
        F.when(gid == 3, F.col("sales_territory"))
        .when(gid == 5, F.col("state_province"))
        .otherwise(F.col("city"))
        .alias("area"),
        "sales",
        "profit",
    )
    w = Window.partitionBy("level").orderBy(F.desc_nulls_last("sales"), F.asc_nulls_last("area"))
    ranked = named.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return ranked.orderBy("level", "_rank").drop("_rank")


def q05_salesperson(fact_order: DataFrame, fact_sale: DataFrame, dim_employee: DataFrame) -> DataFrame:
    orders = fact_order.groupBy("employee_key").agg(money_sum("ordered_sales").alias("order_value"))
    sales = fact_sale.groupBy("employee_key").agg(money_sum("sales").alias("invoiced_sales"))
    out = (
        dim_employee.join(orders, "employee_key", "left")
        .join(sales, "employee_key", "left")
        .select("employee_name", "order_value", "invoiced_sales")
    )
    return out.orderBy(F.desc_nulls_last("invoiced_sales"), F.asc_nulls_last("employee_name"))


def q06_fill_rate(fact_order: DataFrame, fact_sale: DataFrame) -> DataFrame:
    ordered = fact_order.groupBy("order_id", "product_key").agg(
        F.sum("ordered_quantity").alias("_ordered")
    )
    invoiced = (
        fact_sale.where(F.col("order_id").isNotNull())
        .groupBy("order_id", "product_key")
        .agg(F.sum("invoiced_quantity").alias("_invoiced"))
    )
    matched = ordered.join(invoiced, ["order_id", "product_key"], "left")
    total_ordered = F.sum("_ordered")
    total_invoiced = F.sum(F.coalesce(F.col("_invoiced"), F.lit(0)))
    return matched.agg(
        total_ordered.cast("bigint").alias("quantity_ordered"),
        total_invoiced.cast("bigint").alias("quantity_invoiced"),
        ratio_percent(total_invoiced, total_ordered).alias("percent_invoiced"),
    )


def q07_days_to_invoice(fact_sale: DataFrame, invoice_cols: tuple[str, ...] = ("invoice_id", "order_id")) -> DataFrame:
    cols = list(dict.fromkeys([*invoice_cols, "order_id"]))
    invoices = (
        fact_sale.where(F.col("order_id").isNotNull())
        .groupBy(*cols)
        .agg(F.max("days_to_invoice").alias("days_to_invoice"))
    )
    return invoices.agg(
        F.count(F.lit(1)).alias("invoices_counted"),
        F.round(F.avg(F.col("days_to_invoice").cast("double")), 2).alias("average_days_to_invoice"),
    )


def q08_backorder_value(order_backorders: DataFrame, fact_order: DataFrame, line_col: str = "order_line_id") -> DataFrame:
    # Aggregate the follow-up orders' lines per order first: the result is
    # already hash-partitioned by order id, so only the link side moves for
    # the join; links without lines drop out (inner join), as in the question.
    per_order = fact_order.groupBy("order_id").agg(
        F.count(line_col).alias("_lines"),
        F.sum("ordered_quantity").alias("_qty"),
        F.sum("ordered_sales").alias("_value"),
    )
    link = order_backorders.select(
        F.col("order_id").alias("original_order_id"), "backorder_order_id"
    )
    joined = link.join(per_order, link["backorder_order_id"] == per_order["order_id"])
    out = joined.groupBy("original_order_id", "backorder_order_id").agg(
        F.sum("_lines").cast("bigint").alias("backorder_lines"),
        qty_sum("_qty").alias("backorder_quantity"),
        money_sum("_value").alias("estimated_backorder_value"),
    )
    return out.orderBy(
        F.desc_nulls_last("estimated_backorder_value"),
        "original_order_id",
        "backorder_order_id",
    )


def q09_version_history(dim_customer: DataFrame) -> DataFrame:
    # Customers with history first: a version count per id (two numbers per
    # row, partial aggregation) -- a necessary condition for the (id, name)
    # HAVING below. Only their rows build the category path, so the string
    # aggregate never runs over the whole dimension.
    with_history = (
        dim_customer.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select("customer_id")
    )
    rows = join_checked(dim_customer, with_history, "customer_id", "left_semi")
    history = F.expr(
        f"listagg(customer_category, '{HISTORY_SEPARATOR}') "
        "WITHIN GROUP (ORDER BY effective_start_date)"
    )
    out = (
        rows.groupBy("customer_id", "customer_name")
        .agg(F.count(F.lit(1)).alias("versions"), history.alias("category_history"))
        .where(F.col("versions") > 1)
    )
    return out.orderBy(F.asc_nulls_last("customer_id"))


def q10_asof_sales(fact_sale: DataFrame, dim_customer: DataFrame, customer_id: int = 1) -> DataFrame:
    versions = dim_customer.where(F.col("customer_id") == customer_id)
    # one customer's versions: broadcast (after a count) so the fact table is
    # filtered where it lies instead of being shuffled to meet them
    by_version = join_checked(fact_sale, versions.select("customer_key"), "customer_key", "left_semi")
    totals = by_version.groupBy("customer_key").agg(
        F.sum("sales").alias("_sales"), F.sum("profit").alias("_profit")
    )
    group_cols = [
        "customer_id",
        "customer_name",
        "customer_category",
        "effective_start_date",
        "effective_end_date",
        "is_current",
    ]
    out = (
        totals.join(versions, "customer_key")
        .groupBy(*group_cols)
        .agg(money_sum("_sales").alias("sales"), money_sum("_profit").alias("profit"))
    )
    return out.orderBy("effective_start_date")
