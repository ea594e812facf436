"""Stage the driver's TPC-H-like tables as the 16-table sales source model.

The mapping (stand-ins for the reference's extracts):

* countries / state provinces / cities  <- region / nation (+ its region as
  sales territory) / customer (one delivery city per customer)
* customer categories <- distinct market segments, id by alphabetical order
* buying groups       <- customer key modulo 3 (0 means no group)
* people              <- suppliers (salespeople) and customers (not salespeople,
  person id = -(customer key + 1) so ids stay unique)
* stock items / stock groups / bridge <- part / supplier / distinct
  (part, supplier) pairs of line items
* orders, order lines <- orders, all line items (unit price from the part,
  salesperson = the line's supplier, picked quantity only for shipped lines)
* invoices, invoice lines <- line items with line status 'F'; invoice date =
  ship date; an invoice is one (order, invoice date). All of them are loaded;
  invoice dates before the order date are reported by the gate, not dropped
* order backorders    <- each order with status 'P' links to the customer's
  next order (by order date, then order key)

Line items and orders are joined once; the part is joined once for the unit
price. Both wide line frames come from that single join. Both joins are left
joins: a line without its order or part stays, with nulls, so that the
constraint and row-count checks can see it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.money import money, rate
from martwright.operators.keys import dense_key
from martwright.operators.sequence import next_in_key
from martwright.sources.model import Sources
from martwright.session import partitions_by_size
from martwright.sources.parquet import read_table, table_path

# Fixed values of the stand-in mapping.
SHIPPED_LINE_STATUS = "F"
BACKORDER_ORDER_STATUS = "P"
BUYING_GROUP_MODULUS = 3
BUYING_GROUP_NAME_PREFIX = "Buying Group "

#: Bytes of the line table (Parquet) whose pairs one task makes distinct.
DISTINCT_BYTES = 16 << 20


def line_frame(lineitem: DataFrame, header: DataFrame, stock_items: DataFrame) -> DataFrame:
    """Line items with their order header (customer, date, backorder link)
    and the item's unit price: the frame both wide line frames come from.
    ``lineitem`` may be any subset (e.g. one micro-batch of new lines)."""
    lines = lineitem.join(
        header,
        lineitem["l_orderkey"] == F.col("order_id"),
        "left",
    ).join(
        stock_items.select("stock_item_id", "unit_price"),
        lineitem["l_partkey"] == F.col("stock_item_id"),
        "left",
    )
    quantity = F.col("l_quantity").cast("int")
    shipped = F.col("l_linestatus") == SHIPPED_LINE_STATUS
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("stock_item_id"),
        F.col("l_suppkey").alias("salesperson_person_id"),
        "customer_id",
        "order_date",
        "backorder_order_id",
        quantity.alias("quantity"),
        F.when(shipped, quantity).otherwise(F.lit(0)).alias("picked_quantity"),
        "unit_price",
        rate(F.col("l_tax")).alias("tax_rate"),
        money(F.col("l_extendedprice")).alias("extended_price"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        shipped.alias("_shipped"),
    )


def order_lines_wide_of(lines: DataFrame) -> DataFrame:
    return lines.drop("extended_price", "ship_date", "_shipped")


def distinct_dealt(rows: DataFrame, partitions: int) -> DataFrame:
    """Distinct rows that hardly repeat: dealt out by value first, so that no task
    holds the values of a whole input split, which would spill and spare nothing."""
    return rows.repartition(partitions, *rows.columns).distinct()


def stage_driver_tables(
    spark: SparkSession,
    sf_dir: str,
    materialize: Callable[[str, DataFrame], DataFrame] | None = None,
) -> Sources:
    """Lazy source model over the driver tables.

    ``materialize(name, df)`` may store an intermediate frame and return it
    read back; it is applied to the joined line frame, from which both wide
    frames and four source tables are projected."""
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    customer = read_table(
        spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    orders_raw = read_table(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    lineitem = read_table(
        spark,
        sf_dir,
        "lineitem",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_linestatus",
        "l_shipdate",
    )

    countries = region.select(
        F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country_name")
    )
    state_provinces = nation.join(
        region, nation["n_regionkey"] == region["r_regionkey"], "left"
    ).select(
        F.col("n_nationkey").alias("state_province_id"),
        F.col("n_name").alias("state_province_name"),
        F.col("n_regionkey").alias("country_id"),
        F.col("r_name").alias("sales_territory"),
    )
    cities = customer.select(
        F.col("c_custkey").alias("city_id"),
        F.col("c_name").alias("city_name"),
        F.col("c_nationkey").alias("state_province_id"),
    )
    customer_categories = dense_key(
        customer.select(F.col("c_mktsegment").alias("customer_category_name")).distinct(),
        ["customer_category_name"],
        "customer_category_id",
    ).select("customer_category_id", "customer_category_name")

    group_id = F.col("c_custkey") % BUYING_GROUP_MODULUS
    buying_groups = (
        customer.select(group_id.alias("buying_group_id"))
        .where(F.col("buying_group_id") != 0)
        .distinct()
        .select(
            "buying_group_id",
            F.concat(
                F.lit(BUYING_GROUP_NAME_PREFIX), F.col("buying_group_id").cast("string")
            ).alias("buying_group_name"),
        )
    )
    people = supplier.select(
        F.col("s_suppkey").alias("person_id"),
        F.col("s_name").alias("full_name"),
        F.lit(True).alias("is_salesperson"),
    ).unionByName(
        customer.select(
            (-(F.col("c_custkey") + 1)).alias("person_id"),
            F.col("c_name").alias("full_name"),
            F.lit(False).alias("is_salesperson"),
        )
    )
    customers = customer.join(
        customer_categories,
        customer["c_mktsegment"] == customer_categories["customer_category_name"],
        "left",
    ).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "customer_category_id",
        F.when(group_id != 0, group_id).alias("buying_group_id"),
        F.col("c_custkey").alias("delivery_city_id"),
    )
    stock_groups = supplier.select(
        F.col("s_suppkey").alias("stock_group_id"), F.col("s_name").alias("stock_group_name")
    )
    stock_items = part.select(
        F.col("p_partkey").alias("stock_item_id"),
        F.col("p_name").alias("stock_item_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("string").alias("size"),
        money(F.col("p_retailprice")).alias("unit_price"),
    )
    stock_item_stock_groups = distinct_dealt(
        lineitem.select(F.col("l_partkey").alias("stock_item_id"), F.col("l_suppkey").alias("stock_group_id")),
        partitions_by_size(spark, table_path(sf_dir, "lineitem"), DISTINCT_BYTES),
    )

    orders = orders_raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )
    order_backorders = (
        next_in_key(
            orders.select("order_id", "customer_id", "order_date", "order_status"),
            key_col="customer_id",
            order_cols=["order_date", "order_id"],
            value_col="order_id",
            out_col="backorder_order_id",
        )
        .where(
            (F.col("order_status") == BACKORDER_ORDER_STATUS)
            & F.col("backorder_order_id").isNotNull()
        )
        .select("order_id", "backorder_order_id")
    )

    # The order header carries its backorder link (an order attribute in the
    # extracts): joined at order grain here, so the order-line fact needs no
    # join of its own on the order key.
    header = orders.select("order_id", "customer_id", "order_date").join(
        order_backorders, "order_id", "left"
    )
    lines = line_frame(lineitem, header, stock_items)
    if materialize is not None:
        lines = materialize("lines", lines)
    order_lines_wide = order_lines_wide_of(lines)

    tax_amount = F.round(F.col("extended_price") * F.col("tax_rate"), 2).cast("decimal(18,2)")
    sales = (F.col("extended_price") - F.col("tax_amount")).cast("decimal(18,2)")
    invoice_lines_wide = (
        lines.where(F.col("_shipped"))
        .withColumn("invoice_date", F.col("ship_date"))
        .withColumn("tax_amount", tax_amount)
        .withColumn(
            "line_profit",
            (sales - F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"),
        )
        .select(
            "order_id",
            "line_number",
            "stock_item_id",
            "salesperson_person_id",
            "customer_id",
            "order_date",
            "invoice_date",
            "quantity",
            "unit_price",
            "tax_rate",
            "tax_amount",
            "line_profit",
            "extended_price",
        )
    )
    invoices = invoice_lines_wide.select("order_id", "invoice_date", "customer_id").distinct()
    order_lines = order_lines_wide.select(
        "order_id",
        "line_number",
        "stock_item_id",
        "salesperson_person_id",
        "quantity",
        "picked_quantity",
        "unit_price",
        "tax_rate",
    )
    invoice_lines = invoice_lines_wide.select(
        "order_id",
        "invoice_date",
        "line_number",
        "stock_item_id",
        "quantity",
        "unit_price",
        "tax_rate",
        "tax_amount",
        "line_profit",
        "extended_price",
    )
    return Sources(
        countries=countries,
        state_provinces=state_provinces,
        cities=cities,
        people=people,
        customer_categories=customer_categories,
        buying_groups=buying_groups,
        colors=None,
        stock_groups=stock_groups,
        stock_items=stock_items,
        stock_item_stock_groups=stock_item_stock_groups,
        customers=customers,
        orders=orders.select("order_id", "customer_id", "order_date"),
        order_backorders=order_backorders,
        order_lines=order_lines,
        invoices=invoices,
        invoice_lines=invoice_lines,
        order_lines_wide=order_lines_wide,
        invoice_lines_wide=invoice_lines_wide,
        order_line_id_cols=("order_id", "line_number"),
        invoice_line_id_cols=("order_id", "line_number"),
        invoice_id_cols=("order_id", "date_key"),
    )
