"""Plans over richer histories: dated snapshot series, versions of many orders,
arrivals with late and repeated rows, and all extracts written and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.asof import asof_scan
from martwright.operators.dimensions import OPEN_START, customer_snapshot
from martwright.operators.overlaps import overlap_pairs
from martwright.operators.scd2 import history_from_snapshots
from martwright.plans.reports import SOURCE_ORDER, profile
from martwright.plans.warehouse import Warehouse
from martwright.session import scratch_path, stash
from martwright.sources.extracts import MANIFEST, ingest, write_extract
from martwright.streaming.watermark import WatermarkedLoad, accepted_rows, partitions_for, run_watermarked

# Fixed values of the demonstration series: dates of the two later snapshots.
SECOND, THIRD = dt.date(1995, 6, 1), dt.date(1998, 1, 1)


def snapshot_series(wh: Warehouse) -> DataFrame:
    """Three dated customer snapshots, the latest first and the first one given
    twice: the base; every tenth customer in category BUILDING and every seventh
    renamed; every tenth in MACHINERY, every fifth in category AUTOMOBILE."""
    src = wh.sources
    base = customer_snapshot(
        src.customers, src.customer_categories, src.buying_groups, src.cities, src.state_provinces, src.countries)
    second = base.where("customer_id % 10 = 1 OR customer_id % 7 = 2").withColumn(
        "customer_category", F.when(F.expr("customer_id % 10 = 1"), F.lit("BUILDING")).otherwise(F.col("customer_category"))).withColumn(
        "customer_name", F.when(F.expr("customer_id % 7 = 2"), F.upper(F.concat("customer_name", F.lit(" ltd")))).otherwise(F.col("customer_name")))
    third = base.where("customer_id % 5 = 1").withColumn(
        "customer_category", F.when(F.expr("customer_id % 10 = 1"), F.lit("MACHINERY")).otherwise(F.lit("AUTOMOBILE")))
    dated = [(third, THIRD), (base, OPEN_START), (second, SECOND), (base, OPEN_START)]
    out = None
    for rows, day in dated:
        rows = rows.withColumn("snapshot_date", F.lit(day))
        out = rows if out is None else out.unionByName(rows)
    return out


def dim_customer_series(wh: Warehouse) -> DataFrame:
    return history_from_snapshots(snapshot_series(wh))


def asof_scan_lines(wh: Warehouse) -> DataFrame:
    """Every order line with the customer version of the series valid on its
    order date, by the ordered scan."""
    lines = wh.sources.order_lines_wide.select("order_id", "line_number", "customer_id", "order_date")
    versions = stash(dim_customer_series(wh), "dim-customer-series")
    return asof_scan(lines, versions, "customer_id", "order_date", "customer_id", "customer_key").select(
        "order_id", "line_number", "order_date", "customer_key")


def overlap_pairs_of(dim_customer: DataFrame) -> DataFrame:
    return overlap_pairs(dim_customer, "customer_id", "customer_key")


def overlap_pairs_unexpired(wh: Warehouse) -> DataFrame:
    """Pairs per customer as if the change had not closed the old versions."""
    cols = ["customer_id", "customer_key", "effective_start_date", "effective_end_date"]
    added = wh.dim_customer.where(F.col("effective_start_date") != F.lit(OPEN_START)).select(*cols)
    return overlap_pairs_of(wh.dim_customer_initial.select(*cols).unionByName(added))


def overlap_pairs_orders(wh: Warehouse) -> DataFrame:
    """Pairs of a customer's orders that are open on the same day, an order being
    open for 60 days less those of its number modulo 90: many ranges of an id,
    some of them ending before they begin."""
    orders = wh.sources.orders.select(
        "customer_id", "order_id", F.col("order_date").alias("opened"),
        F.expr("date_add(order_date, CAST(60 - order_id % 90 AS INT))").alias("closed"))
    return overlap_pairs(orders, "customer_id", "order_id", "opened", "closed")


# Arrivals of line items: days from this date and the delivery's lag give the
# number; rows of a tenth of the orders are delivered again in the next one.
ARRIVALS, ARRIVAL_DAYS, ALLOWED_DELAY = 6, 430, dt.timedelta(days=30)
ARRIVAL = ("least(5, CAST(floor((datediff(CAST(l_shipdate AS DATE), DATE '1992-01-01') + (l_orderkey * 7 + l_linenumber) % 120) / 430) AS INT))")


def watermarked_line_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in six arrivals, each loaded by a run of its own from the same
    checkpoint: what is more than the allowed delay behind the latest ship date of
    earlier arrivals is refused, what arrived before is recognised."""
    table = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    lines = spark.read.parquet(table)
    base = scratch_path(spark, "watermarked")
    dealt = stash(lines.withColumn("_arrival", F.expr(ARRIVAL)), "arrivals")
    cfg = WatermarkedLoad(
        source_glob=f"{base}/landing/arrival-*/*.parquet", source_base=f"{base}/landing", schema=lines.schema,
        target=f"{base}/lines", checkpoint=f"{base}/checkpoint", event_col="l_shipdate", allowed_delay=ALLOWED_DELAY,
        state_partitions=partitions_for(spark, table))
    for k in range(ARRIVALS):
        again = (F.col("_arrival") == k - 1) & (F.col("l_orderkey") % 10 == 3)
        dealt.where((F.col("_arrival") == k) | again).select(*lines.columns).write.parquet(f"{base}/landing/arrival-{k}")
        run_watermarked(spark, cfg)
    return accepted_rows(spark, cfg)


def _extract_frames(wh: Warehouse) -> dict[str, DataFrame]:
    """The source tables under the extracts' header names, one frame per file.
    What the stand-ins do not have is a null, an empty text or a rule of the id."""
    src = wh.sources
    null = F.lit(None).cast("string")
    colors = src.stock_items.select(F.col("brand").alias("ColorName")).distinct()
    brand_number = F.regexp_extract("ColorName", r"(\d+)$", 1).cast("int")
    links = src.order_backorders.select("order_id", F.col("backorder_order_id").alias("BackorderOrderID"))
    frames = {
        "countries": src.countries.select(
            F.col("country_id").alias("CountryID"), F.col("country_name").alias("CountryName"), null.alias("Continent"), F.lit("").alias("Region")),
        "state_provinces": src.state_provinces.select(
            F.col("state_province_id").alias("StateProvinceID"), F.col("state_province_name").alias("StateProvinceName"),
            F.col("country_id").alias("CountryID"), F.col("sales_territory").alias("SalesTerritory")),
        "cities": src.cities.select(
            F.col("city_id").alias("CityID"), F.col("city_name").alias("CityName"), F.col("state_province_id").alias("StateProvinceID")),
        "people": src.people.select(
            F.col("person_id").alias("PersonID"), F.col("full_name").alias("FullName"), F.col("is_salesperson").cast("int").alias("IsSalesperson")),
        "customer_categories": src.customer_categories.select(
            F.col("customer_category_id").alias("CustomerCategoryID"), F.col("customer_category_name").alias("CustomerCategoryName")),
        "buying_groups": src.buying_groups.select(
            F.col("buying_group_id").alias("BuyingGroupID"), F.col("buying_group_name").alias("BuyingGroupName")),
        "colors": colors.select(brand_number.alias("ColorID"), "ColorName"),
        "stock_groups": src.stock_groups.select(
            F.col("stock_group_id").alias("StockGroupID"), F.col("stock_group_name").alias("StockGroupName")),
        "stock_items": src.stock_items.select(
            F.col("stock_item_id").alias("StockItemID"), F.col("stock_item_name").alias("StockItemName"), null.alias("ColorID"),
            F.col("brand").alias("Brand"), F.col("size").alias("Size"), F.col("unit_price").alias("UnitPrice")),
        "stock_item_stock_groups": src.stock_item_stock_groups.select(
            F.col("stock_item_id").alias("StockItemStockGroupID"), F.col("stock_item_id").alias("StockItemID"), F.col("stock_group_id").alias("StockGroupID")),
        "customers": src.customers.select(
            F.col("customer_id").alias("CustomerID"), F.col("customer_name").alias("CustomerName"),
            F.col("customer_category_id").alias("CustomerCategoryID"), F.col("buying_group_id").alias("BuyingGroupID"),
            F.col("delivery_city_id").alias("DeliveryCityID"),
            F.expr("date_add(DATE '1995-01-01', CAST(customer_id % 1000 AS INT))").alias("AccountOpenedDate"),
            F.expr("CAST(customer_id % 37 AS DECIMAL(9,4)) / 8").cast("decimal(9,4)").alias("StandardDiscountPercentage")),
        "orders": src.orders.join(links, "order_id", "left").select(
            F.col("order_id").alias("OrderID"), F.col("customer_id").alias("CustomerID"), null.alias("SalespersonPersonID"),
            F.col("order_date").alias("OrderDate"), (F.col("order_id") % 2).cast("int").alias("IsUndersupplyBackordered"), "BackorderOrderID"),
        "order_lines": src.order_lines.select(
            F.col("line_number").alias("OrderLineID"), F.col("order_id").alias("OrderID"), F.col("stock_item_id").alias("StockItemID"),
            F.col("quantity").alias("Quantity"), F.col("picked_quantity").alias("PickedQuantity"), F.col("unit_price").alias("UnitPrice"),
            F.col("tax_rate").alias("TaxRate")),
        "invoices": src.invoices.select(
            F.col("order_id").alias("InvoiceID"), F.col("customer_id").alias("CustomerID"), F.col("order_id").alias("OrderID"),
            null.alias("SalespersonPersonID"), F.col("invoice_date").alias("InvoiceDate")),
        "invoice_lines": src.invoice_lines.select(
            F.col("line_number").alias("InvoiceLineID"), F.col("order_id").alias("InvoiceID"), F.col("stock_item_id").alias("StockItemID"),
            F.col("quantity").alias("Quantity"), F.col("unit_price").alias("UnitPrice"), F.col("tax_rate").alias("TaxRate"),
            F.col("tax_amount").alias("TaxAmount"), F.col("line_profit").alias("LineProfit"), F.col("extended_price").alias("ExtendedPrice")),
    }
    files = {spec.table: spec.file for spec in MANIFEST}
    # a column that nobody keeps, with separators, quotes and a line break inside its quotes
    note = F.concat(F.lit('a "note";\nof '), F.lit("two lines; \"\"\n"))
    return {files[table]: frame.select(note.alias("Comments"), "*") for table, frame in frames.items()}


def extract_round_trip(wh: Warehouse) -> DataFrame:
    """All 16 tables written as quoted extracts with line breaks in quotes, found,
    read split, typed and filtered by the ingest, then profiled."""
    spark = wh.fact_sale.sparkSession
    root = scratch_path(spark, "extracts")
    for file, frame in _extract_frames(wh).items():
        write_extract(frame, f"{root}/{file}")
    tables = ingest(spark, root)
    out = None
    for name in SOURCE_ORDER:
        # the profile reads a table once for each column: it is parsed and typed once
        typed = stash(tables[name], f"extract-{name}")
        # a plan for each table: one of all columns of all tables fills the driver's memory
        part = stash(profile(typed, name, exact=True, full=True), f"profile-{name}")
        out = part if out is None else out.unionByName(part)
    return out
