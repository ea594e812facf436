"""Typed ingest of the semicolon-separated source extracts.

* Every file is read as all-string columns (no type sniffing) with ``;`` as
  separator, a header line, ``NULL`` as the null token and quoted fields that
  may contain the separator.
* Columns are picked **by header name** and cast to the declared type with
  ANSI casts: a bad number or date fails the job; a missing column fails at
  analysis, before any data is read; extra columns in the file are pruned.
* All required files are checked first and *all* missing ones are reported
  together, before any work starts.
* ``publish_snapshot`` writes every table of a run to a fresh folder and only
  then moves the ``_current`` pointer, so readers never see a half-loaded
  snapshot (the replacement for the reference's load transaction).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import path_exists, replace_text
from martwright.sources.records import read_records
from martwright.sources.model import Sources, widen_invoice_lines, widen_order_lines


@dataclass(frozen=True)
class ExtractSpec:
    table: str
    file: str
    # (header name in the file, column name in the table, Spark SQL type)
    columns: tuple[tuple[str, str, str], ...]
    where: str | None = None  # SQL predicate over the header names


INT, TEXT, BOOL, DATE = "int", "string", "boolean", "date"
MONEY, RATE = "decimal(18,2)", "decimal(9,4)"

# The extract files, the header names kept from each and the
# declared column types of the source schema, in load order (parents first).
MANIFEST: tuple[ExtractSpec, ...] = (
    ExtractSpec("countries", "Application/Application.Countries.csv", (
        ("CountryID", "country_id", INT), ("CountryName", "country_name", TEXT),
        ("Continent", "continent", TEXT), ("Region", "region", TEXT))),
    ExtractSpec("state_provinces", "Application/Application.StateProvinces.csv", (
        ("StateProvinceID", "state_province_id", INT), ("StateProvinceName", "state_province_name", TEXT),
        ("CountryID", "country_id", INT), ("SalesTerritory", "sales_territory", TEXT))),
    ExtractSpec("cities", "Application/Application.Cities.csv", (
        ("CityID", "city_id", INT), ("CityName", "city_name", TEXT),
        ("StateProvinceID", "state_province_id", INT))),
    ExtractSpec("people", "Application/Application.People.csv", (
        ("PersonID", "person_id", INT), ("FullName", "full_name", TEXT),
        ("IsSalesperson", "is_salesperson", BOOL))),
    ExtractSpec("customer_categories", "Sales/Sales.CustomerCategories.csv", (
        ("CustomerCategoryID", "customer_category_id", INT),
        ("CustomerCategoryName", "customer_category_name", TEXT))),
    ExtractSpec("buying_groups", "Sales/Sales.BuyingGroups.csv", (
        ("BuyingGroupID", "buying_group_id", INT), ("BuyingGroupName", "buying_group_name", TEXT))),
    ExtractSpec("colors", "Warehouse/Warehouse.Colors.csv", (
        ("ColorID", "color_id", INT), ("ColorName", "color_name", TEXT))),
    ExtractSpec("stock_groups", "Warehouse/Warehouse.StockGroups.csv", (
        ("StockGroupID", "stock_group_id", INT), ("StockGroupName", "stock_group_name", TEXT))),
    ExtractSpec("stock_items", "Warehouse/Warehouse.StockItems.csv", (
        ("StockItemID", "stock_item_id", INT), ("StockItemName", "stock_item_name", TEXT),
        ("ColorID", "color_id", INT), ("Brand", "brand", TEXT), ("Size", "size", TEXT),
        ("UnitPrice", "unit_price", MONEY))),
    ExtractSpec("stock_item_stock_groups", "Warehouse/Warehouse.StockItemStockGroups.csv", (
        ("StockItemStockGroupID", "stock_item_stock_group_id", INT),
        ("StockItemID", "stock_item_id", INT), ("StockGroupID", "stock_group_id", INT))),
    ExtractSpec("customers", "Sales/Sales.Customers.csv", (
        ("CustomerID", "customer_id", INT), ("CustomerName", "customer_name", TEXT),
        ("CustomerCategoryID", "customer_category_id", INT), ("BuyingGroupID", "buying_group_id", INT),
        ("DeliveryCityID", "delivery_city_id", INT), ("AccountOpenedDate", "account_opened_date", DATE),
        ("StandardDiscountPercentage", "standard_discount_percentage", RATE))),
    ExtractSpec("orders", "Sales/Sales.Orders.csv", (
        ("OrderID", "order_id", INT), ("CustomerID", "customer_id", INT),
        ("SalespersonPersonID", "salesperson_person_id", INT), ("OrderDate", "order_date", DATE),
        ("IsUndersupplyBackordered", "is_undersupply_backordered", BOOL))),
    ExtractSpec("order_backorders", "Sales/Sales.Orders.csv", (
        ("OrderID", "order_id", INT), ("BackorderOrderID", "backorder_order_id", INT)),
        where="BackorderOrderID IS NOT NULL"),
    ExtractSpec("order_lines", "Sales/Sales.OrderLines.csv", (
        ("OrderLineID", "order_line_id", INT), ("OrderID", "order_id", INT),
        ("StockItemID", "stock_item_id", INT), ("Quantity", "quantity", INT),
        ("PickedQuantity", "picked_quantity", INT), ("UnitPrice", "unit_price", MONEY),
        ("TaxRate", "tax_rate", RATE))),
    ExtractSpec("invoices", "Sales/Sales.Invoices.csv", (
        ("InvoiceID", "invoice_id", INT), ("CustomerID", "customer_id", INT),
        ("OrderID", "order_id", INT), ("SalespersonPersonID", "salesperson_person_id", INT),
        ("InvoiceDate", "invoice_date", DATE))),
    ExtractSpec("invoice_lines", "Sales/Sales.InvoiceLines.csv", (
        ("InvoiceLineID", "invoice_line_id", INT), ("InvoiceID", "invoice_id", INT),
        ("StockItemID", "stock_item_id", INT), ("Quantity", "quantity", INT),
        ("UnitPrice", "unit_price", MONEY), ("TaxRate", "tax_rate", RATE),
        ("TaxAmount", "tax_amount", MONEY), ("LineProfit", "line_profit", MONEY),
        ("ExtendedPrice", "extended_price", MONEY))),
)

NULL_TEXT = "NULL"
CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "inferSchema": "false",
}


def _join(root: str, rel: str) -> str:
    return f"{root.rstrip('/')}/{rel}"


def read_extract(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """All-string DataFrame of one extract (a file, or a folder of part files):
    ``NULL`` is null, an empty field is an empty string.

    By default a pass over the quotes finds out how the file can be cut
    (``records.read_records``): it is read by many tasks, line breaks in quotes
    included. ``multi_line`` skips that pass: False where it is known that no
    quoted field has a line break, True to read each file in one task."""
    if multi_line is None:
        raw = read_records(spark, path, CSV_OPTIONS)
    else:
        raw = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower()).csv(path)
    # the reader gives null for an empty field; the text NULL is still there
    return raw.select(*[
        F.when(F.col(f"`{c}`") == NULL_TEXT, F.lit(None)).otherwise(F.coalesce(f"`{c}`", F.lit(""))).alias(c)
        for c in raw.columns
    ])


def missing_inputs(spark: SparkSession, root: str, manifest=MANIFEST) -> list[str]:
    return [rel for rel in sorted({s.file for s in manifest}) if not path_exists(spark, _join(root, rel))]


def check_inputs(spark: SparkSession, root: str, manifest=MANIFEST) -> None:
    missing = missing_inputs(spark, root, manifest)
    if missing:
        raise FileNotFoundError(f"Missing source files: {', '.join(missing)}")


def typed_table(raw: DataFrame, spec: ExtractSpec) -> DataFrame:
    df = raw.where(F.expr(spec.where)) if spec.where else raw
    # an empty field is a value of text only
    value = lambda h, t: F.col(f"`{h}`") if t == "string" else F.nullif(F.col(f"`{h}`"), F.lit(""))
    return df.select(*[value(h, t).cast(t).alias(name) for h, name, t in spec.columns])


def ingest(
    spark: SparkSession, root: str, manifest=MANIFEST, multi_line: dict[str, bool] | None = None
) -> dict[str, DataFrame]:
    """Typed tables by name; fails early on missing files/columns. ``multi_line``
    says for single files (by name in the manifest) what ``read_extract`` would
    otherwise find out."""
    check_inputs(spark, root, manifest)
    raw: dict[str, DataFrame] = {}
    out: dict[str, DataFrame] = {}
    for spec in manifest:
        if spec.file not in raw:
            raw[spec.file] = read_extract(spark, _join(root, spec.file), (multi_line or {}).get(spec.file))
        out[spec.table] = typed_table(raw[spec.file], spec)
    return out


def sources_from_tables(t: dict[str, DataFrame]) -> Sources:
    """The normalised model over ingested extracts, with the wide line frames
    derived by joins (lines -> headers -> order date)."""
    return Sources(
        countries=t["countries"],
        state_provinces=t["state_provinces"],
        cities=t["cities"],
        people=t["people"],
        customer_categories=t["customer_categories"],
        buying_groups=t["buying_groups"],
        colors=t.get("colors"),
        stock_groups=t["stock_groups"],
        stock_items=t["stock_items"],
        stock_item_stock_groups=t["stock_item_stock_groups"],
        customers=t["customers"],
        orders=t["orders"],
        order_backorders=t["order_backorders"],
        order_lines=t["order_lines"],
        invoices=t["invoices"],
        invoice_lines=t["invoice_lines"],
        order_lines_wide=widen_order_lines(t["order_lines"], t["orders"], t["order_backorders"]),
        invoice_lines_wide=widen_invoice_lines(t["invoice_lines"], t["invoices"], t["orders"]),
        order_line_id_cols=("order_line_id",),
        invoice_line_id_cols=("invoice_line_id",),
        invoice_id_cols=("invoice_id",),
    )


def write_run(tables: dict[str, DataFrame], base: str, run_id: str | None = None) -> str:
    """Write all tables to ``base/run-<id>/<table>``; returns the run folder.
    Nobody reads it until ``point_at`` makes it the current one."""
    run_dir = _join(base, f"run-{run_id or uuid.uuid4().hex[:12]}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(_join(run_dir, name))
    return run_dir


def read_run(spark: SparkSession, run_dir: str, names) -> dict[str, DataFrame]:
    """The tables of a run: where its manifest says, if it has one (a run stored
    by stages), else in a folder of their names."""
    out = {}
    for name in names:
        entry, place = _join(run_dir, f"_manifest/{name}"), _join(run_dir, name)
        if path_exists(spark, entry):
            place = json.loads(spark.read.text(entry).first()[0])["path"]
        out[name] = spark.read.parquet(place)
    return out


def point_at(spark: SparkSession, base: str, run_dir: str) -> None:
    """Make a run the current one: the pointer is a file, replaced by one
    rename, so a reader always finds the old run or the new."""
    replace_text(spark, _join(base, "_current/run.txt"), run_dir)


def publish_snapshot(tables: dict[str, DataFrame], base: str, run_id: str | None = None) -> str:
    """Write a run and make it the current one. Returns the run folder."""
    run_dir = write_run(tables, base, run_id)
    point_at(next(iter(tables.values())).sparkSession, base, run_dir)
    return run_dir


def read_published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    run_dir = spark.read.text(_join(base, "_current")).first()[0]
    return read_run(spark, run_dir, [spec.table for spec in MANIFEST])


def write_extract(df: DataFrame, path: str) -> None:
    """Write a DataFrame in the extract format (``;``, header, ``NULL``)."""
    (
        df.write.mode("overwrite")
        .options(sep=";", header="true", nullValue="NULL", quote='"', escape='"')
        .csv(path)
    )
