"""The normalised source model (16 tables) and the wide line frames.

``Sources`` holds lazy DataFrames with the reference's column names. The two
wide frames carry, per order line and per invoice line, the header attributes
the fact builders need (customer, salesperson, dates). They are derived by
joins from the normalised tables, or built directly by a staging layer that
already has them side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Sources:
    countries: DataFrame
    state_provinces: DataFrame
    cities: DataFrame
    people: DataFrame
    customer_categories: DataFrame
    buying_groups: DataFrame
    colors: DataFrame | None
    stock_groups: DataFrame
    stock_items: DataFrame
    stock_item_stock_groups: DataFrame
    customers: DataFrame
    orders: DataFrame
    order_backorders: DataFrame
    order_lines: DataFrame
    invoices: DataFrame
    invoice_lines: DataFrame
    # order line + order header: order_id, line id column(s), stock_item_id,
    # salesperson_person_id, customer_id, order_date, quantity,
    # picked_quantity, unit_price (+ backorder_order_id when the header
    # carries the backorder link)
    order_lines_wide: DataFrame
    # invoice line + invoice header + order date (null without an order)
    invoice_lines_wide: DataFrame
    # names of the fact columns identifying one line / one invoice (the
    # invoice date appears in the facts as its date key)
    order_line_id_cols: tuple[str, ...] = ("order_line_id",)
    invoice_line_id_cols: tuple[str, ...] = ("invoice_line_id",)
    invoice_id_cols: tuple[str, ...] = ("invoice_id",)

    def tables(self) -> dict[str, DataFrame]:
        """The 16 normalised source tables by name (absent ones skipped)."""
        skip = {
            "order_lines_wide",
            "invoice_lines_wide",
            "order_line_id_cols",
            "invoice_line_id_cols",
            "invoice_id_cols",
        }
        out = {}
        for f in fields(self):
            if f.name in skip:
                continue
            value = getattr(self, f.name)
            if value is not None:
                out[f.name] = value
        return out


def widen_order_lines(
    order_lines: DataFrame, orders: DataFrame, order_backorders: DataFrame | None = None
) -> DataFrame:
    """Order lines with their order's customer, salesperson, date and (when
    given) backorder link -- joined to the header at order grain first."""
    header = orders.select("order_id", "customer_id", "salesperson_person_id", "order_date")
    if order_backorders is not None:
        header = header.join(order_backorders.select("order_id", "backorder_order_id"), "order_id", "left")
    return order_lines.join(header, "order_id", "left")


def widen_invoice_lines(invoice_lines: DataFrame, invoices: DataFrame, orders: DataFrame) -> DataFrame:
    """Invoice lines with their invoice header and the order date (left join)."""
    header = invoices.select(
        "invoice_id", "customer_id", "order_id", "salesperson_person_id", "invoice_date"
    )
    order_dates = orders.select(F.col("order_id").alias("_oid"), "order_date")
    lines = invoice_lines.join(header, "invoice_id", "left")
    return lines.join(order_dates, lines["order_id"] == order_dates["_oid"], "left").drop("_oid")


def store_sources(src: Sources, path: str, names: tuple[str, ...] | None = None) -> Sources:
    """Write source frames (all, or only ``names``) as parquet under ``path``
    and return the same model reading them back: those frames are computed
    once, and every later build, report and check scans files instead of
    recomputing their joins and aggregations."""
    stored = {}
    for f in fields(src):
        value = getattr(src, f.name)
        if isinstance(value, DataFrame) and (names is None or f.name in names):
            target = f"{path.rstrip('/')}/{f.name}"
            value.write.mode("overwrite").parquet(target)
            stored[f.name] = value.sparkSession.read.parquet(target).select(*value.columns)
    return replace(src, **stored)


def parquet_materializer(path: str):
    """``materialize`` hook writing a frame under ``path`` and reading it back."""

    def materialize(name: str, df: DataFrame) -> DataFrame:
        target = f"{path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(target)
        return df.sparkSession.read.parquet(target).select(*df.columns)

    return materialize


# Staged frames that aggregate or join the line items; everything else is a
# projection of a driver table or of the stored line join.
DERIVED_SOURCES = ("stock_item_stock_groups", "order_backorders", "invoices")
