"""Fact builders: one row per order line and one row per invoice line.

Surrogate keys with the semantics of inner joins to the dimensions: customer
by the version valid on the transaction date, salesperson and product by
natural key. The date key is a pure function of the date (``yyyyMMdd``), so
no join to the date dimension is needed; the unresolved-key gate still checks
that every date key exists in ``dim_date``.

How each key is found, cheapest proven way first:

* one pass profiles the three natural keys of the lines (distinct values
  with row counts) -- hot values and key existence are read from it;
* product / salesperson: arithmetic when the surrogate is provably an offset
  of the natural key and every key exists, else a join (hot keys salted);
* customer: arithmetic for customers with one open version, a broadcast
  version join for customers with history (counted), else the general
  version join (hot keys salted).

Nothing here broadcasts a table without counting it first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions.calendar import date_key
from martwright.functions.money import money
from martwright.operators.asof import versioned_key
from martwright.operators.dimensions import OPEN_END, OPEN_START
from martwright.operators.joins import SPLIT_ROWS, KeyProfile, substitute_key


def _unique(cols) -> list[str]:
    out: list[str] = []
    for c in cols:
        if c not in out:
            out.append(c)
    return out


def _key_dims(
    fact: DataFrame,
    date_col: str,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_product: DataFrame,
    salt_cols: list[str],
    split_rows: int,
) -> DataFrame:
    # One pass over the fact profiles its three natural keys (distinct values
    # with row counts): hot values (more than ``split_rows`` lines) are split
    # over tasks, and the existence proofs below read the profile, not the
    # fact.
    profile = KeyProfile(fact, ["stock_item_id", "customer_id", "salesperson_person_id"])
    hot = profile.hot_all(split_rows)
    present = profile.presence(
        {
            "stock_item_id": (dim_product, "stock_item_id"),
            "customer_id": (dim_customer, "customer_id"),
            "salesperson_person_id": (dim_employee, "person_id"),
        }
    )
    # Product and salesperson keys: arithmetic when provably an offset of
    # the natural key (no shuffle of the fact), else a join. Product first:
    # line frames built by a join on the item key are already partitioned by
    # it, so even the join adds no exchange on the fact side.
    f = substitute_key(
        fact, dim_product, "stock_item_id", "stock_item_id", "product_key",
        hot=hot["stock_item_id"], salt_cols=salt_cols, present=present["stock_item_id"],
    )
    f = versioned_key(
        f, dim_customer, "customer_id", date_col, "customer_id", "customer_key",
        OPEN_START, OPEN_END, hot=hot["customer_id"], salt_cols=salt_cols,
        present=present["customer_id"],
    )
    return substitute_key(
        f, dim_employee, "salesperson_person_id", "person_id", "employee_key",
        hot=hot["salesperson_person_id"], salt_cols=salt_cols,
        present=present["salesperson_person_id"],
    )


def fact_order(
    order_lines_wide: DataFrame,
    order_backorders: DataFrame,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_product: DataFrame,
    line_id_cols: tuple[str, ...] = ("order_line_id",),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    ids = _unique([*line_id_cols, "order_id"])
    f = _key_dims(
        order_lines_wide, "order_date", dim_customer, dim_employee, dim_product,
        salt_cols=[*ids, "stock_item_id"], split_rows=split_rows,
    )
    if "backorder_order_id" in order_lines_wide.columns:
        # the lines already carry their order's link (joined at order grain)
        f = f.withColumnRenamed("backorder_order_id", "_backorder")
    else:
        link = order_backorders.select("order_id", F.col("backorder_order_id").alias("_backorder"))
        f = f.join(link, "order_id", "left")
    return f.select(
        *ids,
        date_key(F.col("order_date")).alias("date_key"),
        "customer_key",
        "employee_key",
        "product_key",
        F.col("quantity").alias("ordered_quantity"),
        "picked_quantity",
        money(F.col("quantity") * F.col("unit_price")).alias("ordered_sales"),
        F.col("_backorder").isNotNull().alias("is_backordered"),
    )


def fact_sale(
    invoice_lines_wide: DataFrame,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_product: DataFrame,
    line_id_cols: tuple[str, ...] = ("invoice_line_id",),
    invoice_id_cols: tuple[str, ...] = ("invoice_id",),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    ids = _unique([c for c in (*line_id_cols, *invoice_id_cols, "order_id") if c != "date_key"])
    f = _key_dims(
        invoice_lines_wide, "invoice_date", dim_customer, dim_employee, dim_product,
        salt_cols=[*ids, "stock_item_id"], split_rows=split_rows,
    )
    days = F.when(
        F.col("order_date").isNotNull(), F.datediff(F.col("invoice_date"), F.col("order_date"))
    ).cast("int")
    return f.select(
        *ids,
        date_key(F.col("invoice_date")).alias("date_key"),
        "customer_key",
        "employee_key",
        "product_key",
        F.col("quantity").alias("invoiced_quantity"),
        money(F.col("extended_price") - F.col("tax_amount")).alias("sales"),
        F.col("line_profit").cast("decimal(18,2)").alias("profit"),
        days.alias("days_to_invoice"),
    )
