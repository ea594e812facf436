"""Report plans over a built warehouse: integrity, gates, counts, profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.distinct import column_sketches, distinct_values, estimated
from martwright.operators.gates import overlapping_versions, quality_gates
from martwright.operators.scd2 import apply_type1
from martwright.operators.quality import check_constraints, stand_in_rules, warehouse_rules
from martwright.plans.warehouse import Warehouse
from martwright.sources.extracts import MANIFEST

# Source tables in report order: the extract load order.
SOURCE_ORDER = tuple(spec.table for spec in MANIFEST)
WAREHOUSE_ORDER = ("dim_date", "dim_customer", "dim_employee", "dim_product", "fact_order", "fact_sale")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _warehouse_rules(wh: Warehouse):
    src = wh.sources
    return warehouse_rules(src.order_line_id_cols, src.invoice_line_id_cols, src.invoice_id_cols)


def constraint_report(wh: Warehouse) -> DataFrame:
    """Source-layer rules (keys, NOT NULL, CHECK, references) and the
    warehouse-layer keys, one row per rule."""
    tables = dict(wh.sources.tables())
    tables.update(wh.tables())
    return check_constraints(tables, stand_in_rules() + _warehouse_rules(wh))


def unresolved_keys(wh: Warehouse) -> DataFrame:
    """Per fact and dimension key: fact rows whose key has no dimension row."""
    fk_only = []
    for r in _warehouse_rules(wh):
        if r.foreign_keys:
            fk_only.append(type(r)(r.table, foreign_keys=r.foreign_keys))
    return check_constraints(wh.tables(), fk_only).select("rule", "violations")


def duplicate_keys(wh: Warehouse) -> DataFrame:
    """Order-line identifiers occurring more than once in the order fact."""
    cols = list(wh.sources.order_line_id_cols)
    return (
        wh.fact_order.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def overlap_check(wh: Warehouse) -> DataFrame:
    return overlapping_versions(wh.dim_customer)


def unexpired_copy(wh: Warehouse) -> DataFrame:
    """A deliberately broken history: new versions added but the old ones
    left open (what an append without the expiry step would produce)."""
    new_versions = wh.dim_customer.where(
        F.col("effective_start_date") != F.lit("1900-01-01").cast("date")
    )
    return wh.dim_customer_initial.unionByName(new_versions.select(*wh.dim_customer_initial.columns))


def overlap_check_unexpired(wh: Warehouse) -> DataFrame:
    return overlapping_versions(unexpired_copy(wh))


def broken_copy(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Order lines and order facts with faults that the checks must find: lines
    of unknown orders with negative quantities, facts without a product key."""
    lines = wh.sources.order_lines
    orphans = lines.where("line_number = 1 AND order_id % 7 = 0").withColumn(
        "order_id", -F.col("order_id") - 1).withColumn("quantity", -F.col("quantity"))
    facts = wh.fact_order.withColumn("product_key", F.when(
        ~((F.col("line_number") == 2) & (F.col("order_id") % 7 == 0)), F.col("product_key")))
    return lines.unionByName(orphans.select(*lines.columns)), facts


def dq_report_broken(wh: Warehouse) -> DataFrame:
    lines, facts = broken_copy(wh)
    return dq_report(wh, order_lines=lines, fact_order=facts)


def constraint_report_broken(wh: Warehouse) -> DataFrame:
    lines, facts = broken_copy(wh)
    tables = dict(wh.sources.tables()) | wh.tables() | {"order_lines": lines, "fact_order": facts}
    rules = [r for r in stand_in_rules() + _warehouse_rules(wh) if r.table in {"order_lines", "fact_order"}]
    return check_constraints(tables, rules)


def dim_customer_type1(wh: Warehouse) -> DataFrame:
    """Every tenth customer is renamed and leaves its buying group, on all of
    its versions."""
    named = wh.sources.customers.where("customer_id % 10 = 1").select(
        "customer_id", F.concat(F.upper("customer_name"), F.lit(" Ltd")).alias("customer_name"),
        F.lit(None).cast("string").alias("buying_group"))
    return apply_type1(wh.dim_customer, named, ["customer_name", "buying_group"])


def dq_report(wh: Warehouse, order_lines: DataFrame | None = None, fact_order: DataFrame | None = None) -> DataFrame:
    src = wh.sources
    return quality_gates(
        order_lines=src.order_lines if order_lines is None else order_lines,
        invoice_lines=src.invoice_lines,
        invoices=src.invoices,
        orders=src.orders,
        dims={
            "dim_date": wh.dim_date,
            "dim_customer": wh.dim_customer,
            "dim_employee": wh.dim_employee,
            "dim_product": wh.dim_product,
        },
        fact_order=wh.fact_order if fact_order is None else fact_order,
        fact_sale=wh.fact_sale,
        order_line_cols=src.order_line_id_cols,
        sale_line_cols=src.invoice_line_id_cols,
        dim_customer_initial=wh.dim_customer_initial,
        changed_snapshot=wh.changed_snapshot,
    )


def row_counts(wh: Warehouse) -> DataFrame:
    """(table_name, rows) for every source and warehouse table."""
    tables = wh.sources.tables()
    parts = [
        tables[n].agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        for n in SOURCE_ORDER
        if n in tables
    ]
    wt = wh.tables()
    parts += [
        wt[n].agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        for n in WAREHOUSE_ORDER
    ]
    return _union(parts)


def profile(df: DataFrame, table_name: str, exact: bool = False, full: bool = False) -> DataFrame:
    """Rows, nulls and distinct values of every column (``full=True`` adds the
    column type and its min / max as text).

    ``exact=False`` takes HyperLogLog sketches in one pass (``distinct.column_sketches``,
    which merge over parts); ``exact=True`` counts distinct values exactly, column
    by column, without repeating rows (``distinct.distinct_values``)."""
    columns = df.columns
    if exact or full:
        aggs = [F.count(F.lit(1)).cast("bigint").alias("_rows")]
        for i, c in enumerate(columns):
            value = F.col(f"`{c}`")
            aggs.append(F.count(value).cast("bigint").alias(f"_nn{i}"))
            if full:
                aggs += [F.min(value).cast("string").alias(f"_lo{i}"), F.max(value).cast("string").alias(f"_hi{i}")]
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        entries = [F.struct(
            F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"_nn{i}")).alias("nulls"),
            *([F.lit(types[c]).alias("data_type"), F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value")] if full else []))
            for i, c in enumerate(columns)]
        counted = df.agg(*aggs).select(F.col("_rows").alias("row_count"), F.explode(F.array(*entries)).alias("_e")).select("row_count", "_e.*")
        distinct = distinct_values(df) if exact else estimated(column_sketches(df)).select("column_name", "distinct_values")
        rows = counted.join(F.broadcast(distinct), "column_name")  # a row per column
    else:
        rows = estimated(column_sketches(df))
    extra = ["data_type", "min_value", "max_value"] if full else []
    return rows.select(F.lit(table_name).alias("table_name"), "column_name", "row_count", "nulls", "distinct_values", *extra)


def table_profile(wh: Warehouse, exact: bool = True, full: bool = False) -> DataFrame:
    tables = wh.sources.tables()
    return _union([profile(tables[n], n, exact=exact, full=full) for n in SOURCE_ORDER if n in tables])
