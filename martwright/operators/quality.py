"""Declarative integrity rules and the warehouse quality gates.

Parquet tables enforce no keys or checks, so every constraint of the source
schema becomes a *validation job* that reports its violations as rows
``(rule, table_name, violations)`` instead of rejecting an insert:

* all row-local rules of a table (NOT NULL, CHECK >= 0) run as one
  aggregate pass over that table;
* primary keys / unique sets are a ``groupBy(key).count() > 1`` (partial
  aggregation, so a hot key value collapses map-side);
* foreign keys are checked per referenced parent key: the distinct non-null
  child keys of all rules pointing at it (with per-rule row counts, so a hot
  value is one row in the shuffle) meet the parent keys in one anti join.

Everything is unioned into one DataFrame, so the whole report is one action.
The oracle has a rule list of its own, written from the declared schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]


@dataclass(frozen=True)
class TableRules:
    table: str
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default_factory=tuple)


def _cols(cols) -> str:
    return ",".join(cols)


def _report_row(df: DataFrame, rule: str, table: str) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.col("violations").cast("bigint")
    )


def _duplicate_groups(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    dup = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("violations"))


def check_table(tables: dict[str, DataFrame], r: TableRules) -> list[DataFrame]:
    df = tables[r.table]
    parts: list[DataFrame] = []
    nn = list(dict.fromkeys([*r.primary_key, *r.not_null]))
    local = [(f"not_null:{r.table}({c})", F.count_if(F.col(c).isNull())) for c in nn]
    local += [(f"non_negative:{r.table}({c})", F.count_if(F.col(c) < 0)) for c in r.non_negative]
    if local:
        row = df.agg(*[expr.cast("bigint").alias(f"_r{i}") for i, (_, expr) in enumerate(local)])
        names = [n for n, _ in local]
        stacked = row.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("violations"))
                        for i, n in enumerate(names)
                    ]
                )
            ).alias("_x")
        ).select("_x.rule", "_x.violations")
        parts.append(
            stacked.select("rule", F.lit(r.table).alias("table_name"), F.col("violations").cast("bigint"))
        )
    if r.primary_key:
        parts.append(
            _report_row(
                _duplicate_groups(df, r.primary_key),
                f"primary_key:{r.table}({_cols(r.primary_key)})",
                r.table,
            )
        )
    for u in r.unique:
        parts.append(_report_row(_duplicate_groups(df, u), f"unique:{r.table}({_cols(u)})", r.table))
    return parts


def _fk_name(table: str, fk: ForeignKey) -> str:
    return f"foreign_key:{table}({_cols(fk.cols)})->{fk.parent}({_cols(fk.parent_cols)})"


def check_foreign_keys(tables: dict[str, DataFrame], rules: list[TableRules]) -> list[DataFrame]:
    """All foreign keys, one pass per referenced parent key.

    The non-null child keys of every rule pointing at the same parent key are
    tagged with their rule and grouped by key value (per-rule counts as
    conditional sums; partial aggregation collapses a hot value map-side).
    One anti join with the parent keys -- reusing that key partitioning --
    leaves the orphan values; one aggregate turns them into a row per rule."""
    groups: dict[tuple[str, tuple[str, ...]], list[tuple[str, ForeignKey]]] = {}
    for r in rules:
        if r.table not in tables:
            continue
        for fk in r.foreign_keys:
            groups.setdefault((fk.parent, fk.parent_cols), []).append((r.table, fk))
    parts: list[DataFrame] = []
    for (parent_name, parent_cols), members in groups.items():
        parent = tables[parent_name]
        types = [parent.schema[c].dataType for c in parent_cols]
        kcols = [f"_k{i}" for i in range(len(parent_cols))]
        tagged = None
        for j, (table, fk) in enumerate(members):
            child = tables[table].select(
                *[F.col(c).cast(t).alias(k) for c, t, k in zip(fk.cols, types, kcols)],
                F.lit(j).alias("_r"),
            )
            for k in kcols:
                child = child.where(F.col(k).isNotNull())
            tagged = child if tagged is None else tagged.union(child)
        counts = tagged.groupBy(*kcols).agg(
            *[F.count_if(F.col("_r") == j).alias(f"_n{j}") for j in range(len(members))]
        )
        keys = parent.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(parent_cols)])
        cond = None
        for i, k in enumerate(kcols):
            term = F.col(k) == F.col(f"_p{i}")
            cond = term if cond is None else cond & term
        orphans = counts.join(keys, cond, "left_anti")
        totals = orphans.agg(
            *[F.coalesce(F.sum(f"_n{j}"), F.lit(0)).cast("bigint").alias(f"_t{j}") for j in range(len(members))]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(_fk_name(table, fk)).alias("rule"),
                    F.lit(table).alias("table_name"),
                    F.col(f"_t{j}").alias("violations"),
                )
                for j, (table, fk) in enumerate(members)
            ]
        )
        parts.append(totals.select(F.explode(rows).alias("_x")).select("_x.rule", "_x.table_name", "_x.violations"))
    return parts


def check_constraints(tables: dict[str, DataFrame], rules: list[TableRules]) -> DataFrame:
    """One report row per rule: (rule, table_name, violations)."""
    parts: list[DataFrame] = []
    for r in rules:
        if r.table in tables:
            parts.extend(check_table(tables, r))
    parts.extend(check_foreign_keys(tables, rules))
    # every part is (rule, table_name, violations) in this order: a positional
    # union avoids re-resolving names on an ever larger plan
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


# ---------------------------------------------------------------------------
# Rules of the source schema. Keys, NOT NULL columns, CHECK
# (>= 0) columns and references as declared by the reference's source DDL.
# ---------------------------------------------------------------------------


def _fk(cols, parent, parent_cols=None) -> ForeignKey:
    cols = (cols,) if isinstance(cols, str) else tuple(cols)
    parent_cols = cols if parent_cols is None else ((parent_cols,) if isinstance(parent_cols, str) else tuple(parent_cols))
    return ForeignKey(cols, parent, parent_cols)


EXTRACT_RULES: list[TableRules] = [
    TableRules("countries", ("country_id",), ("country_name",)),
    TableRules(
        "state_provinces",
        ("state_province_id",),
        ("state_province_name", "country_id"),
        foreign_keys=(_fk("country_id", "countries"),),
    ),
    TableRules(
        "cities",
        ("city_id",),
        ("city_name", "state_province_id"),
        foreign_keys=(_fk("state_province_id", "state_provinces"),),
    ),
    TableRules("customer_categories", ("customer_category_id",), ("customer_category_name",)),
    TableRules("buying_groups", ("buying_group_id",), ("buying_group_name",)),
    TableRules("people", ("person_id",), ("full_name", "is_salesperson")),
    TableRules(
        "customers",
        ("customer_id",),
        ("customer_name", "customer_category_id", "delivery_city_id"),
        foreign_keys=(
            _fk("customer_category_id", "customer_categories"),
            _fk("buying_group_id", "buying_groups"),
            _fk("delivery_city_id", "cities", "city_id"),
        ),
    ),
    TableRules("colors", ("color_id",), ("color_name",)),
    TableRules(
        "stock_items",
        ("stock_item_id",),
        ("stock_item_name",),
        ("unit_price",),
        foreign_keys=(_fk("color_id", "colors"),),
    ),
    TableRules("stock_groups", ("stock_group_id",), ("stock_group_name",)),
    TableRules(
        "stock_item_stock_groups",
        ("stock_item_stock_group_id",),
        ("stock_item_id", "stock_group_id"),
        unique=(("stock_item_id", "stock_group_id"),),
        foreign_keys=(_fk("stock_item_id", "stock_items"), _fk("stock_group_id", "stock_groups")),
    ),
    TableRules(
        "orders",
        ("order_id",),
        ("customer_id", "salesperson_person_id", "order_date", "is_undersupply_backordered"),
        foreign_keys=(
            _fk("customer_id", "customers"),
            _fk("salesperson_person_id", "people", "person_id"),
        ),
    ),
    TableRules(
        "order_backorders",
        ("order_id",),
        ("backorder_order_id",),
        foreign_keys=(_fk("order_id", "orders"), _fk("backorder_order_id", "orders", "order_id")),
    ),
    TableRules(
        "order_lines",
        ("order_line_id",),
        ("order_id", "stock_item_id", "quantity", "picked_quantity", "unit_price", "tax_rate"),
        ("quantity", "picked_quantity", "unit_price", "tax_rate"),
        foreign_keys=(_fk("order_id", "orders"), _fk("stock_item_id", "stock_items")),
    ),
    TableRules(
        "invoices",
        ("invoice_id",),
        ("customer_id", "salesperson_person_id", "invoice_date"),
        foreign_keys=(
            _fk("customer_id", "customers"),
            _fk("order_id", "orders"),
            _fk("salesperson_person_id", "people", "person_id"),
        ),
    ),
    TableRules(
        "invoice_lines",
        ("invoice_line_id",),
        (
            "invoice_id",
            "stock_item_id",
            "quantity",
            "unit_price",
            "tax_rate",
            "tax_amount",
            "line_profit",
            "extended_price",
        ),
        ("quantity", "unit_price", "tax_rate"),
        foreign_keys=(_fk("invoice_id", "invoices"), _fk("stock_item_id", "stock_items")),
    ),
]


def stand_in_rules() -> list[TableRules]:
    """The extract rules adapted to the driver-table stand-ins: tables without
    a single-column id use their natural composite identity, the salesperson
    sits on the line, colours and the undersupply flag do not exist."""
    by_name = {r.table: r for r in EXTRACT_RULES}
    out = [by_name[n] for n in (
        "countries", "state_provinces", "cities", "customer_categories", "buying_groups",
        "people", "customers", "stock_groups", "order_backorders",
    )]
    out.append(TableRules("stock_items", ("stock_item_id",), ("stock_item_name",), ("unit_price",)))
    out.append(
        TableRules(
            "stock_item_stock_groups",
            ("stock_item_id", "stock_group_id"),
            foreign_keys=(_fk("stock_item_id", "stock_items"), _fk("stock_group_id", "stock_groups")),
        )
    )
    out.append(
        TableRules(
            "orders",
            ("order_id",),
            ("customer_id", "order_date"),
            foreign_keys=(_fk("customer_id", "customers"),),
        )
    )
    out.append(
        TableRules(
            "order_lines",
            ("order_id", "line_number"),
            ("stock_item_id", "salesperson_person_id", "quantity", "picked_quantity", "unit_price", "tax_rate"),
            ("quantity", "picked_quantity", "unit_price", "tax_rate"),
            foreign_keys=(
                _fk("order_id", "orders"),
                _fk("stock_item_id", "stock_items"),
                _fk("salesperson_person_id", "people", "person_id"),
            ),
        )
    )
    out.append(
        TableRules(
            "invoices",
            ("order_id", "invoice_date"),
            ("customer_id",),
            foreign_keys=(_fk("customer_id", "customers"), _fk("order_id", "orders")),
        )
    )
    out.append(
        TableRules(
            "invoice_lines",
            ("order_id", "invoice_date", "line_number"),
            ("stock_item_id", "quantity", "unit_price", "tax_rate", "tax_amount", "line_profit", "extended_price"),
            ("quantity", "unit_price", "tax_rate"),
            foreign_keys=(
                _fk(("order_id", "invoice_date"), "invoices"),
                _fk("stock_item_id", "stock_items"),
            ),
        )
    )
    return out


# Warehouse-layer keys as declared on the star schema (then lost by CTAS in
# the reference): dimension keys unique and natural keys unique, fact keys
# resolving to the dimensions.
def warehouse_rules(
    order_line_cols: tuple[str, ...],
    sale_line_cols: tuple[str, ...],
    sale_invoice_cols: tuple[str, ...] = ("invoice_id",),
) -> list[TableRules]:
    dims = (
        _fk("date_key", "dim_date"),
        _fk("customer_key", "dim_customer"),
        _fk("employee_key", "dim_employee"),
        _fk("product_key", "dim_product"),
    )
    return [
        TableRules(
            "dim_date",
            ("date_key",),
            ("full_date", "month_name", "calendar_year", "fiscal_month", "fiscal_quarter", "fiscal_year"),
            unique=(("full_date",),),
        ),
        TableRules(
            "dim_customer",
            ("customer_key",),
            (
                "customer_id", "customer_name", "customer_category", "city", "state_province", "country",
                "effective_start_date", "effective_end_date", "is_current",
            ),
        ),
        TableRules("dim_employee", ("employee_key",), ("person_id", "employee_name"), unique=(("person_id",),)),
        TableRules("dim_product", ("product_key",), ("stock_item_id", "product_name"), unique=(("stock_item_id",),)),
        TableRules(
            "fact_order",
            order_line_cols,
            (
                "order_id", "date_key", "customer_key", "employee_key", "product_key",
                "ordered_quantity", "picked_quantity", "ordered_sales", "is_backordered",
            ),
            foreign_keys=dims,
        ),
        TableRules(
            "fact_sale",
            sale_line_cols,
            # the invoice of the stand-in tables is (order, date)
            tuple(dict.fromkeys((
                *sale_invoice_cols, "date_key", "customer_key", "employee_key", "product_key",
                "invoiced_quantity", "sales", "profit",
            ))),
            foreign_keys=dims,
        ),
    ]
