"""End-to-end run over the source extracts, in the reference's order:

ingest -> validate -> publish snapshot -> dimensions -> history change ->
facts -> stored warehouse -> question results -> row counts -> quality gates.

Results are written before the gates are enforced (as in the reference), and
the run log (row counts + gate lines) is written only when every gate passes.

Every stored table is a stage with a proof (``stages.Stages``): a run that broke
is started again under its ``run_id`` and goes on behind its last proven stage.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.operators.gates import enforce, quality_gates
from martwright.operators.quality import EXTRACT_RULES, check_constraints
from martwright.plans import questions as q
from martwright.plans.reports import row_counts
from martwright.plans.stages import Stages
from martwright.plans.warehouse import CategoryChange, Warehouse, build_warehouse
from martwright.session import path_state, stash
from martwright.sources.extracts import MANIFEST, ingest, point_at, sources_from_tables

# The reference's demonstration change (customer 1 becomes
# category 2 from 2015-01-01).
REFERENCE_CHANGE = CategoryChange(change_date=dt.date(2015, 1, 1), new_category_id=2, selector="customer_id = 1")
DEMO_CUSTOMER_ID = 1
#: A result of so many rows is one file.
ONE_FILE_ROWS = 100_000
FACT_ORDER = ("date_key", "customer_key")


def question_frames(wh: Warehouse, customer_id: int = DEMO_CUSTOMER_ID) -> dict[str, DataFrame]:
    src = wh.sources
    return {
        "business_q01": q.q01_monthly_sales(wh.fact_sale, wh.dim_date),
        "business_q02": q.q02_top_products(wh.fact_sale, wh.dim_product),
        "business_q03": q.q03_top_customers(wh.fact_sale, wh.dim_customer),
        "business_q04": q.q04_geography_top10(wh.fact_sale, wh.dim_customer),
        "business_q05": q.q05_salesperson(wh.fact_order, wh.fact_sale, wh.dim_employee),
        "business_q06": q.q06_fill_rate(wh.fact_order, wh.fact_sale),
        "business_q07": q.q07_days_to_invoice(wh.fact_sale, invoice_cols=src.invoice_id_cols),
        "business_q08": q.q08_backorder_value(
            src.order_backorders, wh.fact_order, line_col=src.order_line_id_cols[-1]
        ),
        "business_q09": q.q09_version_history(wh.dim_customer),
        "business_q10": q.q10_asof_sales(wh.fact_sale, wh.dim_customer, customer_id=customer_id),
    }


def write_result(df: DataFrame, path: str, max_rows: int = ONE_FILE_ROWS) -> None:
    """Header + rows as CSV, in the result's order: one file at ``path`` for a
    result of up to ``max_rows`` rows, else a folder of part files in order (a
    range-partitioned sort, nothing through one task)."""
    spark = df.sparkSession
    stored = stash(df.withColumn("_at", F.monotonically_increasing_id()), "result")  # computed once; its order kept
    ordered = stored.orderBy("_at").select(*df.columns)
    if stored.count() > max_rows:
        ordered.write.mode("overwrite").option("header", "true").csv(path)
        return
    parts = f"{path}-{uuid.uuid4().hex[:12]}"
    first = Window.orderBy("_at")  # so few rows are one task's work
    one = stored.withColumn("_n", F.row_number().over(first)).sortWithinPartitions("_n").select(*df.columns)
    one.write.option("header", "true").csv(parts)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [f.getPath() for f in fs.listStatus(hadoop.Path(parts)) if f.getPath().getName().startswith("part-")]
    if len(files) != 1:
        raise OSError(f"{parts}: {len(files)} files")
    fs.delete(hadoop.Path(path), True)
    fs.rename(files[0], hadoop.Path(path))
    fs.delete(hadoop.Path(parts), True)


def warehouse_gates(wh: Warehouse) -> DataFrame:
    src = wh.sources
    return quality_gates(
        order_lines=src.order_lines,
        invoice_lines=src.invoice_lines,
        invoices=src.invoices,
        orders=src.orders,
        dims={
            "dim_date": wh.dim_date,
            "dim_customer": wh.dim_customer,
            "dim_employee": wh.dim_employee,
            "dim_product": wh.dim_product,
        },
        fact_order=wh.fact_order,
        fact_sale=wh.fact_sale,
        order_line_cols=src.order_line_id_cols,
        sale_line_cols=src.invoice_line_id_cols,
        dim_customer_initial=wh.dim_customer_initial,
        changed_snapshot=wh.changed_snapshot,
    )


def _stored_warehouse(wh: Warehouse, stages: Stages) -> Warehouse:
    """The six tables as stages; facts partitioned by year-month, in date ranges."""
    month = lambda df: df.withColumn("year_month", (F.col("date_key") / 100).cast("int"))
    stored = {}
    for name, df in wh.tables().items():
        if name.startswith("fact_"):
            stored[name] = stages.table(name, lambda df=df: month(df), "year_month", FACT_ORDER).select(*df.columns)
        else:
            stored[name] = stages.table(name, lambda df=df: df)
    return replace(wh, **stored)


def run_pipeline(
    spark: SparkSession,
    extracts_root: str,
    out_base: str,
    change: CategoryChange = REFERENCE_CHANGE,
    run_id: str | None = None,
) -> dict[str, object]:
    """One run; with the ``run_id`` of a broken one its proven stages are read,
    not built again, if the extracts are still the same files."""
    ingested = ingest(spark, extracts_root)
    files = sorted({spec.file for spec in MANIFEST})
    state = [(f, path_state(spark, f"{extracts_root.rstrip('/')}/{f}")) for f in files]
    run_dir = f"{out_base.rstrip('/')}/runs/run-{run_id or uuid.uuid4().hex[:12]}"
    inputs = hashlib.sha256(repr((state, change)).encode()).hexdigest()
    stages = Stages(spark, run_dir, inputs)
    # written first, then checked: what is validated is what is published
    tables = {name: stages.table(name, lambda df=df: df) for name, df in ingested.items()}
    violations = check_constraints(tables, EXTRACT_RULES).where(F.col("violations") > 0)
    broken = violations.collect()  # one row per declared rule at most
    if broken:
        detail = ", ".join(f"{r['rule']}={r['violations']}" for r in broken)
        raise ValueError(f"Source constraints violated, nothing published: {detail}")
    point_at(spark, f"{out_base.rstrip('/')}/oltp", run_dir)
    # the joined lines are stored once: the facts' profile and the facts read them
    src = sources_from_tables(tables)
    src = replace(
        src,
        order_lines_wide=stages.table("order_lines_wide", lambda: src.order_lines_wide),
        invoice_lines_wide=stages.table("invoice_lines_wide", lambda: src.invoice_lines_wide),
    )
    wh = _stored_warehouse(build_warehouse(src, change), stages)

    results_dir = f"{out_base.rstrip('/')}/results"
    for name, df in question_frames(wh).items():
        write_result(df, f"{results_dir}/{name}.csv")

    # source and warehouse row counts: one union of one-row counts, one action
    counted = {r["table_name"]: r["row_count"] for r in row_counts(wh).collect()}
    counts = {n: counted[n] for n in wh.tables()}
    gates = enforce(warehouse_gates(wh))
    log = (
        ["Source row counts:"]
        + [f"  {n}: {c:,}" for n, c in counted.items() if n not in counts]
        + ["Warehouse row counts:"]
        + [f"  {n}: {c:,}" for n, c in counts.items()]
        + [f"PASS: {rule}" for rule, _ in gates]
    )
    spark.createDataFrame([(line,) for line in log], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{results_dir}/pipeline_log")
    return {"run_dir": run_dir, "counts": counts, "gates": gates, "reused": stages.reused}
