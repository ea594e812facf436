"""Name -> (spark, sf_dir) -> DataFrame for every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans import questions as q
from martwright.plans import reports as r
from martwright.plans import series
from martwright.plans.warehouse import warehouse_for
from martwright.session import scratch_path, stash
from martwright.streaming.incremental import IncrementalLoad, run_incremental
from martwright.sources.extracts import MANIFEST, read_extract, typed_table, write_extract

QueryFn = Callable[[SparkSession, str], DataFrame]


def _q01(spark, d):
    wh = warehouse_for(spark, d)
    return q.q01_monthly_sales(wh.fact_sale, wh.dim_date)


def _q02(spark, d):
    wh = warehouse_for(spark, d)
    return q.q02_top_products(wh.fact_sale, wh.dim_product)


def _q03(spark, d):
    wh = warehouse_for(spark, d)
    return q.q03_top_customers(wh.fact_sale, wh.dim_customer)


def _q04(spark, d):
    wh = warehouse_for(spark, d)
    return q.q04_geography_top10(wh.fact_sale, wh.dim_customer)


def _q05(spark, d):
    wh = warehouse_for(spark, d)
    return q.q05_salesperson(wh.fact_order, wh.fact_sale, wh.dim_employee)


def _q06(spark, d):
    wh = warehouse_for(spark, d)
    return q.q06_fill_rate(wh.fact_order, wh.fact_sale)


def _q07(spark, d):
    wh = warehouse_for(spark, d)
    return q.q07_days_to_invoice(wh.fact_sale, invoice_cols=wh.sources.invoice_id_cols)


def _q08(spark, d):
    wh = warehouse_for(spark, d)
    return q.q08_backorder_value(wh.sources.order_backorders, wh.fact_order, line_col=wh.sources.order_line_id_cols[-1])


def _q09(spark, d):
    return q.q09_version_history(warehouse_for(spark, d).dim_customer)


def _q10(spark, d):
    wh = warehouse_for(spark, d)
    return q.q10_asof_sales(wh.fact_sale, wh.dim_customer, customer_id=1)


QUESTIONS: dict[str, QueryFn] = {
    "q01_monthly_sales": _q01,
    "q02_top_products": _q02,
    "q03_top_customers": _q03,
    "q04_geography_top10": _q04,
    "q05_salesperson": _q05,
    "q06_fill_rate": _q06,
    "q07_days_to_invoice": _q07,
    "q08_backorder_value": _q08,
    "q09_version_history": _q09,
    "q10_asof_sales": _q10,
}

OPERATORS: dict[str, QueryFn] = {
    "dim_date": lambda s, d: warehouse_for(s, d).dim_date,
    "dim_customer_initial": lambda s, d: warehouse_for(s, d).dim_customer_initial,
    "dim_customer_scd2": lambda s, d: warehouse_for(s, d).dim_customer,
    "dim_employee": lambda s, d: warehouse_for(s, d).dim_employee,
    "dim_product": lambda s, d: warehouse_for(s, d).dim_product,
    "fact_order": lambda s, d: warehouse_for(s, d).fact_order,
    "fact_sale": lambda s, d: warehouse_for(s, d).fact_sale,
}


def _csv_round_trip(spark, d):
    """People written in the extract format (``;``, ``NULL``, 0/1 flags, an
    extra column holding the separator) and ingested back by header name."""
    people = warehouse_for(spark, d).sources.people
    path = scratch_path(spark, "extract-people")
    write_extract(
        people.select(
            F.concat(F.lit("note; "), F.col("full_name")).alias("Comments"),
            F.col("person_id").alias("PersonID"),
            F.col("full_name").alias("FullName"),
            F.col("is_salesperson").cast("int").alias("IsSalesperson"),
        ),
        path,
    )
    spec = next(s for s in MANIFEST if s.table == "people")
    return typed_table(read_extract(spark, path), spec)


def _incremental_line_load(spark, d):
    """Stream the line items into a keyed, month-partitioned table, then
    replay everything as after a lost checkpoint: the table stays exact."""
    from dataclasses import replace

    schema = spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet").schema
    base = scratch_path(spark, "incremental")
    cfg = IncrementalLoad(
        source_glob=f"{d.rstrip('/')}/lineitem*.parquet",
        source_base=d,
        schema=schema,
        target=f"{base}/lines",
        monitor=f"{base}/late_rows",
        checkpoint=f"{base}/checkpoint",
        key_cols=tuple(schema.names),
        partition_col="ship_month",
        partition_expr="CAST(date_format(l_shipdate, 'yyyyMM') AS INT)",
        event_col="l_shipdate",
    )
    run_incremental(spark, cfg)
    run_incremental(spark, replace(cfg, checkpoint=f"{base}/checkpoint-replay"))
    return spark.read.parquet(cfg.target).select(*schema.names)


def _late_row_monitor(spark, d):
    """Line items arrive in three folders; the monitor counts, per batch, those
    shipped before the latest ship date seen earlier less the allowed day. A
    replay after a lost checkpoint leaves the monitor as it is."""
    from dataclasses import replace

    lines = spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet")
    base = scratch_path(spark, "late-rows")
    cfg = IncrementalLoad(
        source_glob=f"{base}/landing/part-*/*.parquet",
        source_base=f"{base}/landing",
        schema=lines.schema,
        target=f"{base}/lines",
        monitor=f"{base}/late_rows",
        checkpoint=f"{base}/checkpoint",
        key_cols=tuple(lines.columns),
        event_col="l_shipdate",
        max_files_per_trigger=None,
    )
    for k in range(3):  # an arrival is a folder of any number of files, and one batch
        lines.where(F.col("l_orderkey") % 3 == k).write.parquet(f"{base}/landing/part-{k}")
        run_incremental(spark, cfg)
    run_incremental(spark, replace(cfg, checkpoint=f"{base}/checkpoint-replay"))
    return spark.read.parquet(cfg.monitor).select("batch_id", "rows_in_batch", "late_rows", "max_event_time")


def _result_sink_round_trip(spark, d):
    """The backorder question (one row per link: grows with the orders)
    written by the result sink as header CSV and read back with its schema."""
    from martwright.plans.pipeline import write_result

    df = _q08(spark, d)
    path = scratch_path(spark, "result-q08")
    write_result(df, path)
    return spark.read.schema(df.schema).option("header", "true").csv(path)


def _incremental_fact_order(spark, d):
    """Order-line facts built incrementally by a streaming load of the line
    items (each batch keyed against the stored dimensions), then everything
    replayed as after a lost checkpoint: equal to the batch-built fact."""
    from dataclasses import replace

    from martwright.operators.facts import fact_order
    from martwright.sources.staging import line_frame, order_lines_wide_of
    from martwright.streaming.incremental import FactIncrement, rows_without, run_fact_increment

    wh = warehouse_for(spark, d)
    src = wh.sources
    header = src.orders.select("order_id", "customer_id", "order_date").join(
        src.order_backorders, "order_id", "left"
    )

    def to_facts(raw):
        # joined once: the keys are profiled, then found on two branches
        lines = stash(order_lines_wide_of(line_frame(raw, header, src.stock_items)), "increment-lines")
        return fact_order(
            lines, src.order_backorders, wh.dim_customer, wh.dim_employee, wh.dim_product,
            line_id_cols=src.order_line_id_cols,
        )

    base = scratch_path(spark, "fact-increment")
    cfg = FactIncrement(
        source_glob=f"{d.rstrip('/')}/lineitem*.parquet",
        source_base=d,
        schema=spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet").schema,
        deltas=f"{base}/deltas",
        facts=f"{base}/facts",
        checkpoint=f"{base}/checkpoint",
        partition_col="ship_month",
        partition_expr="CAST(date_format(l_shipdate, 'yyyyMM') AS INT)",
        fact_partition_col="year_month",
        fact_partition_expr="CAST(date_key / 100 AS INT)",
        to_facts=to_facts,
        # (l_orderkey, l_linenumber) repeats in the driver's lines: a row is its own identity
        not_ready=lambda raw: rows_without(raw, "l_orderkey", src.orders, "order_id"),
    )
    run_fact_increment(spark, cfg)
    facts = run_fact_increment(spark, replace(cfg, checkpoint=f"{base}/checkpoint-replay"))
    return facts.select(*wh.fact_order.columns)


REPORTS: dict[str, QueryFn] = {
    "incremental_fact_order": _incremental_fact_order,
    "result_sink_round_trip": _result_sink_round_trip,
    "incremental_line_load": _incremental_line_load,
    "late_row_monitor": _late_row_monitor,
    "csv_round_trip": _csv_round_trip,
    "constraint_report": lambda s, d: r.constraint_report(warehouse_for(s, d)),
    "unresolved_keys": lambda s, d: r.unresolved_keys(warehouse_for(s, d)),
    "duplicate_keys": lambda s, d: r.duplicate_keys(warehouse_for(s, d)),
    "overlap_check": lambda s, d: r.overlap_check(warehouse_for(s, d)),
    "overlap_check_unexpired": lambda s, d: r.overlap_check_unexpired(warehouse_for(s, d)),
    "dq_report": lambda s, d: r.dq_report(warehouse_for(s, d)),
    "dq_report_broken": lambda s, d: r.dq_report_broken(warehouse_for(s, d)),
    "constraint_report_broken": lambda s, d: r.constraint_report_broken(warehouse_for(s, d)),
    "dim_customer_type1": lambda s, d: r.dim_customer_type1(warehouse_for(s, d)),
    "dim_customer_series": lambda s, d: series.dim_customer_series(warehouse_for(s, d)),
    "asof_scan_lines": lambda s, d: series.asof_scan_lines(warehouse_for(s, d)),
    "overlap_pairs": lambda s, d: series.overlap_pairs_of(warehouse_for(s, d).dim_customer),
    "overlap_pairs_unexpired": lambda s, d: series.overlap_pairs_unexpired(warehouse_for(s, d)),
    "overlap_pairs_orders": lambda s, d: series.overlap_pairs_orders(warehouse_for(s, d)),
    "watermarked_line_load": series.watermarked_line_load,
    "extract_round_trip": lambda s, d: series.extract_round_trip(warehouse_for(s, d)),
    "row_counts": lambda s, d: r.row_counts(warehouse_for(s, d)),
    "table_profile": lambda s, d: r.table_profile(warehouse_for(s, d), exact=True),
}


def all_queries() -> dict[str, QueryFn]:
    out = dict(QUESTIONS)
    out.update(OPERATORS)
    out.update(REPORTS)
    return out
