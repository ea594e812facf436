"""Typed extract ingest and the end-to-end pipeline on hand-made extracts."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from extract_fixture import FILES, write_fixture
from martwright.operators.quality import EXTRACT_RULES, check_constraints
from martwright.plans.pipeline import REFERENCE_CHANGE, question_frames, run_pipeline, warehouse_gates
from martwright.plans.warehouse import build_warehouse
from martwright.sources.extracts import check_inputs, ingest, sources_from_tables


def test_typed_ingest(spark, tmp_out):
    root = write_fixture(tmp_out)
    t = ingest(spark, root)
    countries = {r["country_id"]: r["country_name"] for r in t["countries"].collect()}
    assert countries[2] == "Freedonia; North"
    assert t["countries"].columns == ["country_id", "country_name", "continent", "region"]
    people = {r["person_id"]: r["is_salesperson"] for r in t["people"].collect()}
    assert people == {1: True, 2: True, 3: False}
    prices = {r["stock_item_id"]: r["unit_price"] for r in t["stock_items"].collect()}
    assert prices[1] == decimal.Decimal("10.01")  # 10.005 rounds half up
    states = {r["state_province_id"]: r["sales_territory"] for r in t["state_provinces"].collect()}
    assert states[11] is None
    opened = {r["customer_id"]: r["account_opened_date"] for r in t["customers"].collect()}
    assert opened[2] == dt.date(2013, 1, 1) and opened[3] is None
    assert t["order_backorders"].collect()[0].asDict() == {"order_id": 1, "backorder_order_id": 4}


def test_missing_files_reported_together(spark, tmp_out):
    files = dict(FILES)
    files.pop("Sales/Sales.Invoices.csv")
    files.pop("Warehouse/Warehouse.Colors.csv")
    root = write_fixture(tmp_out, files)
    with pytest.raises(FileNotFoundError) as err:
        check_inputs(spark, root)
    assert "Sales/Sales.Invoices.csv" in str(err.value)
    assert "Warehouse/Warehouse.Colors.csv" in str(err.value)


def test_missing_column_fails_at_analysis(spark, tmp_out):
    files = dict(FILES)
    files["Sales/Sales.BuyingGroups.csv"] = ["BuyingGroupID;Name", "1;Group One"]
    root = write_fixture(tmp_out, files)
    with pytest.raises(AnalysisException):
        ingest(spark, root)


def test_bad_number_fails(spark, tmp_out):
    files = dict(FILES)
    files["Warehouse/Warehouse.StockGroups.csv"] = ["StockGroupID;StockGroupName", "x1;Toys"]
    root = write_fixture(tmp_out, files)
    t = ingest(spark, root)
    with pytest.raises(Exception):
        t["stock_groups"].collect()


def test_constraints_clean_and_fire(spark, tmp_out):
    root = write_fixture(tmp_out)
    t = ingest(spark, root)
    report = {r["rule"]: r["violations"] for r in check_constraints(t, EXTRACT_RULES).collect()}
    assert all(v == 0 for v in report.values()), {k: v for k, v in report.items() if v}
    # mutations: duplicate key, orphan reference, negative quantity, null name
    files = dict(FILES)
    files["Sales/Sales.OrderLines.csv"] = FILES["Sales/Sales.OrderLines.csv"] + [
        "5;9;1;-1;0;1.00;15.000",
    ]
    files["Sales/Sales.BuyingGroups.csv"] = FILES["Sales/Sales.BuyingGroups.csv"] + ["3;NULL"]
    root2 = write_fixture(os.path.join(tmp_out, "broken"), files)
    t2 = ingest(spark, root2)
    report = {r["rule"]: r["violations"] for r in check_constraints(t2, EXTRACT_RULES).collect()}
    assert report["primary_key:order_lines(order_line_id)"] == 1
    assert report["foreign_key:order_lines(order_id)->orders(order_id)"] == 1
    assert report["non_negative:order_lines(quantity)"] == 1
    assert report["not_null:buying_groups(buying_group_name)"] == 1


def test_warehouse_from_extracts(spark, tmp_out):
    src = sources_from_tables(ingest(spark, write_fixture(tmp_out)))
    wh = build_warehouse(src, REFERENCE_CHANGE)
    dc = wh.dim_customer.orderBy("customer_key").collect()
    assert [(r["customer_key"], r["customer_id"], r["customer_category"], r["is_current"]) for r in dc] == [
        (1, 1, "Novelty Shop", False),
        (2, 2, "Novelty Shop", True),
        (3, 3, "Wholesaler", True),
        (4, 1, "Wholesaler", True),
    ]
    assert dc[0]["effective_end_date"] == dt.date(2014, 12, 31)
    assert dc[3]["effective_start_date"] == dt.date(2015, 1, 1)
    # product without group keeps a null category; two groups -> lowest id
    prod = {r["stock_item_id"]: r["product_category"] for r in wh.dim_product.collect()}
    assert prod == {1: "Toys", 2: "Packaging", 3: None}
    # dim_date spans 2014-10-31 .. 2015-02-01
    assert wh.dim_date.count() == (dt.date(2015, 2, 1) - dt.date(2014, 10, 31)).days + 1
    # facts: order on 2015-01-01 (start date) -> new version; invoice w/o order -> null days
    fo = {r["order_line_id"]: r for r in wh.fact_order.collect()}
    assert fo[3]["customer_key"] == 4 and fo[1]["customer_key"] == 1
    assert fo[1]["is_backordered"] and not fo[3]["is_backordered"]
    fs = {r["invoice_line_id"]: r for r in wh.fact_sale.collect()}
    assert fs[3]["days_to_invoice"] is None and fs[1]["days_to_invoice"] == 3
    assert fs[1]["sales"] == decimal.Decimal("120.12")
    q = question_frames(wh)
    q6 = q["business_q06"].collect()[0]
    # order 1 ordered 15 of item 1 (two lines), invoiced 12; order 2: 4/4; order 3 and 4: 0
    assert (q6["quantity_ordered"], q6["quantity_invoiced"]) == (29, 16)
    q7 = q["business_q07"].collect()[0]
    assert (q7["invoices_counted"], q7["average_days_to_invoice"]) == (2, 1.5)
    q9 = q["business_q09"].collect()
    assert [(r["customer_id"], r["versions"], r["category_history"]) for r in q9] == [
        (1, 2, "Novelty Shop -> Wholesaler")
    ]
    q10 = q["business_q10"].collect()
    assert [(r["customer_category"], r["sales"]) for r in q10] == [
        ("Novelty Shop", decimal.Decimal("120.12")),
        ("Wholesaler", decimal.Decimal("80.00")),
    ]
    q4 = {(r["level"], r["area"]): r["sales"] for r in q["business_q04"].collect()}
    assert q4[("Territory", None)] == decimal.Decimal("5.50")
    q8 = q["business_q08"].collect()
    assert [(r["original_order_id"], r["backorder_order_id"], r["backorder_lines"]) for r in q8] == [(1, 4, 1)]
    gates = {r["rule"]: r["violations"] for r in warehouse_gates(wh).collect()}
    assert all(v == 0 for v in gates.values()), gates


def test_scd_rerun_is_idempotent_and_noop_change_adds_nothing(spark, tmp_out):
    from martwright.operators.scd2 import apply_scd2
    from martwright.plans.warehouse import changed_snapshot

    src = sources_from_tables(ingest(spark, write_fixture(tmp_out)))
    wh = build_warehouse(src, REFERENCE_CHANGE)
    again = apply_scd2(wh.dim_customer, changed_snapshot(src, REFERENCE_CHANGE), REFERENCE_CHANGE.change_date)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, wh.dim_customer.collect()))
    # customer 3 is already a wholesaler: no new version
    from martwright.plans.warehouse import CategoryChange

    noop = CategoryChange(dt.date(2015, 1, 1), 2, "customer_id = 3")
    wh2 = build_warehouse(src, noop)
    assert wh2.dim_customer.count() == 3
    # two customers change at once: distinct dense keys after the maximum
    both = CategoryChange(dt.date(2015, 1, 1), 2, "customer_id IN (1, 2)")
    keys = sorted(r[0] for r in build_warehouse(src, both).dim_customer.select("customer_key").collect())
    assert keys == [1, 2, 3, 4, 5]


def test_run_pipeline(spark, tmp_out):
    root = write_fixture(os.path.join(tmp_out, "in"))
    out = os.path.join(tmp_out, "out")
    res = run_pipeline(spark, root, out)
    assert res["counts"]["fact_order"] == 5 and res["counts"]["fact_sale"] == 3
    assert len(res["gates"]) == 11
    q1 = spark.read.option("header", True).csv(os.path.join(out, "results", "business_q01.csv"))
    assert q1.columns[:2] == ["calendar_year", "month_name"]
    log = [r[0] for r in spark.read.text(os.path.join(out, "results", "pipeline_log")).collect()]
    assert any(line.startswith("PASS:") for line in log)


def test_pipeline_refuses_to_publish_broken_extracts(spark, tmp_out):
    files = dict(FILES)
    files["Sales/Sales.Orders.csv"] = FILES["Sales/Sales.Orders.csv"] + ["5;99;1;2015-01-01;1;NULL"]
    root = write_fixture(os.path.join(tmp_out, "in"), files)
    out = os.path.join(tmp_out, "out")
    with pytest.raises(ValueError, match="foreign_key:orders"):
        run_pipeline(spark, root, out)
    assert not os.path.exists(os.path.join(out, "oltp"))


def test_command_line_pipeline(spark, tmp_out):
    import argparse

    from martwright.__main__ import run

    root = write_fixture(os.path.join(tmp_out, "in"))
    out = os.path.join(tmp_out, "out")
    res = run(spark, argparse.Namespace(command="pipeline", extracts=root, out=out))
    assert res["counts"]["dim_customer"] == 4
    q10 = spark.read.option("header", True).csv(os.path.join(out, "results", "business_q10.csv")).collect()
    assert [r["customer_category"] for r in q10] == ["Novelty Shop", "Wholesaler"]


def test_full_profile(spark, tmp_out):
    from martwright.plans.reports import profile

    t = ingest(spark, write_fixture(tmp_out))
    rows = {r["column_name"]: r for r in profile(t["stock_items"], "stock_items", full=True).collect()}
    assert rows["unit_price"]["data_type"] == "decimal(18,2)"
    assert (rows["unit_price"]["min_value"], rows["unit_price"]["max_value"]) == ("5.50", "20.00")
    assert rows["color_id"]["nulls"] == 2 and rows["brand"]["distinct_values"] == 1


def test_command_line_tables(spark, tmp_out):
    import argparse

    from conftest import SF_SMALL
    from martwright.__main__ import run

    out = os.path.join(tmp_out, "tables-out")
    res = run(spark, argparse.Namespace(command="tables", sf_dir=SF_SMALL, out=out))
    gates = spark.read.option("header", True).csv(os.path.join(res["results"], "quality_gates.csv"))
    assert gates.count() == 11
    q1 = spark.read.option("header", True).csv(os.path.join(res["results"], "business_q01.csv"))
    assert q1.count() > 0


def test_republish_moves_pointer_without_duplicates(spark, tmp_out):
    from martwright.sources.extracts import publish_snapshot, read_published

    tables = ingest(spark, write_fixture(os.path.join(tmp_out, "in")))
    base = os.path.join(tmp_out, "oltp")
    first = publish_snapshot(tables, base)
    second = publish_snapshot(tables, base)
    assert first != second
    current = read_published(spark, base)
    assert current["order_lines"].count() == tables["order_lines"].count() == 5
    assert {r[0] for r in spark.read.text(os.path.join(base, "_current")).collect()} == {second}


def test_empty_fields_and_quoted_line_breaks(spark, tmp_out):
    from martwright.sources.extracts import MANIFEST, read_extract, typed_table

    spec = next(s for s in MANIFEST if s.table == "people")
    path = os.path.join(tmp_out, "people.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('PersonID;FullName;IsSalesperson\n1;;1\n2;"two\nlines";0\n3;NULL;NULL\n4;"";1\n')
    got = sorted(tuple(r) for r in typed_table(read_extract(spark, path), spec).collect())
    assert got == [(1, "", True), (2, "two\nlines", False), (3, None, None), (4, "", True)]


def test_a_filter_on_a_cast_never_sees_header_or_blank_lines(spark, tmp_out):
    from martwright.sources.extracts import MANIFEST, read_extract, typed_table

    spec = next(s for s in MANIFEST if s.table == "people")
    path = os.path.join(tmp_out, "people.csv")
    for part, rows in (("a", '1;"two\nlines";1\n\n2;b;0\n'), ("b", '"3";c;NULL\n')):
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, f"{part}.csv"), "w", encoding="utf-8") as f:
            f.write("PersonID;FullName;IsSalesperson\n" + rows)
    people = typed_table(read_extract(spark, path), spec)
    for column, values in (("person_id", {1, 2, 3}), ("is_salesperson", {True, False})):
        assert {r[0] for r in people.select(column).where(f"{column} IS NOT NULL").distinct().collect()} == values


def test_proven_stages_are_taken_over(spark, tmp_out):
    """Of a run that broke, and lost a stored file, only what is proven is read again."""
    from martwright.plans.stages import Stages

    built = []

    def build(name):
        built.append(name)
        return spark.range(20).selectExpr("id", f"'{name}' AS t")

    def run(names, inputs="x"):
        built.clear()
        stages = Stages(spark, tmp_out, inputs)
        assert all(stages.table(n, lambda n=n: build(n)).count() == 20 for n in names)
        return list(built), stages.reused

    assert run("ab") == (["a", "b"], [])
    folder = os.path.join(tmp_out, next(d for d in os.listdir(tmp_out) if d.startswith("b-")))
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.rename(os.path.join(folder, part), os.path.join(folder, "_lost"))
    assert run("abc") == (["b", "c"], ["a"])
    assert run("abc") == ([], ["a", "b", "c"])
    assert run("a", "other inputs") == (["a"], [])


def test_fingerprints_tell_rows_not_order(spark):
    from martwright.plans.stages import fingerprint

    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "CAST(NULL AS STRING) AS t")
    assert fingerprint(df) == fingerprint(df.orderBy(F.rand()).repartition(7))
    assert fingerprint(df) != fingerprint(df.unionByName(df.limit(1)))
    assert fingerprint(df) != fingerprint(df.withColumn("k", F.when(F.col("id") == 5, F.lit(9)).otherwise(F.col("k"))))
    assert fingerprint(df.limit(0))["rows"] == 0


def test_results_are_one_ordered_file_or_ordered_parts(spark, tmp_out):
    from martwright.plans.pipeline import write_result

    df = spark.range(500).selectExpr("id * 7919 % 500 AS n", "'x;,\"' AS t").orderBy(F.desc("n"))
    want = [str(n) for n in range(499, -1, -1)]
    for k in range(2):  # again over the first
        write_result(df, os.path.join(tmp_out, "one.csv"))
    assert os.path.isfile(os.path.join(tmp_out, "one.csv")) and sorted(os.listdir(tmp_out)) in (["one.csv"], [".one.csv.crc", "one.csv"])
    lines = open(os.path.join(tmp_out, "one.csv")).read().splitlines()
    assert lines[0] == "n,t" and [x.split(",")[0] for x in lines[1:]] == want
    write_result(df, os.path.join(tmp_out, "many.csv"), max_rows=10)
    assert os.path.isdir(os.path.join(tmp_out, "many.csv"))
    assert [r["n"] for r in spark.read.option("header", True).csv(os.path.join(tmp_out, "many.csv")).collect()] != []
    write_result(df.limit(0), os.path.join(tmp_out, "none.csv"))
    assert open(os.path.join(tmp_out, "none.csv")).read().strip() == "n,t"
