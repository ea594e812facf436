"""Every quality gate stays quiet on clean input and fires on its mutation;
version-join boundaries; ranking ties; cross-question invariants."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from martwright.operators import gates as g
from martwright.operators.asof import asof_join
from martwright.plans import questions as q
from martwright.plans.registry import all_queries

D = dt.date
M = decimal.Decimal
OPEN = D(9999, 12, 31)

DIM_CUSTOMER = "customer_key long, customer_id long, customer_category string, effective_start_date date, effective_end_date date, is_current boolean"
FACT = "order_id long, line_number int, date_key int, customer_key long, employee_key long, product_key long"


def clean(spark):
    dim_customer_initial = spark.createDataFrame(
        [(1, 10, "A", D(1900, 1, 1), OPEN, True), (2, 20, "A", D(1900, 1, 1), OPEN, True)], DIM_CUSTOMER
    )
    dim_customer = spark.createDataFrame(
        [
            (1, 10, "A", D(1900, 1, 1), D(2014, 12, 31), False),
            (2, 20, "A", D(1900, 1, 1), OPEN, True),
            (3, 10, "B", D(2015, 1, 1), OPEN, True),
        ],
        DIM_CUSTOMER,
    )
    snapshot = spark.createDataFrame([(10, "B")], "customer_id long, customer_category string")
    dims = {
        "dim_date": spark.createDataFrame([(20141201,), (20150201,)], "date_key int"),
        "dim_customer": dim_customer,
        "dim_employee": spark.createDataFrame([(1,)], "employee_key long"),
        "dim_product": spark.createDataFrame([(1,)], "product_key long"),
    }
    fact_order = spark.createDataFrame(
        [(100, 1, 20141201, 1, 1, 1), (101, 1, 20150201, 3, 1, 1)], FACT
    )
    fact_sale = spark.createDataFrame(
        [(100, 1, 20141201, 1, 1, 1), (101, 1, 20150201, 3, 1, 1)], FACT
    )
    order_lines = spark.createDataFrame(
        [(100, 1, 5, 5, M("1.00"), M("0.1500")), (101, 1, 5, 0, M("1.00"), M("0.1500"))],
        "order_id long, line_number int, quantity int, picked_quantity int, unit_price decimal(18,2), tax_rate decimal(9,4)",
    )
    invoice_lines = spark.createDataFrame(
        [(100, 1, 5, M("1.00"), M("0.1500"), M("0.75"), M("5.75")), (101, 1, 5, M("1.00"), M("0.1500"), M("0.75"), M("5.75"))],
        "order_id long, line_number int, quantity int, unit_price decimal(18,2), tax_rate decimal(9,4), tax_amount decimal(18,2), extended_price decimal(18,2)",
    )
    invoices = spark.createDataFrame([(100, D(2014, 12, 1)), (101, D(2015, 2, 1))], "order_id long, invoice_date date")
    orders = spark.createDataFrame([(100, D(2014, 11, 30)), (101, D(2015, 1, 30))], "order_id long, order_date date")
    return dict(
        order_lines=order_lines,
        invoice_lines=invoice_lines,
        invoices=invoices,
        orders=orders,
        dims=dims,
        fact_order=fact_order,
        fact_sale=fact_sale,
        order_line_cols=("order_id", "line_number"),
        sale_line_cols=("order_id", "line_number"),
        dim_customer_initial=dim_customer_initial,
        changed_snapshot=snapshot,
    )


def report(args):
    return {r["rule"]: r["violations"] for r in g.quality_gates(**args).collect()}


def test_clean_input_passes(spark):
    rep = report(clean(spark))
    assert len(rep) == 11 and all(v == 0 for v in rep.values()), rep


def _with(spark, **changes):
    args = clean(spark)
    for k, fn in changes.items():
        if k.startswith("dim_") and k in args["dims"]:
            args["dims"] = dict(args["dims"], **{k: fn(args["dims"][k])})
        else:
            args[k] = fn(args[k])
    return args


@pytest.mark.parametrize(
    "gate, mutation",
    [
        (g.GATE_ORDER_ROWS, {"fact_order": lambda f: f.limit(1)}),
        (g.GATE_SALE_ROWS, {"invoice_lines": lambda f: f.unionByName(f.limit(1))}),
        (g.GATE_UNIQUE_IDS, {"fact_sale": lambda f: f.unionByName(f.limit(1))}),
        (g.GATE_KEYS_RESOLVE, {"fact_order": lambda f: f.withColumn("product_key", F.lit(9).cast("long"))}),
        (g.GATE_VALID_VALUES, {"order_lines": lambda f: f.withColumn("picked_quantity", F.lit(9))}),
        (g.GATE_INVOICE_DATES, {"invoices": lambda f: f.withColumn("invoice_date", F.lit(D(2000, 1, 1)))}),
        (g.GATE_ONE_CURRENT, {"dim_customer": lambda d: d.withColumn("is_current", F.lit(True))}),
        (g.GATE_VALID_RANGES, {"dim_customer": lambda d: d.withColumn(
            "effective_end_date", F.when(F.col("customer_key") == 2, F.lit(D(1800, 1, 1))).otherwise(F.col("effective_end_date")))}),
        (g.GATE_NO_OVERLAP, {"dim_customer": lambda d: d.withColumn("effective_end_date", F.lit(OPEN))}),
        (g.GATE_TWO_VERSIONS, {"dim_customer": lambda d: d.where(F.col("customer_key") != 3)}),
        (g.GATE_BOTH_VERSIONS_SOLD, {"fact_sale": lambda f: f.where(F.col("customer_key") != 3)}),
    ],
)
def test_gate_fires(spark, gate, mutation):
    rep = report(_with(spark, **mutation))
    assert rep[gate] > 0, rep


def test_asof_boundaries_are_inclusive(spark):
    dim = clean(spark)["dims"]["dim_customer"]
    facts = spark.createDataFrame(
        [(10, D(2014, 12, 31)), (10, D(2015, 1, 1)), (10, D(1900, 1, 1)), (20, OPEN)],
        "customer_id long, d date",
    )
    got = sorted(
        (r["d"], r["customer_key"])
        for r in asof_join(facts, dim, "customer_id", "d", "customer_id", "customer_key").collect()
    )
    assert got == [(D(1900, 1, 1), 1), (D(2014, 12, 31), 1), (D(2015, 1, 1), 3), (OPEN, 2)]


def test_top_k_ties_break_by_natural_key(spark):
    products = spark.createDataFrame(
        [(k, "cat", f"p{k:02d}") for k in range(1, 13)],
        "product_key long, product_category string, product_name string",
    )
    sales = spark.createDataFrame(
        [(k, M("10.00"), M("1.00"), 1) for k in range(1, 13)],
        "product_key long, sales decimal(18,2), profit decimal(18,2), invoiced_quantity int",
    )
    rows = q.q02_top_products(sales, products).where(F.col("ranking") == "Top by sales").collect()
    assert [r["product_name"] for r in rows] == [f"p{k:02d}" for k in range(1, 11)]


def test_cross_question_invariants(spark):
    qs = all_queries()
    q1 = qs["q01_monthly_sales"](spark, SF_MID).agg(F.sum("sales"), F.sum("quantity_sold")).first()
    q4 = qs["q04_geography_top10"](spark, SF_MID).where(F.col("level") == "Territory").agg(F.sum("sales")).first()
    q5 = qs["q05_salesperson"](spark, SF_MID).agg(F.sum("invoiced_sales")).first()
    q6 = qs["q06_fill_rate"](spark, SF_MID).first()
    assert q1[0] == q4[0] == q5[0]
    assert q1[1] == q6["quantity_invoiced"]
    q9 = qs["q09_version_history"](spark, SF_MID)
    assert q9.count() == qs["dim_customer_scd2"](spark, SF_MID).count() - qs["dim_customer_initial"](spark, SF_MID).count()


def test_hot_key_split_equals_plain_join(spark):
    from martwright.operators.joins import hot_keys, salted_join

    # key 7 holds a third of the rows
    fact = spark.range(3000).select(
        F.col("id").alias("line"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
    )
    dim = spark.range(50).select(F.col("id").alias("dk"), (F.col("id") * 10).alias("surrogate"))
    hot = hot_keys(fact, ["k"], split_rows=100)["k"]
    assert {r["_hk_id"]: r["_hk_n"] for r in hot.collect()} == {7: 11}  # 1040 rows / 100
    split = salted_join(fact, dim, "k", "dk", hot, ["line"])
    plain = fact.join(dim, F.col("k") == F.col("dk"))
    assert sorted(map(tuple, split.select("line", "surrogate").collect())) == sorted(
        map(tuple, plain.select("line", "surrogate").collect())
    )


def test_facts_with_forced_splitting_match(spark):
    from martwright.operators.facts import fact_order, fact_sale
    from martwright.plans.registry import all_queries
    from martwright.plans.warehouse import warehouse_for
    from conftest import SF_SMALL

    wh = warehouse_for(spark, SF_SMALL)
    src = wh.sources
    split_o = fact_order(
        src.order_lines_wide, src.order_backorders, wh.dim_customer, wh.dim_employee, wh.dim_product,
        line_id_cols=src.order_line_id_cols, split_rows=20,
    )
    split_s = fact_sale(
        src.invoice_lines_wide, wh.dim_customer, wh.dim_employee, wh.dim_product,
        line_id_cols=src.invoice_line_id_cols, invoice_id_cols=src.invoice_id_cols, split_rows=5,
    )
    for got, name in ((split_o, "fact_order"), (split_s, "fact_sale")):
        want = all_queries()[name](spark, SF_SMALL)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_substitute_key_paths(spark):
    from martwright.operators.joins import arithmetic_key, substitute_key

    fact = spark.createDataFrame(
        [(1, 10), (2, 11), (3, 12), (4, None), (5, 10)], "line long, k long"
    )
    dense = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "nat long, sk long")
    gappy = spark.createDataFrame([(10, 1), (12, 2), (13, 3), (11, 9)], "nat long, sk long")
    short = spark.createDataFrame([(10, 1), (11, 2)], "nat long, sk long")
    assert arithmetic_key(dense, "nat", "sk") == (10, 1)
    assert arithmetic_key(gappy, "nat", "sk") is None

    def rows(df):
        return sorted((r["line"], r["sk"]) for r in df.select("line", "sk").collect())

    def plain(dim):
        return fact.join(dim, F.col("k") == F.col("nat"))

    got = substitute_key(fact, dense, "k", "nat", "sk")
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()  # arithmetic path
    assert rows(got) == rows(plain(dense)) == [(1, 1), (2, 2), (3, 3), (5, 1)]
    assert rows(substitute_key(fact, gappy, "k", "nat", "sk")) == rows(plain(gappy))
    # key 12 has no dimension row: the join path drops it, like an inner join
    assert rows(substitute_key(fact, short, "k", "nat", "sk")) == rows(plain(short)) == [(1, 1), (2, 2), (5, 1)]


def test_versioned_key_matches_version_join(spark):
    from martwright.operators.asof import asof_join, versioned_key

    dim = clean(spark)["dims"]["dim_customer"]  # id 10 has two versions, id 20 one open version
    facts = spark.createDataFrame(
        [
            (1, 10, D(2014, 12, 31)), (2, 10, D(2015, 1, 1)), (3, 20, D(2000, 1, 1)),
            (4, 20, None), (5, None, D(2000, 1, 1)), (6, 20, D(1850, 1, 1)),
        ],
        "line long, customer_id long, d date",
    )
    want = asof_join(facts, dim, "customer_id", "d", "customer_id", "customer_key")
    args = (facts, dim, "customer_id", "d", "customer_id", "customer_key", D(1900, 1, 1), OPEN)

    def rows(df):
        return sorted((r["line"], r["customer_key"]) for r in df.collect())

    assert rows(versioned_key(*args)) == rows(want) == [(1, 1), (2, 3), (3, 2)]
    assert rows(versioned_key(*args, max_broadcast_rows=0)) == rows(want)  # general path
    missing = facts.unionByName(spark.createDataFrame([(7, 30, D(2000, 1, 1))], facts.schema))
    got = versioned_key(missing, *args[1:])  # id 30 unknown: proof fails, join drops it
    assert rows(got) == rows(asof_join(missing, dim, "customer_id", "d", "customer_id", "customer_key"))


def test_planted_faults_are_reported(spark):
    from conftest import SF_SMALL
    from martwright.plans import reports as r
    from martwright.plans.warehouse import warehouse_for

    wh = warehouse_for(spark, SF_SMALL)
    gates = {x["rule"]: x["violations"] for x in r.dq_report_broken(wh).collect()}
    assert all(gates[k] > 0 for k in (g.GATE_ORDER_ROWS, g.GATE_KEYS_RESOLVE, g.GATE_VALID_VALUES, g.GATE_INVOICE_DATES))
    rules = {x["rule"]: x["violations"] for x in r.constraint_report_broken(wh).collect()}
    assert rules["foreign_key:order_lines(order_id)->orders(order_id)"] > 0
    assert rules["not_null:fact_order(product_key)"] > 0 and rules["non_negative:order_lines(quantity)"] > 0


def test_orphan_lines_reach_the_checks(spark, tmp_out):
    import os

    from conftest import SF_SMALL
    from martwright.plans import reports as r
    from martwright.plans.warehouse import INPUT_TABLES, warehouse_for

    for t in INPUT_TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "lineitem":
            df = df.unionByName(df.limit(50).withColumn("l_orderkey", F.lit(-5).cast("long")))
        df.write.parquet(os.path.join(tmp_out, f"{t}.parquet"))
    wh = warehouse_for(spark, tmp_out)
    lines = spark.read.parquet(os.path.join(tmp_out, "lineitem.parquet")).count()
    assert wh.sources.order_lines.count() == lines and wh.fact_order.count() == lines - 50
    gates = {x["rule"]: x["violations"] for x in r.dq_report(wh).collect()}
    assert gates[g.GATE_ORDER_ROWS] == 50
