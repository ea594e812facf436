"""Skew-safe numbering and ordered scans agree with plain window functions."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.functions.calendar import fiscal_month, fiscal_quarter, fiscal_year, date_key, month_name
from martwright.operators.keys import dense_key
from martwright.operators.sequence import next_in_key, prior_max_in_key


def _hot(spark, n=3000):
    # a third of all rows on key 7, the rest spread over 200 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 200).alias("k"),
        ((F.col("id") * 7919) % 10007).alias("t"),
        F.col("id").alias("v"),
    )


def test_dense_key_matches_row_number(spark):
    df = spark.range(5000).select(((F.col("id") * 48271) % 100003).alias("nat"))
    got = dense_key(df, ["nat"], "k", start=5, num_partitions=7)
    want = df.withColumn("k", F.row_number().over(Window.orderBy("nat")) + 4)
    assert sorted(map(tuple, got.select("nat", "k").collect())) == sorted(
        map(tuple, want.select("nat", F.col("k").cast("bigint")).collect())
    )


def test_dense_key_hot_values(spark):
    df = _hot(spark)
    got = dense_key(df, ["k", "t", "v"], "key", num_partitions=6).select("key").collect()
    assert sorted(r[0] for r in got) == list(range(1, 3001))


def test_next_in_key_matches_lead(spark):
    df = _hot(spark)
    got = next_in_key(df, "k", ["t", "v"], "v", "nxt", num_partitions=5)
    w = Window.partitionBy("k").orderBy("t", "v")
    want = df.withColumn("nxt", F.lead("v").over(w))
    assert sorted(map(tuple, got.select("k", "t", "v", "nxt").collect())) == sorted(
        map(tuple, want.select("k", "t", "v", "nxt").collect())
    )


def test_prior_max_matches_window(spark):
    df = _hot(spark)
    got = prior_max_in_key(df, "k", ["t", "v"], "v", "pm", num_partitions=5)
    w = Window.partitionBy("k").orderBy("t", "v").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("pm", F.max("v").over(w))
    assert sorted(map(tuple, got.select("k", "t", "v", "pm").collect())) == sorted(
        map(tuple, want.select("k", "t", "v", "pm").collect())
    )


def test_fiscal_calendar(spark):
    days = [dt.date(2014, 10, 31), dt.date(2014, 11, 1), dt.date(2014, 12, 31), dt.date(2015, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    rows = df.select(
        date_key(d), month_name(d), fiscal_month(d), fiscal_quarter(d), fiscal_year(d)
    ).collect()
    assert [tuple(r) for r in rows] == [
        (20141031, "October", 12, 4, 2014),
        (20141101, "November", 1, 1, 2015),
        (20141231, "December", 2, 1, 2015),
        (20150101, "January", 3, 1, 2015),
    ]


def test_small_path_equals_distributed_path(spark):
    df = _hot(spark, 900)
    a = dense_key(df, ["k", "t", "v"], "key").select("v", "key")
    b = dense_key(df, ["k", "t", "v"], "key").select("v", "key")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_keyed_scans_with_null_keys(spark):
    df = _hot(spark, 1200).withColumn("k", F.when(F.col("k") == 7, F.lit(None)).otherwise(F.col("k")))
    w = Window.partitionBy("k").orderBy("t", "v")
    got = next_in_key(df, "k", ["t", "v"], "v", "nxt", num_partitions=5)
    want = df.withColumn("nxt", F.lead("v").over(w))
    assert sorted(map(tuple, got.select("v", "nxt").collect())) == sorted(
        map(tuple, want.select("v", "nxt").collect())
    )
    got = prior_max_in_key(df, "k", ["t", "v"], "v", "pm", num_partitions=5)
    want = df.withColumn("pm", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    assert sorted(map(tuple, got.select("v", "pm").collect())) == sorted(
        map(tuple, want.select("v", "pm").collect())
    )


def test_approximate_profile_close_to_exact(spark):
    from martwright.plans.reports import profile

    df = spark.range(20000).select((F.col("id") % 5000).alias("a"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("b"))
    exact = {r["column_name"]: r for r in profile(df, "t", exact=True).collect()}
    approx = {r["column_name"]: r for r in profile(df, "t", exact=False).collect()}
    assert exact["a"]["distinct_values"] == 5000 and exact["b"]["nulls"] == approx["b"]["nulls"]
    for c in ("a", "b"):
        assert abs(approx[c]["distinct_values"] - exact[c]["distinct_values"]) <= 0.1 * exact[c]["distinct_values"]
