"""Incremental load: exact after replays, late rows counted per batch."""

import datetime as dt
import os
from dataclasses import replace

from martwright.streaming.incremental import IncrementalLoad, run_incremental


def test_incremental_load_replay_and_late_rows(spark, tmp_out):
    land = os.path.join(tmp_out, "landing")
    schema = "id long, ts timestamp_ntz, v double"
    day = lambda d: dt.datetime(2020, 1, d)
    first = [(1, day(10), 1.0), (2, day(20), 2.0), (2, day(20), 2.0)]
    second = [(3, day(5), 3.0), (4, day(19), 4.0), (5, day(21), 5.0), (1, day(10), 1.0)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(os.path.join(land, "part-a"))
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(os.path.join(land, "part-b"))
    out = os.path.join(tmp_out, "out")
    cfg = IncrementalLoad(
        source_glob=os.path.join(land, "part-*", "*.parquet"),
        source_base=land,
        schema=spark.createDataFrame([], schema).schema,
        target=os.path.join(out, "rows"),
        monitor=os.path.join(out, "late"),
        checkpoint=os.path.join(out, "ckpt"),
        key_cols=("id", "ts", "v"),
        partition_col="day",
        partition_expr="CAST(date_format(ts, 'yyyyMMdd') AS INT)",
        event_col="ts",
    )
    rows = run_incremental(spark, cfg)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3, 4, 5]
    late = {r["batch_id"]: r["late_rows"] for r in spark.read.parquet(cfg.monitor).collect()}
    # batch 0 sees up to day 20; batch 1 has day 5 and day 10 older than day 19
    assert late == {0: 0, 1: 2}
    again = run_incremental(spark, replace(cfg, checkpoint=os.path.join(out, "ckpt2")))
    assert again.count() == 5


def test_fact_increment_two_batches_and_replay(spark, tmp_out):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from martwright.operators.facts import fact_order
    from martwright.plans.warehouse import warehouse_for
    from martwright.sources.staging import line_frame, order_lines_wide_of
    from martwright.streaming.incremental import FactIncrement, run_fact_increment

    wh = warehouse_for(spark, SF_SMALL)
    src = wh.sources
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    land = os.path.join(tmp_out, "landing")
    # two arrivals; the second repeats some lines of the first
    lineitem.where(F.col("l_orderkey") % 2 == 0).coalesce(1).write.parquet(os.path.join(land, "part-a"))
    lineitem.where((F.col("l_orderkey") % 2 == 1) | (F.col("l_orderkey") % 10 == 0)).coalesce(1).write.parquet(
        os.path.join(land, "part-b")
    )
    header = src.orders.select("order_id", "customer_id", "order_date").join(src.order_backorders, "order_id", "left")

    def to_facts(raw):
        lines = order_lines_wide_of(line_frame(raw, header, src.stock_items))
        return fact_order(lines, src.order_backorders, wh.dim_customer, wh.dim_employee, wh.dim_product,
                          line_id_cols=src.order_line_id_cols)

    out = os.path.join(tmp_out, "out")
    cfg = FactIncrement(
        source_glob=os.path.join(land, "part-*", "*.parquet"), source_base=land, schema=lineitem.schema,
        deltas=os.path.join(out, "deltas"), facts=os.path.join(out, "facts"), checkpoint=os.path.join(out, "c1"),
        partition_col="ship_month", partition_expr="CAST(date_format(l_shipdate, 'yyyyMM') AS INT)",
        fact_partition_col="year_month", fact_partition_expr="CAST(date_key / 100 AS INT)", to_facts=to_facts,
        max_files_per_trigger=1, monitor=os.path.join(out, "late"), event_col="l_shipdate",
    )
    want = sorted(map(tuple, wh.fact_order.collect()))
    first = run_fact_increment(spark, cfg)
    assert first.select("_batch").distinct().count() == 2  # one batch per arrival
    monitor = spark.read.parquet(cfg.monitor).collect()
    assert sorted(r["batch_id"] for r in monitor) == [0, 1] and all(r["late_rows"] >= 0 for r in monitor)
    assert sorted(map(tuple, first.select(*wh.fact_order.columns).collect())) == want
    again = run_fact_increment(spark, replace(cfg, checkpoint=os.path.join(out, "c2")))
    assert sorted(map(tuple, again.select(*wh.fact_order.columns).collect())) == want


class _Landing:
    """Raw lines (id, month, qty) land file by file; the header of a line may
    come later. Facts are lines joined with their header."""

    RAW = "l_id long, l_header long, ym int, qty int"

    def __init__(self, spark, base):
        from martwright.streaming.incremental import FactIncrement

        self.spark, self.base, self.files = spark, base, 0
        self.headers = os.path.join(base, "headers")
        schema = spark.createDataFrame([], self.RAW).schema
        self.cfg = FactIncrement(
            source_glob=os.path.join(base, "landing", "part-*", "*.parquet"), source_base=os.path.join(base, "landing"),
            schema=schema, deltas=os.path.join(base, "deltas"), facts=os.path.join(base, "facts"),
            checkpoint=os.path.join(base, "checkpoint"), partition_col="month", partition_expr="ym",
            fact_partition_col="year_month", fact_partition_expr="ym",
            to_facts=lambda raw: raw.join(spark.read.parquet(self.headers), raw["l_header"] == self.header_id()).select(
                raw["l_id"].alias("line"), "ym", "qty", "customer"),
            line_key=("l_id",), fact_line_key=("line",),
            not_ready=lambda raw: raw.join(spark.read.parquet(self.headers), raw["l_header"] == self.header_id(), "left_anti"),
        )

    @staticmethod
    def header_id():
        from pyspark.sql import functions as F

        return F.col("h_id")

    def land(self, *rows):
        self.spark.createDataFrame(list(rows), self.RAW).coalesce(1).write.parquet(
            os.path.join(self.base, "landing", f"part-{self.files:03d}"))
        self.files += 1

    def have(self, *ids):
        self.spark.createDataFrame([(i, f"c{i}") for i in ids], "h_id long, customer string").write.mode("overwrite").parquet(self.headers)

    def run(self, **changes):
        from martwright.streaming.incremental import run_fact_increment

        return sorted(tuple(r) for r in run_fact_increment(self.spark, replace(self.cfg, **changes)).select("line", "qty").collect())


def test_lost_checkpoint_with_only_new_files_keeps_every_row(spark, tmp_out):
    import shutil

    land = _Landing(spark, tmp_out)
    land.have(1, 2)
    land.land((1, 1, 202001, 5), (2, 1, 202001, 6))
    assert land.run() == [(1, 5), (2, 6)]
    shutil.move(os.path.join(land.base, "landing", "part-000"), os.path.join(land.base, "gone"))
    land.land((3, 2, 202001, 7), (4, 2, 202002, 8))
    for checkpoint in ("checkpoint-2", "checkpoint-3"):  # lost once, and once more with nothing new
        assert land.run(checkpoint=os.path.join(land.base, checkpoint)) == [(1, 5), (2, 6), (3, 7), (4, 8)]


def test_line_waits_for_its_header_and_a_correction_replaces_it(spark, tmp_out):
    from martwright.streaming.incremental import pending_lines

    land = _Landing(spark, tmp_out)
    land.have(1)
    land.land((1, 1, 202001, 5), (2, 9, 202001, 6))
    assert land.run() == [(1, 5)]
    assert [r["l_id"] for r in pending_lines(spark, land.cfg).collect()] == [2]
    land.have(1, 9)
    land.land((1, 1, 202002, 50))  # the same line, corrected, in another month
    assert land.run() == [(1, 50), (2, 6)]
    assert pending_lines(spark, land.cfg).isEmpty()
    assert land.run(checkpoint=os.path.join(land.base, "replay")) == [(1, 50), (2, 6)]


def test_monitor_is_the_same_after_a_replay(spark, tmp_out):
    land = os.path.join(tmp_out, "landing")
    schema = "id long, ts timestamp_ntz"
    for k, days in enumerate(([10, 20], [5, 21], [19, 30])):
        spark.createDataFrame([(100 * k + d, dt.datetime(2020, 1, d)) for d in days], schema).coalesce(1).write.parquet(
            os.path.join(land, f"part-{k}"))
    cfg = IncrementalLoad(
        source_glob=os.path.join(land, "part-*", "*.parquet"), source_base=land,
        schema=spark.createDataFrame([], schema).schema, target=os.path.join(tmp_out, "rows"),
        monitor=os.path.join(tmp_out, "late"), checkpoint=os.path.join(tmp_out, "c1"), key_cols=("id",), event_col="ts")
    run_incremental(spark, cfg)
    want = sorted((r["batch_id"], r["rows_in_batch"], r["late_rows"]) for r in spark.read.parquet(cfg.monitor).collect())
    assert want == [(0, 2, 0), (1, 2, 1), (2, 2, 1)]
    run_incremental(spark, replace(cfg, checkpoint=os.path.join(tmp_out, "c2")))
    assert sorted((r["batch_id"], r["rows_in_batch"], r["late_rows"]) for r in spark.read.parquet(cfg.monitor).collect()) == want


def test_compaction_bounds_the_files_and_survives_any_crash(spark, tmp_out, monkeypatch):
    """Many batches with corrected and repeated lines, compacted now and then and
    killed between each two steps: always the facts of an uncompacted load."""
    from martwright.streaming import incremental as inc

    schema = "id long, v int, day int"
    batches = [[(i, 0, 20200100 + i % 3) for i in range(30)]]
    for b in range(1, 9):
        batches.append([(i, b, 20200100 + i % 3) for i in range(b, 30, 7)] + [(100 + b, b, 20200101)] + batches[-1][:2])

    def config(name, compact_after=None):
        base = os.path.join(tmp_out, name)
        return inc.FactIncrement(
            source_glob=f"{base}/landing/b-*/*.parquet", source_base=f"{base}/landing", schema=spark.createDataFrame([], schema).schema,
            deltas=f"{base}/deltas", facts=f"{base}/facts", checkpoint=f"{base}/checkpoint", partition_col="month", partition_expr="day % 100",
            fact_partition_col="fact_month", fact_partition_expr="day % 100", to_facts=lambda raw: raw.select("id", "v", "day"),
            line_key=("id",), fact_line_key=("id",), max_files_per_trigger=None, compact_after=compact_after)

    def load(cfg, k):
        spark.createDataFrame(batches[k], schema).coalesce(1).write.parquet(f"{os.path.dirname(cfg.deltas)}/landing/b-{k}")
        return facts(inc.run_fact_increment(spark, cfg))

    facts = lambda df: sorted(tuple(r) for r in df.select("id", "v", "day").collect())
    plain, packed = config("plain"), config("packed")
    steps = ["write", "replace_text", "delete_path", None, "replace_text", None, "delete_path", None]
    for k in range(len(batches)):
        want = load(plain, k)
        newest = {}
        for i, v, d in (row for b in batches[:k + 1] for row in b):
            newest[i] = max(newest.get(i, (i, v, d)), (i, v, d))
        assert load(packed, k) == want == sorted(newest.values())
        step = steps[k % len(steps)]
        if step == "write":
            monkeypatch.setattr(inc, "_latest", _killed)
        elif step:
            monkeypatch.setattr(inc, step, _killed)
        try:
            inc.compact(spark, packed)
        except KeyboardInterrupt:
            pass
        monkeypatch.undo()
        assert facts(inc.read_facts(spark, packed)) == want  # whatever the crash left
    inc.compact(spark, packed)
    inc.compact(spark, packed)  # nothing left to do
    opened = lambda cfg: sum("/facts" in f for f in inc.read_facts(spark, cfg).inputFiles())
    assert opened(packed) <= 6 < 20 < opened(plain)
    # all again, as after a lost checkpoint: nothing is added
    again = inc.run_fact_increment(spark, replace(packed, checkpoint=os.path.join(tmp_out, "other"), compact_after=0))
    assert facts(again) == want


def _killed(*args, **kwargs):
    raise KeyboardInterrupt


def _loaded_twice(spark, tmp_out, monkeypatch, **more):
    """The frames stored by a load and its replay, by name, and the target."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from martwright.streaming import incremental

    schema = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    cfg = incremental.IncrementalLoad(
        source_glob="", source_base="", schema=schema, target=f"{tmp_out}/t", monitor=f"{tmp_out}/m", checkpoint=f"{tmp_out}/c", **more)
    plans, real = [], incremental.stash

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(incremental, "stash", seen)
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c")], schema)
    incremental.load_batch(spark, cfg, batch, 0, 0)
    incremental.load_batch(spark, cfg, batch.unionByName(spark.createDataFrame([(3, "d"), (3, "d")], schema)), 1, 0)
    return plans, sorted((tuple(r) for r in spark.read.parquet(cfg.target).select("k", "v").collect()), key=repr)


def test_known_rows_go_before_duplicates(spark, tmp_out, monkeypatch):
    plans, rows = _loaded_twice(spark, tmp_out, monkeypatch, key_cols=("k", "v"))
    assert rows == [(1, "a"), (2, None), (3, "d"), (None, "c")]
    joined = plans[1][plans[1].index("Join LeftAnti"):]
    assert "Aggregate" in plans[1][:plans[1].index("Join LeftAnti")] and "Aggregate" not in joined


def test_a_key_of_several_partitions_is_loaded_once(spark, tmp_out, monkeypatch):
    plans, rows = _loaded_twice(spark, tmp_out, monkeypatch, key_cols=("k",), partition_col="p", partition_expr="length(coalesce(v, ''))")
    assert rows == [(1, "a"), (2, None), (3, "d"), (None, "c")]


def test_lines_of_an_increment_are_stored_once(spark, monkeypatch):
    from conftest import SF_SMALL
    from martwright.plans.registry import all_queries
    from martwright.streaming import incremental

    names, real = [], incremental.stash
    monkeypatch.setattr(incremental, "stash", lambda df, name: names.append(name) or real(df, name))
    all_queries()["incremental_fact_order"](spark, SF_SMALL)
    assert "batch" in names and "to-facts" not in names


def test_known_rows_are_told_by_digests(spark):
    from martwright.streaming import incremental as inc

    schema = "a long, b long, c string, d double, p int"
    some = [(None, 5, "x", 0.0, 1), (5, None, "x", float("nan"), 1), (1, 2, None, -0.0, 2), (1, 2, "", 1.5, 2), (1, 2, "", 1.5, 2)]
    frame = lambda rows: spark.createDataFrame(rows, schema)
    keys, told = ["a", "b", "c", "d"], lambda df: sorted(map(str, df.collect()))
    for old in ([], some[:1], some[1:], [(5, None, "x", 0.0, 1)], [(1, 2, None, 0.0, 2), (1, 2, "", 1.5, 3)], some):
        plain = inc._without_known(frame(some), frame(old), keys, "p")
        assert told(inc._without_known(frame(some), frame(old), keys, "p", whole=True)) == told(plain)
    replayed = inc._without_known(frame(some), frame(some), keys, "p", whole=True)
    assert "Join" not in replayed._jdf.queryExecution().optimizedPlan().toString()  # no row moves
    allnew = inc._without_known(frame(some), frame([(9, 9, "z", 0.0, 1)]), keys, "p", whole=True)
    assert "Join" not in allnew._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_header_are_found_by_keys(spark):
    from martwright.streaming.incremental import rows_without

    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k long, v string")
    others = spark.createDataFrame([(1,), (1,), (None,), (3,)], "h long")
    assert sorted(r["v"] for r in rows_without(rows, "k", others, "h").collect()) == ["c", "d"]


def test_a_batch_is_dealt_out_and_stored_once(spark, tmp_out, monkeypatch):
    from martwright.streaming import incremental as inc

    land = _Landing(spark, tmp_out)
    names, ranges, real, spread = [], [], inc.stash, inc._overwrite_partitions
    monkeypatch.setattr(inc, "stash", lambda df, name: names.append(name) or real(df, name))
    monkeypatch.setattr(inc, "_overwrite_partitions", lambda df, path, *a: ranges.append(path) or spread(df, path, *a))
    land.have(1)
    land.land((1, 9, 202001, 5), (1, 9, 202001, 5))  # gives no fact yet
    import pytest

    with pytest.raises(ValueError, match="nothing loaded"):
        land.run()
    land.have(1, 9)
    land.land((2, 1, 202002, 6))
    assert land.run() == [(1, 5), (2, 6)]
    assert "facts" not in names and land.cfg.deltas not in ranges
