"""Overlap pairs, the as-of scan, snapshot series, split CSV reading, watermarked
loads and the shipped package, each against a plain version."""

import datetime as dt
import glob
import os
import random
import subprocess
import sys
import textwrap
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators.asof import asof_join, asof_scan, versioned_key
from martwright.operators.joins import join_checked, measured
from martwright.operators.overlaps import overlap_pairs
from martwright.operators.scd2 import history_from_snapshots
from martwright.operators.sequence import prior_sum_in_key, prior_value_in_key
from martwright.sources.extracts import CSV_OPTIONS, read_extract
from martwright.sources.records import quote_pieces, read_records
from martwright.streaming import watermark
from martwright.streaming.watermark import WatermarkedLoad, accepted_rows, late_rows, run_watermarked

DAY = dt.date(2020, 1, 1)
OPEN_START, OPEN_END = dt.date(1900, 1, 1), dt.date(9999, 12, 31)


def day(n):
    return DAY + dt.timedelta(days=n)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _hot(spark, n=3000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 200).alias("k"),
        ((F.col("id") * 7919) % 10007).alias("t"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"))


def test_prior_sum_and_value_match_windows(spark):
    df = _hot(spark)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0))).withColumn("l", F.last("v", ignorenulls=True).over(w))
    got = prior_value_in_key(prior_sum_in_key(df, "k", ["t"], "v", "s", num_partitions=5), "k", ["t"], "v", "l", num_partitions=7)
    assert rows(got) == rows(want)


# overlapping pairs


def plain_pairs(ranges):
    out = {}
    for i, (a, ka, sa, ea) in enumerate(ranges):
        for b, kb, sb, eb in ranges[i + 1:]:
            if None in (a, b, ka, kb, sa, sb, ea, eb) or a != b or ka == kb:
                continue
            if sa <= eb and sb <= ea:
                out[a] = out.get(a, 0) + 1
    return sorted(out.items(), key=str)


def test_overlap_pairs_equal_the_self_join(spark):
    rng = random.Random(4)
    ranges = []
    for k in range(900):
        start = day(rng.randrange(300))
        ranges.append((7 if k % 3 == 0 else rng.randrange(40), k, start, start + dt.timedelta(days=rng.randrange(25))))
    ranges += [(7, 1000 + k, day(50 + k), day(40 + k)) for k in range(9)]  # end before they begin
    ranges += [(7, 3, day(10), day(20)), (7, 3, day(12), day(20)), (8, 3, day(12), day(20))]  # keys given twice
    ranges += [(None, 1, day(1), day(9)), (9, None, day(1), day(9)), (9, 2, None, day(9)), (9, 4, day(1), None), (11, 5, day(1), day(1)), (11, 6, day(1), day(1))]
    df = spark.createDataFrame(ranges, "customer_id long, customer_key long, effective_start_date date, effective_end_date date")
    assert rows(overlap_pairs(df, "customer_id", "customer_key", num_partitions=6)) == plain_pairs(ranges)
    assert rows(overlap_pairs(df.limit(0), "customer_id", "customer_key")) == []


# as-of scan


def versions_and_facts(spark, n=4000):
    rng = random.Random(2)
    versions, key = [], 0
    for c in range(60):
        cuts = sorted({rng.randrange(1, 400) for _ in range(0 if c % 3 else 40 if c == 6 else 5)})
        starts = [OPEN_START] + [day(x) for x in cuts]
        for i, s in enumerate(starts):
            key += 1
            if c == 9 and i == 2:
                continue  # a gap: facts in it have no version
            versions.append((key, c, s, starts[i + 1] - dt.timedelta(days=1) if i + 1 < len(starts) else OPEN_END))
    # customer 6 has a third of the facts
    facts = [(i, 6 if i % 3 == 0 else rng.randrange(70), day(rng.randrange(-20, 420))) for i in range(n)]
    facts += [(n, None, day(3)), (n + 1, 6, None), (n + 1, 6, day(5)), (n + 1, 6, day(5))]
    return (spark.createDataFrame(versions, "customer_key long, customer_id long, effective_start_date date, effective_end_date date"),
            spark.createDataFrame(facts, "id long, customer_id long, on_date date"))


def test_asof_scan_equals_the_join(spark):
    dim, fact = versions_and_facts(spark)
    args = (fact, dim, "customer_id", "on_date", "customer_id", "customer_key")
    want = rows(asof_join(*args).select("id", "customer_id", "on_date", "customer_key"))
    scan = asof_scan(*args, num_partitions=9)
    assert scan.columns == ["id", "customer_id", "on_date", "customer_key"] and rows(scan) == want
    assert len({r[3] for r in want if r[1] == 6}) > 20
    # history above the broadcast bound: the versioned key goes by the scan
    above = versioned_key(*args, open_start=OPEN_START, open_end=OPEN_END, max_broadcast_rows=1)
    plan = above._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan and rows(above.select(*scan.columns)) == want
    assert rows(asof_scan(fact.limit(0), dim, *args[2:])) == [] == rows(asof_scan(fact, dim.limit(0), *args[2:]))


def test_overlapping_versions_keep_the_join(spark):
    dim, fact = versions_and_facts(spark, 300)
    twice = dim.unionByName(dim.where("customer_id = 6").withColumn("customer_key", F.col("customer_key") + 9000))
    args = (fact, twice, "customer_id", "on_date", "customer_id", "customer_key")
    got = versioned_key(*args, open_start=OPEN_START, open_end=OPEN_END, max_broadcast_rows=1)
    cols = ["id", "customer_key"]
    assert rows(got.select(*cols)) == rows(asof_join(*args).select(*cols))


def test_join_checked_counts_bytes(spark):
    small = spark.createDataFrame([("x" * 1000, 1)] * 10, "t string, n int")
    assert measured(small)[0] == 10 and measured(small)[1] >= 10_000
    big = spark.range(5).withColumn("n", F.lit(1))
    for bound, broadcast in ((1 << 20, True), (100, False)):
        hinted = join_checked(big, small, "n", max_bytes=bound)._jdf.queryExecution().analyzed().toString()
        assert ("broadcast" in hinted.lower()) == broadcast


# snapshot series

SNAPSHOT = "customer_id long, category string, name string, snapshot_date date"


def plain_history(snapshots):
    versions, names = [], {}
    by_id = {}
    for c, category, name, on in snapshots:
        if c is not None and on is not None:
            by_id.setdefault(c, {}).setdefault(on, []).append((category, name))
    for c, dated in by_id.items():
        begun = []
        for on in sorted(dated):
            category, names[c] = max(dated[on], key=lambda r: tuple((x is not None, x) for x in r))
            if not begun or begun[-1][1] != category:
                begun.append((on, category))
        for i, (on, category) in enumerate(begun):
            last = i + 1 == len(begun)
            versions.append((on, c, category, OPEN_START if i == 0 else on, OPEN_END if last else begun[i + 1][0] - dt.timedelta(days=1), last))
    versions.sort(key=lambda v: v[:2])
    return sorted(((k + 1, c, category, names[c], s, e, cur) for k, (_, c, category, s, e, cur) in enumerate(versions)), key=str)


def test_history_from_snapshots(spark):
    rng = random.Random(8)
    snapshots = [
        (c, rng.choice(["A", "B", None]), f"n{c}-{rng.randrange(3)}", day(30 * s))
        for s in range(6) for c in range(80) if s == 0 or rng.random() < 0.6]
    snapshots += [(500, "A", "late", day(95)), (None, "A", "x", day(1)), (3, "A", "x", None)]
    rng.shuffle(snapshots)
    history = lambda given: history_from_snapshots(
        spark.createDataFrame(given, SNAPSHOT), tracked=("category",), attributes=["customer_id", "category", "name"])
    want = plain_history(snapshots)
    assert rows(history(snapshots)) == want
    assert rows(history(snapshots + snapshots[:200])) == want  # given again: nothing new
    # a later snapshot leaves all keys as they are
    more = snapshots + [(c, "C", "new", day(400)) for c in range(0, 80, 7)]
    keys = {(r[1], r[4]): r[0] for r in rows(history(more))}
    assert all(keys[(c, s)] == k for k, c, _, _, s, _, _ in want)
    assert rows(history_from_snapshots(spark.createDataFrame([], SNAPSHOT), ("category",), attributes=["customer_id", "category", "name"])) == []


# split CSV


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_quoted_line_breaks_are_read_split(spark, tmp_out, small_splits):
    rng = random.Random(6)
    pieces = ['plain', '"with; separator"', '"a ""quoted"" word"', '"two\nlines"', '"\n\n\nlong ' + "x\n" * 400 + '"', "NULL", "", '""', '"ends in quote"""', '"a;\n;b"']
    body = "".join(f"{i};{rng.choice(pieces)};{rng.choice(pieces)}\n" for i in range(400))
    write(f"{tmp_out}/files/one.csv", "Id;First;Second\n" + body)
    write(f"{tmp_out}/files/two.csv", "Id;First;Second\n" + "".join(f"{i};x;y\n" for i in range(900, 1100)) + '7;last;"no end of line\nat all"')
    write(f"{tmp_out}/files/three.csv", "Id;First;Second\n" + "".join(f"{i};x;\"q;{i}\"\n" for i in range(2000, 2200)))
    path = f"{tmp_out}/files"
    found = quote_pieces(spark, path).groupBy("file").agg(F.count("*").alias("n"), F.max("broken").alias("b")).collect()
    assert sorted(r["b"] for r in found) == [False, True, True] and min(r["n"] for r in found) > 2
    want = rows(read_extract(spark, path, multi_line=True))
    assert rows(read_extract(spark, path)) == want and len(want) == 400 + 201 + 200
    one = read_records(spark, f"{path}/one.csv", CSV_OPTIONS)
    assert one.rdd.getNumPartitions() > 1


def test_records_are_whole_however_splits_fall(spark, tmp_out):
    """Splits follow the size of all files of a scan: those of a folder are not
    those of the files in it that have line breaks in quotes."""
    settings = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "9"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        write(f"{tmp_out}/files/one.csv", "Id;Text\n" + "".join(f"{i};\"two\nlines {i}\"\n" for i in range(300)))
        write(f"{tmp_out}/files/two.csv", "Id;Text\n" + "".join(f"{i};plain\n" for i in range(1000, 4000)))
        got = rows(read_extract(spark, f"{tmp_out}/files"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == sorted([(str(i), f"two\nlines {i}") for i in range(300)] + [(str(i), "plain") for i in range(1000, 4000)], key=str)


def test_files_without_line_breaks_are_split(spark, tmp_out, small_splits):
    write(f"{tmp_out}/a.csv", "Id;Text\n" + "".join(f"{i};\"t;{i}\"\n" for i in range(500)))
    df = read_extract(spark, f"{tmp_out}/a.csv")
    assert df.rdd.getNumPartitions() > 3 and df.count() == 500
    write(f"{tmp_out}/empty.csv", "Id;Text\n")
    assert rows(read_extract(spark, f"{tmp_out}/empty.csv")) == []


def test_bad_records_still_fail(spark, tmp_out):
    write(f"{tmp_out}/bad.csv", 'Id;Text\n1;"two\nlines"\n2;too;many;fields\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_extract(spark, f"{tmp_out}/bad.csv").collect()


# watermarked load


def plain_accepted(arrivals, delay):
    seen, horizon, out, brought = None, None, [], set()
    for batch in arrivals:
        for row in dict.fromkeys(batch):
            if row[1] is None or row in brought:
                continue
            brought.add(row)
            if horizon is None or row[1] > horizon:
                out.append(row)
        times = [r[1] for r in batch if r[1] is not None] + ([seen] if seen else [])
        seen = max(times, default=None)
        horizon = seen and seen - delay
    return sorted(out, key=str)


def test_watermarked_load_restarts_and_refuses_late_rows(spark, tmp_out):
    at = lambda d: dt.datetime(2020, 1, 1) + dt.timedelta(days=d)
    arrivals = [
        [(1, at(10)), (2, at(20)), (2, at(20)), (9, None)],
        [(3, at(5)), (4, at(18)), (2, at(20)), (5, at(30))],  # 5 days: late; a row again
        [(6, at(24)), (4, at(18)), (7, at(29)), (5, at(30)), (5, at(30))],
        [],
        [(8, at(28)), (10, at(60))],
        [(11, at(31)), (12, at(59))],
    ]
    schema = "id long, ts timestamp_ntz"
    cfg = WatermarkedLoad(
        source_glob=f"{tmp_out}/landing/arrival-*/*.parquet", source_base=f"{tmp_out}/landing", schema=spark.createDataFrame([], schema).schema,
        target=f"{tmp_out}/rows", checkpoint=f"{tmp_out}/checkpoint", event_col="ts", allowed_delay=dt.timedelta(days=3))
    held = []
    for k, batch in enumerate(arrivals):
        spark.createDataFrame(batch, schema).repartition(3).write.parquet(f"{tmp_out}/landing/arrival-{k}")
        # every run is a restart from the checkpoint
        progress = run_watermarked(spark, cfg)
        held += [p["held"] for p in progress]
        assert rows(accepted_rows(spark, cfg)) == plain_accepted(arrivals[:k + 1], cfg.allowed_delay)
    assert run_watermarked(spark, cfg) == []  # nothing new
    assert held[-1] < len(rows(accepted_rows(spark, cfg)))  # the store forgets
    every = {r for b in arrivals for r in b}
    assert set(rows(late_rows(spark, cfg))) == every - set(rows(accepted_rows(spark, cfg)))


def test_state_partitions_follow_the_data_and_stay(spark, tmp_out):
    rows_ = spark.range(100).selectExpr("id", "timestamp_ntz'2020-01-01' + make_dt_interval(CAST(id AS INT)) AS ts")
    table = f"{tmp_out}/table"
    rows_.coalesce(1).write.parquet(table)
    cores = spark.sparkContext.defaultParallelism
    assert watermark.partitions_for(spark, table) == cores
    cfg = WatermarkedLoad(
        source_glob=f"{tmp_out}/landing/arrival-*/*.parquet", source_base=f"{tmp_out}/landing", schema=rows_.schema,
        target=f"{tmp_out}/rows", checkpoint=f"{tmp_out}/checkpoint", event_col="ts", state_partitions=3)
    settings = ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")
    before = [spark.conf.get(k, None) for k in settings]
    for k, n in enumerate((3, 5)):  # the second run has another number: the checkpoint's holds
        rows_.where(f"id % 2 = {k}").write.parquet(f"{tmp_out}/landing/arrival-{k}")
        run_watermarked(spark, replace(cfg, state_partitions=n))
        assert [spark.conf.get(k, None) for k in settings] == before
    assert len(glob.glob(f"{tmp_out}/checkpoint/state/0/[0-9]*")) == 3
    # the second arrival's rows but the last are a day and more behind the first's last
    assert sorted(r["id"] for r in accepted_rows(spark, cfg).collect()) == [*range(0, 98, 2), 98, 99]


def test_state_partitions_grow_with_the_table(spark, tmp_out, monkeypatch):
    table = f"{tmp_out}/table"
    spark.range(100).coalesce(1).write.parquet(table)
    stored = sum(os.path.getsize(f) for f in glob.glob(f"{table}/*"))
    monkeypatch.setattr(watermark, "STATE_BYTES", 10)
    assert watermark.partitions_for(spark, table) == -(-stored // 10)


def test_distinct_rows_are_dealt_before_they_are_held(spark):
    from martwright.sources.staging import distinct_dealt

    pairs = [(k % 7, None if k % 5 == 0 else k % 3) for k in range(200)] + [(None, None)] * 3
    out = distinct_dealt(spark.createDataFrame(pairs, "a long, b long").coalesce(2), 6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one exchange, below both aggregates
    assert plan.count("Exchange ") == 1 and "HashAggregate" not in plan[plan.index("Exchange "):]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(set(pairs), key=str)


# the package on the workers


def test_workers_can_import_the_package_from_a_foreign_folder(tmp_out):
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    code = textwrap.dedent(f"""
        import importlib.util, sys
        spec = importlib.util.spec_from_file_location("entry_by_path", {entry!r})
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())
        from martwright.session import ship_package

        ship_package(spark)

        def names(batches):
            import pyarrow as pa
            import martwright.functions as f
            for b in batches:
                yield pa.RecordBatch.from_pydict({{"name": [f.__name__] * b.num_rows}})

        print("FOUND", [r[0] for r in spark.range(2).mapInArrow(names, "name string").collect()])
        """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_out, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND ['martwright.functions', 'martwright.functions']" in out.stdout, out.stderr[-2000:]


# distinct values


def test_distinct_values_without_expand(spark):
    from martwright.operators.distinct import column_sketches, dense_columns, distinct_values, estimated, merged_sketches
    from martwright.plans.reports import profile

    df = spark.range(20_000).selectExpr(
        "id - 10000 AS dense", "id * 1000003 AS sparse", "CAST(id % 900 AS INT) AS few", "concat('t', id % 5000) AS text",
        "IF(id % 2 = 0, date_add(DATE '2020-01-01', CAST(id % 700 AS INT)), NULL) AS day", "CAST(id % 77 AS DECIMAL(9,2)) AS money",
        "id % 2 = 0 AS flag", "CAST(NULL AS INT) AS nothing")
    assert dense_columns(df) == {"dense", "few", "day"}
    exact = distinct_values(df)
    assert "Expand" not in exact._jdf.queryExecution().executedPlan().toString()
    want = {"dense": 20_000, "sparse": 20_000, "few": 900, "text": 5000, "day": 350, "money": 77, "flag": 2, "nothing": 0}
    assert dict(rows(exact)) == want
    assert {r["column_name"]: (r["row_count"], r["nulls"], r["distinct_values"]) for r in profile(df, "t", exact=True).collect()} == {
        c: (20_000, 10_000 if c == "day" else 20_000 if c == "nothing" else 0, n) for c, n in want.items()}
    assert {r["distinct_values"] for r in profile(df.limit(0), "t", exact=True).collect()} == {0}
    # sketches of parts merge into those of the whole; three standard errors are 5 %
    parts = [column_sketches(df.where(f"few % 3 = {k}")) for k in range(3)]
    merged = {r["column_name"]: r for r in estimated(merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))).collect()}
    assert all(abs(merged[c]["distinct_values"] - n) <= 0.05 * n for c, n in want.items())
    assert all(r["row_count"] == 20_000 for r in merged.values()) and merged["day"]["nulls"] == 10_000


def test_dense_values_are_counted_without_a_sort(spark):
    from martwright.operators.distinct import dense_columns, distinct_values

    df = spark.createDataFrame([(n,) for n in (-129, -128, -64, -1, -1, 0, 0, 63, 64, 65, 127, None)], "n long")
    assert dense_columns(df) == {"n"}
    counted = distinct_values(df)
    assert counted.collect()[0]["distinct_values"] == 9
    assert "SortAggregate" not in counted._jdf.queryExecution().executedPlan().toString()


def test_carried_values_join_no_rows(spark):
    from martwright.operators.sequence import prior_value_in_key

    rows = [(k, at, f"v{at}" if at % 5 == 1 else None) for k in (None, 1, 2) for at in range(40)]
    df = spark.createDataFrame(rows, "k int, at int, v string")
    out = prior_value_in_key(df, "k", ["at"], "v", "found", num_partitions=7)
    assert out.columns == ["k", "at", "v", "found"]
    got = {(r["k"], r["at"]): r["found"] for r in out.collect()}
    assert got == {(k, at): f"v{(at - 2) // 5 * 5 + 1}" if at > 1 else None for k, at, _ in rows}
    assert "LeftOuter" not in out._jdf.queryExecution().optimizedPlan().toString()
