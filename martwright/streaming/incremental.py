"""Incremental, retry-safe loading with a late-data monitor.

What the reference advises for high daily volumes -- incremental ingestion,
partitioned storage, hourly batches, monitoring of retries and late data,
same grains -- as a Structured Streaming job: a file source picks up new extract
files (``trigger(availableNow=True)`` processes everything available, then
stops: one scheduled batch run) and ``foreachBatch`` loads them.

A *run* is the life of one checkpoint: its number is kept inside the checkpoint
folder, one above all runs that the target knows. (run, batch) therefore never
names two different batches, and a lost checkpoint starts a new run instead of
reusing the stored batches' places.

* Rows that the target already holds are recognised by a left-anti join and are
  skipped, so replaying a batch, or everything, never doubles a row.
* Rows are written by ranges of (partition, key), sized by AQE: a busy month is
  split over tasks.
* Per batch that brings something new, rows whose event time is older than the
  latest event time of *earlier* batches minus an allowed delay are counted as
  late. The monitor row is the batch's own partition: a retry rewrites it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from martwright.session import delete_path, matching_paths, path_exists, read_text, replace_text, stash

_RUN, _BATCH = "_run", "_batch"
_DIGEST = ["_digest_a", "_digest_b"]


@dataclass(frozen=True)
class IncrementalLoad:
    source_glob: str  # e.g. /landing/lineitem*.parquet
    source_base: str  # folder the glob lives in
    schema: StructType
    target: str
    monitor: str
    checkpoint: str
    key_cols: tuple[str, ...]
    partition_col: str | None = None
    partition_expr: str | None = None  # SQL expression deriving partition_col
    event_col: str | None = None
    allowed_delay: dt.timedelta = dt.timedelta(days=1)
    max_files_per_trigger: int | None = 1  # None: all that has arrived is one batch
    transform: Callable[[DataFrame], DataFrame] | None = None


def _existing(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when there is no such folder; a folder
    that cannot be read is an error, not an empty table. With a schema, a
    folder without rows is an empty table."""
    if not path_exists(spark, path):
        return None
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def _run_number(spark: SparkSession, checkpoint: str, known: list[str]) -> int:
    """The number of this checkpoint's run: kept in the checkpoint folder, or
    one above every run in the ``known`` tables."""
    place = f"{checkpoint.rstrip('/')}/run-number"
    if path_exists(spark, place):
        return int(spark.read.text(place).first()[0])
    highest = -1
    marks = StructType([StructField(_RUN, IntegerType()), StructField(_BATCH, LongType())])
    for path in known:
        table = _existing(spark, path, marks)  # a compacted folder may have no file left
        if table is not None:
            found = table.agg(F.max(_RUN)).first()[0]
            highest = max(highest, -1 if found is None else int(found))
    spark.createDataFrame([(str(highest + 1),)], "value string").coalesce(1).write.text(place)
    return highest + 1


def _null_safe_match(cols) -> F.Column:
    cond = None
    for c in cols:
        term = F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}"))
        cond = term if cond is None else cond & term
    return cond


def _digest(rows: DataFrame, cols: list[str]) -> list[F.Column]:
    """128 bits of the values of ``cols``, as two longs; which are null counts."""
    values = [F.col(f"`{c}`") for c in cols]
    nulls = F.concat(*[F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in values])
    return [F.xxhash64(F.lit(k), nulls, *values).alias(name) for k, name in enumerate(_DIGEST)]


def _without_known(rows: DataFrame, old: DataFrame | None, keys: list[str], partition_col: str | None, whole: bool = False) -> DataFrame:
    """``rows`` whose keys ``old`` does not hold; only the partitions that the
    rows touch are read of it (a semi join that prunes folders at run time).

    ``whole``: the keys are all that a row holds, and reading ``rows`` again gives
    the same ones. Then digests are compared, and first counted: rows move only
    where some are known and others are not."""
    if old is None:
        return rows
    if partition_col:
        old = old.join(rows.select(partition_col).distinct(), partition_col, "left_semi")
    if whole:
        held = old.select(*[F.col(f"`{c}`").cast(rows.schema[c].dataType).alias(c) for c in keys])
        held = held.select(*_digest(held, keys))
        met = rows.select(*_digest(rows, keys)).join(held.withColumn("_known", F.lit(True)), _DIGEST, "left")
        count = met.agg(F.count(F.lit(1)).alias("rows"), F.count("_known").alias("known")).first()
        if not count["known"]:
            return rows
        if count["known"] == count["rows"]:
            return rows.limit(0)
        return rows.select("*", *_digest(rows, keys)).join(held, _DIGEST, "left_anti").drop(*_DIGEST)
    if partition_col:
        keys = [*keys, partition_col]
    return rows.alias("_new").join(old.select(*keys).alias("_old"), _null_safe_match(keys), "left_anti")


def rows_without(rows: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """``rows`` whose ``key`` is no ``other_key`` of ``others``, or is null. Only keys
    move to find those that are missing; where they are few, no row does."""
    keys = rows.select(F.col(key).alias("_key")).distinct()
    missing = stash(keys.join(others, F.col("_key") == others[other_key], "left_anti"), "missing-keys")
    return rows.join(missing, rows[key].eqNullSafe(missing["_key"]), "left_semi")


def _overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str], spread: str) -> None:
    """Replace the written partitions; rows of one are spread over tasks."""
    _write_partitions(df.repartitionByRange(*partition_cols, spread), path, partition_cols)  # AQE sizes the ranges


def _write_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Replace the written partitions; rows are written as they are dealt out."""
    df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*partition_cols).parquet(path)


def load_batch(spark: SparkSession, cfg: IncrementalLoad, batch: DataFrame, run: int, batch_id: int) -> None:
    rows = cfg.transform(batch) if cfg.transform else batch
    keys = list(cfg.key_cols)
    # Where a key lies in one partition, known rows go first, so that a replay has none
    # left to shuffle for its duplicates; else one row of a key is chosen first.
    known_first = not cfg.partition_col or set(keys) >= set(rows.columns)
    if not known_first:
        rows = rows.dropDuplicates(keys)
    if cfg.partition_col:
        rows = rows.withColumn(cfg.partition_col, F.expr(cfg.partition_expr))
    rows = _without_known(rows, _existing(spark, cfg.target), keys, cfg.partition_col, whole=set(keys) >= set(cfg.schema.names) and not cfg.transform)
    # computed once: it is counted, monitored and written
    rows = stash(rows.dropDuplicates(keys) if known_first else rows, "batch")
    if rows.isEmpty():  # a replay, or a batch of known rows only
        return
    if cfg.event_col:
        record_late_rows(spark, cfg.monitor, batch, run, batch_id, cfg.event_col, cfg.allowed_delay)
    if cfg.partition_col:
        rows = rows.repartitionByRange(cfg.partition_col, cfg.key_cols[0])  # AQE sizes the ranges
        rows.write.mode("append").partitionBy(cfg.partition_col).parquet(cfg.target)
    else:
        rows.write.mode("append").parquet(cfg.target)


def record_late_rows(
    spark: SparkSession,
    monitor: str,
    batch: DataFrame,
    run: int,
    batch_id: int,
    event_col: str,
    allowed_delay: dt.timedelta,
) -> None:
    """The batch's monitor row: its rows, how many are older than the latest
    event time of earlier batches minus ``allowed_delay`` (late), and its own
    latest event time. A retry replaces the row and sees the same horizon."""
    seen = _existing(spark, monitor)
    horizon = None
    if seen is not None:
        earlier = seen.where((F.col(_RUN) < run) | ((F.col(_RUN) == run) & (F.col(_BATCH) < batch_id)))
        horizon = earlier.agg(F.max("max_event_time")).first()[0]  # one row per batch
    event_type = batch.schema[event_col].dataType.simpleString()
    # the cutoff travels as text, so no time zone is involved
    cutoff = F.lit(str(horizon - allowed_delay) if horizon is not None else None).cast(event_type)
    stats = batch.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_in_batch"),
        F.count_if(F.col(event_col) < cutoff).cast("bigint").alias("late_rows"),
        F.max(event_col).alias("max_event_time"),
    ).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "*", F.lit(run).alias(_RUN), F.lit(batch_id).cast("bigint").alias(_BATCH))
    _overwrite_partitions(stats, monitor, [_RUN, _BATCH], "batch_id")


def _stream(spark: SparkSession, cfg: IncrementalLoad | FactIncrement) -> DataFrame:
    reader = spark.readStream.schema(cfg.schema).option("basePath", cfg.source_base)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    return reader.parquet(cfg.source_glob)


def run_incremental(spark: SparkSession, cfg: IncrementalLoad) -> DataFrame:
    """Run all available input through the load; return the target table."""
    run = _run_number(spark, cfg.checkpoint, [cfg.monitor])
    stream = _stream(spark, cfg)
    query = (
        stream.writeStream.foreachBatch(lambda df, bid: load_batch(spark, cfg, df, run, bid))
        .option("checkpointLocation", cfg.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(cfg.target)


@dataclass(frozen=True)
class FactIncrement:
    """Incremental load at fact grain.

    For batch (run, n), everything is written to partitions of its own and
    replaced by a retry:

    * ``deltas``: the batch's raw rows that no committed other batch holds (full-row
      comparison, so a replay adds nothing);
    * ``facts``: the facts of these rows and of the rows that were pending;
    * ``pending``: rows that are ``not_ready`` (their order header is not there
      yet), for the next batch to try again;
    * ``commits``: written last. What an interrupted batch left is not read
      by anyone and does not count as held.

    The fact table is the latest version of each line (``line_key``), so a
    corrected line replaces the old one instead of doubling it.

    ``compact`` merges committed batches into one base table each for deltas and
    facts (of a line only its latest version), so that a read opens the base and
    the few batches after it, however many there were."""

    source_glob: str
    source_base: str
    schema: StructType
    deltas: str
    facts: str
    checkpoint: str
    partition_col: str
    partition_expr: str  # SQL over the raw columns
    fact_partition_col: str
    fact_partition_expr: str  # SQL over the fact columns
    to_facts: Callable[[DataFrame], DataFrame]
    # the line's identity in the raw rows and in the facts; without one every
    # distinct row is a line of its own
    line_key: tuple[str, ...] = ()
    fact_line_key: tuple[str, ...] = ()
    # the raw rows that cannot give facts yet (e.g. no order header); None: all can
    not_ready: Callable[[DataFrame], DataFrame] | None = None
    max_files_per_trigger: int | None = 1
    monitor: str | None = None  # late-row monitor table (needs event_col)
    event_col: str | None = None
    allowed_delay: dt.timedelta = dt.timedelta(days=1)
    # committed batches beyond the last compaction that a run leaves; None: never compact
    compact_after: int | None = 32

    @property
    def pending(self) -> str:
        return f"{self.deltas.rstrip('/')}-pending"

    @property
    def pending_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(_RUN, IntegerType()), StructField(_BATCH, LongType())])

    @property
    def commits(self) -> str:
        return f"{self.deltas.rstrip('/')}-commits"

    @property
    def manifest(self) -> str:
        return f"{self.deltas.rstrip('/')}-compacted/current.json"


def _base(spark: SparkSession, cfg: FactIncrement) -> dict | None:
    """What the last compaction covers: its tables, and its last run and batch."""
    text = read_text(spark, cfg.manifest)
    return json.loads(text) if text else None


def _after(covered: dict | None) -> F.Column:
    """Batches behind the covered ones; a filter on folders, so that others are not opened."""
    if covered is None:
        return F.lit(True)
    return (F.col(_RUN) > covered["run"]) | ((F.col(_RUN) == covered["run"]) & (F.col(_BATCH) > covered["batch"]))


def _committed(spark: SparkSession, cfg: FactIncrement, path: str, run: int | None = None, batch_id: int | None = None) -> DataFrame | None:
    """Rows of committed batches (other than the given one): the compacted ones
    from the base, the others from their folders."""
    covered = _base(spark, cfg)
    base = None
    if covered and path in (cfg.deltas, cfg.facts):
        base = spark.read.parquet(covered["deltas" if path == cfg.deltas else "facts"])
    schema = cfg.pending_schema if path == cfg.pending else None if base is None else base.schema
    # batches that gave no facts leave a folder without a partition
    table = _existing(spark, path, schema) if schema is not None or matching_paths(spark, f"{path.rstrip('/')}/*=*") else None
    commits = _existing(spark, cfg.commits)
    if table is None or commits is None:
        return base
    if run is not None:
        commits = commits.where((F.col(_RUN) != run) | (F.col(_BATCH) != batch_id))
    if base is not None:
        table, commits = table.where(_after(covered)), commits.where(_after(covered))
    rows = table.join(commits.select(_RUN, _BATCH), [_RUN, _BATCH], "left_semi")  # one row per batch
    return rows if base is None else base.unionByName(rows)


def _latest(rows: DataFrame, key: list[str], tie: list[str]) -> DataFrame:
    """The last version of each line: by run, batch, then the row's values."""
    if not key:
        return rows
    order = Window.partitionBy(*key).orderBy(F.desc(_RUN), F.desc(_BATCH), *[F.desc(c) for c in tie])
    return rows.withColumn("_version", F.row_number().over(order)).where("_version = 1").drop("_version")


def read_facts(spark: SparkSession, cfg: FactIncrement) -> DataFrame:
    """The fact table: the latest committed version of every line."""
    facts = _committed(spark, cfg, cfg.facts)
    if facts is None:
        raise ValueError(f"nothing loaded at {cfg.facts}")
    own = [c for c in facts.columns if c not in {_RUN, _BATCH, *cfg.fact_line_key}]
    return _latest(facts, list(cfg.fact_line_key), own)


def fact_batch(spark: SparkSession, cfg: FactIncrement, batch: DataFrame, run: int, batch_id: int) -> None:
    raw = list(cfg.schema.names)
    rows = batch.select(*raw).withColumn(cfg.partition_col, F.expr(cfg.partition_expr))
    held = _committed(spark, cfg, cfg.deltas, run, batch_id)
    mark = [F.lit(run).alias(_RUN), F.lit(batch_id).cast("bigint").alias(_BATCH)]
    # dealt out once, as they are written: rows that are equal meet in one range of (partition, values)
    fresh = _without_known(rows, held, raw, cfg.partition_col, whole=True)
    added = stash(fresh.repartitionByRange(cfg.partition_col, *raw).dropDuplicates([cfg.partition_col, *raw]), "batch")
    waiting = None
    before = _committed(spark, cfg, cfg.pending, run, batch_id)
    if before is not None:  # the last committed batch holds all that still waits
        commits = spark.read.parquet(cfg.commits).where((F.col(_RUN) != run) | (F.col(_BATCH) != batch_id))
        last = commits.orderBy(F.desc(_RUN), F.desc(_BATCH)).first()
        waiting = before.where((F.col(_RUN) == last[_RUN]) & (F.col(_BATCH) == last[_BATCH])).select(*raw)
    if not added.isEmpty():
        if cfg.monitor and cfg.event_col:
            record_late_rows(spark, cfg.monitor, batch, run, batch_id, cfg.event_col, cfg.allowed_delay)
        _write_partitions(added.select("*", *mark), cfg.deltas, [cfg.partition_col, _RUN, _BATCH])
    elif waiting is None or waiting.isEmpty():  # a replay, or known rows only
        return
    # of a line given twice in one batch the facts take one version
    todo = added.select(*raw) if waiting is None else added.select(*raw).unionByName(waiting)
    if cfg.line_key or waiting is not None:  # else it is stored already
        todo = stash(_latest(todo.select("*", *mark), list(cfg.line_key), [c for c in raw if c not in cfg.line_key]).select(*raw), "to-facts")
    facts = cfg.to_facts(todo).withColumn(cfg.fact_partition_col, F.expr(cfg.fact_partition_expr))
    _overwrite_partitions(facts.select("*", *mark), cfg.facts, [cfg.fact_partition_col, _RUN, _BATCH], facts.columns[0])
    late = cfg.not_ready(todo) if cfg.not_ready else todo.limit(0)
    late.select(*raw, *mark).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(_RUN, _BATCH).parquet(cfg.pending)
    commit = spark.createDataFrame([(run, batch_id)], f"{_RUN} int, {_BATCH} bigint").withColumn("committed", F.current_timestamp())
    commit.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(_RUN, _BATCH).parquet(cfg.commits)
    for used in {f.rsplit("/", 1)[0] for f in added.inputFiles()}:  # it is in the deltas now
        delete_path(spark, used)


def pending_lines(spark: SparkSession, cfg: FactIncrement) -> DataFrame | None:
    """Raw lines that still wait for their order header."""
    table = _committed(spark, cfg, cfg.pending)
    if table is None:
        return None
    last = spark.read.parquet(cfg.commits).orderBy(F.desc(_RUN), F.desc(_BATCH)).first()
    return table.where((F.col(_RUN) == last[_RUN]) & (F.col(_BATCH) == last[_BATCH])).select(*cfg.schema.names)


def compact(spark: SparkSession, cfg: FactIncrement) -> None:
    """Merge all committed batches into a new base and drop what it replaces.

    The base is written beside the old one; one rename of the manifest makes it
    the current one together with the number of its last batch; then the old base
    and the covered batches' folders are deleted. Whatever step a crash leaves
    undone, readers find each row once: by the manifest, which covers a batch
    whole or not at all. A later call finishes the deletions."""
    commits = _existing(spark, cfg.commits)
    covered = _base(spark, cfg)
    if commits is not None:
        last = commits.where(_after(covered)).orderBy(F.desc(_RUN), F.desc(_BATCH)).first()
        if last is not None:
            new = {"run": int(last[_RUN]), "batch": int(last[_BATCH])}
            for name, path, part in (("deltas", cfg.deltas, cfg.partition_col), ("facts", cfg.facts, cfg.fact_partition_col)):
                rows = _committed(spark, cfg, path)
                if name == "facts":
                    own = [c for c in rows.columns if c not in {_RUN, _BATCH, *cfg.fact_line_key}]
                    rows = _latest(rows, list(cfg.fact_line_key), own)
                new[name] = f"{path.rstrip('/')}-base/{uuid.uuid4().hex[:12]}"
                first = next(c for c in rows.columns if c not in (part, _RUN, _BATCH))
                rows.withColumn(_RUN, F.col(_RUN).cast("int")).withColumn(_BATCH, F.col(_BATCH).cast("long")).repartitionByRange(
                    part, first).write.partitionBy(part).parquet(new[name])
            replace_text(spark, cfg.manifest, json.dumps(new))
            covered = new
    if covered is None:
        return
    for name, path in (("deltas", cfg.deltas), ("facts", cfg.facts)):
        for old in matching_paths(spark, f"{path.rstrip('/')}-base/*"):
            if old.rstrip("/").rsplit("/", 1)[1] != covered[name].rsplit("/", 1)[1]:
                delete_path(spark, old)
        for folder in matching_paths(spark, f"{path.rstrip('/')}/*/{_RUN}=*/{_BATCH}=*"):
            run, batch = (int(x.split("=")[1]) for x in folder.rstrip("/").rsplit("/", 2)[1:])
            if (run, batch) <= (covered["run"], covered["batch"]):
                delete_path(spark, folder)


def run_fact_increment(spark: SparkSession, cfg: FactIncrement) -> DataFrame:
    """Run all available input through the load; return the fact table."""
    run = _run_number(spark, cfg.checkpoint, [cfg.deltas, cfg.commits])
    stream = _stream(spark, cfg)
    query = (
        stream.writeStream.foreachBatch(lambda df, bid: fact_batch(spark, cfg, df, run, bid))
        .option("checkpointLocation", cfg.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if cfg.compact_after is not None:
        commits = _existing(spark, cfg.commits)
        if commits is not None and commits.where(_after(_base(spark, cfg))).count() > cfg.compact_after:
            compact(spark, cfg)
    return read_facts(spark, cfg)
