"""Loading with an event-time watermark: late rows are refused, repeated rows
are recognised by a state store that forgets what can no longer arrive.

The watermark is the latest event time of the batches before, less the allowed
delay. A row behind it is late. A row ahead of it is held as a key in the state
store until the watermark has passed its event time and the delay; as any copy of
it that comes later is late by then, a copy is either late or found in the
state. So the store keeps the keys of one delay, not of all history, and a load
never reads its target. State is kept in RocksDB, on disk, and partitioned by key;
every batch opens and commits a store for each partition, however few rows it has, so
their number follows the data (``state_partitions``).

The accepted rows go to a file sink whose log makes each batch count once; the
checkpoint holds offsets, watermark and state, so a run continues where an
interrupted one was. What was refused stays in the landing folder; ``late_rows``
finds it for a correction.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martwright.session import partitions_by_size

#: Bytes of stored rows (Parquet) for one partition of the state store.
STATE_BYTES = 16 << 20
_AT = "_event_time"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class WatermarkedLoad:
    source_glob: str  # e.g. /landing/arrival-*/*.parquet
    source_base: str  # folder the glob lives in
    schema: StructType
    target: str
    checkpoint: str
    event_col: str  # timestamp, timestamp_ntz or date
    key_cols: tuple[str, ...] = ()  # a row's identity; empty: all columns
    allowed_delay: dt.timedelta = dt.timedelta(days=1)
    max_files_per_trigger: int | None = None  # None: what has arrived is one batch
    state_partitions: int | None = None  # fixed by the first run of a checkpoint; None: the session's shuffle partitions


def partitions_for(spark: SparkSession, path: str) -> int:
    """State partitions for rows like those stored at ``path``: one for each
    ``STATE_BYTES`` of them, and for each core at least."""
    return partitions_by_size(spark, path, STATE_BYTES)


def accepted_stream(rows: DataFrame, cfg: WatermarkedLoad) -> DataFrame:
    """The rows ahead of the watermark, each key once. Rows without an event
    time are never late and never expire, so they are refused."""
    keys = list(cfg.key_cols) or list(cfg.schema.names)
    at = F.col(cfg.event_col)
    if cfg.schema[cfg.event_col].dataType.typeName() != "timestamp":
        # without a time zone: microseconds since 1970 as they stand, so that no zone's clock change shifts a delay
        micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(`{cfg.event_col}` AS TIMESTAMP_NTZ))"
        at = F.timestamp_micros(F.expr(micros))
    timed = rows.where(F.col(cfg.event_col).isNotNull()).withColumn(_AT, at)
    return (
        timed.withWatermark(_AT, f"{int(cfg.allowed_delay.total_seconds())} seconds")
        .dropDuplicatesWithinWatermark(keys)
        .select(*cfg.schema.names)
    )


def run_watermarked(spark: SparkSession, cfg: WatermarkedLoad) -> list[dict]:
    """Load all that has arrived; for each batch that brought rows, its number,
    rows, rows behind the watermark and the watermark."""
    source = spark.readStream.schema(cfg.schema).option("basePath", cfg.source_base)
    if cfg.max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    settings = {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB}
    if cfg.state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(cfg.state_partitions)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)  # read when a query starts
    try:
        query = (
            accepted_stream(source.parquet(cfg.source_glob), cfg)
            .writeStream.format("parquet").outputMode("append")
            .option("path", cfg.target).option("checkpointLocation", cfg.checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "late": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
            "held": sum(s["numRowsTotal"] for s in p["stateOperators"]),
            "watermark": p["eventTime"].get("watermark"),
        }
        for p in query.recentProgress
        if p["numInputRows"]
    ]


def accepted_rows(spark: SparkSession, cfg: WatermarkedLoad) -> DataFrame:
    """What was accepted so far: the files of finished batches."""
    return spark.read.schema(cfg.schema).parquet(cfg.target)


def late_rows(spark: SparkSession, cfg: WatermarkedLoad) -> DataFrame:
    """What arrived and was never accepted, for a later correction: distinct
    rows of the landing folder that the target does not hold (null-safe on the key)."""
    keys = list(cfg.key_cols) or list(cfg.schema.names)
    arrived = spark.read.schema(cfg.schema).option("basePath", cfg.source_base).parquet(cfg.source_glob).dropDuplicates(keys)
    held = accepted_rows(spark, cfg).select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_held_{k}"))
    return arrived.join(held, same, "left_anti")
