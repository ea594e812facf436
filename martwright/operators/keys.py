"""Dense surrogate keys without a one-partition window.

``ROW_NUMBER() OVER (ORDER BY id)`` makes Spark move every row into a single
partition. ``dense_key`` gives the same numbers (1..n in key order, or
``start``..) with all work spread over the cluster, in the same way at every size:

1. range-partition by the order columns and sort inside each partition
   (the sampled range bounds split any hot key value range over partitions);
2. store that result below the shared checkpoint folder, each row with its
   partition and place, so both are fixed even if executors are lost;
3. count rows per partition (a table with one row per partition), turn the
   counts into prefix offsets;
4. key = start + offset(partition) + position inside the partition.

Only the per-partition count table (bounded by the partition count) is
broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.session import stash


def range_sorted(df: DataFrame, cols, num_partitions: int | None) -> DataFrame:
    """Rows in ranges of ``cols``, sorted inside; AQE sizes the ranges from the
    data unless a number is given."""
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def dense_key(
    df: DataFrame,
    order_cols: list[str | Column],
    key_col: str,
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``key_col`` (BIGINT) numbering rows densely from ``start`` in
    ``order_cols`` order (ascending, nulls first as in Spark's default).

    The order columns must identify a row (a natural key); then the numbers
    do not depend on how rows are partitioned."""
    # The input (typically a join of source tables) is computed once and kept as
    # parquet in the shared checkpoint folder: finding the ranges reads it twice.
    base = stash(df, "dense-key-input")
    ranged = range_sorted(base, order_cols, num_partitions)
    tagged = stash(
        ranged.withColumn("_dk_pid", F.spark_partition_id()).withColumn("_dk_mid", F.monotonically_increasing_id()),
        "dense-key-ranges",
    )
    stats = tagged.groupBy("_dk_pid").agg(
        F.count(F.lit(1)).alias("_dk_n"), F.min("_dk_mid").alias("_dk_first")
    )
    offsets = stats.select(
        "_dk_pid",
        "_dk_first",
        F.coalesce(
            F.sum("_dk_n").over(
                Window.orderBy("_dk_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_dk_offset"),
    )
    keyed = tagged.join(F.broadcast(offsets), "_dk_pid").withColumn(
        key_col,
        (F.lit(start) + F.col("_dk_offset") + F.col("_dk_mid") - F.col("_dk_first")).cast("bigint"),
    )
    return keyed.drop("_dk_pid", "_dk_mid", "_dk_first", "_dk_offset")


def with_leading_key(df: DataFrame, key_col: str) -> DataFrame:
    """Move ``key_col`` to the front of the column list."""
    return df.select(key_col, *[c for c in df.columns if c != key_col])
