"""Ordered scans inside a key that stay balanced when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task, so a key
holding a third of the table becomes a third of the job in one task. These
operators split each key over the range partitions instead:

1. range-partition by (key, order columns), sort inside partitions and store
   each row with its partition and place (fixed, safe against task reruns);
2. do the ordered work inside each (partition, key) piece with a window
   partitioned by (partition id, key) -- a hot key is spread over many pieces;
3. fix the piece boundaries with a small table holding one row per
   (partition, key) piece: a key spans at most the number of partitions, so
   the boundary window per key is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.keys import range_sorted
from martwright.session import stash

_PID = "_sq_pid"
_POS = "_sq_pos"


def _pieces(df: DataFrame, key_col: str, order_cols: list[str | Column], num_partitions: int | None) -> DataFrame:
    ranged = range_sorted(df, [key_col, *order_cols], num_partitions)
    placed = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_POS, F.monotonically_increasing_id())
    # place and order are stored with the rows: no rerun of a task can change them
    return stash(placed, "pieces")


def _attach(inner: DataFrame, carry: DataFrame, key_col: str) -> DataFrame:
    """Left-join the per-piece carry values; null keys match null-safely, as
    rows with a null key form one window partition."""
    c = carry.select(
        F.col(_PID).alias("_sq_cpid"), F.col(key_col).alias("_sq_ckey"), "_sq_carry"
    )
    cond = (F.col(_PID) == F.col("_sq_cpid")) & F.col(key_col).eqNullSafe(F.col("_sq_ckey"))
    return inner.join(c, cond, "left").drop("_sq_cpid", "_sq_ckey")


def next_in_key(
    df: DataFrame,
    key_col: str,
    order_cols: list[str | Column],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = ``value_col`` of the next row of the same key in
    ``order_cols`` order (SQL ``LEAD(value) OVER (PARTITION BY key ORDER BY ...)``)."""
    tagged = _pieces(df, key_col, order_cols, num_partitions)
    piece = Window.partitionBy(_PID, key_col).orderBy(_POS)
    inner = tagged.withColumn("_sq_next", F.lead(value_col).over(piece)).withColumn(
        "_sq_last", F.lead(_POS).over(piece).isNull()
    )
    firsts = tagged.groupBy(_PID, key_col).agg(F.min_by(value_col, _POS).alias("_sq_first"))
    carry = firsts.select(
        _PID,
        key_col,
        F.lead("_sq_first").over(Window.partitionBy(key_col).orderBy(_PID)).alias("_sq_carry"),
    )
    out = _attach(inner, carry, key_col).withColumn(
        out_col, F.when(F.col("_sq_last"), F.col("_sq_carry")).otherwise(F.col("_sq_next"))
    )
    return out.drop(_PID, _POS, "_sq_next", "_sq_last", "_sq_carry")


def _prior_in_key(df, key_col, order_cols, num_partitions, inner, total, over_totals, combine, out_col) -> DataFrame:
    """``out_col`` of each row from all earlier rows of its key: ``inner`` over
    those of its own piece, ``over_totals`` over the ``total`` of each earlier
    piece, and ``combine`` of the two."""
    tagged = _pieces(df, key_col, order_cols, num_partitions)
    before = Window.partitionBy(_PID, key_col).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(key_col).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = tagged.groupBy(_PID, key_col).agg(total.alias("_sq_total")).select(
        _PID, key_col, over_totals(F.col("_sq_total")).over(earlier).alias("_sq_carry"))
    out = _attach(tagged.withColumn("_sq_inner", inner.over(before)), carry, key_col)
    return out.withColumn(out_col, combine(F.col("_sq_inner"), F.col("_sq_carry"))).drop(_PID, _POS, "_sq_inner", "_sq_carry")


def prior_max_in_key(
    df: DataFrame,
    key_col: str,
    order_cols: list[str | Column],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = max of ``value_col`` over all earlier rows of the same
    key in ``order_cols`` order (null for the first row of a key)."""
    return _prior_in_key(df, key_col, order_cols, num_partitions, F.max(value_col), F.max(value_col), F.max, F.greatest, out_col)


def prior_sum_in_key(
    df: DataFrame,
    key_col: str,
    order_cols: list[str | Column],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all earlier rows of the same
    key in ``order_cols`` order (0 for the first row of a key)."""
    add = lambda inner, carry: F.coalesce(inner, F.lit(0)) + F.coalesce(carry, F.lit(0))
    return _prior_in_key(df, key_col, order_cols, num_partitions, F.sum(value_col), F.sum(value_col), F.sum, add, out_col)


def prior_value_in_key(
    df: DataFrame,
    key_col: str,
    order_cols: list[str | Column],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = the last non-null ``value_col`` (any type) of the
    earlier rows of the same key in ``order_cols`` order (null before the first)."""
    tagged = _pieces(df, key_col, order_cols, num_partitions)
    latest = F.max_by(value_col, F.when(F.col(value_col).isNotNull(), F.col(_POS)))
    earlier = Window.partitionBy(key_col).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = tagged.groupBy(_PID, key_col).agg(latest.alias("_sq_total")).select(
        _PID, key_col, F.last("_sq_total", ignorenulls=True).over(earlier).alias(value_col))
    # What a piece takes over lies before its first row: the rows themselves are joined
    # with nothing, so they are shuffled once.
    before_first = carry.where(F.col(value_col).isNotNull()).withColumn(_POS, F.lit(-1).cast("long"))
    before = Window.partitionBy(_PID, key_col).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    line = tagged.unionByName(before_first, allowMissingColumns=True)
    return line.withColumn(out_col, F.last(value_col, ignorenulls=True).over(before)).where(F.col(_POS) >= 0).drop(_PID, _POS)
