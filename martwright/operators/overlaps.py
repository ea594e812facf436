"""Counting overlapping pairs of date ranges without forming pairs.

Put the first and last day of every range of an id on one line, first days
before last days of the same date. When a range begins, the ranges open at that
moment are those that began earlier less those that ended earlier. Summed over
all beginnings, this counts every overlapping pair once. The sums are prefix
sums over (id, date) pieces (``prior_sum_in_key``), so an id of any size is
spread over tasks and the work stays linear in the ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.sequence import prior_sum_in_key


def _swept(ranges: DataFrame, num_partitions: int | None) -> DataFrame:
    """(_id, pairs) over ranges (_id, _key, _start, _end) with _start <= _end."""
    ends = F.array(
        F.struct(F.col("_start").alias("day"), F.lit(0).alias("closes"), F.lit(1).alias("open")),
        F.struct(F.col("_end").alias("day"), F.lit(1).alias("closes"), F.lit(-1).alias("open")),
    )
    events = ranges.select("_id", "_key", F.explode(ends).alias("e")).select("_id", "_key", "e.*")
    counted = prior_sum_in_key(events, "_id", ["day", "closes", "_key"], "open", "pairs", num_partitions)
    return counted.where("closes = 0").groupBy("_id").agg(F.sum("pairs").cast("bigint").alias("pairs"))


def overlap_pairs(
    ranges: DataFrame,
    id_col: str,
    key_col: str,
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    num_partitions: int | None = None,
) -> DataFrame:
    """(id, pairs): for every id with any, the pairs of its ranges with
    different keys that share a day.

    Pairs of equal keys do not count, nor do ranges with a null id, key, first or
    last day (no comparison holds for them). A range that ends before it begins
    shares a day, by comparison of its ends, with each range that holds both of
    its ends; such rows are faults (a gate of their own) and meet the proper
    ranges of their id in a join that is aggregated at once.
    """
    rows = ranges.select(
        F.col(id_col).alias("_id"), F.col(key_col).alias("_key"), F.col(start_col).alias("_start"), F.col(end_col).alias("_end")
    ).na.drop()
    proper = rows.where("_start <= _end")
    found = _swept(proper, num_partitions)
    # keys given more than once: their own pairs are taken off again
    repeated = proper.groupBy("_id", "_key").count().where("count > 1").drop("count")
    twice = proper.join(repeated, ["_id", "_key"], "left_semi").withColumn("_group", F.struct("_id", "_key"))
    own = _swept(twice.select(F.col("_group").alias("_id"), "_key", "_start", "_end"), num_partitions).select("_id._id", (-F.col("pairs")).alias("pairs"))
    reversed_ = rows.where("_start > _end").select(
        F.col("_id"), F.col("_key").alias("_fault"), F.col("_start").alias("_from"), F.col("_end").alias("_to"))
    around = (
        proper.join(reversed_, "_id")
        .where((F.col("_fault") != F.col("_key")) & (F.col("_start") <= F.col("_to")) & (F.col("_end") >= F.col("_from")))
        .groupBy("_id").agg(F.count(F.lit(1)).alias("pairs"))
    )
    return (
        found.unionByName(own).unionByName(around)
        .groupBy(F.col("_id").alias(id_col)).agg(F.sum("pairs").cast("bigint").alias("pairs")).where("pairs > 0")
    )
