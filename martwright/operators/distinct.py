"""Counting distinct values of many columns without expanding the rows.

*Exact.* Every column is read and grouped on its own: a columnar table is read once
in all, and no row is repeated for each column, as several COUNT(DISTINCT) in one
aggregate would do. Integers and dates that are dense (fewer possible values than
64 for each row) become words of 64 bits, a bit for each value, so that a hash
aggregate needs neither a sort of the rows nor an entry for each value.

*Sketches.* ``column_sketches`` makes one HyperLogLog sketch per column in a single
pass; sketches of parts (days, batches, partitions of a table) merge into those
of the whole without reading it again. The standard error is 1.04 / 2 ** (k / 2)
of the count, 1.6 % for k = 12.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two.
SKETCH_K = 12
#: An integer column whose values span less than so many times its rows is dense.
DENSE = 64
_INTEGERS = ("byte", "short", "integer", "long")


def _as_integer(df: DataFrame, column: str):
    """The column as a long, where its type is an integer or a date."""
    kind = df.schema[column].dataType.typeName()
    if kind in _INTEGERS:
        return F.col(f"`{column}`").cast("long")
    return F.unix_date(F.col(f"`{column}`")).cast("long") if kind == "date" else None


def dense_columns(df: DataFrame) -> set[str]:
    """Columns fit for bitmaps, found by one aggregate (one row)."""
    numbers = {c: _as_integer(df, c) for c in df.columns}
    numbers = {c: n for c, n in numbers.items() if n is not None}
    if not numbers:
        return set()
    asked = [x for i, n in enumerate(numbers.values()) for x in (
        F.count(n).alias(f"n{i}"), F.min(n).alias(f"lo{i}"), F.max(n).alias(f"hi{i}"))]
    row = df.agg(*asked).first()
    return {c for i, c in enumerate(numbers) if row[f"n{i}"] and row[f"hi{i}"] - row[f"lo{i}"] < DENSE * row[f"n{i}"]}


def distinct_values(df: DataFrame) -> DataFrame:
    """(column_name, distinct_values): exact counts of non-null values, a row per column."""
    dense = dense_columns(df)
    out = None
    for c in df.columns:
        if c in dense:
            number = _as_integer(df, c)
            # a word of 64 bits is updated in place by a hash aggregate; a binary bitmap would sort every row
            held = df.select(number.alias("v")).where("v IS NOT NULL").groupBy(F.shiftright("v", 6).alias("word")).agg(
                F.bit_count(F.bit_or(F.expr("shiftleft(1L, CAST(v & 63 AS INT))"))).cast("long").alias("n"))
        else:
            held = df.select(F.col(f"`{c}`").alias("v")).where("v IS NOT NULL").distinct().select(F.lit(1).cast("long").alias("n"))
        one = held.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("distinct_values")).select(
            F.lit(c).alias("column_name"), "distinct_values")
        out = one if out is None else out.unionByName(one)
    return out


def column_sketches(df: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(column_name, rows, present, sketch), by one pass without a shuffle of values."""
    aggs = []
    for i, f in enumerate(df.schema.fields):
        value = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        hashed = value if kind in ("integer", "long", "string", "binary") else value.cast("string")
        aggs += [F.count(value).alias(f"n{i}"), F.hll_sketch_agg(hashed, k).alias(f"s{i}")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("present"), F.col(f"s{i}").alias("sketch"))
               for i, c in enumerate(df.columns)]
    return row.select("rows", F.explode(F.array(*entries)).alias("e")).select("e.column_name", "rows", "e.present", "e.sketch")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The sketches of a whole from those of its parts."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame) -> DataFrame:
    """(column_name, row_count, nulls, distinct_values) of sketches."""
    return sketches.select("column_name", F.col("rows").alias("row_count"), (F.col("rows") - F.col("present")).alias("nulls"),
                           F.hll_sketch_estimate("sketch").alias("distinct_values"))
