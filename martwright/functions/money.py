"""Money, rate and ratio expressions with engine-independent result types.

Row-level money is DECIMAL(18,2), rates DECIMAL(9,4); money sums are widened
to DECIMAL(38,2) and integer sums to BIGINT so both Spark and the SQL oracle
agree on the type (Spark would otherwise widen differently).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"
MONEY_TOTAL = "decimal(38,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def rate(c: Column) -> Column:
    return c.cast(RATE)


def money_sum(c: Column | str) -> Column:
    return F.sum(c).cast(MONEY_TOTAL)


def qty_sum(c: Column | str) -> Column:
    return F.sum(c).cast("bigint")


def ratio_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a double rounded to ``digits``; null when whole is 0."""
    return F.round(
        F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)),
        digits,
    )
