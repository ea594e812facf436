"""Calendar attributes of a date column.

Fixed values that must equal the reference: the smart key is ``yyyyMMdd`` as an
integer, month names are full English names, and the fiscal year starts on
November 1 (November is fiscal month 1 of the next fiscal year).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First month of the fiscal year (November).
FISCAL_YEAR_START_MONTH = 11


def date_key(d: Column) -> Column:
    # yyyyMMdd by integer arithmetic (no string formatting per row)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def calendar_year(d: Column) -> Column:
    return F.year(d).cast("smallint")


def fiscal_month(d: Column) -> Column:
    # Shift so that the start month maps to 1: (m + 1) % 12 + 1 for November.
    shift = 12 - FISCAL_YEAR_START_MONTH
    return ((F.month(d) + shift) % 12 + 1).cast("smallint")


def fiscal_quarter(d: Column) -> Column:
    shift = 12 - FISCAL_YEAR_START_MONTH
    return (F.floor(((F.month(d) + shift) % 12) / F.lit(3.0)) + 1).cast("smallint")


def fiscal_year(d: Column) -> Column:
    bump = F.when(F.month(d) >= FISCAL_YEAR_START_MONTH, 1).otherwise(0)
    return (F.year(d) + bump).cast("smallint")
