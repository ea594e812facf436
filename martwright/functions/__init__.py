"""Column expressions shared by the builders (all JVM-side, codegen-friendly)."""

from martwright.functions.calendar import (
    calendar_year,
    date_key,
    fiscal_month,
    fiscal_quarter,
    fiscal_year,
    month_name,
)
from martwright.functions.money import money, money_sum, qty_sum, rate, ratio_percent

__all__ = [
    "calendar_year",
    "date_key",
    "fiscal_month",
    "fiscal_quarter",
    "fiscal_year",
    "month_name",
    "money",
    "money_sum",
    "qty_sum",
    "rate",
    "ratio_percent",
]
