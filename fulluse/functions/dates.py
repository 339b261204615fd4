"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def months_between_boundaries(later: Column, earlier: Column) -> Column:
    """Calendar-month boundaries crossed, whatever the day of the month."""
    return (month_number(later) - month_number(earlier)).cast("long")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("long")
