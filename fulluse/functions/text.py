"""Presentation of money and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit letters of the short money format.
MONEY_UNITS = (("B", 1e9), ("M", 1e6), ("k", 1e3))


def whole_percent(share: Column) -> Column:
    """A share as whole percent; an exact half goes to the even side."""
    return F.bround(F.round(share, 12) * 100, 0)


def short_money(amount: Column) -> Column:
    """``$1.5M`` style; a dash for NULL."""
    text = F.when(amount.isNull(), F.lit("—"))
    for unit, size in MONEY_UNITS:
        text = text.when(
            F.abs(amount) >= size, F.format_string(f"$%,.1f{unit}", amount / F.lit(size))
        )
    return text.otherwise(F.format_string("$%,.0f", amount))
