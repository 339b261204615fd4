"""Decimals at which doubles are compared, and the rounding, which both engines carry out in the same steps.

Money is summed in whole millionths on both sides, so its sums agree to the last bit and six decimals lose nothing.
Other doubles are compared at nine.
"""

from __future__ import annotations


def digits(column: str) -> int:
    money = "usd" in column or column in ("contract_value_month", "observed")
    return 6 if money else 9


def rounded_sql(column: str) -> str:
    n = digits(column)
    return f"floor({column} * 1e{n} + 0.5) / 1e{n}"
