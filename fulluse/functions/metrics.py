"""The metric definitions as column functions. NULL, zero and no row are three different answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS_PER_YEAR = 12
MILLIONTHS = 1_000_000


def ratio(part: Column, whole: Column) -> Column:
    """NULL when the denominator is zero or missing."""
    return F.try_divide(part, whole)


def exact_sum(value: Column) -> Column:
    """A sum of money in whole millionths, cast back once: the same in every order of rows and partitions.

    A row counts to the nearest millionth and may hold up to nine trillion.
    """
    units = F.floor(value * MILLIONTHS + 0.5).cast("decimal(20,0)")
    return F.sum(units).cast("double") / MILLIONTHS


def settled(value: Column) -> Column:
    """A mean or share without the last-digit noise of its summation order.

    Thresholds are tested on this, so that a value that is exactly at a
    threshold falls on the same side in every run.
    """
    return F.round(value, 12)


def capped(value: Column) -> Column:
    """At most 1, and NULL stays NULL: ``least`` alone skips NULLs and would return a full score."""
    return F.when(value.isNotNull(), F.least(value, F.lit(1.0)))


def overage_ratio(consumed: Column, licensed: Column, unlimited: Column) -> Column:
    """Uncapped use of capacity; NULL when any contract in the group is unlimited."""
    return F.when(unlimited, F.lit(None)).otherwise(ratio(consumed, licensed))


def consumption_rate(consumed: Column, licensed: Column, unlimited: Column) -> Column:
    return capped(overage_ratio(consumed, licensed, unlimited))


def usd_price(list_price: Column, fx_rate: Column) -> Column:
    return list_price * fx_rate


def monthly(annual: Column) -> Column:
    return annual / F.lit(float(MONTHS_PER_YEAR))


def annualized(per_month: Column) -> Column:
    return per_month * MONTHS_PER_YEAR


def vrr(deploying: Column, unlimited: Column, rate: Column, coverage: Column) -> Column:
    """Value realization rate. Deploying wins over unlimited; missing factors count as zero."""
    zero = F.lit(0.0)
    scored = F.coalesce(rate, zero) * F.coalesce(coverage, zero)
    return F.when(deploying, F.lit(None)).when(unlimited, coverage).otherwise(scored)


def realized(value: Column, score: Column) -> Column:
    return value * F.coalesce(score, F.lit(0.0))


def at_risk(value: Column, score: Column) -> Column:
    return value * (F.lit(1.0) - F.coalesce(score, F.lit(0.0)))


def weighted_vrr(score: Column, value: Column) -> Column:
    """Value-weighted mean; unscored rows leave both the numerator and the denominator."""
    return ratio(exact_sum(score * value), exact_sum(F.when(score.isNotNull(), value)))


def is_shelfware(consumed: Column, days: Column, deploy_days: int) -> Column:
    return (consumed == 0) & (F.coalesce(days, F.lit(0)) >= deploy_days)


def is_deploying(days: Column, deploy_days: int) -> Column:
    return F.coalesce(days, F.lit(0)) < deploy_days


def is_overage(over: Column, threshold: float) -> Column:
    return F.coalesce(over, F.lit(0.0)) >= threshold


def is_spike_drop(
    index: Column, consumed: Column, early: Column, total: Column, min_index: int, share: float
) -> Column:
    """Dormant now, and most of all consumption came from the months up to two before."""
    return (
        (index > min_index) & (consumed == 0) & (total > 0) & (ratio(early, total) >= share)
    )


def quota(opening: Column, share: float) -> Column:
    return opening * share


def attainment(recovered: Column, opening: Column, share: float) -> Column:
    return ratio(recovered, quota(opening, share))
