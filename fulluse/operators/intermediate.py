"""Factors, deployment and flags at customer x SKU x month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulluse.functions import dates as d
from fulluse.functions import metrics as m
from fulluse.operators import staging
from fulluse.plans.params import Params

KEY = ["cust_id", "product_id", "month"]
PAIR = ["cust_id", "product_id"]


def consumption_rate(stg_consumption: DataFrame) -> DataFrame:
    """Capacity factor. Any unlimited contract in the group removes the denominator."""
    grouped = stg_consumption.groupBy(*KEY).agg(
        F.sum("consumed_units").alias("consumed_units"),
        F.sum("licensed_amount_month").alias("licensed_amount_month"),
        F.bool_or("is_unlimited").alias("is_unlimited"),
        F.max("price_per_unit_usd").alias("price_per_unit_usd"),
        m.exact_sum(F.col("contract_value_month")).alias("contract_value_month"),
        F.bool_and("was_zero_filled").alias("all_months_zero_filled"),
    )
    basis = (F.col("consumed_units"), F.col("licensed_amount_month"), F.col("is_unlimited"))
    return grouped.withColumns(
        {"consumption_rate": m.consumption_rate(*basis), "overage_ratio": m.overage_ratio(*basis)}
    )


def feature_coverage(
    contracts: DataFrame,
    window: staging.MonthWindow,
    hits: DataFrame,
    features: DataFrame,
) -> DataFrame:
    """Breadth factor: weight of active over weight of entitled features.

    ``hits`` is the result of :func:`staging.feature_hits`.

    Entitled weight is the number of contracts times the SKU's catalogue
    weight, so only recorded activity is joined; the contract x feature grid is
    never built. A repeated record adds its feature's weight once more to both
    sides, as it does when the grid is joined row by row.
    """
    catalogue = features.groupBy("product_id").agg(
        F.sum("feature_value_weight").alias("_sku_weight"),
        F.count("*").alias("_sku_features"),
    )
    # The catalogue meets contracts, so that the fact keeps the key it is grouped by.
    terms = contracts.select(*PAIR, "start_date", "end_date").join(catalogue, "product_id")
    seats = staging.spread_months(terms, window).groupBy(*KEY).agg(
        F.count("*").alias("_contracts"),
        F.max("_sku_weight").alias("_sku_weight"),
        F.max("_sku_features").alias("_sku_features"),
    )
    weights = features.select("product_id", "feature_id", "feature_value_weight")
    weight = F.col("feature_value_weight")
    extra = F.col("records") - 1
    touched = (
        hits.join(weights, ["product_id", "feature_id"])
        .groupBy(*KEY)
        .agg(
            F.sum(F.col("active_records") * weight).alias("_active_weight"),
            F.sum("active_records").alias("_active"),
            F.sum(extra * weight).alias("_extra_weight"),
            F.sum(extra).alias("_extra"),
        )
    )
    zero = F.lit(0).cast("long")
    active_weight = F.coalesce("_active_weight", zero)
    entitled_weight = F.col("_contracts") * F.col("_sku_weight") + F.coalesce("_extra_weight", zero)
    entitled = F.col("_contracts") * F.col("_sku_features") + F.coalesce("_extra", zero)
    return seats.join(touched, KEY, "left").select(
        *KEY,
        active_weight.alias("active_weight"),
        entitled_weight.alias("entitled_weight"),
        F.coalesce("_active", zero).alias("active_features"),
        entitled.alias("entitled_features"),
        m.ratio(active_weight, entitled_weight).alias("feature_coverage"),
    )


def contract_milestones(raw_events: DataFrame) -> DataFrame:
    """First date of each milestone per contract, one row each."""

    def first(kind: str) -> Column:
        return F.min(F.when(F.col("event_type") == kind, F.col("event_date")))

    return raw_events.groupBy("entitlement_id").agg(
        first("contract_start").alias("_contract_start"),
        first("first_value").alias("_first_value"),
        first("core_complete").alias("_core_complete"),
    )


def deployment(
    contracts: DataFrame, raw_events: DataFrame, window: staging.MonthWindow
) -> DataFrame:
    """Days to first value, to core completion and since the start.

    Milestones join the contracts before the months are spread, so the join
    moves one row per contract instead of one per contract-month.
    """
    dated = contracts.select(
        "entitlement_id", "cust_id", "product_id", "start_date", "end_date"
    ).join(contract_milestones(raw_events), "entitlement_id", "left")
    begun = F.col("_contract_start")
    timed = dated.select(
        *PAIR,
        "start_date",
        "end_date",
        d.days_between(F.col("_first_value"), begun).alias("_ttfv"),
        d.days_between(F.col("_core_complete"), begun).alias("_core"),
    )
    age = d.days_between(F.last_day("month"), F.col("start_date"))
    return (
        staging.spread_months(timed, window)
        .groupBy(*KEY)
        .agg(
            F.min("_ttfv").alias("ttfv_days"),
            F.min("_core").alias("core_complete_days"),
            F.max(age).alias("days_since_start"),
        )
    )


def add_flags(frame: DataFrame, latest: Column, params: Params) -> DataFrame:
    """Six behaviour flags on rows that carry consumption, overage and days since start.

    One window over the pair's months gives position, whole total and the
    total up to two months back. Rows are already one per month, so a window
    group is bounded by the calendar.
    """
    order = Window.partitionBy(*PAIR).orderBy("month")
    used = F.sum("consumed_units")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -2)
    curve = frame.withColumns(
        {
            "_index": F.row_number().over(order),
            "_total": used.over(everything),
            "_early": used.over(earlier),
        }
    )
    consumed, days = F.col("consumed_units"), F.col("days_since_start")
    return curve.withColumns(
        {
            "flag_shelfware": m.is_shelfware(consumed, days, params.deploy_days),
            "flag_spike_drop": m.is_spike_drop(
                F.col("_index"),
                consumed,
                F.col("_early"),
                F.col("_total"),
                params.spike_min_index,
                params.spike_share,
            ),
            "flag_chronic_overage": m.is_overage(F.col("overage_ratio"), params.overage_ratio),
            "flag_deploying": m.is_deploying(days, params.deploy_days),
            "flag_unlimited": F.col("is_unlimited"),
            "is_incomplete": F.col("month") >= latest,
        }
    ).drop("_index", "_total", "_early")


FLAGS = [
    "flag_shelfware",
    "flag_spike_drop",
    "flag_chronic_overage",
    "flag_deploying",
    "flag_unlimited",
    "is_incomplete",
]


def flags(
    rates: DataFrame, deployments: DataFrame, latest: Column, params: Params
) -> DataFrame:
    behaviour = rates.select(*KEY, "consumed_units", "overage_ratio", "is_unlimited")
    timing = deployments.select(*KEY, "days_since_start")
    return add_flags(behaviour.join(timing, KEY, "left"), latest, params).select(*KEY, *FLAGS)
