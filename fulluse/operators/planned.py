"""Measures that the product and technical specifications define beyond the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulluse.functions import dates as d
from fulluse.functions import metrics as m
from fulluse.operators.insights import latest_complete_month
from fulluse.operators.intermediate import KEY, PAIR
from fulluse.plans.params import Params


def overage_sustained(rates: DataFrame, params: Params) -> DataFrame:
    """Length of the current run of over-consuming months, and whether it is long enough.

    Months of one run share the difference between month number and position.
    Groups are bounded by the calendar: one row per month.
    """
    order = Window.partitionBy(*PAIR).orderBy("month")
    run = Window.partitionBy(*PAIR, "_run").orderBy("month")
    over = rates.filter(m.is_overage(F.col("overage_ratio"), params.overage_ratio))
    return (
        over.select(*KEY, "overage_ratio")
        .withColumn("_run", d.month_number(F.col("month")) - F.row_number().over(order))
        .withColumn("run_months", F.row_number().over(run).cast("long"))
        .withColumn("overage_sustained", F.col("run_months") >= params.overage_run_months)
        .drop("_run")
    )


def provisional_by_lag(months: DataFrame, as_of: Column, params: Params) -> DataFrame:
    """Months still open at ``as_of`` given the reporting lag."""
    cutoff = F.date_sub(as_of, params.reporting_lag_days)
    return months.select("month", (F.col("month") >= cutoff).alias("is_provisional"))


def capacity_asof(spine: DataFrame) -> DataFrame:
    """Capacity of the contracts active on the last day of the month, not on any day of it."""
    close = F.last_day("month")
    return (
        spine.filter(close.between(F.col("start_date"), F.col("end_date")))
        .groupBy(*KEY)
        .agg(
            F.sum("licensed_amount_month").alias("licensed_amount_month"),
            F.count("*").alias("contracts"),
        )
    )


def core_completion(activity: DataFrame) -> DataFrame:
    """Share of entitled Core features in use per customer, SKU and month."""
    core = F.col("feature_tier") == "Core"
    active, entitled = F.count_if(core & F.col("is_active")), F.count_if(core)
    return activity.groupBy(*KEY).agg(
        active.alias("core_active"),
        entitled.alias("core_entitled"),
        m.ratio(active, entitled).alias("core_completion"),
    )


# Lower edges and labels of the score bands.
BANDS = ((0.7, "0.70+"), (0.4, "0.40-0.70"), (0.1, "0.10-0.40"))


def vrr_bands(customer_adoption: DataFrame) -> DataFrame:
    """Accounts per score band in the last complete month, with their share of all scored ones."""
    score = m.settled(F.col("vrr_value_weighted"))
    band = F.when(score == 0, "0.00")
    for edge, label in BANDS:
        band = band.when(score >= edge, label)
    month = latest_complete_month(customer_adoption)
    scored = customer_adoption.filter((F.col("month") == month) & score.isNotNull())
    total = scored.agg(F.count("*")).scalar()
    return (
        scored.groupBy(band.otherwise("0.00-0.10").alias("band"))
        .agg(F.count("*").alias("accounts"))
        .withColumn("share", m.ratio(F.col("accounts"), total))
    )


def rollup_by(fact: DataFrame, *dims: str) -> DataFrame:
    """Score and dollars of each month at every level of a list of dimensions, from the total down."""
    levels = [["month", *dims[:depth]] for depth in range(len(dims) + 1)]
    return fact.groupingSets(levels, "month", *dims).agg(
        F.grouping_id().cast("long").alias("level"),
        m.annualized(m.exact_sum(F.col("licensed_value_usd"))).alias("book_usd"),
        m.annualized(m.exact_sum(F.col("value_at_risk_usd"))).alias("var_usd"),
        m.weighted_vrr(F.col("vrr"), F.col("licensed_value_usd")).alias("vrr_value_weighted"),
        F.avg("vrr").alias("vrr_unweighted"),
    )


def sustained_recovery(recovery: DataFrame) -> DataFrame:
    """Recovery that still holds one quarter later; open (NULL) while there is no later one."""
    order = Window.partitionBy("account_owner").orderBy("quarter")
    recovered = F.col("value_recovered_usd")
    holds = F.col("_next") <= F.col("closing_var_usd")
    return recovery.withColumn("_next", F.lead("closing_var_usd").over(order)).select(
        "account_owner",
        "quarter",
        "value_recovered_usd",
        holds.alias("is_sustained"),
        F.when(holds, recovered)
        .when(F.col("_next").isNotNull(), F.least(recovered, F.lit(0.0)))
        .alias("sustained_recovered_usd"),
    )


def stage_progression(fact: DataFrame) -> DataFrame:
    """Customer-SKU pairs that left deployment each month, and those already realizing value."""
    order = Window.partitionBy(*PAIR).orderBy("month")
    was = F.lag("flag_deploying").over(order)
    moved = F.col("_was") & ~F.col("flag_deploying")
    return (
        fact.select(*KEY, "flag_deploying", "vrr")
        .withColumn("_was", was)
        .filter(moved)
        .groupBy("month")
        .agg(
            F.count("*").alias("pairs_scored"),
            F.count_if(F.col("vrr") > 0).alias("pairs_adopting"),
        )
    )


def guard_metrics(customer_adoption: DataFrame, params: Params, months: int = 3) -> DataFrame:
    """Per owner: score spread over the book and improvement from a low base over three months."""
    latest = latest_complete_month(customer_adoption)
    score = m.settled(F.col("vrr_value_weighted"))
    scored = customer_adoption.filter(score.isNotNull())
    now = scored.filter(F.col("month") == latest).select(
        "cust_id", "account_owner", score.alias("now")
    )
    then = scored.filter(F.col("month") == F.add_months(latest, -months)).select(
        "cust_id", score.alias("then")
    )
    low = F.col("then") < params.partial_vrr
    base, better = F.count_if(low), F.count_if(low & (F.col("now") > F.col("then")))
    return (
        now.join(then, "cust_id", "left")
        .groupBy("account_owner")
        .agg(
            F.count("*").alias("accounts"),
            (F.max("now") - F.min("now")).alias("vrr_spread"),
            F.stddev_pop("now").alias("vrr_stddev"),
            base.alias("low_base_accounts"),
            better.alias("low_base_improved"),
            m.ratio(better, base).alias("low_base_improved_share"),
        )
    )


def activation_survival(activity: DataFrame, months: int = 3) -> DataFrame:
    """First activations per month, and how many are active again three months on.

    Only activations whose later month is within the data count.
    """
    unit = ["cust_id", "product_id", "feature_id"]
    active = activity.filter("is_active").select(*unit, "month").distinct()
    first = active.groupBy(*unit).agg(F.min("month").alias("month"))
    later = active.select(
        *unit, F.add_months("month", -months).alias("month"), F.lit(True).alias("_alive")
    )
    newest = activity.agg(F.max("month")).scalar()
    return (
        first.filter(F.add_months("month", months) <= newest)
        .join(later, [*unit, "month"], "left")
        .groupBy("month")
        .agg(F.count("*").alias("activations"), F.count("_alive").alias("still_active"))
        .withColumn("survival_share", m.ratio(F.col("still_active"), F.col("activations")))
    )


def feature_value_share(fact: DataFrame, features: DataFrame) -> DataFrame:
    """Monthly contract value of a pair split over its SKU's features by weight."""
    totals = features.groupBy("product_id").agg(F.sum("feature_value_weight").alias("_all"))
    weights = (
        features.select("product_id", "feature_id", "feature_value_weight")
        .join(totals, "product_id")
        .select(
            "product_id",
            "feature_id",
            m.ratio(F.col("feature_value_weight"), F.col("_all")).alias("weight_share"),
        )
    )
    value = F.col("licensed_value_usd") * F.col("weight_share")
    return (
        fact.select(*KEY, "licensed_value_usd")
        .join(weights, "product_id")
        .select(*KEY, "feature_id", "weight_share", value.alias("feature_value_usd"))
    )


def coverage_unweighted(coverage: DataFrame) -> DataFrame:
    share = m.ratio(F.col("active_features"), F.col("entitled_features"))
    return coverage.select(*KEY, share.alias("coverage_unweighted"))
