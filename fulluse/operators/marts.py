"""Marts: the base fact and its rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulluse.functions import dates as d
from fulluse.functions import metrics as m
from fulluse.operators.intermediate import FLAGS, KEY, add_flags
from fulluse.operators.staging import PRODUCT_DIMS
from fulluse.plans.params import Params

CUSTOMER_DIMS = ("cust_name", "segment", "region", "industry", "account_owner")
MONEY = ("licensed_value_usd", "realized_value_usd", "value_at_risk_usd")


#: What the base fact is made of, and what two of them are called in it.
FACTORS = (
    *KEY,
    "consumed_units",
    "licensed_amount_month",
    "is_unlimited",
    "consumption_rate",
    "overage_ratio",
    "feature_coverage",
    "active_features",
    "entitled_features",
    "active_weight",
    "entitled_weight",
    "ttfv_days",
    "days_since_start",
    "contract_value_month",
)
STORED_AS = {"is_unlimited": "flag_unlimited", "contract_value_month": "licensed_value_usd"}


def factors(rates: DataFrame, coverage: DataFrame, deployments: DataFrame) -> DataFrame:
    """The three factor tables share one grouping key, so they join where they are."""
    return rates.join(coverage, KEY, "left").join(deployments, KEY, "left")


def customer_sku_month(
    rates: DataFrame,
    coverage: DataFrame,
    deployments: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    latest: Column,
    params: Params,
) -> DataFrame:
    """The base fact: factors, flags, score and its dollar split per customer x SKU x month."""
    return scored(factors(rates, coverage, deployments), customers, products, latest, params)


def scored(
    factor_rows: DataFrame, customers: DataFrame, products: DataFrame, latest: Column, params: Params
) -> DataFrame:
    """Flags, in one window pass over all months of a pair, score and dollar split of rows with all factors."""
    flagged = add_flags(factor_rows, latest, params)
    who = customers.select("cust_id", *CUSTOMER_DIMS, "behaviour_cohort")
    what = products.select("product_id", *PRODUCT_DIMS).distinct()
    named = flagged.join(who, "cust_id").join(what, "product_id")
    score = m.vrr(
        F.col("flag_deploying"),
        F.col("flag_unlimited"),
        F.col("consumption_rate"),
        F.col("feature_coverage"),
    )
    value = F.col("contract_value_month")
    return named.withColumn("vrr", score).select(
        "cust_id",
        *CUSTOMER_DIMS,
        "behaviour_cohort",
        "product_id",
        *PRODUCT_DIMS,
        "month",
        "consumed_units",
        "licensed_amount_month",
        "consumption_rate",
        "overage_ratio",
        "feature_coverage",
        "active_features",
        "entitled_features",
        "active_weight",
        "entitled_weight",
        "ttfv_days",
        "days_since_start",
        *FLAGS,
        "vrr",
        value.alias("licensed_value_usd"),
        m.realized(value, F.col("vrr")).alias("realized_value_usd"),
        m.at_risk(value, F.col("vrr")).alias("value_at_risk_usd"),
    )


def money_sums() -> list[Column]:
    return [m.exact_sum(F.col(c)).alias(c) for c in MONEY]


def score_means() -> list[Column]:
    """Weighted and plain score plus the plain mean of both factors."""
    return [
        m.weighted_vrr(F.col("vrr"), F.col("licensed_value_usd")).alias("vrr_value_weighted"),
        F.avg("vrr").alias("vrr_unweighted"),
        F.avg("consumption_rate").alias("consumption_rate"),
        F.avg("feature_coverage").alias("feature_coverage"),
    ]


def flag_counts(**names: str) -> list[Column]:
    return [F.count_if(flag).alias(name) for name, flag in names.items()]


def unfinished() -> Column:
    return F.bool_or("is_incomplete").alias("is_incomplete")


def customer_adoption(fact: DataFrame) -> DataFrame:
    """A customer's SKUs of a month meet in one exchange, in which both the distinct count and the sums are taken."""
    return fact.repartition("cust_id", "month").groupBy("cust_id", *CUSTOMER_DIMS, "month").agg(
        F.count_distinct("product_id").alias("skus_held"),
        *money_sums(),
        *score_means(),
        *flag_counts(
            skus_shelfware="flag_shelfware",
            skus_spike_drop="flag_spike_drop",
            skus_overage="flag_chronic_overage",
            skus_deploying="flag_deploying",
        ),
        unfinished(),
    )


def product_adoption(fact: DataFrame) -> DataFrame:
    return fact.groupBy("product_id", *PRODUCT_DIMS, "month").agg(
        F.count_distinct("cust_id").alias("customers"),
        *money_sums(),
        *score_means(),
        *flag_counts(
            customers_shelfware="flag_shelfware", customers_overage="flag_chronic_overage"
        ),
        unfinished(),
    )


def feature_adoption(
    hits: DataFrame,
    spine: DataFrame,
    features: DataFrame,
) -> DataFrame:
    """Customers entitled to and active on each feature, and its usage, per month.

    Everyone on a SKU is entitled to all its features, so entitled customers
    are counted once per SKU and month and then spread over the catalogue.
    """
    entitled = spine.groupBy("product_id", "month").agg(
        F.count_distinct("cust_id").alias("customers_entitled")
    )
    used = hits.groupBy("product_id", "feature_id", "month").agg(
        F.count_distinct(F.when(F.col("active_records") > 0, F.col("cust_id"))).alias("_active"),
        F.sum("usage_events").alias("_usage"),
    )
    dims = ["product_id", "feature_id", "feature_name", "feature_tier", "feature_value_weight"]
    catalogue = features.groupBy(*dims).agg(F.count("*").alias("_copies"))
    zero = F.lit(0).cast("long")
    active = F.coalesce("_active", zero)
    return (
        entitled.join(catalogue, "product_id")
        .join(used, ["product_id", "feature_id", "month"], "left")
        .select(
            *dims,
            "month",
            "customers_entitled",
            active.alias("customers_active"),
            m.ratio(active, F.col("customers_entitled")).alias("adoption_rate"),
            (F.coalesce("_usage", zero) * F.col("_copies")).alias("usage_events"),
        )
    )


def owner_quarters(fact: DataFrame) -> DataFrame:
    """Scored book and at-risk value per owner and quarter, as a monthly sum times twelve."""
    return (
        fact.filter(F.col("vrr").isNotNull())
        .withColumn("quarter", d.quarter_start(F.col("month")))
        .groupBy("account_owner", "quarter")
        .agg(
            m.annualized(m.exact_sum(F.col("value_at_risk_usd"))).alias("annualized_var_usd"),
            m.annualized(m.exact_sum(F.col("licensed_value_usd"))).alias("annualized_book_usd"),
            F.count_distinct("cust_id").alias("accounts"),
            F.bool_and(~F.col("is_incomplete")).alias("quarter_is_complete"),
        )
    )


def owner_recovery(fact: DataFrame, params: Params) -> DataFrame:
    """At-risk dollars recovered between consecutive complete quarters; losses are negative."""
    order = Window.partitionBy("account_owner").orderBy("quarter")
    closed = owner_quarters(fact).filter("quarter_is_complete")
    opening = F.col("opening_var_usd")
    recovered = opening - F.col("annualized_var_usd")
    return (
        closed.withColumn("opening_var_usd", F.lag("annualized_var_usd").over(order))
        .filter(opening.isNotNull())
        .select(
            "account_owner",
            "quarter",
            "accounts",
            "annualized_book_usd",
            "opening_var_usd",
            F.col("annualized_var_usd").alias("closing_var_usd"),
            recovered.alias("value_recovered_usd"),
            m.quota(opening, params.quota_share).alias("quota_usd"),
            m.attainment(recovered, opening, params.quota_share).alias("quota_attainment"),
            "quarter_is_complete",
        )
    )


def distinct_months(fact: DataFrame, column: str, name: str) -> DataFrame:
    """How many values of a column each month has; only distinct ones travel."""
    return fact.select("month", column).distinct().groupBy(F.col("month").alias("_month")).agg(F.count(column).alias(name))


def exec_summary(fact: DataFrame) -> DataFrame:
    """Distinct counts are taken by themselves, so that the sums see every row once and not once for each count."""
    sums = fact.groupBy("month").agg(
        *money_sums(),
        m.annualized(m.exact_sum(F.col("value_at_risk_usd"))).alias("annualized_var_usd"),
        *score_means(),
        *flag_counts(
            n_shelfware="flag_shelfware",
            n_spike_drop="flag_spike_drop",
            n_overage="flag_chronic_overage",
            n_deploying="flag_deploying",
            n_unlimited="flag_unlimited",
        ),
        unfinished(),
    )
    counted = sums
    for column, name in (("cust_id", "customers"), ("product_id", "skus")):
        counts = distinct_months(fact, column, name)
        counted = counted.join(counts, F.col("month").eqNullSafe(F.col("_month"))).drop("_month")
    return counted.select("month", "customers", "skus", *[c for c in sums.columns if c != "month"])
