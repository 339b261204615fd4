"""The analytical tables that decision makers read, over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulluse.functions import metrics as m
from fulluse.functions.text import short_money, whole_percent
from fulluse.operators import audit
from fulluse.plans.params import Params


def complete(mart: DataFrame) -> DataFrame:
    return mart.filter(~F.col("is_incomplete"))


def latest_complete_month(mart: DataFrame) -> Column:
    return complete(mart).agg(F.max("month")).scalar()


def complete_months(mart: DataFrame) -> DataFrame:
    """Months a reader can choose, newest first."""
    return complete(mart).select("month").distinct().orderBy(F.desc("month"))


def yearly_money() -> list[Column]:
    return [
        m.annualized(F.col("licensed_value_usd")).alias("book_usd"),
        m.annualized(F.col("value_at_risk_usd")).alias("var_usd"),
    ]


# Overview


def trust_strip(log: DataFrame, exec_summary: DataFrame) -> DataFrame:
    """What one run removed, and the month the numbers are complete through."""

    def removed(action: str) -> Column:
        amount = F.max(F.when(F.col("action") == action, F.abs("rows_removed")))
        return F.coalesce(amount, F.lit(0)).cast("long")

    return log.agg(
        removed(audit.EXCLUDE_INTERNAL).alias("internal_removed"),
        removed(audit.DEDUPE).alias("duplicates_removed"),
        removed(audit.DROP_UNENTITLED).alias("unentitled_removed"),
    ).withColumn("complete_through", latest_complete_month(exec_summary))


def overview_kpis(exec_summary: DataFrame) -> DataFrame:
    """Headline figures of the last complete month against the one before."""
    done = complete(exec_summary)
    last_two = done.orderBy(F.desc("month")).limit(2)

    def newest(column: str) -> Column:
        return F.max_by(column, "month").alias(column)

    score = F.max_by("vrr_value_weighted", "month")
    before = F.when(F.count("*") == 2, F.min_by("vrr_value_weighted", "month"))
    return last_two.agg(
        F.max("month").alias("month"),
        newest("vrr_value_weighted"),
        (score - before).alias("vrr_change"),
        newest("annualized_var_usd"),
        (F.lit(1.0) - score).alias("at_risk_share"),
        newest("n_shelfware"),
        newest("n_overage"),
    ).withColumn("vrr_mean", done.agg(F.avg("vrr_value_weighted")).scalar())


def scored_trend(exec_summary: DataFrame) -> DataFrame:
    """Score and both factors by month; the two newest months are provisional."""
    newest_two = exec_summary.select("month").orderBy(F.desc("month")).limit(2)
    since = newest_two.agg(F.min("month")).scalar()
    return (
        exec_summary.withColumn("is_provisional", F.col("month") >= since)
        .filter(~F.col("is_incomplete") | F.col("is_provisional"))
        .select(
            "month", "vrr_value_weighted", "consumption_rate", "feature_coverage", "is_provisional"
        )
        .orderBy("month")
    )


def value_trend(exec_summary: DataFrame) -> DataFrame:
    return (
        complete(exec_summary)
        .select("month", "realized_value_usd", "value_at_risk_usd")
        .orderBy("month")
    )


def weighted_gap(exec_summary: DataFrame, params: Params) -> DataFrame:
    """Do large contracts score above or below small ones, by month."""
    gap = F.col("vrr_value_weighted") - F.col("vrr_unweighted")
    size = m.settled(gap)
    finding = F.when(size < -params.even_gap, "below").when(size > params.even_gap, "above")
    return complete(exec_summary).select(
        "month", gap.alias("gap"), F.when(gap.isNotNull(), finding.otherwise("even")).alias("finding")
    )


def segment_risk(customer_adoption: DataFrame) -> DataFrame:
    month = latest_complete_month(customer_adoption)
    return (
        customer_adoption.filter(F.col("month") == month)
        .groupBy("segment")
        .agg(
            m.annualized(m.exact_sum(F.col("value_at_risk_usd"))).alias("var_usd"),
            F.count("*").alias("customers"),
        )
        .orderBy(F.desc_nulls_last("var_usd"), "segment")
    )


# Quadrant keys with their label, play and owner.
QUADRANTS = (
    ("value", "Realizing value", "Expansion conversation", "Sales"),
    (
        "scaled",
        "Set up, never scaled",
        "Enablement — why hasn't volume grown?",
        "Customer Success",
    ),
    (
        "hot",
        "Running hot on one thing",
        "They'll hit the cap and renegotiate on price",
        "Sales + Product",
    ),
    ("stalled", "Not started", "Deployment intervention — churn risk", "CS leadership"),
)


def quadrant_accounts(customer_adoption: DataFrame, params: Params) -> DataFrame:
    """Accounts of the last complete month in a two-by-two of coverage and capacity use."""
    month = latest_complete_month(customer_adoption)
    broad = m.settled(F.col("feature_coverage")) >= params.split
    heavy = m.settled(F.col("consumption_rate")) >= params.split
    key = (
        F.when(broad & heavy, "value").when(broad, "scaled").when(heavy, "hot").otherwise("stalled")
    )
    return (
        customer_adoption.filter(F.col("month") == month)
        .dropna(subset=["feature_coverage", "consumption_rate"])
        .select(
            "cust_name",
            "segment",
            "account_owner",
            "feature_coverage",
            "consumption_rate",
            F.col("vrr_value_weighted").alias("vrr"),
            *yearly_money(),
            key.alias("quadrant"),
        )
    )


def quadrant_summary(accounts: DataFrame) -> DataFrame:
    """Accounts and at-risk dollars per quadrant; an empty quadrant keeps its row."""
    spark = accounts.sparkSession
    boxes = F.array(
        *[
            F.struct(
                F.lit(place).alias("place"),
                F.lit(key).alias("quadrant"),
                F.lit(label).alias("label"),
                F.lit(play).alias("play"),
                F.lit(owner).alias("owner"),
            )
            for place, (key, label, play, owner) in enumerate(QUADRANTS)
        ]
    )
    totals = accounts.groupBy("quadrant").agg(
        F.count("*").alias("accounts"), m.exact_sum(F.col("var_usd")).alias("var_usd")
    )
    return (
        spark.range(1)
        .select(F.inline(boxes))
        .join(totals, "quadrant", "left")
        .orderBy("place")
        .select(
            "quadrant",
            "label",
            F.coalesce("accounts", F.lit(0)).cast("long").alias("accounts"),
            F.coalesce("var_usd", F.lit(0.0)).alias("var_usd"),
            "play",
            "owner",
        )
    )


# Feature depth


def feature_depth(activity: DataFrame, month: Column) -> DataFrame:
    """Customer-SKU relationships by number of features used and use of a Core feature.

    Overlapping contracts on a SKU count each feature once.
    """
    features = (
        activity.filter(F.col("month") == month)
        .groupBy("cust_id", "product_id", "feature_id")
        .agg(F.bool_or("is_active").alias("used"), F.min("feature_tier").alias("tier"))
    )
    core = F.col("used") & (F.col("tier") == "Core")
    return (
        features.groupBy("cust_id", "product_id")
        .agg(F.count_if("used").alias("features_used"), F.bool_or(core).alias("uses_core"))
        .groupBy("features_used", "uses_core")
        .agg(F.count("*").alias("n"))
        .orderBy("features_used", "uses_core")
    )


def of_sku(rows: DataFrame, entitlements: DataFrame, product_name: str) -> DataFrame:
    """Rows of the SKUs that carry a name in the contracts."""
    named = entitlements.filter(F.col("product_name") == product_name)
    return rows.join(named.select("product_id").distinct(), "product_id", "left_semi")


def feature_depth_kpis(depth: DataFrame) -> DataFrame:
    """Shares of relationships that use at most one feature, no Core feature, or the most seen."""
    deepest = depth.agg(F.max("features_used")).scalar()

    def part(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    total = F.sum("n")
    shallow = part(F.col("features_used") <= 1)
    return depth.withColumn("_deepest", deepest).agg(
        total.alias("relationships"),
        shallow.alias("shallow"),
        m.ratio(shallow, total).alias("shallow_share"),
        m.ratio(part(~F.col("uses_core")), total).alias("no_core_share"),
        m.ratio(part(F.col("features_used") == F.col("_deepest")), total).alias("full_share"),
    )


def feature_depth_pivot(depth: DataFrame) -> DataFrame:
    return (
        depth.groupBy("features_used")
        .pivot("uses_core", [True, False])
        .agg(F.sum("n"))
        .select(
            "features_used",
            F.coalesce("true", F.lit(0)).cast("long").alias("with_core"),
            F.coalesce("false", F.lit(0)).cast("long").alias("without_core"),
        )
        .orderBy("features_used")
    )


# Customers


def account_detail(
    accounts: DataFrame, exec_summary: DataFrame, month: Column, cust_id: Column
) -> DataFrame:
    """One account of a worklist with its factors, and its score against that of the whole book."""
    book = exec_summary.filter(F.col("month") == month).agg(F.max("vrr_value_weighted")).scalar()
    return accounts.filter(F.col("cust_id") == cust_id).select(
        "cust_id",
        "cust_name",
        "vrr",
        (F.col("vrr") - book).alias("vrr_gap"),
        "consumption_rate",
        "feature_coverage",
    )


# Status names, in order of priority.
TOO_NEW = "Too new to score"
NOT_USING = "Paying, not using"
STOPPED = "Used it, then stopped"
OVER_USING = "Using more than they bought"
HEALTHY = "Healthy"
PARTLY = "Partly deployed"
BARELY = "Barely deployed"


def status(params: Params) -> Column:
    score = m.settled(F.col("vrr_value_weighted"))
    return (
        F.when(F.col("skus_deploying") == F.col("skus_held"), TOO_NEW)
        .when(F.col("skus_shelfware") > 0, NOT_USING)
        .when(F.col("skus_spike_drop") > 0, STOPPED)
        .when(F.col("skus_overage") > 0, OVER_USING)
        .when(score >= params.healthy_vrr, HEALTHY)
        .when(score >= params.partial_vrr, PARTLY)
        .otherwise(BARELY)
    )


def customer_status(customer_adoption: DataFrame, params: Params) -> DataFrame:
    return customer_adoption.select("cust_id", "month", status(params).alias("status"))


def customer_worklist(
    customer_adoption: DataFrame,
    month: Column,
    params: Params,
    segment: str | None = None,
    needs_attention: bool = False,
) -> DataFrame:
    """Accounts of a month by dollars at stake."""
    rows = customer_adoption.filter(F.col("month") == month)
    if segment is not None:
        rows = rows.filter(F.col("segment") == segment)
    rows = rows.select(
        "cust_id",
        "cust_name",
        status(params).alias("status"),
        "segment",
        "region",
        "account_owner",
        F.col("vrr_value_weighted").alias("vrr"),
        "consumption_rate",
        "feature_coverage",
        *yearly_money(),
        "skus_held",
    )
    if needs_attention:
        rows = rows.filter(~F.col("status").isin(HEALTHY, TOO_NEW))
    return rows.orderBy(F.desc_nulls_last("var_usd"), "cust_name", "cust_id")


def worklist_display(worklist: DataFrame) -> DataFrame:
    """The worklist as a reader sees it: whole percents and short money."""
    return worklist.select(
        "cust_name",
        "status",
        whole_percent(F.col("vrr")).alias("score_pct"),
        whole_percent(F.col("consumption_rate")).alias("capacity_pct"),
        whole_percent(F.col("feature_coverage")).alias("features_pct"),
        short_money(F.col("book_usd")).alias("book"),
        short_money(F.col("var_usd")).alias("at_risk"),
    )


def worklist_headline(worklist: DataFrame) -> DataFrame:
    return worklist.agg(
        F.count("*").alias("accounts"),
        m.exact_sum(F.col("var_usd")).alias("var_usd"),
        F.avg("vrr").alias("vrr_mean"),
    )


def unused_features(
    activity: DataFrame,
    entitlements: DataFrame,
    cust_id: Column,
    month: Column,
    top: int | None = 40,
) -> DataFrame:
    """Entitled features one customer left idle in a month, most valuable first; all of them without ``top``."""
    names = entitlements.select("product_id", "product_name").distinct()
    idle = (
        activity.filter(
            (F.col("month") == month) & (F.col("cust_id") == cust_id) & ~F.col("is_active")
        )
        .select("product_id", "feature_id", "feature_name", "feature_tier", "feature_value_weight")
        .join(names, "product_id")
    )
    if top is not None:
        idle = idle.orderBy(F.desc("feature_value_weight"), "feature_id", "product_name").limit(top)
    return idle.select("feature_name", "feature_tier", "product_name")


def unused_summary(unused: DataFrame) -> DataFrame:
    """Counts of all idle features of an account, so give it the list without a cut."""
    return unused.agg(
        F.count("*").alias("features"),
        F.count_if(F.col("feature_tier") == "Core").alias("core_features"),
    )


# Products


def platform_risk(product_adoption: DataFrame, month: Column) -> DataFrame:
    """Book and at-risk value per platform. Here unscored value stays in the denominator."""
    value = F.col("licensed_value_usd")
    return (
        product_adoption.filter(F.col("month") == month)
        .groupBy("product_platform")
        .agg(
            m.annualized(m.exact_sum(value)).alias("book_usd"),
            m.annualized(m.exact_sum(F.col("value_at_risk_usd"))).alias("var_usd"),
            m.ratio(m.exact_sum(F.col("vrr_value_weighted") * value), m.exact_sum(value)).alias("vrr"),
        )
        .orderBy(F.desc_nulls_last("var_usd"), "product_platform")
    )


def sku_league(product_adoption: DataFrame, month: Column, top: int = 60) -> DataFrame:
    return (
        product_adoption.filter(F.col("month") == month)
        .select(
            "product_name",
            "product_platform",
            "sku_tier",
            "customers",
            F.col("vrr_value_weighted").alias("vrr"),
            "consumption_rate",
            "feature_coverage",
            *yearly_money(),
        )
        .orderBy(F.desc_nulls_last("var_usd"), "product_name")
        .limit(top)
    )


def sku_feature_league(
    feature_adoption: DataFrame, entitlements: DataFrame, month: Column, product_name: str
) -> DataFrame:
    """Features of one SKU: most valuable first, least adopted first among equals."""
    return (
        of_sku(feature_adoption.filter(F.col("month") == month), entitlements, product_name)
        .orderBy(
            F.desc("feature_value_weight"), F.asc_nulls_first("adoption_rate"), "feature_id"
        )
        .select(
            "feature_name", "feature_tier", "customers_entitled", "customers_active", "adoption_rate"
        )
    )


# Owners

OWNER_COLUMNS = [
    "account_owner",
    "quarter",
    "accounts",
    "opening_var_usd",
    "closing_var_usd",
    "value_recovered_usd",
    "quota_usd",
    "quota_attainment",
]


def owner_board(recovery: DataFrame) -> DataFrame:
    return recovery.select(*OWNER_COLUMNS).orderBy("quarter", "account_owner")


def owner_board_latest(recovery: DataFrame) -> DataFrame:
    """The newest quarter, weakest recovery first."""
    newest = recovery.agg(F.max("quarter")).scalar()
    return (
        recovery.filter(F.col("quarter") == newest)
        .select(*OWNER_COLUMNS)
        .orderBy(F.asc_nulls_last("value_recovered_usd"), "account_owner")
    )
