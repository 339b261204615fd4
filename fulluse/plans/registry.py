"""Every named query as a function of the models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulluse.functions import metrics as m
from fulluse.operators import audit, checks, insights, planned
from fulluse.operators.intermediate import KEY
from fulluse.operators.staging import MonthWindow
from fulluse.plans import increment, storage
from fulluse.plans.params import Params
from fulluse.plans.pipeline import MODELS, Models, publish_audit, read_history, session_models
from fulluse.sources import tables
from fulluse.sources.schemas import raw_tables

Query = Callable[[Models], DataFrame]

# The adapted book has other sizes and cohorts than the thresholds' defaults assume.
ADAPTED = replace(
    Params(),
    portfolio_bounds=(1e5, 1e12),
    cohort_shares={"shelfware": (0.08, 0.12), "unlabelled": (0.88, 0.92)},
    row_bounds={
        "customers": (1, 10_000_000),
        "products": (6, 6),
        "entitlements": (1, 1_000_000_000),
        "features": (24, 24),
    },
    spike_cohort="unlabelled",
    overage_cohort="unlabelled",
)

FACT = "mart_customer_sku_month"


def fact_columns(*names: str) -> Query:
    return lambda t: t[FACT].select(*KEY, *names)


def load_parity(t: Models) -> DataFrame:
    """Rows of each derivation against rows of the stored table."""
    return tables.load_parity({name: t.raw.source(name) for name in raw_tables()}, t.raw)


METRICS: dict[str, Query] = {
    "consumption_rate": lambda t: t["int_consumption_rate"].select(*KEY, "consumption_rate"),
    "overage_ratio": lambda t: t["int_consumption_rate"].select(*KEY, "overage_ratio"),
    "feature_coverage": lambda t: t["int_feature_coverage"].select(*KEY, "feature_coverage"),
    "vrr": fact_columns("vrr"),
    "value_split": fact_columns("licensed_value_usd", "realized_value_usd", "value_at_risk_usd"),
    **{
        name: (lambda flag: lambda t: t["int_flags"].select(*KEY, flag))(name)
        for name in (
            "flag_shelfware",
            "flag_spike_drop",
            "flag_chronic_overage",
            "flag_deploying",
            "flag_unlimited",
            "is_incomplete",
        )
    },
    "vrr_value_weighted": lambda t: t[FACT]
    .groupBy("month")
    .agg(m.weighted_vrr(F.col("vrr"), F.col("licensed_value_usd")).alias("vrr_value_weighted")),
    "annualize": lambda t: t[FACT]
    .groupBy("month")
    .agg(m.annualized(m.exact_sum(F.col("value_at_risk_usd"))).alias("annualized_var_usd")),
    "currency_normalize": lambda t: t["stg_entitlements"].select(
        "entitlement_id", "currency", "price_per_unit_usd"
    ),
    "owner_quota": lambda t: t["mart_owner_recovery"].select(
        "account_owner", "quarter", "quota_usd", "quota_attainment"
    ),
}


def audit_rows(t: Models) -> DataFrame:
    """The whole audit of these models, counted once and kept beside them."""
    return t.kept("audit_rows", lambda: audit.full(t, MODELS))


def built_rows(t: Models) -> DataFrame:
    rows = audit_rows(t).filter(F.col("action") == audit.BUILT)
    return rows.select("layer", "model", "action", "rows_out")


def audit_part(*actions: str) -> Query:
    return lambda t: audit_rows(t).filter(F.col("action").isin(*actions))


AUDIT: dict[str, Query] = {
    "audit_model_built": built_rows,
    "audit_dedupe": audit_part(audit.DEDUPE),
    "audit_internal": audit_part(audit.EXCLUDE_INTERNAL),
    "audit_currency": audit_part(audit.CONVERT_CURRENCY),
    "audit_unlimited": audit_part(audit.FLAG_UNLIMITED),
    "audit_zero_fill": audit_part(audit.ZERO_FILL),
    "audit_unentitled": audit_part(audit.DROP_UNENTITLED),
    "audit_gap_months": audit_part(audit.EXCLUDE_GAPS),
    "audit_incomplete": audit_part(audit.MARK_INCOMPLETE),
    "audit_flags": audit_part(audit.FLAG_RAISED),
    "audit_cleaning_view": lambda t: audit.cleaning_view(chosen_run(t)),
    "audit_built_view": lambda t: audit.built_view(chosen_run(t)).drop("runtime"),
}

SOURCES: dict[str, Query] = {
    **{f"src_{name}": (lambda n: lambda t: t[n])(name) for name in raw_tables()},
    "chk_required": lambda t: tables.required_nulls(t.raw),
    "load_parity": load_parity,
}


#: When the registered runs took place; a caller's own runs have the time they started.
RUNS = tuple(datetime(2002, 1, day, 6, tzinfo=UTC) for day in (1, 2))


def publish(t: Models, runs: Sequence[datetime] = RUNS) -> DataFrame:
    """Publish the audit for each run time in the history beside the models and read the history back."""
    if t.folder is None:
        raise ValueError("these models keep no history")
    path, rows = f"{t.folder}/pipeline_audit", audit_rows(t)
    for run_ts in runs:
        publish_audit(audit.stamp(rows, run_ts), path)
    return read_history(rows.sparkSession, path)


def chosen_run(t: Models, run_ts: datetime = RUNS[-1]) -> DataFrame:
    """The audit of one run in the history."""
    return audit.of_run(publish(t), audit.run_id(run_ts))


def earlier_book(raw: Mapping[str, DataFrame], window: MonthWindow) -> dict[str, DataFrame]:
    """The raw tables as they may have been before: the last two months of usage and some contracts are not in yet,
    some usage is other, some is there that went since, some contracts have other terms."""
    first, last = window
    month, part = F.col("month"), increment.bucket("entitlement_id")
    out = {name: raw[name] for name in raw_tables()}
    usage = raw["consumption_monthly"].filter(month < F.add_months(last, -1))
    other = (month == F.add_months(first, 6)) & (part % 16 == 3)
    usage = usage.withColumn("consumed_units", F.when(other, F.col("consumed_units") + 1).otherwise(F.col("consumed_units")))
    since_gone = usage.filter((month == F.add_months(first, 9)) & (part % 16 == 5))
    out["consumption_monthly"] = usage.unionByName(since_gone.withColumn("consumed_units", F.col("consumed_units") * 3))
    activity = raw["feature_adoption_monthly"].filter(month < F.add_months(last, -1))
    out["feature_adoption_monthly"] = activity.filter((month != F.add_months(first, 12)) | (part % 16 != 4))
    terms = raw["entitlements"].filter(part != 7)
    out["entitlements"] = terms.withColumn("is_unlimited", F.col("is_unlimited") | (part == 9))
    return out


def month_refresh(t: Models) -> DataFrame:
    """The base fact of an earlier book, brought to the book of today by what differs.

    The session's own fact is not asked for: the store makes the fact, and its columns come from a lazy plan.
    """
    spark = t["entitlements"].sparkSession
    work = storage.WorkFolder(spark, "increment")
    raw = tables.land(t.raw, f"{work.path}/raw")
    store = increment.Store(spark, f"{work.path}/store", t.params)
    store.build(earlier_book(raw, t.window()))
    store.refresh(raw)
    return store.read(FACT, Models(raw, t.params, window=t.window())[FACT])


def published(log: DataFrame) -> DataFrame:
    """Run times as seconds, which read alike in every time zone."""
    rest = [c for c in log.columns[2:] if c != audit.RUN]
    return log.select("run_id", F.unix_seconds("run_ts").alias("run_epoch"), *rest)


EXEC = "mart_exec_summary"
BY_CUSTOMER = "mart_customer_adoption"
BY_PRODUCT = "mart_product_adoption"
ACTIVITY = "stg_feature_activity"
CHOSEN_SKU = "PROMO SKU"


def depth(t: Models) -> DataFrame:
    return insights.feature_depth(t[ACTIVITY], insights.latest_complete_month(t[FACT]))


def sku_depth(t: Models) -> DataFrame:
    rows = insights.of_sku(t[ACTIVITY], t["stg_entitlements"], CHOSEN_SKU)
    return insights.feature_depth(rows, insights.latest_complete_month(t[FACT]))


def worklist(t: Models, **choice: object) -> DataFrame:
    month = insights.latest_complete_month(t[FACT])
    return insights.customer_worklist(t[BY_CUSTOMER], month, t.params, **choice)


def unused(t: Models, **cut: int | None) -> DataFrame:
    """Idle features of the account at the top of the worklist."""
    first = worklist(t).select("cust_id").limit(1).scalar()
    month = insights.latest_complete_month(t[FACT])
    return insights.unused_features(t[ACTIVITY], t["stg_entitlements"], first, month, **cut)


def account(t: Models) -> DataFrame:
    """The account at the top of the worklist."""
    first = worklist(t).select("cust_id").limit(1).scalar()
    month = insights.latest_complete_month(t[FACT])
    return insights.account_detail(worklist(t), t[EXEC], month, first)


INSIGHTS: dict[str, Query] = {
    "trust_strip": lambda t: insights.trust_strip(audit.latest_run(publish(t)), t[EXEC]),
    "overview_kpis": lambda t: insights.overview_kpis(t[EXEC]),
    "weighted_gap": lambda t: insights.weighted_gap(t[EXEC], t.params),
    "segment_risk": lambda t: insights.segment_risk(t[BY_CUSTOMER]),
    "quadrant_accounts": lambda t: insights.quadrant_accounts(t[BY_CUSTOMER], t.params),
    "quadrant_summary": lambda t: insights.quadrant_summary(
        insights.quadrant_accounts(t[BY_CUSTOMER], t.params)
    ),
    "feature_depth": depth,
    "feature_depth_kpis": lambda t: insights.feature_depth_kpis(depth(t)),
    "feature_depth_pivot": lambda t: insights.feature_depth_pivot(depth(t)),
    "feature_depth_product": sku_depth,
    "sku_depth_kpis": lambda t: insights.feature_depth_kpis(sku_depth(t)),
    "account_detail": account,
    "customer_status": lambda t: insights.customer_status(t[BY_CUSTOMER], t.params),
    "customer_worklist": worklist,
    "customer_worklist_filtered": lambda t: worklist(
        t, segment="Enterprise", needs_attention=True
    ),
    "worklist_display": lambda t: insights.worklist_display(worklist(t)),
    "worklist_headline": lambda t: insights.worklist_headline(worklist(t)),
    "unused_features": unused,
    "unused_summary": lambda t: insights.unused_summary(unused(t, top=None)),
    "platform_risk": lambda t: insights.platform_risk(
        t[BY_PRODUCT], insights.latest_complete_month(t[FACT])
    ),
    "sku_league": lambda t: insights.sku_league(
        t[BY_PRODUCT], insights.latest_complete_month(t[FACT])
    ),
    "sku_feature_league": lambda t: insights.sku_feature_league(
        t["mart_feature_adoption"],
        t["stg_entitlements"],
        insights.latest_complete_month(t[FACT]),
        CHOSEN_SKU,
    ),
    "owner_board": lambda t: insights.owner_board(t["mart_owner_recovery"]),
    "owner_board_latest": lambda t: insights.owner_board_latest(t["mart_owner_recovery"]),
    "audit_publish": lambda t: published(publish(t)),
    "run_history": lambda t: published(audit.run_history(publish(t))),
    "scored_trend": lambda t: insights.scored_trend(t[EXEC]),
    "value_trend": lambda t: insights.value_trend(t[EXEC]),
    "complete_months": lambda t: insights.complete_months(t[FACT]),
}

PLANNED: dict[str, Query] = {
    "overage_sustained": lambda t: planned.overage_sustained(
        t["int_consumption_rate"], t.params
    ),
    "provisional_by_lag": lambda t: planned.provisional_by_lag(
        t[EXEC], F.lit("2001-11-15").cast("date"), t.params
    ),
    "capacity_asof": lambda t: planned.capacity_asof(t["stg_entitlement_month"]),
    "core_completion": lambda t: planned.core_completion(t[ACTIVITY]),
    "vrr_bands": lambda t: planned.vrr_bands(t[BY_CUSTOMER]),
    "rollup_region_segment": lambda t: planned.rollup_by(t[FACT], "region", "segment"),
    "sustained_recovery": lambda t: planned.sustained_recovery(t["mart_owner_recovery"]),
    "stage_progression": lambda t: planned.stage_progression(t[FACT]),
    "guard_metrics": lambda t: planned.guard_metrics(t[BY_CUSTOMER], t.params),
    "activation_survival": lambda t: planned.activation_survival(t[ACTIVITY]),
    "feature_value_share": lambda t: planned.feature_value_share(
        t[FACT], t["features"]
    ),
    "incremental_month_refresh": month_refresh,
    "coverage_unweighted": lambda t: planned.coverage_unweighted(t["int_feature_coverage"]),
}

CHECKS: dict[str, Query] = {
    **{name: (lambda n: lambda t: checks.check(t, n))(name) for name in checks.NAMES},
    "spike_curve": lambda t: checks.score_curve(t[FACT], t.params.spike_cohort),
    "dq_all": checks.run_all,
}

QUERIES: dict[str, Query] = {
    **SOURCES,
    **{name: (lambda n: lambda t: t[n])(name) for name in MODELS},
    **METRICS,
    **AUDIT,
    **CHECKS,
    **INSIGHTS,
    **PLANNED,
}


def adapted_models(spark: SparkSession, folder: str) -> Models:
    return session_models(spark, folder, ADAPTED)
