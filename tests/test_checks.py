"""Checks on a healthy book, and each of several faults planted into a table it reads."""

from __future__ import annotations

from dataclasses import replace

import pytest

from conftest import Book, day, months
from fulluse.operators import checks
from fulluse.plans.params import Params
from fulluse.plans.pipeline import Models
from fulluse.plans.storage import WorkFolder
from pyspark.sql import functions as F

FACT = "mart_customer_sku_month"


def cohort_book(spark) -> Book:
    """One spike-and-drop, one shelfware, one over-consuming and one steady customer."""
    book = Book(spark)
    book.sku("S", weights=(3, 1))
    grid = months("2024-01-01", 13)
    for cust, cohort in (("C1", "spike_drop"), ("C2", "shelfware"), ("C3", "overage"), ("C4", "ok")):
        book.customer(cust, cohort=cohort)
        contract = f"E-{cust}"
        book.contract(contract, cust, "S", "2023-07-01", "2025-06-30")
        for i, month in enumerate(grid):
            amount = {
                "spike_drop": 30.0 if i < 3 else 0.0,
                "shelfware": 0.0,
                "overage": 14.0,
                "ok": 3.0 if i == 12 else 6.0,
            }[cohort]
            if amount:
                book.used(contract, cust, "S", month, amount)
                book.active(contract, cust, "S", "S-F0", month)
    return book


@pytest.fixture(scope="module")
def models(spark):
    params = replace(Params(), portfolio_bounds=(1.0, 1e6))
    return Models(cohort_book(spark).raw(), params, WorkFolder(spark, "test").keep)


def verdict(df):
    return {r["check_name"]: r for r in df.collect()}


@pytest.mark.parametrize(
    "name",
    [
        "dq_shelfware_scores_zero",
        "dq_shelfware_never_null",
        "dq_spike_decay",
        "dq_rate_le_one",
        "dq_overage_flagged",
        "dq_unlimited_coverage_only",
        "dq_gap_not_scored",
        "dq_incomplete_last_only",
        "dq_spine_unique",
        "dq_zero_fill_happened",
        "dq_value_split_reconcile",
        "dq_customer_rollup",
        "dq_portfolio_plausible",
        "dq_recovery_complete_only",
        "dq_recovery_has_negative",
        "dq_recovery_reconciles",
        "dq_shelfware_zero_usage",
        "dq_overage_ratio",
        "dq_core_feature_per_product",
        "dq_orphan_fk:entitlements.cust_id",
        "dq_pk_unique:customers",
        "dq_expansion_denominator",
    ],
)
def test_planted_cohorts_pass(models, name):
    row = verdict(checks.check(models, name.split(":")[0]))[name]
    assert row["passed"], row


def test_missing_things_fail_with_a_count(models):
    for name in ("dq_internal_exist", "dq_unlimited_exist", "dq_overlaps_exist", "dq_renewal_gaps"):
        row = verdict(checks.check(models, name))[name]
        assert (row["violations"], row["observed"], row["passed"]) == (1, 0.0, False)


def test_one_commercial_model_is_not_enough(models):
    row = verdict(checks.check(models, "dq_models_covered"))["dq_models_covered"]
    assert not row["passed"] and row["observed"] == 1.0


@pytest.mark.parametrize(
    ("name", "column", "value"),
    [
        ("dq_rate_le_one", "consumption_rate", "1.5D"),
        ("dq_coverage_le_one", "feature_coverage", "1.01D"),
        ("dq_shelfware_never_null", "vrr", "cast(null as double)"),
        ("dq_rates_unit_interval", "vrr", "-0.1D"),
        ("dq_value_split_reconcile", "realized_value_usd", "1e6D"),
        ("dq_no_internal", "cust_name", "'INTERNAL test'"),
        ("dq_factors_not_null", "feature_coverage", "cast(null as double)"),
        ("dq_deploying_null", "flag_deploying", "vrr = 0"),
        ("dq_unlimited_coverage_only", "flag_unlimited", "true"),
    ],
)
def test_a_fault_in_the_base_fact_is_counted(models, name, column, value):
    broken = models[FACT].withColumn(column, F.expr(value))
    rules = checks.only(checks.fact_rules(Params()), name)
    row = checks.evaluate(broken, rules).collect()[0]
    assert row["violations"] > 0 and not row["passed"]


def test_scored_month_in_a_gap_is_found(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-03-31")
    book.contract("E2", "C1", "S", "2024-08-01", "2024-12-31")
    book.window("2024-01-01", 12)
    models = book.models()
    stray = models[FACT].limit(1).withColumn("month", F.lit(day("2024-05-01")))
    rows = models[FACT].unionByName(stray)
    row = checks.gap_not_scored(rows, models["entitlements"], Params()).collect()[0]
    assert (row["violations"], row["passed"]) == (1, False)


def test_orphans_and_repeated_keys_are_counted(book):
    book.customer("C1")
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C9", "S", "2024-01-01", "2024-03-31")
    book.window("2024-01-01", 2)
    models = book.models()
    orphans = verdict(checks.check(models, "dq_orphan_fk"))
    assert orphans["dq_orphan_fk:entitlements.cust_id"]["violations"] == 1
    assert orphans["dq_orphan_fk:consumption_monthly.entitlement_id"]["violations"] == 2
    assert verdict(checks.check(models, "dq_pk_unique"))["dq_pk_unique:customers"]["violations"] == 1


def test_wrong_rate_for_dollars_is_counted(book):
    book.contract("E1", "C1", "S", "2024-01-01", "2024-03-31", currency="USD", fx=1.1)
    book.contract("E2", "C1", "S", "2024-01-01", "2024-03-31", currency="EUR", fx=1.0)
    book.contract("E3", "C1", "S", "2024-01-01", "2024-03-31", currency="EUR", fx=1.1)
    assert verdict(checks.check(book.models(), "dq_all_usd"))["dq_all_usd"]["violations"] == 2
