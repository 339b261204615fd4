"""Hand-written books with hand-computed answers, one per rule of the models."""

from __future__ import annotations

import pytest

from conftest import day, months
from pyspark.sql import functions as F

FACT = "mart_customer_sku_month"


def facts(models, cust="C1"):
    rows = models[FACT].filter(F.col("cust_id") == cust).orderBy("product_id", "month").collect()
    return {row["month"]: row for row in rows}


def test_worked_account(book):
    book.customer("C1")
    book.sku("S", price=100_000.0, weights=(3, 3, 2, 1))
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31", units=1, licensed=10_000_000.0)
    book.window("2024-01-01", 7)
    june = day("2024-06-01")
    book.used("E1", "C1", "S", june, 667_000.0)
    book.active("E1", "C1", "S", "S-F0", june)
    row = facts(book.models())[june]
    assert row["feature_coverage"] == pytest.approx(3 / 9)
    assert row["consumption_rate"] == pytest.approx(0.8004)
    assert row["vrr"] == pytest.approx(0.2668)
    assert row["licensed_value_usd"] == pytest.approx(8333.33, abs=0.01)
    assert row["realized_value_usd"] == pytest.approx(2223.3, abs=0.1)
    assert row["value_at_risk_usd"] == pytest.approx(6110.0, abs=0.1)


def test_spike_then_drop_is_flagged_from_month_five(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    book.window("2024-01-01", 12)
    for month in months("2024-01-01", 3):
        book.used("E1", "C1", "S", month, 36.0)
    rows = facts(book.models())
    flags = [rows[month]["flag_spike_drop"] for month in months("2024-01-01", 12)]
    assert flags == [False] * 4 + [True] * 8


def test_shelfware_is_null_while_deploying_then_zero(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    book.window("2024-01-01", 6)
    models = book.models()
    rows = facts(models)
    ordered = [rows[month] for month in months("2024-01-01", 6)]
    assert [r["days_since_start"] for r in ordered[:3]] == [30, 59, 90]
    assert [r["vrr"] for r in ordered] == [None, None, 0.0, 0.0, 0.0, 0.0]
    assert [r["flag_shelfware"] for r in ordered] == [False, False, True, True, True, True]
    assert ordered[0]["value_at_risk_usd"] == ordered[0]["licensed_value_usd"]
    assert models["stg_consumption"].filter("was_zero_filled").count() == 6


def test_overage_is_capped_and_kept(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    for month in months("2024-01-01", 5):
        book.used("E1", "C1", "S", month, 13.0)
    for row in facts(book.models()).values():
        assert row["consumption_rate"] == 1.0
        assert row["overage_ratio"] == pytest.approx(1.3)
        assert row["flag_chronic_overage"]


def test_expansion_adds_capacity_once_and_does_not_restart_deployment(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31", units=10, licensed=120.0)
    book.contract("E2", "C1", "S", "2024-07-01", "2025-06-30", units=20, licensed=240.0)
    book.window("2024-01-01", 12)
    models = book.models()
    rows = facts(models)
    assert rows[day("2024-06-01")]["licensed_amount_month"] == 10.0
    assert rows[day("2024-07-01")]["licensed_amount_month"] == 30.0
    assert not rows[day("2024-07-01")]["flag_deploying"]
    assert rows[day("2024-07-01")]["entitled_features"] == 6
    assert models[FACT].count() == 12


@pytest.mark.parametrize(("start", "deploying"), [("2024-01-02", True), ("2024-01-01", False)])
def test_deployment_ends_at_ninety_days(book, start, deploying):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", start, "2024-12-31")
    book.window("2024-01-01", 4)
    row = facts(book.models())[day("2024-03-01")]
    assert row["days_since_start"] == (89 if deploying else 90)
    assert row["flag_deploying"] is deploying
    assert (row["vrr"] is None) is deploying
    assert row["value_at_risk_usd"] == row["licensed_value_usd"]


def test_repeated_usage_keeps_the_larger_amount(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    january = day("2024-01-01")
    book.used("E1", "C1", "S", january, 4.0)
    book.used("E1", "C1", "S", january, 7.0)
    row = book.models()["stg_consumption"].collect()[0]
    assert (row["consumed_units"], row["was_zero_filled"]) == (7.0, False)


def test_unlimited_contract_scores_the_whole_group_on_coverage(book):
    book.customer("C1")
    book.sku("S", weights=(3, 1))
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31", licensed=None, unlimited=True)
    book.contract("E2", "C1", "S", "2024-01-01", "2024-12-31")
    book.window("2024-01-01", 6)
    may = day("2024-05-01")
    book.used("E2", "C1", "S", may, 50.0)
    book.active("E2", "C1", "S", "S-F0", may)
    row = facts(book.models())[may]
    assert row["flag_unlimited"]
    assert row["consumption_rate"] is None and row["overage_ratio"] is None
    assert row["vrr"] == row["feature_coverage"] == pytest.approx(3 / 8)


@pytest.mark.parametrize("licensed", [0.0, None])
def test_missing_denominator_is_not_a_full_score(book, licensed):
    book.customer("C1")
    book.sku("S", weights=(3,))
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31", licensed=licensed)
    book.window("2024-01-01", 6)
    may = day("2024-05-01")
    book.used("E1", "C1", "S", may, 5.0)
    book.active("E1", "C1", "S", "S-F0", may)
    row = facts(book.models())[may]
    assert row["consumption_rate"] is None
    assert row["vrr"] == 0.0


def test_activity_on_a_foreign_feature_is_dropped(book):
    book.customer("C1")
    book.sku("S")
    book.sku("OTHER")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    book.window("2024-01-01", 1)
    january = day("2024-01-01")
    for feature in ("S-F0", "S-F1", "S-F2", "OTHER-F0"):
        book.active("E1", "C1", "S", feature, january)
    models = book.models()
    assert models["stg_feature_activity"].count() == 3
    assert facts(models)[january]["feature_coverage"] == 1.0


def test_repeated_activity_counts_twice_and_coverage_stays_in_range(book):
    book.customer("C1")
    book.sku("S", weights=(3, 2, 1))
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    book.window("2024-01-01", 1)
    january = day("2024-01-01")
    book.active("E1", "C1", "S", "S-F1", january)
    book.active("E1", "C1", "S", "S-F1", january, active=False)
    models = book.models()
    assert models["stg_feature_activity"].count() == 4
    row = facts(models)[january]
    assert (row["active_weight"], row["entitled_weight"]) == (2, 8)
    assert (row["active_features"], row["entitled_features"]) == (1, 4)


def test_gap_months_have_no_row(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-06-15")
    book.contract("E2", "C1", "S", "2024-09-10", "2025-06-30")
    book.window("2024-01-01", 12)
    held = set(facts(book.models()))
    assert held == set(months("2024-01-01", 12)) - {day("2024-07-01"), day("2024-08-01")}


def test_contract_is_active_in_partial_months_and_clipped_to_the_window(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2023-06-20", "2024-03-01")
    book.contract("E2", "C1", "S", "2024-05-31", "2030-01-01")
    book.contract("E3", "C1", "S", "2024-04-20", "2024-04-10")
    book.contract("E4", "C1", "S", "2031-01-01", "2031-12-31")
    book.window("2024-01-01", 6)
    spine = book.models()["stg_entitlement_month"].select("entitlement_id", "month").collect()
    got = sorted((r[0], r[1]) for r in spine)
    assert got == [
        ("E1", day("2024-01-01")),
        ("E1", day("2024-02-01")),
        ("E1", day("2024-03-01")),
        ("E2", day("2024-05-01")),
        ("E2", day("2024-06-01")),
        ("E3", day("2024-04-01")),
    ]


def test_no_usage_at_all_gives_no_spine(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31")
    assert book.models()["stg_entitlement_month"].count() == 0


def test_internal_and_unknown_tenants_are_absent(book):
    for cust, internal in (("C1", False), ("C2", True), ("C3", None)):
        book.customer(cust, internal)
        book.contract(f"E-{cust}", cust, "S", "2024-01-01", "2024-12-31")
    book.sku("S")
    book.window("2024-01-01", 2)
    models = book.models()
    assert [r["cust_id"] for r in models["stg_customers"].collect()] == ["C1"]
    assert {r["cust_id"] for r in models[FACT].collect()} == {"C1"}


@pytest.mark.parametrize(("currency", "fx"), [("EUR", 1.09), ("GBP", 1.27)])
def test_money_is_in_dollars_and_twelve_months_add_up(book, currency, fx):
    book.customer("C1")
    book.sku("S", price=30.0)
    book.contract("E1", "C1", "S", "2024-01-01", "2024-12-31", units=7, currency=currency, fx=fx)
    book.window("2024-01-01", 12)
    total = book.models()[FACT].agg(F.sum("licensed_value_usd")).collect()[0][0]
    assert total == pytest.approx(7 * 30 * fx)


def test_only_the_last_month_is_incomplete_and_its_quarter_is_unpaid(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2023-01-01", "2025-12-31")
    book.window("2024-01-01", 8)
    models = book.models()
    late = [m for m, r in sorted(facts(models).items()) if r["is_incomplete"]]
    assert late == [day("2024-08-01")]
    quarters = [r["quarter"] for r in models["mart_owner_recovery"].collect()]
    assert quarters == [day("2024-04-01")]


def test_recovery_is_signed_and_scaled(book):
    book.customer("C1")
    book.sku("S", price=12.0, weights=(3,))
    book.contract("E1", "C1", "S", "2023-01-01", "2025-12-31", units=100, licensed=120.0)
    book.window("2024-01-01", 10)
    for month in months("2024-01-01", 3) + months("2024-07-01", 3):
        book.used("E1", "C1", "S", month, 5.0)
        book.active("E1", "C1", "S", "S-F0", month)
    rows = book.models()["mart_owner_recovery"].orderBy("quarter").collect()
    assert [r["value_recovered_usd"] for r in rows] == [-1800.0, 1800.0]
    assert [r["opening_var_usd"] for r in rows] == [1800.0, 3600.0]
    assert rows[1]["quota_usd"] == pytest.approx(540.0)
    assert rows[1]["quota_attainment"] == pytest.approx(1800 / 540)
    assert all(r["quarter_is_complete"] for r in rows)


def test_days_to_first_value_and_core(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-10", "2024-12-31")
    book.event("E1", "C1", "S", "first_value", "2024-02-09")
    book.event("E1", "C1", "S", "first_value", "2024-03-09")
    book.event("E1", "C1", "S", "core_complete", "2024-01-15")
    book.window("2024-01-01", 2)
    row = book.models()["int_deployment"].orderBy("month").collect()[0]
    assert (row["ttfv_days"], row["core_complete_days"], row["days_since_start"]) == (30, 5, 21)


def test_rollups_keep_weighted_and_plain_means_apart(book):
    book.customer("C1")
    book.sku("BIG", price=1200.0, weights=(3,))
    book.sku("SMALL", price=12.0, weights=(3,))
    book.window("2024-01-01", 6)
    may = day("2024-05-01")
    for sku, units in (("BIG", 10.0), ("SMALL", 2.0)):
        book.contract(f"E-{sku}", "C1", sku, "2024-01-01", "2024-12-31", units=1)
        book.used(f"E-{sku}", "C1", sku, may, units)
        book.active(f"E-{sku}", "C1", sku, f"{sku}-F0", may)
    row = book.models()["mart_customer_adoption"].filter(F.col("month") == may).collect()[0]
    assert row["skus_held"] == 2
    assert row["vrr_unweighted"] == pytest.approx(0.6)
    assert row["vrr_value_weighted"] == pytest.approx((100 + 0.2) / 101)


def test_feature_adoption_counts_customers(book):
    book.sku("S", weights=(3, 1))
    book.window("2024-01-01", 1)
    january = day("2024-01-01")
    for cust in ("C1", "C2", "C3"):
        book.customer(cust)
        book.contract(f"E-{cust}", cust, "S", "2024-01-01", "2024-12-31")
    book.active("E-C1", "C1", "S", "S-F0", january, events=4)
    book.active("E-C2", "C2", "S", "S-F0", january, active=False, events=3)
    rows = {r["feature_id"]: r for r in book.models()["mart_feature_adoption"].collect()}
    core, other = rows["S-F0"], rows["S-F1"]
    assert (core["customers_entitled"], core["customers_active"], core["usage_events"]) == (3, 1, 7)
    assert core["adoption_rate"] == pytest.approx(1 / 3)
    assert (other["customers_active"], other["adoption_rate"], other["usage_events"]) == (0, 0.0, 0)
