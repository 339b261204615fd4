from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest

from conftest import Book, day, months
from fulluse.operators import audit, insights, planned
from fulluse.plans import pipeline
from fulluse.plans.params import Params
from fulluse.plans.pipeline import MODELS
from pyspark.sql import functions as F

P = Params()


def accounts(spark, *rows):
    """Customer-month rows with only the columns that a test cares about filled in."""
    filled = []
    for i, row in enumerate(rows):
        base = {
            "cust_id": f"C{i}",
            "cust_name": f"Customer {i}",
            "segment": "Enterprise",
            "region": "EU",
            "account_owner": "A",
            "month": day("2024-05-01"),
            "skus_held": 2,
            "skus_shelfware": 0,
            "skus_spike_drop": 0,
            "skus_overage": 0,
            "skus_deploying": 0,
            "vrr_value_weighted": 0.5,
            "consumption_rate": 0.5,
            "feature_coverage": 0.5,
            "licensed_value_usd": 100.0,
            "value_at_risk_usd": 50.0,
            "is_incomplete": False,
        }
        filled.append(tuple({**base, **row}.values()))
    return spark.createDataFrame(
        filled,
        "cust_id string, cust_name string, segment string, region string, account_owner string, "
        "month date, skus_held long, skus_shelfware long, skus_spike_drop long, skus_overage long, "
        "skus_deploying long, vrr_value_weighted double, consumption_rate double, "
        "feature_coverage double, licensed_value_usd double, value_at_risk_usd double, "
        "is_incomplete boolean",
    )


def test_status_follows_priority(spark):
    rows = accounts(
        spark,
        {"skus_deploying": 2, "skus_shelfware": 1},
        {"skus_shelfware": 1, "skus_overage": 1},
        {"skus_spike_drop": 1, "skus_overage": 1},
        {"skus_overage": 1},
        {"vrr_value_weighted": 0.5},
        {"vrr_value_weighted": 0.25},
        {"vrr_value_weighted": None},
    )
    got = [r["status"] for r in insights.customer_status(rows, P).orderBy("cust_id").collect()]
    assert got == [
        "Too new to score",
        "Paying, not using",
        "Used it, then stopped",
        "Using more than they bought",
        "Healthy",
        "Partly deployed",
        "Barely deployed",
    ]


def test_quadrant_edge_counts_as_high_and_empty_boxes_stay(spark):
    rows = accounts(
        spark,
        {"feature_coverage": 0.5, "consumption_rate": 0.5},
        {"feature_coverage": 0.49, "consumption_rate": 0.9},
        {"feature_coverage": None},
        {"month": day("2024-06-01"), "is_incomplete": True},
    )
    placed = insights.quadrant_accounts(rows, P)
    assert {r["cust_name"]: r["quadrant"] for r in placed.collect()} == {
        "Customer 0": "value",
        "Customer 1": "hot",
    }
    boxes = insights.quadrant_summary(placed).collect()
    assert [(r["quadrant"], r["accounts"]) for r in boxes] == [
        ("value", 1),
        ("scaled", 0),
        ("hot", 1),
        ("stalled", 0),
    ]
    higher = insights.quadrant_accounts(rows, replace(P, split=0.6))
    assert {r["quadrant"] for r in higher.collect()} == {"stalled", "hot"}


def test_worklist_filters_and_headline(spark):
    rows = accounts(
        spark,
        {"value_at_risk_usd": 10.0, "skus_shelfware": 1},
        {"value_at_risk_usd": 90.0, "skus_shelfware": 1},
        {"value_at_risk_usd": 70.0},
        {"value_at_risk_usd": 80.0, "segment": "Mid-Market", "skus_shelfware": 1},
    )
    month = F.lit(day("2024-05-01"))
    full = insights.customer_worklist(rows, month, P)
    assert [r["var_usd"] for r in full.collect()] == [1080.0, 960.0, 840.0, 120.0]
    risky = insights.customer_worklist(rows, month, P, "Enterprise", needs_attention=True)
    assert [r["cust_name"] for r in risky.collect()] == ["Customer 1", "Customer 0"]
    head = insights.worklist_headline(full).collect()[0]
    assert (head["accounts"], head["var_usd"], head["vrr_mean"]) == (4, 3000.0, 0.5)


@pytest.mark.parametrize(("weighted", "finding"), [(0.3, "below"), (0.7, "above"), (0.505, "even")])
def test_weighted_gap_has_a_dead_band(spark, weighted, finding):
    row = [(day("2024-05-01"), weighted, 0.5, False)]
    summary = spark.createDataFrame(
        row, "month date, vrr_value_weighted double, vrr_unweighted double, is_incomplete boolean"
    )
    assert insights.weighted_gap(summary, P).collect()[0]["finding"] == finding


def test_depth_counts_a_feature_once_over_overlapping_contracts(spark):
    may = day("2024-05-01")
    rows = [
        ("C1", "S", "F0", "Core", may, False),
        ("C1", "S", "F0", "Core", may, True),
        ("C1", "S", "F1", "Adjacent", may, True),
        ("C2", "S", "F0", "Core", may, False),
        ("C2", "S", "F1", "Adjacent", may, True),
    ]
    activity = spark.createDataFrame(
        rows,
        "cust_id string, product_id string, feature_id string, feature_tier string, month date, "
        "is_active boolean",
    )
    depth = insights.feature_depth(activity, F.lit(may))
    assert [tuple(r) for r in depth.collect()] == [(1, False, 1), (2, True, 1)]
    kpis = insights.feature_depth_kpis(depth).collect()[0]
    assert (kpis["shallow_share"], kpis["no_core_share"], kpis["full_share"]) == (0.5, 0.5, 0.5)
    pivot = insights.feature_depth_pivot(depth).collect()
    assert [tuple(r) for r in pivot] == [(1, 0, 1), (2, 1, 0)]


def test_overview_compares_the_two_newest_complete_months(spark):
    rows = [
        (day("2024-03-01"), 0.2, 10.0, 1, 1, False),
        (day("2024-04-01"), 0.4, 20.0, 2, 1, False),
        (day("2024-05-01"), 0.9, 30.0, 3, 1, True),
    ]
    summary = spark.createDataFrame(
        rows,
        "month date, vrr_value_weighted double, annualized_var_usd double, n_shelfware long, "
        "n_overage long, is_incomplete boolean",
    )
    row = insights.overview_kpis(summary).collect()[0]
    assert row["month"] == day("2024-04-01")
    assert row["vrr_change"] == pytest.approx(0.2)
    assert row["vrr_mean"] == pytest.approx(0.3)
    assert row["n_shelfware"] == 2


def test_overage_must_last_to_be_sustained(spark):
    grid = months("2024-01-01", 8)
    ratios = [1.3, 1.2, 1.25, 1.0, 1.3, 1.3, 1.3, 1.3]
    rates = spark.createDataFrame(
        [("C", "S", m, r) for m, r in zip(grid, ratios) if m != grid[5]],
        "cust_id string, product_id string, month date, overage_ratio double",
    )
    rows = planned.overage_sustained(rates, P).orderBy("month").collect()
    assert [r["run_months"] for r in rows] == [1, 2, 3, 1, 1, 2]
    assert [r["overage_sustained"] for r in rows] == [False, False, True, False, False, False]


def test_capacity_on_the_last_day_ignores_contracts_that_ended_earlier(book):
    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-02-10")
    book.window("2024-01-01", 3)
    models = book.models()
    held = planned.capacity_asof(models["stg_entitlement_month"]).collect()
    assert [r["month"] for r in held] == [day("2024-01-01")]


def test_recovery_counts_only_when_it_holds(spark):
    quarters = [day(f"2024-{m}-01") for m in ("01", "04", "07")]
    rows = spark.createDataFrame(
        [("A", quarters[0], 50.0, 60.0), ("A", quarters[1], -20.0, 80.0), ("A", quarters[2], 30.0, 50.0)],
        "account_owner string, quarter date, value_recovered_usd double, closing_var_usd double",
    )
    got = planned.sustained_recovery(rows).orderBy("quarter").collect()
    assert [r["is_sustained"] for r in got] == [False, True, None]
    assert [r["sustained_recovered_usd"] for r in got] == [0.0, -20.0, None]


def pipeline_book(spark) -> Book:
    book = Book(spark)
    book.customer("C1")
    book.customer("C2", internal=True)
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-06-15", currency="EUR", fx=1.1)
    book.contract("E2", "C1", "S", "2024-09-10", "2025-06-30", licensed=None, unlimited=True)
    book.window("2024-01-01", 12)
    january = day("2024-01-01")
    book.used("E1", "C1", "S", january, 5.0)
    book.used("E1", "C1", "S", january, 6.0)
    book.active("E1", "C1", "S", "S-F0", january)
    book.active("E1", "C1", "S", "ELSE", january)
    return book


def test_run_writes_every_model_and_appends_its_audit(spark, tmp_path):
    raw, folder = pipeline_book(spark).raw(), str(tmp_path / "marts")
    for hour in (1, 2):
        result = pipeline.run(raw, folder, dt.datetime(2024, 12, 31, hour))
    history = spark.read.parquet(f"{folder}/pipeline_audit")
    assert history.count() == 2 * (len(MODELS) + 12)
    runs = [r["run_id"] for r in audit.run_history(history).collect()]
    assert runs == ["20241231020000", "20241231010000"]

    log = audit.latest_run(history)
    built = {r["model"]: r for r in audit.built_view(log).collect()}
    assert list(built) == sorted(MODELS)
    for name in MODELS:
        assert spark.read.parquet(f"{folder}/{name}").count() == built[name]["row_count"]
        assert built[name]["runtime"].endswith("s")

    rows = {r["action"]: r for r in audit.cleaning_view(log).collect()}
    assert (rows["dedupe"]["rows_in"], rows["dedupe"]["rows_out"]) == (14, 13)
    assert rows["exclude internal"]["rows_removed"] == 1
    assert rows["drop unentitled"]["rows_removed"] == 1
    assert rows["exclude gap months"]["rows_removed"] == 2
    assert rows["zero-fill"]["rows_removed"] == -9
    assert rows["convert currency"]["note"].startswith("1 contracts")
    assert rows["mark incomplete"]["note"] == "2024-12 still loading"

    strip = insights.trust_strip(log, result.models["mart_exec_summary"]).collect()[0]
    assert tuple(strip) == (1, 1, 1, day("2024-11-01"))


def test_refresh_equals_a_full_run_after_added_changed_and_removed_input(spark, tmp_path):
    kept, whole = str(tmp_path / "kept"), str(tmp_path / "whole")
    book = pipeline_book(spark)
    pipeline.run(book.raw(), kept, dt.datetime(2024, 12, 31))
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "kept/mart_customer_sku_month").glob("month=2024-05*/*.parquet")}
    book.used("E1", "C1", "S", day("2024-02-01"), 1.0)
    book.used("E2", "C1", "S", day("2024-11-01"), 2.0)
    book.window("2025-01-01", 1)
    raw = book.raw()
    changed = dict(raw)
    for step in range(2):
        if step:  # contracts are cut back, so the last months hold nothing
            cut = F.least("end_date", F.lit("2024-09-30").cast("date"))
            changed["entitlements"] = raw["entitlements"].withColumn("end_date", cut).filter("start_date <= end_date")
        pipeline.refresh(changed, kept)
        pipeline.run(changed, whole, dt.datetime(2024, 12, 31))
        for name in MODELS:
            a, b = spark.read.parquet(f"{kept}/{name}"), spark.read.parquet(f"{whole}/{name}")
            assert sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(
                map(repr, b.select(*sorted(b.columns)).collect())
            ), (step, name)
        if not step:
            assert untouched == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "kept/mart_customer_sku_month").glob("month=2024-05*/*.parquet")}


def test_idle_features_of_one_of_two_customers_with_a_name(spark):
    activity = spark.createDataFrame(
        [(c, "S", f"F{n}", f"f{n}", "Core", 3, day("2024-01-01"), False) for c, k in (("A", 2), ("B", 50)) for n in range(k)],
        "cust_id string, product_id string, feature_id string, feature_name string, feature_tier string, "
        "feature_value_weight long, month date, is_active boolean",
    )
    contracts = spark.createDataFrame([("S", "S name")], "product_id string, product_name string")
    def idle(cust, **cut):
        return insights.unused_features(activity, contracts, F.lit(cust), F.lit(day("2024-01-01")), **cut)

    assert (idle("A").count(), idle("B").count()) == (2, 40)
    assert insights.unused_summary(idle("B", top=None)).collect()[0]["features"] == 50
