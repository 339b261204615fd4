"""What travels: steps that once sent more rows, or wider ones, through an exchange than they need."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import day
from fulluse.operators import audit, checks, marts, staging
from fulluse.plans import increment, registry, storage
from fulluse.plans.pipeline import Models
from fulluse.sources import tables
from fulluse.sources.adapter import AdaptedTables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


def activity_book(book):
    book.customer("C1")
    book.sku("S1", price=12.0, weights=(3, 2, 1))
    book.contract("E1", "C1", "S1", "2000-01-01", "2000-03-31")
    book.window("2000-01-01", 3)
    for _ in range(3):
        book.active("E1", "C1", "S1", "S1-F0", day("2000-01-01"))
    book.active("E1", "C1", "S1", "S1-F1", day("2000-02-01"), active=None, events=None)
    book.active("E1", "C1", "S1", "S1-F9", day("2000-02-01"))
    return book


def test_activity_grid_unfolds_after_its_layout(book):
    """names, copies and idle features pass no exchange, also when rows are laid by month."""
    t = Models(activity_book(book).raw())
    grid = staging.feature_activity(
        t["stg_entitlement_month"], t["stg_entitlements"], t.window(), t["features"],
        t["feature_adoption_monthly"], together=storage.BY_MONTH,
    )
    lines = plan(grid).splitlines()
    unfolds = next(i for i, line in enumerate(lines) if "Generate explode(filter(" in line)
    laid = next(i for i, line in enumerate(lines) if "REBALANCE_PARTITIONS_BY_COL" in line)
    assert unfolds < laid
    found = {(str(r["month"]), r["feature_id"], r["is_active"], r["usage_events"]): r["n"] for r in
             grid.groupBy("month", "feature_id", "is_active", "usage_events").agg(F.count("*").alias("n")).collect()}
    january = {("2000-01-01", "S1-F0", True, 5): 3, ("2000-01-01", "S1-F1", False, 0): 1, ("2000-01-01", "S1-F2", False, 0): 1}
    rest = {(m, f"S1-F{k}", False, 0): 1 for m in ("2000-02-01", "2000-03-01") for k in range(3)}
    assert found == january | rest


def test_rows_are_sorted_where_they_are(spark):
    df = spark.range(0, 100, 1, 2).select((100 - F.col("id")).alias("month"))
    rows = storage.arranged(df, (), ("month",))
    assert "Sort [month" in plan(rows) and "Exchange" not in plan(rows)


def adapted(spark, folder):
    """Two suppliers, one with a dormant account, on two part types with two size classes, over some months."""
    def put(name, schema, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    put("region", "r_regionkey int, r_name string", [(0, "R")])
    put("nation", "n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)])
    put("supplier", "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        [(k, f"S{k}", 0, 5000.0) for k in (7, 12)])
    put("part", "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double",
        [(1, "a", "PROMO", 4, 10.0), (2, "b", "PROMO", 5, 11.0), (3, "c", "SMALL", 4, 12.0)])
    items = [(7, 1, "1997-02-03", 10.0), (7, 2, "1997-02-20", 30.0), (7, 1, "1997-03-01", 26.0), (7, 1, "1998-05-05", 3.0),
             (12, 3, "1997-07-01", 25.0), (12, 3, "1997-07-01", 5.0), (12, 2, "1999-01-31", 1.0), (None, 1, "1997-01-01", 2.0)]
    put("lineitem", "l_suppkey long, l_partkey long, l_shipdate timestamp, l_quantity double",
        [(s, p, dt.datetime.fromisoformat(d), q) for s, p, d, q in items])
    made = []
    return AdaptedTables(spark, folder, lambda name, df: made.append(name) or storage.replace_table(df, f"{folder}/kept/{name}")), made


def test_contract_months_do_not_travel_to_their_usage(spark, tmp_path):
    """Each raw table is derived once, contracts meet usage by customer and SKU."""
    t, made = adapted(spark, str(tmp_path))
    for name in t:
        t[name]
    assert {"products", "features", "customers", "booked"} <= set(made) and len(made) == len(set(made))
    assert not [line for line in exchanges(t._booked()) if "cust_id" in line and "month" in line]
    assert not [line for line in exchanges(t._deployment_events()) if "month" in line]
    assert not exchanges(t._consumption_monthly()) and not exchanges(t._feature_adoption_monthly())
    used = {(r["cust_id"], r["product_id"], str(r["month"])): (r["entitlement_id"], r["consumed_units"])
            for r in t["consumption_monthly"].collect()}
    assert used[("7", "PROMO", "1997-02-01")] == ("7-PROMO-1997-B", 40.0)
    assert used[("12", "SMALL", "1997-07-01")] == ("12-SMALL-1997-B", 30.0)
    steps = {(r["entitlement_id"], r["event_type"]): str(r["event_date"]) for r in t["deployment_events"].collect()}
    assert steps[("7-PROMO-1997-B", "first_value")] == "1997-02-20" and steps[("7-PROMO-1997-B", "core_complete")] == "1997-02-03"
    assert ("7-PROMO-1998-B", "first_value") not in steps and steps[("7-PROMO-1998-B", "core_complete")] == "1998-05-05"


def test_customer_rollup_has_one_exchange(book):
    """F8: the distinct count of SKUs is taken in the exchange of the sums."""
    t = Models(activity_book(book).raw())
    fact = t["mart_customer_sku_month"].localCheckpoint()
    rollup = marts.customer_adoption(fact)
    assert len(exchanges(rollup)) == 1
    assert [r["skus_held"] for r in rollup.collect()] == [1, 1, 1]


def test_gaps_and_capacity_move_contracts_and_not_their_months(book):
    """a contract loaded twice counts once, and no exchange carries a month of it."""
    book.customer("C1")
    book.sku("S1", price=12.0)
    for contract, first, last in (("E1", "2000-01-01", "2000-02-29"), ("E1", "2000-01-01", "2000-02-29"), ("E2", "2000-05-01", "2000-05-31")):
        book.contract(contract, "C1", "S1", first, last)
    book.window("2000-01-01", 6)
    t = Models(book.raw())
    gaps = audit.CLEANING["gap_months"](t, None)
    assert not [line for line in exchanges(gaps) if "month" in line]
    assert [r["rows_removed"] for r in gaps.collect()] == [2]
    held = checks.capacity_months(t["stg_entitlements"], t.window())
    assert not [line for line in exchanges(held) if "month" in line.split("licensed_amount")[0]]
    assert [(str(r["month"]), r["licensed_amount_month"]) for r in held.orderBy("month").collect()] == [
        ("2000-01-01", 10.0), ("2000-02-01", 10.0), ("2000-05-01", 10.0)]


def test_refresh_makes_the_fact_once_in_its_store(spark, tmp_path):
    """the refreshed fact equals the session's, which is not built for it."""
    raw, _ = adapted(spark, str(tmp_path))
    t = Models(raw, registry.ADAPTED)
    found = registry.month_refresh(t)
    assert registry.FACT not in t._built and "stg_consumption" not in t._built
    fact = t[registry.FACT]
    assert found.columns == fact.columns and found.count() == fact.count() > 0
    assert found.exceptAll(fact).count() == 0


def test_usage_meets_contracts_without_an_exchange_before_it(spark, tmp_path):
    """months of usage and days of milestones are made in the exchange by customer and SKU."""
    t, _ = adapted(spark, str(tmp_path))
    t.usage()
    t["entitlements"]
    assert len(exchanges(t._booked())) == 1
    assert len([line for line in exchanges(t._deployment_events()) if "product_id" in line and "entitlement_id" not in line]) == 1
    events = {(r["cust_id"], r["feature_id"], str(r["month"])): r["usage_events"] for r in t["feature_adoption_monthly"].collect()}
    assert events[("12", "SMALL-0", "1997-07-01")] == 2 and events[("7", "PROMO-1", "1997-02-01")] == 1


def test_summary_and_grid_read_their_rows_once(book):
    """no row of the fact is copied for a distinct count, and combined records are one exchange."""
    t = Models(activity_book(book).raw())
    fact = t["mart_customer_sku_month"].localCheckpoint()
    summary = marts.exec_summary(fact)
    assert "Expand" not in plan(summary)
    assert [(r["customers"], r["skus"]) for r in summary.collect()] == [(1, 1)] * 3
    unknown = fact.withColumns({"cust_id": F.lit(None).cast("string"), "month": F.lit(None).cast("date")})
    assert [(r["month"], r["customers"], r["skus"]) for r in marts.exec_summary(unknown).collect()] == [(None, 0, 1)]
    spark = fact.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(t["stg_feature_activity"]).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    combined = [line for line in lines if "Exchange hashpartitioning(entitlement_id" in line and "usage_events" in line]
    assert len(combined) == 2 and len([line for line in combined if "ReusedExchange" in line]) == 1


def test_store_lays_its_grid_before_it_unfolds(spark, book, tmp_path, monkeypatch):
    """F2, incremental_month_refresh: neither the build nor the refresh sends rows of the unfolded grid through an exchange."""
    seen, real = [], storage.arranged

    def watched(df, together, within=()):
        rows = real(df, together, within)
        if "feature_tier" in rows.columns and "entitlement_id" in rows.columns:
            seen.append(plan(rows).splitlines())
        return rows

    monkeypatch.setattr(storage, "arranged", watched)
    raw = tables.land(activity_book(book).raw(), str(tmp_path / "raw"))
    store = increment.Store(spark, str(tmp_path / "store"))
    store.build(raw)
    later = {**raw, "feature_adoption_monthly": raw["feature_adoption_monthly"].filter("month <> '2000-02-01' or feature_id = 'S1-F9'")}
    store.refresh(later)
    assert len(seen) == 2
    for lines in seen:
        unfolds = next(i for i, line in enumerate(lines) if "Generate explode(filter(" in line)
        assert not [line for line in lines[:unfolds] if "Exchange" in line]
    grid = Models(later)["stg_feature_activity"]
    found = store.read("stg_feature_activity", grid)
    assert found.count() == grid.count() and not found.exceptAll(grid).count()
