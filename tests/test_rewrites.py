"""The engine's rewrites against the row-by-row definitions, on random books and without broadcasts."""

from __future__ import annotations

import datetime as dt
import itertools
import random
import statistics
from dataclasses import replace

import pytest

from conftest import Book, day, months
from fulluse.operators import checks
from fulluse.plans.params import Params
from fulluse.plans.pipeline import Models
from fulluse.plans.storage import WorkFolder
from pyspark.sql import functions as F


def random_book(spark, seed: int) -> Book:
    """Hot contracts, repeats, overlaps, gaps, foreign features and open amounts."""
    rng = random.Random(seed)
    book = Book(spark)
    grid = months("2024-01-01", 8)
    book.window("2024-01-01", 8)
    for sku in ("S1", "S2"):
        book.sku(sku, price=rng.choice([7.0, 11.0]), weights=(3, 2, 1, 1))
    for cust in ("C1", "C2", "C3"):
        book.customer(cust, internal=cust == "C3", owner=rng.choice(["A", "B"]))
    for n in range(10):
        cust = rng.choice(["C1", "C1", "C2", "C3"])
        sku = rng.choice(["S1", "S1", "S2"])
        start = rng.choice(grid).replace(day=rng.choice([1, 15, 28]))
        end = rng.choice(months("2024-02-01", 14)).replace(day=rng.choice([1, 10, 27]))
        if end < start:
            start, end = end, start
        unlimited = rng.random() < 0.2
        amount = None if unlimited else rng.choice([0.0, 60.0, 120.0])
        contract = f"E{n}"
        book.contract(
            contract, cust, sku, start.isoformat(), end.isoformat(), rng.randint(1, 9), amount, unlimited
        )
        for month in grid:
            for _ in range(rng.choice([0, 1, 1, 5 if n == 0 else 2])):
                book.used(contract, cust, sku, month, float(rng.randint(0, 20)))
            for feature in (f"{sku}-F0", f"{sku}-F1", f"{sku}-F3", "S2-F2"):
                for _ in range(rng.choice([0, 1, 1, 6 if n == 0 else 1])):
                    book.active(
                        contract,
                        cust,
                        sku,
                        feature,
                        month,
                        rng.choice([True, False, None]),
                        rng.choice([None, 1, 4]),
                    )
    return book


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted(map(repr, left.select(*columns).collect()))
    b = sorted(map(repr, right.select(*columns).collect()))
    assert a == b


@pytest.fixture(scope="module", params=[1, 2])
def models(request, spark):
    raw = random_book(spark, request.param).raw()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Models(raw, Params(), WorkFolder(spark, "test").keep)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def naive_activity(models):
    spine = models["stg_entitlement_month"].select("entitlement_id", "cust_id", "product_id", "month")
    features = models["features"].drop("feature_description")
    records = models["feature_adoption_monthly"].select(
        "entitlement_id", "month", "feature_id", "is_active", "usage_events"
    )
    return (
        spine.join(features, "product_id")
        .join(records, ["entitlement_id", "month", "feature_id"], "left")
        .fillna({"is_active": False, "usage_events": 0})
    )


def test_feature_activity_is_the_filled_grid(models):
    same(models["stg_feature_activity"], naive_activity(models))


@pytest.mark.parametrize("features", [3, 64, 150])
def test_feature_activity_of_a_wide_catalogue(spark, features):
    """Several words of a SKU's bitmap, a repeated catalogue row, a contract loaded twice and one without records."""
    book = Book(spark)
    book.window("2024-01-01", 2)
    book.sku("S1", price=7.0, weights=(1,) * features)
    book.customer("C1", internal=False, owner="A")
    for contract in ("E1", "E1", "E2"):
        book.contract(contract, "C1", "S1", "2024-01-01", "2024-02-20", 5, 60.0, False)
    for n in {0, 1, features // 2, 63 % features, features - 1}:
        book.active("E1", "C1", "S1", f"S1-F{n}", day("2024-01-01"), True, 2)
    raw = book.raw()
    raw["features"] = raw["features"].union(raw["features"].filter("feature_id = 'S1-F1'"))
    models = Models(raw, Params())
    spine = models["stg_entitlement_month"].select("entitlement_id", "cust_id", "product_id", "month")
    records = raw["feature_adoption_monthly"].select("entitlement_id", "month", "feature_id", "is_active", "usage_events")
    grid = spine.join(raw["features"].drop("feature_description"), "product_id")
    key = ["entitlement_id", "month", "feature_id"]
    idle = grid.join(records, key, "left_anti")
    found = models["stg_feature_activity"]
    assert found.filter("not is_active").count() == idle.count()
    same(found.filter("not is_active").select(*key), idle.select(*key))
    assert found.count() == grid.join(records, key, "left").count()


def test_grid_rows_appear_after_the_last_exchange(models):
    text = Models(models.raw, Params(), window=models.window())["stg_feature_activity"]
    lines = text._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    spread = [i for i, line in enumerate(lines) if "Generate explode(filter(" in line]
    assert len(spread) == 1
    above, level = [], depth[spread[0]]
    for i in range(spread[0] - 1, -1, -1):
        if depth[i] < level:
            above, level = [*above, lines[i]], depth[i]
    assert above and not [line for line in above if "Exchange" in line]
    assert not [line for line in lines if "LeftAnti" in line]


def test_coverage_equals_the_sums_over_the_grid(models):
    weight = F.col("feature_value_weight")
    active = F.sum(F.when(F.col("is_active"), weight).otherwise(0))
    expected = (
        naive_activity(models)
        .groupBy("cust_id", "product_id", "month")
        .agg(
            active.alias("active_weight"),
            F.sum(weight).alias("entitled_weight"),
            F.count_if("is_active").alias("active_features"),
            F.count("*").alias("entitled_features"),
            (active / F.sum(weight)).alias("feature_coverage"),
        )
    )
    same(models["int_feature_coverage"], expected)


def test_feature_adoption_equals_the_counts_over_the_grid(models):
    entitled = F.count_distinct("cust_id")
    active = F.count_distinct(F.when(F.col("is_active"), F.col("cust_id")))
    expected = (
        naive_activity(models)
        .groupBy(
            "product_id", "feature_id", "feature_name", "feature_tier", "feature_value_weight", "month"
        )
        .agg(
            entitled.alias("customers_entitled"),
            active.alias("customers_active"),
            (active / entitled).alias("adoption_rate"),
            F.sum("usage_events").alias("usage_events"),
        )
    )
    same(models["mart_feature_adoption"], expected)


def test_spine_is_contracts_by_months_filtered(models):
    grid = models["consumption_monthly"].select("month").distinct()
    expected = (
        models["stg_entitlements"]
        .crossJoin(grid)
        .filter(
            (F.last_day("month") >= F.col("start_date")) & (F.col("month") <= F.col("end_date"))
        )
        .select("entitlement_id", "month")
    )
    same(models["stg_entitlement_month"].select("entitlement_id", "month"), expected)


def test_contract_sweeps_count_the_same_pairs_as_a_self_join(models):
    contracts = models["entitlements"]
    a = contracts.select(
        "cust_id",
        "product_id",
        *[F.col(c).alias(f"a_{c}") for c in ("entitlement_id", "start_date", "end_date")],
    )
    pairs = contracts.join(a, ["cust_id", "product_id"])
    overlap = pairs.filter(
        (F.col("entitlement_id") != F.col("a_entitlement_id"))
        & (F.col("a_start_date") <= F.col("end_date"))
        & (F.col("start_date") <= F.col("a_end_date"))
    ).count()
    apart = pairs.filter(F.col("start_date") > F.date_add("a_end_date", 31)).count()
    assert checks.overlaps_exist(contracts).collect()[0]["observed"] == overlap
    assert checks.renewal_gaps(contracts, Params()).collect()[0]["observed"] == apart


def test_neighbour_counts_match_a_sorted_walk(models):
    walked = {"overlaps": 0, "gaps": 0}
    groups: dict[tuple, list] = {}
    for row in models["entitlements"].collect():
        groups.setdefault((row["cust_id"], row["product_id"]), []).append(
            (row["start_date"], row["end_date"])
        )
    for terms in groups.values():
        terms.sort()
        for (_, end), (start, _) in zip(terms, terms[1:]):
            walked["overlaps"] += start <= end
            walked["gaps"] += (start - end).days > 1
    got = {
        r["check_name"].split(":")[1]: r["observed"]
        for r in checks.adjacent_contracts(models["entitlements"]).collect()
    }
    assert got == walked


def test_all_checks_in_one_frame_equal_the_single_ones(models):
    together = {r["check_name"]: r for r in checks.run_all(models).collect()}
    for name in ("dq_rate_le_one", "dq_recovery_reconciles", "dq_orphan_fk", "dq_pk_unique"):
        for row in checks.check(models, name).collect():
            assert together[row["check_name"]] == row
    named = {name.split(":")[0] for name in together}
    assert named == set(checks.NAMES)


def test_terms_that_end_before_they_start_are_counted(spark):
    rng = random.Random(7)
    base = dt.date(2024, 1, 1)
    rows = [
        (f"E{n % 40}", rng.choice(["C1", "C2"]), "S", *(base + dt.timedelta(rng.randint(0, 30)) for _ in "se"))
        for n in range(60)
    ] + [("E99", "C1", "S", None, base)]
    contracts = spark.createDataFrame(
        rows, "entitlement_id string, cust_id string, product_id string, start_date date, end_date date"
    )
    whole = [r for r in rows if r[3] is not None]
    pairs = [(a, b) for a in whole for b in whole if a[1] == b[1]]
    meeting = sum(a[3] <= b[4] and b[3] <= a[4] for a, b in pairs if a[0] != b[0])
    apart = sum((b[3] - a[4]).days > 3 for a, b in pairs)
    assert checks.overlaps_exist(contracts).collect()[0]["observed"] == meeting
    short = replace(Params(), gap_days=3)
    assert checks.renewal_gaps(contracts, short).collect()[0]["observed"] == apart
    overlaps = gaps = 0
    for cust in ("C1", "C2"):
        terms = sorted(r[3:] for r in whole if r[1] == cust)
        for (_, end), (start, _) in itertools.pairwise(terms):
            overlaps += start <= end
            gaps += (start - end).days > 1
    found = {r["check_name"]: r["observed"] for r in checks.adjacent_contracts(contracts).collect()}
    assert found == {
        "dq_adjacent_overlap_gap:overlaps": overlaps, "dq_adjacent_overlap_gap:gaps": gaps
    }


@pytest.mark.parametrize("count", [0, 1, 2, 7, 1000])
def test_median_is_exact(spark, count):
    rng = random.Random(count)
    values = [rng.choice([1.5, 1.5, rng.random() * 9, rng.random() ** 9]) for _ in range(count)]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    expected = statistics.median(values) if values else None
    assert checks.median(rows, "x", steps=5).collect()[0][0] == expected


def test_counts_taken_at_the_writes_equal_a_recount(spark, book, tmp_path):
    """The audit of a run scans no model that it has just written, and publishing a run again adds no rows."""
    from datetime import datetime

    from fulluse.operators import audit
    from fulluse.plans import pipeline

    book.customer("C1")
    book.sku("S")
    book.contract("E1", "C1", "S", "2024-01-01", "2024-08-15")
    book.contract("E2", "C1", "S", "2024-02-10", "2024-06-30", licensed=None, unlimited=True)
    book.window("2024-01-01", 9)
    book.used("E1", "C1", "S", day("2024-01-01"), 5.0)
    folder, when = str(tmp_path / "marts"), datetime(2024, 12, 31, 1)
    run = pipeline.run(book.raw(), folder, when)
    columns = [c for c in audit.COLUMNS if c != "note"]
    recount = audit.full(run.models, pipeline.MODELS)
    assert sorted(map(str, run.audit.select(*columns).collect())) == sorted(map(str, recount.select(*columns).collect()))
    notes = run.audit.filter(F.col("action") != audit.BUILT).select("note")
    assert sorted(map(str, notes.collect())) == sorted(map(str, recount.filter(F.col("action") != audit.BUILT).select("note").collect()))
    taken = {"int_flags": {"n": 1, "late": 1, "last": day("2024-09-01"), **dict.fromkeys(audit.RAISED, 0)}}
    plan = audit.flags(audit.counted(run.models, "int_flags", taken))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    rows = run.audit.count()
    pipeline.publish_audit(run.audit, f"{folder}/pipeline_audit")
    history = pipeline.read_history(spark, f"{folder}/pipeline_audit")
    assert history.count() == rows == audit.latest_run(history).count()
    plan = audit.latest_run(history)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan
    assert audit.of_run(history, "20000101000000").count() == 0
