"""Incremental refresh: every stored table equals a full build, whatever changed, and only what is reached is read."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import Book, day, months
from fulluse.plans import increment
from fulluse.plans.pipeline import Models
from fulluse.sources import tables

TABLES = (*increment.SMALL, *increment.BY_MONTH, increment.ADOPTION, *increment.ROLLUPS)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """A small book over ten months: renewals, overlaps, gaps, internal and unlimited contracts, repeats, strangers."""
    rng, book, span = random.Random(3), Book(spark), months("2000-01-01", 10)
    for k in range(8):
        book.customer(f"C{k}", internal=k == 2, segment="Enterprise" if k % 2 else "Mid-Market", owner=f"O{k % 3}")
    book.sku("S1", price=12.0)
    book.sku("S2", price=7.3, weights=(3, 1))
    for n in range(24):
        cust, sku, first = f"C{rng.randrange(8)}", f"S{rng.randint(1, 2)}", rng.randrange(-2, 8)
        start = dt.date(1999 + (first + 12) // 12, (first + 12) % 12 + 1, rng.choice((1, 1, 15)))
        end = start + dt.timedelta(days=rng.choice((60, 150, 300)))
        free = n % 9 == 4
        book.contract(f"E{n}", cust, sku, str(start), str(end), units=rng.randint(1, 9), licensed=None if free else 120.0, unlimited=free)
        if n % 3:
            book.event(f"E{n}", cust, sku, "first_value", str(start + dt.timedelta(days=rng.randrange(90))))
        for month in span:
            if rng.random() < 0.6:
                for _ in range(rng.choice((1, 1, 2))):
                    book.used(f"E{n}", cust, sku, month, float(rng.randrange(20)))
            if rng.random() < 0.5:
                book.active(f"E{n}", cust, sku, f"{sku}-F{rng.randrange(2)}", month, active=rng.random() < 0.8)
    book.window("2000-01-01", 10)
    return tables.land(book.raw(), str(tmp_path_factory.mktemp("landed")))


@pytest.fixture(scope="module")
def whole(spark, landed, tmp_path_factory):
    store = increment.Store(spark, str(tmp_path_factory.mktemp("whole")))
    store.build(landed)
    return store


def different(store, whole, raw):
    models = Models(raw)
    found = []
    for name in TABLES:
        a, b = (s.read(name, models[name]) for s in (store, whole))
        if a.exceptAll(b).count() or b.exceptAll(a).count():
            found.append(name)
    return found


def changed(raw, table, function):
    return {name: raw[name] for name in raw} | {table: function(raw[table])}


def of(month):
    return F.col("month") == day(month)


def part(number, parts=7):
    return F.pmod(F.xxhash64("entitlement_id"), F.lit(parts)) == number


def usage_and_activity(raw):
    other = F.when(of("2000-03-01") & part(0, 3), 0.0).otherwise(F.col("consumed_units"))
    raw = changed(raw, "consumption_monthly", lambda df: df.withColumn("consumed_units", other))
    return changed(raw, "feature_adoption_monthly", lambda df: df.filter(~(of("2000-07-01") & part(1, 2))))


def contracts_and_customers(raw):
    def gone_since(df):
        late = {"entitlement_id": F.concat(F.lit("G-"), "entitlement_id"), "end_date": F.lit(day("2001-01-31"))}
        return df.filter(~part(3, 9)).unionByName(df.limit(3).withColumns(late))

    def customers(df):
        segment = F.when(F.col("cust_id") == "C7", "Other").otherwise(F.col("segment"))
        return df.withColumns({"segment": segment, "is_internal": F.col("is_internal") | (F.col("cust_id") == "C5")})

    raw = changed(changed(raw, "entitlements", gone_since), "customers", customers)
    return changed(raw, "deployment_events", lambda df: df.filter(~part(1, 5) | (F.col("event_type") != "first_value")))


def later_months(raw):
    later = F.lit(day("2001-01-01"))
    return changed(raw, "consumption_monthly", lambda df: df.unionByName(df.filter(of("2000-03-01")).limit(5).withColumn("month", later)))


EDITS = {
    "nothing": lambda raw: dict(raw),
    "usage and activity": usage_and_activity,
    "contracts and customers": contracts_and_customers,
    "later months than now": later_months,
}


@pytest.mark.parametrize("name", EDITS)
def test_refresh_equals_build(spark, landed, whole, tmp_path, name):
    store = increment.Store(spark, str(tmp_path))
    store.build(EDITS[name](landed))
    found = store.refresh(landed)
    assert found is not None
    assert different(store, whole, landed) == []
    if name == "nothing":
        assert found.months == [] and found.pairs.count() == 0


def test_changed_catalogue_is_a_full_build(spark, landed, whole, tmp_path):
    store = increment.Store(spark, str(tmp_path))
    store.build(changed(landed, "features", lambda df: df.withColumn("feature_value_weight", F.col("feature_value_weight") + 1)))
    assert store.refresh(landed) is None
    assert different(store, whole, landed) == []


def test_books_of_nothing(spark, landed, whole, tmp_path):
    empty = {name: df.limit(0) for name, df in landed.items()} | {t: landed[t] for t in increment.CATALOGUE}
    store = increment.Store(spark, str(tmp_path))
    store.build(empty)
    store.refresh(landed)
    assert different(store, whole, landed) == []
    store.refresh(empty)
    assert store.read(increment.FACT, Models(landed)[increment.FACT]).count() == 0


def test_only_reached_months_are_scanned_and_written(spark, landed, tmp_path):
    month = day("2000-03-01")
    store = increment.Store(spark, str(tmp_path))
    booked = Models(landed)["stg_consumption"].filter(of("2000-03-01") & ~F.col("was_zero_filled"))
    one = F.col("entitlement_id") == booked.orderBy("entitlement_id").first()["entitlement_id"]
    store.build(changed(
        landed, "consumption_monthly",
        lambda df: df.withColumn("consumed_units", F.when(one & of("2000-03-01"), 1000.0).otherwise(F.col("consumed_units"))),
    ))
    files = {p: p.stat().st_mtime_ns for p in Path(tmp_path, increment.FACT).rglob("*.parquet")}
    found = store.refresh(landed)
    assert found.months == [month] and found.activity_months == []
    models = Models(landed)
    assert 0 < found.pairs.count() < models["stg_entitlements"].select("cust_id", "product_id").distinct().count() / 2
    plan = increment.recomputed(landed, models["stg_entitlements"], found)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and ("consumption_monthly" in line or "feature_adoption_monthly" in line)]
    assert scans and all(f"= {month}" in line.split("PartitionFilters:")[1].split("]")[0] for line in scans)
    left = {p for p in Path(tmp_path, increment.FACT).rglob("*.parquet") if files.get(p) == p.stat().st_mtime_ns}
    rewritten = {p.parent.name for p in files} - {p.parent.name for p in left}
    assert f"month={month}" in rewritten and len(rewritten) < len({p.parent.name for p in files}) / 2


def test_digests_tell_every_kind_of_change(spark, landed):
    old = increment.digests(landed)
    usage = landed["consumption_monthly"]
    row = usage.orderBy("entitlement_id", "month").limit(1)
    for new in (usage.unionByName(row), usage.exceptAll(row), usage.exceptAll(row).unionByName(row.withColumn("consumed_units", F.lit(-1.0)))):
        cells = increment.changed_cells(old, increment.digests({**landed, "consumption_monthly": new})).collect()
        assert [(c["table_name"], c["month"]) for c in cells] == [("consumption_monthly", row.first()["month"])]
    assert increment.changed_cells(old, increment.digests({n: df.repartition(3) for n, df in landed.items()})).count() == 0


def test_months_between():
    assert increment.months_between(dt.date(1999, 11, 1), dt.date(2000, 2, 1)) == [
        dt.date(1999, 11, 1), dt.date(1999, 12, 1), dt.date(2000, 1, 1), dt.date(2000, 2, 1),
    ]
    assert increment.months_between(None, None) == []
