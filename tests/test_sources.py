from __future__ import annotations

import os

import pytest

from conftest import day
from fulluse.plans import storage
from fulluse.sources import tables
from fulluse.sources.adapter import AdaptedTables
from fulluse.sources.schemas import RAW_COLUMNS, raw_schema, raw_tables
from pyspark.sql import functions as F

CUSTOMERS = """cust_id,cust_name,region,segment,industry,customer_since,behaviour_cohort,account_owner,is_internal
C1,"Acme, Inc.",EU,Enterprise,Retail,2020-01-31,normal,OWNER_1,False
C2,Beta,US,Mid-Market,,2021-02-28,shelfware,,True
"""


def write(folder, table, text):
    path = folder / f"{table}.csv"
    path.write_text(text)
    return str(folder)


def test_csv_is_typed(spark, tmp_path):
    folder = write(tmp_path, "customers", CUSTOMERS)
    df = tables.read_raw(spark, folder, "customers")
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in raw_schema("customers")]
    first, second = df.orderBy("cust_id").collect()
    assert (first["cust_name"], first["customer_since"]) == ("Acme, Inc.", day("2020-01-31"))
    assert (first["is_internal"], second["is_internal"]) == (False, True)
    assert second["industry"] is None and second["account_owner"] is None


def test_reordered_header_is_refused(spark, tmp_path):
    lines = CUSTOMERS.splitlines()
    lines[0] = lines[0].replace("cust_id,cust_name", "cust_name,cust_id")
    folder = write(tmp_path, "customers", "\n".join(lines) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_raw(spark, folder, "customers").collect()


def test_unparseable_value_fails_the_read(spark, tmp_path):
    folder = write(tmp_path, "customers", CUSTOMERS.replace("2020-01-31", "soon"))
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        tables.read_raw(spark, folder, "customers").collect()


def test_unlimited_amount_reads_as_null(spark, tmp_path):
    header = ",".join(part.split()[0] for part in RAW_COLUMNS["entitlements"].split(", "))
    folder = write(
        tmp_path,
        "entitlements",
        f"{header}\nE1,C1,S,10,,2024-01-01,2024-12-31,New,USD,1.0,True\n",
    )
    row = tables.read_raw(spark, folder, "entitlements").collect()[0]
    assert (row["licensed_amount"], row["is_unlimited"]) == (None, True)


def test_required_nulls_are_counted_per_column(book):
    book.customer("C1")
    book.rows["customers"].append((None,) + book.rows["customers"][0][1:])
    rows = tables.required_nulls(book.raw()).collect()
    counts = {(r["table_name"], r["column_name"]): r["null_rows"] for r in rows}
    assert counts[("customers", "cust_id")] == 1
    assert sum(counts.values()) == 1 and len(counts) == 13


def test_landing_again_converges_and_parity_reports_losses(book, tmp_path):
    book.customer("C1")
    book.sku("S")
    book.window("2024-01-01", 3)
    raw = book.raw()
    for _ in range(2):
        landed = tables.land(raw, str(tmp_path / "raw"))
    report = {r["table_name"]: r for r in tables.load_parity(raw, landed).collect()}
    assert len(report) == len(raw_tables())
    assert all(r["matches"] for r in report.values())
    assert report["consumption_monthly"]["landed_rows"] == 3

    short = dict(landed, features=landed["features"].limit(1))
    lost = {r["table_name"]: r["lost_rows"] for r in tables.load_parity(raw, short).collect()}
    assert lost["features"] == 2 and sum(lost.values()) == 2


def test_landed_facts_are_sorted_by_customer_and_sku(book, tmp_path):
    for cust in ("C3", "C1", "C2"):
        for sku in ("S2", "S1"):
            book.used(f"E-{cust}-{sku}", cust, sku, day("2024-01-01"), 1.0)
    landed = tables.land({"consumption_monthly": book.raw()["consumption_monthly"]}, str(tmp_path))
    parts = (
        landed["consumption_monthly"]
        .select(F.input_file_name().alias("f"), "cust_id", "product_id")
        .collect()
    )
    by_file = {}
    for row in parts:
        by_file.setdefault(row["f"], []).append((row["cust_id"], row["product_id"]))
    assert all(keys == sorted(keys) for keys in by_file.values())


def test_refresh_replaces_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "cust_id string, product_id string, month date, v int"
    january, february = day("2024-01-01"), day("2024-02-01")
    first = spark.createDataFrame([("C", "S", january, 1), ("C", "S", february, 1)], schema)
    storage.replace_table(first, path, storage.BY_MONTH, storage.IN_MONTH, month_folders=True)
    storage.refresh_months(spark.createDataFrame([("C", "S", february, 2)], schema), path)
    rows = storage.read_written(spark, path, first).orderBy("month").collect()
    assert [(r["month"], r["v"]) for r in rows] == [(january, 1), (february, 2)]


def test_work_folder_lives_under_the_named_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    work = storage.WorkFolder(spark, "test")
    kept = work.keep("t", spark.range(3))
    assert kept.count() == 3
    if named:
        assert work.path.startswith(named)
    assert os.path.exists(f"{work.path}/t")


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_adapter_books_every_line_item(spark, folder):
    usage = AdaptedTables(spark, folder)["consumption_monthly"]
    booked = usage.groupBy("entitlement_id", "month").agg(F.max("consumed_units").alias("units"))
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert booked.agg(F.sum("units")).first()[0] == items.agg(F.sum("l_quantity")).first()[0]
