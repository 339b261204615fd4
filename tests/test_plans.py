"""Physical plans: what must not appear in any query, and pruning and pushdown where it matters."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from conftest import day
from fulluse.plans.registry import adapted_models
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.CORPUS)))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert not [word for word in FORBIDDEN if word in text]


def test_windows_are_partitioned(spark):
    for name in ("mart_customer_sku_month", "mart_owner_recovery", "dq_latest_month_partial"):
        lines = plan(contract.queries()[name](spark, FOLDER)).splitlines()
        windows = [i for i, line in enumerate(lines) if "Window [" in line]
        assert not [i for i in windows if "SinglePartition" in " ".join(lines[i : i + 3])]


def test_rate_scan_reads_only_its_columns(spark):
    models = adapted_models(spark, FOLDER)
    text = plan(models["int_consumption_rate"].select("cust_id", "consumption_rate"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "was_zero_filled" not in scan and "price_per_unit_usd" not in scan


def test_month_filter_reaches_the_fact_scan_through_the_rollup(spark):
    models = adapted_models(spark, FOLDER)
    month = F.lit(day("2000-05-01"))
    text = plan(models["mart_customer_adoption"].filter(F.col("month") == month))
    assert "EqualTo(month,2000-05-01)" in text


def test_data_window_reaches_the_activity_scan(spark):
    text = plan(adapted_models(spark, FOLDER).feature_hits())
    assert "GreaterThanOrEqual(month,1995-01-01)" in text


def test_factors_join_where_they_were_grouped(spark):
    """Joining three factors on their grouping key adds no exchange; the flags add one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        models = adapted_models(spark, FOLDER)
        text = plan(models._mart_customer_sku_month())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    by_key = [line for line in lines if "cust_id" in line and "product_id" in line]
    assert len([line for line in by_key if "month" in line]) == 4
    assert len([line for line in by_key if "month" not in line]) == 1


def test_session_models_follow_their_parameters(spark):
    from fulluse.plans.params import Params
    from fulluse.plans.pipeline import session_models

    one, two = (session_models(spark, FOLDER, Params(deploy_days=d)) for d in (90, 10))
    assert one is not two and one.params.deploy_days == 90 and two.params.deploy_days == 10
    assert session_models(spark, FOLDER, Params(deploy_days=10)) is two
