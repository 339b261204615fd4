from __future__ import annotations

import pytest

from fulluse.functions import dates as d
from fulluse.functions import metrics as m
from fulluse.functions.text import short_money, whole_percent
from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column).collect()[0][0]


def num(x):
    return F.lit(x).cast("double")


def flag(x):
    return F.lit(x).cast("boolean")


@pytest.mark.parametrize(
    ("consumed", "licensed", "unlimited", "rate", "over"),
    [
        (8.0, 10.0, False, 0.8, 0.8),
        (13.0, 10.0, False, 1.0, 1.3),
        (5.0, 0.0, False, None, None),
        (5.0, None, False, None, None),
        (5.0, 10.0, True, None, None),
        (5.0, 10.0, None, 0.5, 0.5),
        (0.0, 10.0, False, 0.0, 0.0),
    ],
)
def test_rate_and_overage(spark, consumed, licensed, unlimited, rate, over):
    basis = (num(consumed), num(licensed), flag(unlimited))
    assert value(spark, m.consumption_rate(*basis)) == rate
    assert value(spark, m.overage_ratio(*basis)) == over


@pytest.mark.parametrize(
    ("deploying", "unlimited", "rate", "coverage", "expected"),
    [
        (True, True, 0.5, 0.5, None),
        (True, False, 0.5, 0.5, None),
        (False, True, None, 0.4, 0.4),
        (False, False, 0.5, 0.4, 0.2),
        (False, False, None, 0.4, 0.0),
        (False, False, 0.5, None, 0.0),
    ],
)
def test_score_branches(spark, deploying, unlimited, rate, coverage, expected):
    got = m.vrr(flag(deploying), flag(unlimited), num(rate), num(coverage))
    assert value(spark, got) == expected


def test_unscored_value_is_all_at_risk(spark):
    assert value(spark, m.realized(num(100.0), num(None))) == 0.0
    assert value(spark, m.at_risk(num(100.0), num(None))) == 100.0


def test_weighted_score_drops_unscored_rows_from_both_sides(spark):
    rows = spark.createDataFrame([(0.5, 100.0), (None, 900.0), (1.0, 300.0)], "s double, v double")
    got = rows.agg(m.weighted_vrr(F.col("s"), F.col("v"))).collect()[0][0]
    assert got == pytest.approx((50 + 300) / 400)


def test_quota_and_attainment_of_the_five_account_book(spark):
    assert value(spark, m.quota(num(865_000.0), 0.15)) == pytest.approx(129_750)
    got = value(spark, m.attainment(num(205_000.0), num(865_000.0), 0.15))
    assert got == pytest.approx(1.58, abs=0.001)


def test_month_difference_counts_boundaries(spark):
    later, earlier = F.lit("2024-02-01").cast("date"), F.lit("2024-01-31").cast("date")
    assert value(spark, d.months_between_boundaries(later, earlier)) == 1


@pytest.mark.parametrize(
    ("amount", "text"),
    [
        (None, "—"),
        (12.0, "$12"),
        (1500.0, "$1.5k"),
        (-2_500_000.0, "$-2.5M"),
        (3.2e9, "$3.2B"),
        (1234e9, "$1,234.0B"),
    ],
)
def test_short_money(spark, amount, text):
    assert value(spark, short_money(num(amount))) == text


@pytest.mark.parametrize(("share", "percent"), [(0.125, 12.0), (0.135, 14.0), (0.1249, 12.0), (None, None)])
def test_whole_percent_sends_halves_to_even(spark, share, percent):
    assert value(spark, whole_percent(num(share))) == percent
