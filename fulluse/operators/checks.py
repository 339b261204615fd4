"""Data-quality checks as data: one row per rule with its count of violations and its verdict.

Rules over one table are aggregated together in one pass. No rule pairs rows
within a group: interval rules sweep daily totals, which the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulluse.functions import metrics as m
from fulluse.operators import staging
from fulluse.operators.intermediate import KEY, PAIR
from fulluse.plans.params import Params
from fulluse.sources.schemas import PRIMARY_KEYS
from fulluse.sources.tables import union_all

if TYPE_CHECKING:
    from fulluse.plans.pipeline import Models

TINY = 1e-9
CENT = 0.01


def nothing_wrong(violations: Column, observed: Column) -> Column:
    return violations == 0


@dataclass(frozen=True)
class Rule:
    """Two aggregates over one table and the verdict drawn from them."""

    violations: Column
    observed: Column
    passed: Callable[[Column, Column], Column] = nothing_wrong


def exists(found: Column, at_least: int = 1) -> Rule:
    """A rule that wants to see something at least so many times."""
    return Rule((found < at_least).cast("long"), found)


def evaluate(table: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """All rules over ``table`` in one aggregate."""
    totals, rows = [], []
    for i, (name, rule) in enumerate(rules.items()):
        bad, seen = f"v{i}", f"o{i}"
        totals += [
            F.coalesce(rule.violations, F.lit(0)).cast("long").alias(bad),
            rule.observed.cast("double").alias(seen),
        ]
        passed = F.coalesce(rule.passed(F.col(bad), F.col(seen)), F.lit(False))
        rows.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.col(bad).alias("violations"),
                F.col(seen).alias("observed"),
                passed.alias("passed"),
            )
        )
    return table.agg(*totals).select(F.inline(F.array(*rows)))


# Rules over the base fact


def fact_rules(p: Params) -> dict[str, Rule]:
    rate, coverage, score = F.col("consumption_rate"), F.col("feature_coverage"), F.col("vrr")
    deploying, unlimited = F.col("flag_deploying"), F.col("flag_unlimited")
    idle = (F.col("behaviour_cohort") == p.shelfware_cohort) & ~deploying
    open_ended = unlimited & ~deploying
    missing = F.lit(-1.0)
    off_coverage = F.abs(F.coalesce(score, missing) - F.coalesce(coverage, missing)) >= TINY
    split_error = F.abs(
        F.col("realized_value_usd") + F.col("value_at_risk_usd") - F.col("licensed_value_usd")
    )
    outside = ~rate.between(0, 1)
    for factor in (coverage, score):
        outside = outside | ~factor.between(0, 1)
    rows = F.count("*")
    return {
        "dq_shelfware_never_null": Rule(F.count_if(idle & score.isNull()), F.count_if(idle)),
        "dq_rate_le_one": Rule(F.count_if(rate > 1), F.max(rate)),
        "dq_deploying_null": Rule(F.count_if(deploying & (score == 0)), F.count_if(deploying)),
        "dq_unlimited_coverage_only": Rule(
            F.count_if(open_ended & (rate.isNotNull() | off_coverage)), F.count_if(open_ended)
        ),
        "dq_no_internal": Rule(F.count_if(F.col("cust_name").startswith("INTERNAL")), rows),
        "dq_factors_not_null": Rule(
            F.count_if((rate.isNull() & ~unlimited) | coverage.isNull()), rows
        ),
        "dq_rates_unit_interval": Rule(F.count_if(outside), rows),
        "dq_coverage_le_one": Rule(
            F.count_if(coverage > 1 + TINY), F.max(coverage), lambda v, o: o <= 1 + TINY
        ),
        "dq_value_split_reconcile": Rule(
            F.count_if(split_error >= CENT), F.max(split_error), lambda v, o: o < CENT
        ),
    }


def shelfware_scores_zero(fact: DataFrame, p: Params) -> DataFrame:
    """Every shelfware customer averages zero once scored, and the flag fires somewhere."""
    customers = (
        fact.filter(F.col("behaviour_cohort") == p.shelfware_cohort)
        .filter(~F.col("flag_deploying"))
        .groupBy("cust_id")
        .agg(
            F.avg("vrr").alias("score"),
            F.max(F.col("flag_shelfware").cast("int")).alias("flagged"),
        )
    )
    scored = F.count_if(F.coalesce("score", F.lit(1.0)) != 0)
    return evaluate(
        customers,
        {
            "dq_shelfware_scores_zero": Rule(
                scored, F.sum("flagged"), lambda v, o: (v == 0) & (o > 0)
            )
        },
    )


def score_curve(fact: DataFrame, cohort: str) -> DataFrame:
    """Mean score of a cohort by position of the scored month in its pair."""
    order = Window.partitionBy(*PAIR).orderBy("month")
    return (
        fact.filter((F.col("behaviour_cohort") == cohort) & F.col("vrr").isNotNull())
        .select(*PAIR, "month", "vrr")
        .withColumn("month_idx", F.row_number().over(order).cast("long"))
        .groupBy("month_idx")
        .agg(F.avg("vrr").alias("avg_vrr"))
    )


def spike_decay(fact: DataFrame, p: Params) -> DataFrame:
    curve = score_curve(fact, p.spike_cohort)
    early = F.avg(F.when(F.col("month_idx") <= 3, F.col("avg_vrr")))
    late = F.avg(F.when(F.col("month_idx") >= 6, F.col("avg_vrr")))
    decayed = F.coalesce((early > late) & (late < 0.05), F.lit(False))
    return evaluate(curve, {"dq_spike_decay": Rule((~decayed).cast("long"), late)})


def overage_flagged(fact: DataFrame, p: Params) -> DataFrame:
    customers = (
        fact.filter(F.col("behaviour_cohort") == p.overage_cohort)
        .groupBy("cust_id")
        .agg(
            F.max(F.col("flag_chronic_overage").cast("int")).alias("flagged"),
            F.max("overage_ratio").alias("peak"),
        )
    )
    unflagged = F.count_if(F.col("flagged") == 0)
    enough = m.ratio(F.sum("flagged"), F.count("*")) > 0.8
    seen = F.max(F.when(F.col("peak") > p.overage_ratio, F.col("peak")))
    rule = Rule(unflagged, F.when(enough, seen), lambda v, o: o.isNotNull())
    return evaluate(customers, {"dq_overage_flagged": rule})


def models_covered(fact: DataFrame) -> DataFrame:
    kinds = fact.groupBy("consumption_model").agg(F.count("vrr").alias("scored"))
    rule = Rule(
        F.count_if(F.col("scored") == 0), F.count("*"), lambda v, o: (v == 0) & (o >= 2)
    )
    return evaluate(kinds, {"dq_models_covered": rule})


def incomplete_last_only(fact: DataFrame) -> DataFrame:
    months = fact.groupBy("month").agg(F.bool_or("is_incomplete").alias("late"))
    late = F.count_if("late")
    last = F.coalesce(F.max_by("late", "month"), F.lit(False)).cast("long")
    return evaluate(
        months, {"dq_incomplete_last_only": Rule((late - last) + (F.lit(1) - last), late)}
    )


def gap_not_scored(fact: DataFrame, entitlements: DataFrame, p: Params) -> DataFrame:
    """Base-fact months inside a long gap between two contracts, with no contract active.

    A pair has such a gap around a month exactly when its earliest end lies
    before it and its latest start after it, so one row per pair is enough.
    """
    ends = entitlements.groupBy(*PAIR).agg(
        F.min("end_date").alias("first_end"), F.max("start_date").alias("last_start")
    )
    covered = (
        staging.spread_months(
            entitlements.select(*PAIR, "start_date", "end_date"),
            (fact.agg(F.min("month")).scalar(), fact.agg(F.max("month")).scalar()),
        )
        .select(*KEY)
        .distinct()
    )
    inside = (
        (F.col("last_start") > F.date_add("first_end", p.gap_days))
        & (F.col("month") > F.col("first_end"))
        & (F.col("month") < F.trunc("last_start", "month"))
    )
    stray = fact.select(*KEY).join(covered, KEY, "left_anti").join(ends, PAIR).filter(inside)
    rows = F.count("*")
    return evaluate(stray, {"dq_gap_not_scored": Rule(rows, rows)})


def rollup_reconciles(fact: DataFrame, rollup: DataFrame, name: str) -> DataFrame:
    base = fact.groupBy("month").agg(m.exact_sum(F.col("value_at_risk_usd")).alias("base"))
    rolled = rollup.groupBy("month").agg(m.exact_sum(F.col("value_at_risk_usd")).alias("rolled"))
    error = F.abs(F.col("base") - F.col("rolled"))
    rule = Rule(F.count_if(error >= CENT), F.max(error), lambda v, o: o < CENT)
    return evaluate(base.join(rolled, "month"), {name: rule})


def portfolio_plausible(fact: DataFrame, p: Params) -> DataFrame:
    latest = fact.agg(F.max("month")).scalar()
    book = m.annualized(m.exact_sum(F.col("licensed_value_usd")))
    low, high = p.portfolio_bounds
    fits = F.coalesce((book > low) & (book < high), F.lit(False))
    return evaluate(
        fact.filter(F.col("month") == latest),
        {"dq_portfolio_plausible": Rule((~fits).cast("long"), book)},
    )


# Rules over staging


def spine_unique(stg_consumption: DataFrame) -> DataFrame:
    copies = stg_consumption.groupBy("entitlement_id", "month").agg(F.count("*").alias("n"))
    rule = Rule(F.count_if(F.col("n") > 1), F.max("n"))
    return evaluate(copies, {"dq_spine_unique": rule})


def twelve_month_reconcile(
    stg_consumption: DataFrame,
    entitlements: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Contracts with exactly twelve months: their monthly values add up to the yearly value."""
    summed = (
        stg_consumption.groupBy("entitlement_id")
        .agg(F.count("*").alias("months"), m.exact_sum(F.col("contract_value_month")).alias("summed"))
        .filter(F.col("months") == 12)
    )
    annual = F.col("units_purchased") * F.col("list_price_per_unit") * F.col("fx_rate_to_usd")
    terms = (
        entitlements.select("entitlement_id", "product_id", "units_purchased", "fx_rate_to_usd")
        .join(products.select("product_id", "list_price_per_unit"), "product_id")
        .select("entitlement_id", annual.alias("annual"))
    )
    error = m.ratio(F.abs(F.col("summed") - F.col("annual")), F.col("annual"))
    rule = Rule(
        F.count_if(error >= 0.001),
        F.max(error),
        lambda v, o: F.coalesce(o < 0.001, F.lit(True)),
    )
    return evaluate(summed.join(terms, "entitlement_id"), {"dq_twelve_month_reconcile": rule})


# Rules over owner recovery


def recovery_rules() -> dict[str, Rule]:
    recovered = F.col("value_recovered_usd")
    error = F.abs(F.col("opening_var_usd") - F.col("closing_var_usd") - recovered)
    negative = F.count_if(recovered < 0)
    return {
        "dq_recovery_complete_only": Rule(
            F.count_if(~F.col("quarter_is_complete")), F.count("*")
        ),
        "dq_recovery_has_negative": exists(negative),
        "dq_recovery_reconciles": Rule(
            F.count_if(error >= CENT), F.max(error), lambda v, o: o < CENT
        ),
    }


# Rules over the raw tables


def customer_rules(p: Params) -> dict[str, Rule]:
    rules = {
        "dq_internal_exist": exists(F.count_if("is_internal")),
        "dq_owner_populated": Rule(
            F.count_if(F.col("account_owner").isNull()), F.count_distinct("account_owner")
        ),
    }
    for cohort, (low, high) in p.cohort_shares.items():
        share = m.ratio(F.count_if(F.col("behaviour_cohort") == cohort), F.count("*"))
        outside = ~F.coalesce(share.between(low, high), F.lit(False))
        rules[f"dq_cohort_shares:{cohort}"] = Rule(outside.cast("long"), share)
    return rules


def entitlement_rules() -> dict[str, Rule]:
    unlimited = F.col("is_unlimited")
    share = m.ratio(F.count_if(F.col("currency") != "USD"), F.count("*"))
    rare = ~F.coalesce(share > 0.05, F.lit(False))
    rate = F.col("fx_rate_to_usd")
    dollars = F.col("currency") == "USD"
    mispriced = rate.isNull() | (rate <= 0) | (dollars & (rate != 1)) | (~dollars & (rate == 1))
    return {
        "dq_unlimited_exist": exists(F.count_if(unlimited)),
        "dq_unlimited_null_amount": Rule(
            F.count_if(unlimited & F.col("licensed_amount").isNotNull()), F.count_if(unlimited)
        ),
        "dq_non_usd_share": Rule(rare.cast("long"), share),
        "dq_all_usd": Rule(F.count_if(mispriced), F.count("*")),
        "dq_term_order": Rule(F.count_if(F.col("start_date") > F.col("end_date")), F.count("*")),
    }


def pairs_apart(contracts: DataFrame, group: Sequence[str], days: int) -> DataFrame:
    """Per group, how many ordered pairs (a, b) have b starting over ``days`` days after a ends.

    Starts and shifted ends are totalled per day; each start then counts the
    ends before it. A group has one row per day, however many contracts it has.
    """
    starts = contracts.select(
        *group, F.col("start_date").alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ends")
    )
    ends = contracts.select(
        *group,
        F.date_add("end_date", days).alias("day"),
        F.lit(0).alias("starts"),
        F.lit(1).alias("ends"),
    )
    daily = (
        starts.unionByName(ends)
        .groupBy(*group, "day")
        .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    )
    before = Window.partitionBy(*group).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum("ends").over(before), F.lit(0))
    wide = "decimal(38,0)"
    return (
        daily.withColumn("pairs", F.col("starts").cast(wide) * ended.cast("decimal(19,0)"))
        .groupBy(*group)
        .agg(F.sum("pairs").cast(wide).alias("apart"), F.sum("starts").alias("contracts"))
    )


# Bits of a day number that is never negative: any date plus DAY_ZERO.
DAY_BITS, DAY_ZERO = 22, 1_000_000


def pairs_around(contracts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group, how many pairs (a, b) have b ending before it starts and a covering both of b's days.

    Only groups with such a b take part. An end on or after b's start lies in
    exactly one of the binary ranges above the day before that start, so each
    contract has a row for each bit, and in each range the starts up to b's
    end are a running count. No pair is built.
    """
    inverted = contracts.filter(F.col("start_date") > F.col("end_date"))
    around = contracts.filter(F.col("start_date") <= F.col("end_date")).join(
        inverted.select(*group).distinct(), [*group], "left_semi"
    )

    def dealt(rows: DataFrame, place: str, day: Column, bit: int, up: int) -> DataFrame:
        levels = F.explode(F.sequence(F.lit(0), F.lit(DAY_BITS - 1)))
        number = (F.unix_date(day) + F.lit(DAY_ZERO - up)).cast("long")
        own = F.expr("shiftright(_number, _level)")
        return (
            rows.groupBy(*group, "start_date", "end_date")
            .agg(F.count("*").alias("_n"))
            .select(*group, F.col(place).alias("day"), "_n", number.alias("_number"), levels.alias("_level"))
            .filter(own % 2 == bit)
            .select(*group, "day", "_level", (own + up).alias("_range"), "_n")
        )

    zero = F.lit(0).cast("long")
    points = dealt(around, "start_date", F.col("end_date"), 1, 0)
    asked = dealt(inverted, "end_date", F.col("start_date"), 0, 1)
    daily = (
        points.withColumn("_asked", zero)
        .unionByName(asked.withColumns({"_asked": F.col("_n"), "_n": zero}))
        .groupBy(*group, "_level", "_range", "day")
        .agg(F.sum("_n").alias("_n"), F.sum("_asked").alias("_asked"))
    )
    begun = Window.partitionBy(*group, "_level", "_range").orderBy("day")
    covered = F.sum("_n").over(begun.rowsBetween(Window.unboundedPreceding, 0))
    return daily.select((F.col("_asked").cast("decimal(19,0)") * covered).alias("pairs"))


def overlapping_pairs(contracts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Ordered pairs of a group in which each starts before the other ends.

    A contract with itself is included. Two contracts that both end before
    they start never meet.
    """
    apart = pairs_apart(contracts.filter(F.col("start_date") <= F.col("end_date")), group, 0)
    n = F.col("contracts").cast("decimal(19,0)")
    wide = "decimal(38,0)"
    return apart.select((n * n - F.col("apart") * 2).cast(wide).alias("pairs")).union(
        pairs_around(contracts, group).select((F.col("pairs") * 2).cast(wide))
    )


def dated(entitlements: DataFrame) -> DataFrame:
    return entitlements.filter(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())


def overlaps_exist(entitlements: DataFrame) -> DataFrame:
    """Contracts of one customer and SKU with meeting terms, counted as ordered pairs."""
    contracts = dated(entitlements)
    same_sku = overlapping_pairs(contracts, PAIR)
    same_id = overlapping_pairs(contracts, [*PAIR, "entitlement_id"]).select(-F.col("pairs"))
    pairs = F.coalesce(F.sum("pairs"), F.lit(0))
    return evaluate(
        same_sku.union(same_id.toDF("pairs")), {"dq_overlaps_exist": exists(pairs, 2)}
    )


def renewal_gaps(entitlements: DataFrame, p: Params) -> DataFrame:
    apart = pairs_apart(dated(entitlements), PAIR, p.gap_days)
    return evaluate(
        apart, {"dq_renewal_gaps": exists(F.coalesce(F.sum("apart"), F.lit(0)))}
    )


def adjacent_contracts(entitlements: DataFrame) -> DataFrame:
    """Overlaps and gaps of over a day between neighbours in start order, per customer and SKU.

    Contracts that start on one day are neighbours of each other; the longest
    of them is compared with the next start.
    """
    order = Window.partitionBy(*PAIR).orderBy("start_date")
    following = F.lead("start_date").over(order)
    start = F.col("start_date")
    steps = (
        dated(entitlements)
        .groupBy(*PAIR, "start_date")
        .agg(
            F.count_if(F.col("end_date") >= start).alias("n"),
            F.count_if(F.date_add("end_date", 1) < start).alias("n_before"),
            F.max("end_date").alias("last_end"),
        )
        .withColumn("following", following)
    )
    last_ends_before = (F.date_add("last_end", 1) < start).cast("long")
    together = F.coalesce(F.sum(F.col("n") - (F.col("last_end") >= start).cast("long")), F.lit(0))
    split = F.coalesce(F.sum(F.col("n_before") - last_ends_before), F.lit(0))
    meets = F.count_if(F.col("following") <= F.col("last_end"))
    parted = F.count_if(F.col("following") > F.date_add("last_end", 1))
    return evaluate(
        steps,
        {
            "dq_adjacent_overlap_gap:overlaps": exists(together + meets),
            "dq_adjacent_overlap_gap:gaps": exists(split + parted),
        },
    )


def duplicates_exist(consumption: DataFrame) -> DataFrame:
    copies = consumption.groupBy("entitlement_id", "month").agg((F.count("*") - 1).alias("extra"))
    return evaluate(
        copies, {"dq_duplicates_exist": exists(F.coalesce(F.sum("extra"), F.lit(0)))}
    )


def unentitled_usage(activity: DataFrame, features: DataFrame) -> DataFrame:
    key = ["feature_id", "product_id"]
    stray = (
        activity.groupBy(*key)
        .agg(F.count("*").alias("n"))
        .join(features.select(*key).distinct(), key, "left_anti")
    )
    return evaluate(stray, {"dq_unentitled_usage": exists(F.coalesce(F.sum("n"), F.lit(0)))})


def latest_month_partial(consumption: DataFrame) -> DataFrame:
    """Usage of the last month against the one before it."""
    last_two = (
        consumption.groupBy("month")
        .agg(F.sum("consumed_units").alias("used"))
        .orderBy(F.desc("month"))
        .limit(2)
    )
    share = F.when(
        F.count("*") == 2, m.ratio(F.max_by("used", "month"), F.min_by("used", "month"))
    )
    full = ~F.coalesce(share < 0.7, F.lit(False))
    return evaluate(last_two, {"dq_latest_month_partial": Rule(full.cast("long"), share)})


def row_counts(raw: Mapping[str, DataFrame], p: Params) -> DataFrame:
    parts = []
    for table, (low, high) in p.row_bounds.items():
        rows = F.count("*")
        outside = (~rows.between(low, high)).cast("long")
        parts.append(evaluate(raw[table], {f"dq_row_counts:{table}": Rule(outside, rows)}))
    return union_all(parts)


def history_months(consumption: DataFrame) -> DataFrame:
    months = consumption.select("month").filter(F.col("month").isNotNull()).distinct()
    return evaluate(months, {"dq_history_months": exists(F.count("*"), 12)})


def core_feature_per_product(products: DataFrame, features: DataFrame) -> DataFrame:
    core = features.filter(F.col("feature_tier") == "Core").select("product_id").distinct()
    bare = products.select("product_id").distinct().join(core, "product_id", "left_anti")
    rows = F.count("*")
    return evaluate(bare, {"dq_core_feature_per_product": Rule(rows, rows)})


# Child table, parent table and foreign key.
FOREIGN_KEYS = (
    ("entitlements", "customers", "cust_id"),
    ("entitlements", "products", "product_id"),
    ("features", "products", "product_id"),
    ("consumption_monthly", "entitlements", "entitlement_id"),
)


def orphan_fk(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows are counted per key before the anti join, so a hot key is one row."""
    parts = []
    for child, parent, key in FOREIGN_KEYS:
        orphans = (
            raw[child]
            .groupBy(key)
            .agg(F.count("*").alias("n"))
            .join(raw[parent].select(key).distinct(), key, "left_anti")
        )
        rows = F.coalesce(F.sum("n"), F.lit(0))
        parts.append(evaluate(orphans, {f"dq_orphan_fk:{child}.{key}": Rule(rows, rows)}))
    return union_all(parts)


def pk_unique(raw: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for table, key in PRIMARY_KEYS.items():
        copies = raw[table].groupBy(*key).agg((F.count("*") - 1).alias("extra"))
        rule = Rule(F.sum("extra"), F.count("*"))
        parts.append(evaluate(copies, {f"dq_pk_unique:{table}": rule}))
    return union_all(parts)


def capacity_months(contracts: DataFrame, window: staging.MonthWindow) -> DataFrame:
    """Contract-months with their capacity, the ones of a customer and SKU in one partition."""
    spine = staging.months_by_pair(contracts, window, "entitlement_id", "licensed_amount", "is_unlimited")
    return spine.select(*KEY, "entitlement_id", staging.monthly_capacity().alias("licensed_amount_month"))


def expansion_denominator(fact: DataFrame, spine: DataFrame) -> DataFrame:
    """Capacity of a pair-month is the sum of its active contracts, each counted once."""
    held = (
        spine.groupBy(*KEY, "entitlement_id")
        .agg(F.max("licensed_amount_month").alias("amount"))
        .groupBy(*KEY)
        .agg(F.sum("amount").alias("amount"), F.count("*").alias("contracts"))
    )
    capacity = fact.select(*KEY, "licensed_amount_month")
    gone = F.lit(-1.0)
    error = F.abs(
        F.coalesce("licensed_amount_month", gone) - F.coalesce("amount", gone)
    )
    rule = Rule(F.count_if(error > 1e-6), F.count_if(F.col("contracts") > 1))
    return evaluate(capacity.join(held, KEY), {"dq_expansion_denominator": rule})


def cohort_usage(consumption: DataFrame, customers: DataFrame, cohort: str) -> DataFrame:
    """Whole-history usage and capacity per customer of a cohort."""
    used = consumption.groupBy("cust_id").agg(
        F.sum("consumed_units").alias("used"), F.sum("licensed_amount_month").alias("capacity")
    )
    members = customers.filter(F.col("behaviour_cohort") == cohort).select("cust_id").distinct()
    return used.join(members, "cust_id", "left_semi")


def shelfware_zero_usage(consumption: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    used = cohort_usage(consumption, customers, p.shelfware_cohort)
    total = F.coalesce(F.sum("used"), F.lit(0.0))
    return evaluate(used, {"dq_shelfware_zero_usage": Rule((total != 0).cast("long"), total)})


def median(rows: DataFrame, column: str, steps: int = 200) -> DataFrame:
    """The exact median of the values that are not NULL, one row; the mean of the middle two for an even count.

    Equal values travel as one row with a count. A sketch only places the
    borders of the steps in which they are ranked, so a task holds about one
    step; which values are in the middle follows from exact counts.
    """
    value = F.col("_value")
    values = rows.select(F.col(column).alias("_value")).filter(value.isNotNull())
    shares = [k / steps for k in range(1, steps)]
    borders = values.agg(F.percentile_approx("_value", shares, 10_000)).scalar()
    counts = values.groupBy("_value").agg(F.count("*").alias("_n")).withColumn("_borders", borders)
    counts = counts.withColumn("_step", F.size(F.filter("_borders", lambda b: b < value))).drop("_borders")
    earlier = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("_step").agg(F.sum("_n").alias("_total"))
    totals = totals.select(
        "_step",
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_total").over(Window.partitionBy()).alias("_all"),
    )
    upto = Window.partitionBy("_step").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("_n").over(upto)).join(totals, "_step")
    last = F.col("_before") + F.col("_upto")

    def at(rank: Column) -> Column:
        return F.max(F.when((last - F.col("_n") < rank) & (rank <= last), value))

    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return ranked.agg(((at(low) + at(high)) / 2).alias("median"))


def overage_ratio(consumption: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """Share of overage customers above the threshold over their whole history.

    Observed is the exact median ratio.
    """
    used = cohort_usage(consumption, customers, p.overage_cohort).withColumn(
        "ratio", m.ratio(F.col("used"), F.col("capacity"))
    )
    over = F.count_if(F.col("ratio") > p.overage_ratio)
    enough = F.coalesce(m.ratio(over, F.count("*")) > 0.9, F.lit(False))
    with_median = used.withColumn("_median", median(used, "ratio").scalar())
    rule = Rule((~enough).cast("long"), F.max("_median"))
    return evaluate(with_median, {"dq_overage_ratio": rule})


# Registry

FACT = "mart_customer_sku_month"


def only(rules: Mapping[str, Rule], name: str) -> dict[str, Rule]:
    """The rules of one named check; a check may have a rule per part."""
    return {k: r for k, r in rules.items() if k == name or k.startswith(f"{name}:")}


# Tables whose rules are evaluated together.
FUSED: dict[str, Callable[[Params], dict[str, Rule]]] = {
    FACT: fact_rules,
    "stg_consumption": lambda p: {
        "dq_zero_fill_happened": exists(F.count_if("was_zero_filled"))
    },
    "mart_owner_recovery": lambda p: recovery_rules(),
    "customers": customer_rules,
    "entitlements": lambda p: entitlement_rules(),
}

SINGLE: dict[str, Callable[[Models], DataFrame]] = {
    "dq_shelfware_scores_zero": lambda t: shelfware_scores_zero(t[FACT], t.params),
    "dq_spike_decay": lambda t: spike_decay(t[FACT], t.params),
    "dq_overage_flagged": lambda t: overage_flagged(t[FACT], t.params),
    "dq_models_covered": lambda t: models_covered(t[FACT]),
    "dq_incomplete_last_only": lambda t: incomplete_last_only(t[FACT]),
    "dq_gap_not_scored": lambda t: gap_not_scored(t[FACT], t["entitlements"], t.params),
    "dq_spine_unique": lambda t: spine_unique(t["stg_consumption"]),
    "dq_twelve_month_reconcile": lambda t: twelve_month_reconcile(
        t["stg_consumption"], t["entitlements"], t["products"]
    ),
    "dq_customer_rollup": lambda t: rollup_reconciles(
        t[FACT], t["mart_customer_adoption"], "dq_customer_rollup"
    ),
    "dq_product_rollup": lambda t: rollup_reconciles(
        t[FACT], t["mart_product_adoption"], "dq_product_rollup"
    ),
    "dq_portfolio_plausible": lambda t: portfolio_plausible(t[FACT], t.params),
    "dq_overlaps_exist": lambda t: overlaps_exist(t["entitlements"]),
    "dq_renewal_gaps": lambda t: renewal_gaps(t["entitlements"], t.params),
    "dq_adjacent_overlap_gap": lambda t: adjacent_contracts(t["entitlements"]),
    "dq_duplicates_exist": lambda t: duplicates_exist(t["consumption_monthly"]),
    "dq_unentitled_usage": lambda t: unentitled_usage(
        t["feature_adoption_monthly"], t["features"]
    ),
    "dq_latest_month_partial": lambda t: latest_month_partial(t["consumption_monthly"]),
    "dq_row_counts": lambda t: row_counts(t.raw, t.params),
    "dq_history_months": lambda t: history_months(t["consumption_monthly"]),
    "dq_core_feature_per_product": lambda t: core_feature_per_product(
        t["products"], t["features"]
    ),
    "dq_orphan_fk": lambda t: orphan_fk(t.raw),
    "dq_shelfware_zero_usage": lambda t: shelfware_zero_usage(
        t["consumption_monthly"], t["customers"], t.params
    ),
    "dq_overage_ratio": lambda t: overage_ratio(
        t["consumption_monthly"], t["customers"], t.params
    ),
    "dq_pk_unique": lambda t: pk_unique(t.raw),
    "dq_expansion_denominator": lambda t: expansion_denominator(
        t[FACT], capacity_months(t["stg_entitlements"], t.window())
    ),
}

# Check name to the table it is evaluated on.
ON_TABLE = {
    **{
        name: FACT
        for name in (
            "dq_shelfware_never_null",
            "dq_rate_le_one",
            "dq_deploying_null",
            "dq_unlimited_coverage_only",
            "dq_no_internal",
            "dq_factors_not_null",
            "dq_rates_unit_interval",
            "dq_coverage_le_one",
            "dq_value_split_reconcile",
        )
    },
    "dq_zero_fill_happened": "stg_consumption",
    "dq_recovery_complete_only": "mart_owner_recovery",
    "dq_recovery_has_negative": "mart_owner_recovery",
    "dq_recovery_reconciles": "mart_owner_recovery",
    "dq_cohort_shares": "customers",
    "dq_internal_exist": "customers",
    "dq_owner_populated": "customers",
    "dq_unlimited_exist": "entitlements",
    "dq_unlimited_null_amount": "entitlements",
    "dq_non_usd_share": "entitlements",
    "dq_all_usd": "entitlements",
    "dq_term_order": "entitlements",
}

NAMES = [*ON_TABLE, *SINGLE]


def check(models: Models, name: str) -> DataFrame:
    if name in SINGLE:
        return SINGLE[name](models)
    table = ON_TABLE[name]
    return evaluate(models[table], only(FUSED[table](models.params), name))


def run_all(models: Models) -> DataFrame:
    """Every check; the rules of one table share one pass."""
    fused = [
        evaluate(models[table], rules(models.params)) for table, rules in FUSED.items()
    ]
    return union_all([*fused, *[single(models) for single in SINGLE.values()]])
