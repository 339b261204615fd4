"""Data-quality checks in SQL, written pairwise and row by row."""

FACT = "mart_customer_sku_month"


def row(name: str, violations: str, observed: str, source: str, passed: str = "") -> str:
    verdict = passed or "violations = 0"
    return (
        f"select '{name}' as check_name, violations, observed, ifnull({verdict}, false) as passed "
        f"from (select ifnull({violations}, 0)::bigint as violations, "
        f"({observed})::double as observed from {source})"
    )


def wanted(name: str, found: str, source: str, at_least: int = 1) -> str:
    return row(name, f"({found} < {at_least})::int", found, source)


def tally(condition: str) -> str:
    return f"count(*) filter (where {condition})"


OPEN = "flag_unlimited and not flag_deploying"
IDLE = "behaviour_cohort = 'shelfware' and not flag_deploying"
SPLIT = "abs(realized_value_usd + value_at_risk_usd - licensed_value_usd)"
MOVED = "abs(opening_var_usd - closing_var_usd - value_recovered_usd)"
OVERLAP = """(select 1 from entitlements as a, entitlements as b
 where a.cust_id = b.cust_id and a.product_id = b.product_id
   and a.entitlement_id <> b.entitlement_id
   and a.start_date <= b.end_date and b.start_date <= a.end_date)"""
PARTED = """(select 1 from entitlements as a, entitlements as b
 where a.cust_id = b.cust_id and a.product_id = b.product_id and b.start_date - a.end_date > 31)"""
STRAY = f"""(select 1 from {FACT} as f
 where not exists (select 1 from entitlements as c where c.cust_id = f.cust_id
   and c.product_id = f.product_id and f.month between date_trunc('month', c.start_date)
   and c.end_date)
 and exists (select 1 from entitlements as a, entitlements as b
   where a.cust_id = f.cust_id and a.product_id = f.product_id and b.cust_id = f.cust_id
   and b.product_id = f.product_id and b.start_date - a.end_date > 31
   and a.end_date < f.month and date_trunc('month', b.start_date) > f.month))"""
NEXT = """(select end_date, lead(start_date) over (partition by cust_id, product_id
   order by start_date, end_date, entitlement_id) as following from entitlements)"""


def rollup(name: str, mart: str) -> str:
    return row(
        name,
        tally("gap >= 0.01"),
        "max(gap)",
        f"""(select abs(x.v - y.v) as gap
 from (select month, money_sum(value_at_risk_usd) as v from {FACT} group by month) as x
 inner join (select month, money_sum(value_at_risk_usd) as v from {mart} group by month) as y
 using (month))""",
        "observed < 0.01",
    )


def share(name: str, condition: str, source: str, test: str) -> str:
    value = f"{tally(condition)} / count(*)::double"
    return row(name, f"(not ({test.format(value)}))::int", value, source)


def orphan(child: str, parent: str, key: str) -> str:
    return row(
        f"dq_orphan_fk:{child}.{key}", "count(*)", "count(*)", f"{child} anti join {parent} using ({key})"
    )


def unique(table: str, key: str) -> str:
    return row(
        f"dq_pk_unique:{table}", f"count(*) - count(distinct {key})", f"count(distinct {key})", table
    )


def bounded(table: str, low: int, high: int) -> str:
    return row(
        f"dq_row_counts:{table}", f"(count(*) not between {low} and {high})::int", "count(*)", table
    )


def both(*parts: str) -> str:
    return "\nunion all\n".join(parts)


CHECKS = {
    "dq_shelfware_never_null": row(
        "dq_shelfware_never_null", tally(f"{IDLE} and vrr is null"), tally(IDLE), FACT
    ),
    "dq_rate_le_one": row(
        "dq_rate_le_one", tally("consumption_rate > 1"), "max(consumption_rate)", FACT
    ),
    "dq_deploying_null": row(
        "dq_deploying_null", tally("flag_deploying and vrr = 0"), tally("flag_deploying"), FACT
    ),
    "dq_unlimited_coverage_only": row(
        "dq_unlimited_coverage_only",
        tally(f"{OPEN} and (consumption_rate is not null or vrr is distinct from feature_coverage)"),
        tally(OPEN),
        FACT,
    ),
    "dq_no_internal": row("dq_no_internal", tally("cust_name ^@ 'INTERNAL'"), "count(*)", FACT),
    "dq_factors_not_null": row(
        "dq_factors_not_null",
        tally("feature_coverage is null or (consumption_rate is null and not flag_unlimited)"),
        "count(*)",
        FACT,
    ),
    "dq_rates_unit_interval": row(
        "dq_rates_unit_interval",
        tally(
            "least(consumption_rate, feature_coverage, vrr) < 0 "
            "or greatest(consumption_rate, feature_coverage, vrr) > 1"
        ),
        "count(*)",
        FACT,
    ),
    "dq_coverage_le_one": row(
        "dq_coverage_le_one",
        tally("feature_coverage > 1.000000001"),
        "max(feature_coverage)",
        FACT,
        "observed <= 1.000000001",
    ),
    "dq_value_split_reconcile": row(
        "dq_value_split_reconcile",
        tally(f"{SPLIT} >= 0.01"),
        f"max({SPLIT})",
        FACT,
        "observed < 0.01",
    ),
    "dq_zero_fill_happened": wanted(
        "dq_zero_fill_happened", tally("was_zero_filled"), "stg_consumption"
    ),
    "dq_recovery_complete_only": row(
        "dq_recovery_complete_only", tally("not quarter_is_complete"), "count(*)",
        "mart_owner_recovery",
    ),
    "dq_recovery_has_negative": wanted(
        "dq_recovery_has_negative", tally("value_recovered_usd < 0"), "mart_owner_recovery"
    ),
    "dq_recovery_reconciles": row(
        "dq_recovery_reconciles", tally(f"{MOVED} >= 0.01"), f"max({MOVED})",
        "mart_owner_recovery", "observed < 0.01",
    ),
    "dq_cohort_shares": both(
        share("dq_cohort_shares:shelfware", "behaviour_cohort = 'shelfware'", "customers",
              "{} between 0.08 and 0.12"),
        share("dq_cohort_shares:unlabelled", "behaviour_cohort = 'unlabelled'", "customers",
              "{} between 0.88 and 0.92"),
    ),
    "dq_internal_exist": wanted("dq_internal_exist", tally("is_internal"), "customers"),
    "dq_owner_populated": row(
        "dq_owner_populated", tally("account_owner is null"), "count(distinct account_owner)",
        "customers",
    ),
    "dq_unlimited_exist": wanted("dq_unlimited_exist", tally("is_unlimited"), "entitlements"),
    "dq_unlimited_null_amount": row(
        "dq_unlimited_null_amount", "count(licensed_amount)", "count(*)",
        "entitlements where is_unlimited",
    ),
    "dq_non_usd_share": share("dq_non_usd_share", "currency <> 'USD'", "entitlements", "{} > 0.05"),
    "dq_all_usd": row(
        "dq_all_usd",
        tally("fx_rate_to_usd is null or fx_rate_to_usd <= 0 or (currency = 'USD') <> (fx_rate_to_usd = 1)"),
        "count(*)", "entitlements",
    ),
    "dq_term_order": row(
        "dq_term_order", tally("start_date > end_date"), "count(*)", "entitlements"
    ),
    "dq_shelfware_scores_zero": row(
        "dq_shelfware_scores_zero", tally("score is distinct from 0"), tally("flagged"),
        f"(select avg(vrr) as score, bool_or(flag_shelfware) as flagged from {FACT} where {IDLE} "
        "group by cust_id)",
        "violations = 0 and observed > 0",
    ),
    "dq_spike_decay": row(
        "dq_spike_decay", "(not ifnull(early > late and late < 0.05, false))::int", "late",
        "(select avg(avg_vrr) filter (where month_idx < 4) as early, "
        "avg(avg_vrr) filter (where month_idx > 5) as late from spike_curve)",
    ),
    "dq_overage_flagged": row(
        "dq_overage_flagged", "count(*) - sum(hit)",
        "case when avg(hit) > 0.8 and max(peak) > 1.2 then max(peak) end",
        "(select max(flag_chronic_overage::int) as hit, max(overage_ratio) as peak "
        f"from {FACT} where behaviour_cohort = 'unlabelled' group by cust_id)",
        "observed is not null",
    ),
    "dq_models_covered": row(
        "dq_models_covered", tally("scored = 0"), "count(*)",
        f"(select count(vrr) as scored from {FACT} group by consumption_model)",
        "violations = 0 and observed >= 2",
    ),
    "dq_incomplete_last_only": row(
        "dq_incomplete_last_only", tally("late <> (month = newest)"), tally("late"),
        f"(select month, bool_or(is_incomplete) as late, max(max(month)) over () as newest "
        f"from {FACT} group by month)",
    ),
    "dq_gap_not_scored": row("dq_gap_not_scored", "count(*)", "count(*)", STRAY),
    "dq_spine_unique": row(
        "dq_spine_unique", tally("n > 1"), "max(n)",
        "(select count(*) as n from stg_consumption group by entitlement_id, month)",
    ),
    "dq_twelve_month_reconcile": row(
        "dq_twelve_month_reconcile", tally("miss >= 0.001"), "max(miss)",
        """(select abs(total - e.units_purchased * p.list_price_per_unit * e.fx_rate_to_usd)
   / (e.units_purchased * p.list_price_per_unit * e.fx_rate_to_usd) as miss
 from (select entitlement_id, money_sum(contract_value_month) as total from stg_consumption
       group by entitlement_id having count(*) = 12)
 inner join entitlements as e using (entitlement_id) inner join products as p using (product_id))""",
        "ifnull(observed < 0.001, true)",
    ),
    "dq_customer_rollup": rollup("dq_customer_rollup", "mart_customer_adoption"),
    "dq_product_rollup": rollup("dq_product_rollup", "mart_product_adoption"),
    "dq_portfolio_plausible": row(
        "dq_portfolio_plausible",
        "(not (12 * money_sum(licensed_value_usd) > 1e5 and 12 * money_sum(licensed_value_usd) < 1e12))::int",
        "12 * money_sum(licensed_value_usd)",
        f"{FACT} where month = (select max(month) from {FACT})",
    ),
    "dq_overlaps_exist": wanted("dq_overlaps_exist", "count(*)", OVERLAP, 2),
    "dq_renewal_gaps": wanted("dq_renewal_gaps", "count(*)", PARTED),
    "dq_adjacent_overlap_gap": both(
        wanted("dq_adjacent_overlap_gap:overlaps", tally("following <= end_date"), NEXT),
        wanted("dq_adjacent_overlap_gap:gaps", tally("following > end_date + 1"), NEXT),
    ),
    "dq_duplicates_exist": wanted(
        "dq_duplicates_exist", "count(*) - count(distinct (entitlement_id, month))",
        "consumption_monthly",
    ),
    "dq_unentitled_usage": wanted(
        "dq_unentitled_usage", "count(*)",
        "feature_adoption_monthly anti join features using (feature_id, product_id)",
    ),
    "dq_latest_month_partial": row(
        "dq_latest_month_partial", "(not ifnull(share < 0.7, false))::int", "share",
        "(select arg_max(used / nullif(before, 0), month) as share from (select month, used, "
        "lag(used) over (order by month) as before from (select month, sum(consumed_units) as used "
        "from consumption_monthly group by month)))",
    ),
    "dq_row_counts": both(
        bounded("customers", 1, 10_000_000), bounded("products", 6, 6),
        bounded("entitlements", 1, 1_000_000_000), bounded("features", 24, 24),
    ),
    "dq_history_months": wanted(
        "dq_history_months", "count(distinct month)", "consumption_monthly", 12
    ),
    "dq_core_feature_per_product": row(
        "dq_core_feature_per_product", "count(*)", "count(*)",
        "products anti join (select product_id from features where feature_tier = 'Core') "
        "using (product_id)",
    ),
    "dq_orphan_fk": both(
        orphan("entitlements", "customers", "cust_id"),
        orphan("entitlements", "products", "product_id"),
        orphan("features", "products", "product_id"),
        orphan("consumption_monthly", "entitlements", "entitlement_id"),
    ),
    "dq_shelfware_zero_usage": row(
        "dq_shelfware_zero_usage", "(ifnull(sum(consumed_units), 0) <> 0)::int",
        "ifnull(sum(consumed_units), 0)",
        "consumption_monthly where cust_id in "
        "(select cust_id from customers where behaviour_cohort = 'shelfware')",
    ),
    "dq_overage_ratio": row(
        "dq_overage_ratio", "(not ifnull(avg((ratio > 1.2)::int) > 0.9, false))::int",
        "median(ratio)",
        "(select ifnull(sum(consumed_units) / nullif(sum(licensed_amount_month), 0), null) as ratio "
        "from consumption_monthly inner join customers using (cust_id) "
        "where behaviour_cohort = 'unlabelled' group by cust_id)",
    ),
    "dq_pk_unique": both(
        unique("customers", "cust_id"), unique("products", "product_id"),
        unique("features", "feature_id"), unique("entitlements", "entitlement_id"),
    ),
    "dq_expansion_denominator": row(
        "dq_expansion_denominator",
        tally("held is distinct from licensed_amount_month"), tally("contracts > 1"),
        f"""(select f.licensed_amount_month, sum(e.licensed_amount / 12) as held,
   count(*) as contracts
 from {FACT} as f inner join entitlements as e on e.cust_id = f.cust_id
  and e.product_id = f.product_id and e.start_date <= last_day(f.month) and e.end_date >= f.month
 group by f.cust_id, f.product_id, f.month, f.licensed_amount_month)""",
    ),
}

CURVE = f"""
select month_idx, avg(vrr) as avg_vrr
from (select vrr, row_number() over (partition by cust_id, product_id order by month) as month_idx
      from {FACT} where vrr is not null and behaviour_cohort = 'unlabelled')
group by month_idx"""

QUERIES = {
    **{name: (sql, ["observed"]) for name, sql in CHECKS.items()},
    "spike_curve": ("select * from spike_curve", ["avg_vrr"]),
    "dq_all": ("\nunion all\n".join(f"({sql})" for sql in CHECKS.values()), ["observed"]),
}
