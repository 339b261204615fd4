"""Analytical and planned queries in SQL."""

from oracle.models import DOUBLES

FACT = "mart_customer_sku_month"
NOW = f"(select max(month) from {FACT} where not is_incomplete)"
EXEC = "mart_exec_summary"
BY_CUSTOMER = "mart_customer_adoption"
BY_PRODUCT = "mart_product_adoption"

PARTS = {
    "finished": f"select * from {EXEC} where not is_incomplete",
    "placed": f"""
select cust_name, segment, account_owner, feature_coverage, consumption_rate,
       vrr_value_weighted as vrr, licensed_value_usd * 12 as book_usd,
       value_at_risk_usd * 12 as var_usd,
       (['stalled', 'hot', 'scaled', 'value'])[
         1 + (round(consumption_rate, 12) >= 0.5)::int
         + 2 * (round(feature_coverage, 12) >= 0.5)::int] as quadrant
from {BY_CUSTOMER}
where month = {NOW} and feature_coverage + consumption_rate is not null""",
    "used_features": f"""
select cust_id, product_id, product_name, count(*) filter (where used) as features_used,
       bool_or(used and core) as uses_core
from (select cust_id, product_id, feature_id, bool_or(is_active) as used,
             bool_or(feature_tier = 'Core') as core
      from stg_feature_activity where month = {NOW} group by all)
inner join products using (product_id)
group by all""",
    "depth": "select features_used, uses_core, count(*) as n from used_features group by all",
    "stated": f"""
select *, case when skus_held = skus_deploying then 'Too new to score'
            when skus_shelfware >= 1 then 'Paying, not using'
            when skus_spike_drop >= 1 then 'Used it, then stopped'
            when skus_overage >= 1 then 'Using more than they bought'
            when ifnull(round(vrr_value_weighted, 12), 0) < 0.25 then 'Barely deployed'
            when round(vrr_value_weighted, 12) < 0.5 then 'Partly deployed'
            else 'Healthy' end as status
from {BY_CUSTOMER}""",
    "worklist": f"""
select cust_id, cust_name, status, segment, region, account_owner, vrr_value_weighted as vrr,
       consumption_rate, feature_coverage, 12 * licensed_value_usd as book_usd,
       12 * value_at_risk_usd as var_usd, skus_held
from stated where month = {NOW}""",
    "idle": f"""
select a.feature_name, a.feature_tier, p.product_name, a.feature_value_weight, a.feature_id
from stg_feature_activity as a
inner join products as p on p.product_id = a.product_id
where a.month = {NOW} and not a.is_active
  and a.cust_id = (select cust_id from worklist order by var_usd desc, cust_name, cust_id limit 1)""",
    "settled": f"""
select cust_id, account_owner, month, round(vrr_value_weighted, 12) as vrr_value_weighted
from {BY_CUSTOMER}""",
    "first_use": """
select cust_id, product_id, feature_id, min(month) as month
from stg_feature_activity where is_active group by all""",
}

WORK = ["vrr", "consumption_rate", "feature_coverage", "book_usd", "var_usd"]
OWNER = "account_owner, quarter, accounts, opening_var_usd, closing_var_usd, value_recovered_usd, quota_usd, quota_attainment"
OWNER_DOUBLES = [
    "opening_var_usd", "closing_var_usd", "value_recovered_usd", "quota_usd", "quota_attainment",
]

BOXES = [
    ("value", "Realizing value", "Expansion conversation", "Sales"),
    ("scaled", "Set up, never scaled", "Enablement — why hasn''t volume grown?", "Customer Success"),
    ("hot", "Running hot on one thing", "They''ll hit the cap and renegotiate on price",
     "Sales + Product"),
    ("stalled", "Not started", "Deployment intervention — churn risk", "CS leadership"),
]

def short(usd: str) -> str:
    return (
        f"case when {usd} is null then '—' "
        f"when abs({usd}) < 1e3 then '$' || format('{{:,.0f}}', {usd}) "
        f"when abs({usd}) < 1e6 then '$' || format('{{:,.1f}}', {usd} / 1e3) || 'k' "
        f"when abs({usd}) < 1e9 then '$' || format('{{:,.1f}}', {usd} / 1e6) || 'M' "
        f"else '$' || format('{{:,.1f}}', {usd} / 1e9) || 'B' end"
    )


QUERIES: dict[str, tuple[str, list[str]]] = {
    "trust_strip": (
        f"""select (select sum(is_internal::int) from customers)::bigint as internal_removed,
 (select count(*) - count(distinct (entitlement_id, month)) from consumption_monthly)
   as duplicates_removed,
 (select count(*) from feature_adoption_monthly anti join features using (feature_id, product_id))
   as unentitled_removed,
 {NOW} as complete_through""",
        [],
    ),
    "overview_kpis": (
        """select month, vrr_value_weighted,
 vrr_value_weighted - lag(vrr_value_weighted) over (order by month) as vrr_change,
 annualized_var_usd, 1 - vrr_value_weighted as at_risk_share, n_shelfware, n_overage,
 avg(vrr_value_weighted) over () as vrr_mean
from finished qualify month = max(month) over ()""",
        ["vrr_value_weighted", "vrr_change", "annualized_var_usd", "at_risk_share", "vrr_mean"],
    ),
    "weighted_gap": (
        """select month, vrr_value_weighted - vrr_unweighted as gap,
 case when vrr_unweighted is null then null
      when abs(round(vrr_value_weighted - vrr_unweighted, 12)) <= 0.01 then 'even'
      when vrr_value_weighted > vrr_unweighted then 'above' else 'below' end as finding
from finished""",
        ["gap"],
    ),
    "segment_risk": (
        f"""select segment, 12 * money_sum(value_at_risk_usd) as var_usd,
 count(distinct cust_id) as customers from {FACT} where month = {NOW} group by segment""",
        ["var_usd"],
    ),
    "quadrant_accounts": ("select * from placed", WORK),
    "quadrant_summary": (
        "select box.quadrant, label, count(cust_name) as accounts, "
        "ifnull(money_sum(var_usd), 0) as var_usd, play, owner from (values "
        + ", ".join(f"('{k}', '{a}', '{b}', '{c}')" for k, a, b, c in BOXES)
        + ") as box(quadrant, label, play, owner) left join placed "
        "on placed.quadrant = box.quadrant group by box.quadrant, label, play, owner",
        ["var_usd"],
    ),
    "feature_depth": ("select * from depth", []),
    "feature_depth_kpis": (
        """select count(*) as relationships, count(*) filter (where features_used < 2) as shallow,
 avg((features_used < 2)::int) as shallow_share, avg((not uses_core)::int) as no_core_share,
 avg((features_used = deepest)::int) as full_share
from (select *, max(features_used) over () as deepest from used_features)""",
        ["shallow_share", "no_core_share", "full_share"],
    ),
    "feature_depth_pivot": (
        """select features_used, count(*) filter (where uses_core) as with_core,
 count(*) filter (where not uses_core) as without_core from used_features group by features_used""",
        [],
    ),
    "feature_depth_product": (
        """select features_used, uses_core, count(*) as n from used_features
where product_name = 'PROMO SKU' group by all""",
        [],
    ),
    "sku_depth_kpis": (
        """select count(*) as relationships, count(*) filter (where features_used < 2) as shallow,
 avg((features_used < 2)::int) as shallow_share, avg((not uses_core)::int) as no_core_share,
 avg((features_used = deepest)::int) as full_share
from (select *, max(features_used) over () as deepest from used_features
      where product_name = 'PROMO SKU')""",
        ["shallow_share", "no_core_share", "full_share"],
    ),
    "account_detail": (
        f"""select cust_id, cust_name, vrr, vrr - (select vrr_value_weighted from {EXEC} where month = {NOW}) as vrr_gap,
 consumption_rate, feature_coverage
from worklist order by var_usd desc, cust_name, cust_id limit 1""",
        ["vrr", "vrr_gap", "consumption_rate", "feature_coverage"],
    ),
    "customer_status": ("select cust_id, month, status from stated", []),
    "customer_worklist": ("select * from worklist", WORK),
    "customer_worklist_filtered": (
        "select * from worklist where segment = 'Enterprise' "
        "and status <> 'Healthy' and status <> 'Too new to score'",
        WORK,
    ),
    "worklist_display": (
        f"""select cust_name, status, round_even(round(vrr, 12) * 100, 0) as score_pct,
 round_even(round(consumption_rate, 12) * 100, 0) as capacity_pct,
 round_even(round(feature_coverage, 12) * 100, 0) as features_pct,
 {short('book_usd')} as book, {short('var_usd')} as at_risk from worklist""",
        ["score_pct", "capacity_pct", "features_pct"],
    ),
    "worklist_headline": (
        "select count(*) as accounts, money_sum(var_usd) as var_usd, avg(vrr) as vrr_mean from worklist",
        ["var_usd", "vrr_mean"],
    ),
    "unused_features": (
        "select feature_name, feature_tier, product_name from idle "
        "order by feature_value_weight desc, feature_id, product_name limit 40",
        [],
    ),
    "unused_summary": (
        "select count(*) as features, count(*) filter (where feature_tier = 'Core') "
        "as core_features from idle",
        [],
    ),
    "platform_risk": (
        f"""select product_platform, 12 * money_sum(licensed_value_usd) as book_usd,
 12 * money_sum(value_at_risk_usd) as var_usd,
 money_sum(vrr_value_weighted * licensed_value_usd) / nullif(money_sum(licensed_value_usd), 0) as vrr
from {BY_PRODUCT} where month = {NOW} group by product_platform""",
        ["book_usd", "var_usd", "vrr"],
    ),
    "sku_league": (
        f"""select product_name, product_platform, sku_tier, customers, vrr_value_weighted as vrr,
 consumption_rate, feature_coverage, 12 * licensed_value_usd as book_usd,
 12 * value_at_risk_usd as var_usd
from {BY_PRODUCT} where month = {NOW} order by var_usd desc nulls last, product_name limit 60""",
        WORK,
    ),
    "sku_feature_league": (
        f"""select feature_name, feature_tier, customers_entitled, customers_active, adoption_rate
from mart_feature_adoption where month = {NOW} and product_id = 'PROMO'""",
        ["adoption_rate"],
    ),
    "owner_board": (f"select {OWNER} from mart_owner_recovery", OWNER_DOUBLES),
    "owner_board_latest": (
        f"select {OWNER} from mart_owner_recovery qualify quarter = max(quarter) over ()",
        OWNER_DOUBLES,
    ),
    "scored_trend": (
        f"""select * exclude (is_incomplete, place), place <= 2 as is_provisional from (
 select month, vrr_value_weighted, consumption_rate, feature_coverage, is_incomplete,
        row_number() over (order by month desc) as place from {EXEC})
where place <= 2 or not is_incomplete""",
        ["vrr_value_weighted", "consumption_rate", "feature_coverage"],
    ),
    "value_trend": (
        "select month, realized_value_usd, value_at_risk_usd from finished",
        ["realized_value_usd", "value_at_risk_usd"],
    ),
    "complete_months": ("select month from finished", []),
    "overage_sustained": (
        """select cust_id, product_id, month, overage_ratio,
 count(*) over run as run_months, count(*) over run >= 3 as overage_sustained
from (select *, month - to_months((row_number() over (partition by cust_id, product_id
        order by month))::int) as anchor
      from int_consumption_rate where overage_ratio >= 1.2)
window run as (partition by cust_id, product_id, anchor order by month)""",
        ["overage_ratio"],
    ),
    "provisional_by_lag": (
        f"select month, month >= date '2001-11-15' - 31 as is_provisional from {EXEC}",
        [],
    ),
    "capacity_asof": (
        """select e.cust_id, e.product_id, c.month, sum(e.licensed_amount / 12)
   filter (where not e.is_unlimited) as licensed_amount_month, count(*) as contracts
from stg_entitlements as e
inner join calendar as c on last_day(c.month) between e.start_date and e.end_date
group by all""",
        ["licensed_amount_month"],
    ),
    "core_completion": (
        """select cust_id, product_id, month, count(*) filter (where is_active) as core_active,
 count(*) as core_entitled, avg(is_active::int) as core_completion
from stg_feature_activity where feature_tier = 'Core' group by all""",
        ["core_completion"],
    ),
    "vrr_bands": (
        f"""select band, count(*) as accounts, count(*) / sum(count(*)) over () as share
from (select case when v = 0 then '0.00' when v < 0.1 then '0.00-0.10'
        when v < 0.4 then '0.10-0.40' when v < 0.7 then '0.40-0.70' else '0.70+' end as band
      from (select round(vrr_value_weighted, 12) as v from {BY_CUSTOMER} where month = {NOW})
      where v is not null)
group by band""",
        ["share"],
    ),
    "rollup_region_segment": (
        f"""select month, region, segment, grouping(month, region, segment)::bigint as level,
 12 * money_sum(licensed_value_usd) as book_usd, 12 * money_sum(value_at_risk_usd) as var_usd,
 money_sum(realized_value_usd) filter (where vrr is not null)
   / nullif(money_sum(licensed_value_usd) filter (where vrr is not null), 0) as vrr_value_weighted,
 avg(vrr) as vrr_unweighted
from {FACT} group by grouping sets ((month), (month, region), (month, region, segment))""",
        ["book_usd", "var_usd", "vrr_value_weighted", "vrr_unweighted"],
    ),
    "sustained_recovery": (
        """select account_owner, quarter, value_recovered_usd, after <= closing_var_usd
   as is_sustained,
 case when after is null then null
      when after > closing_var_usd and value_recovered_usd > 0 then 0
      else value_recovered_usd end as sustained_recovered_usd
from (select *, lead(closing_var_usd) over (partition by account_owner order by quarter) as after
      from mart_owner_recovery)""",
        ["value_recovered_usd", "sustained_recovered_usd"],
    ),
    "stage_progression": (
        f"""select month, count(*) as pairs_scored, count(*) filter (where vrr > 0) as pairs_adopting
from (select month, vrr, flag_deploying, lag(flag_deploying) over (partition by cust_id, product_id
        order by month) as before from {FACT})
where before and not flag_deploying group by month""",
        [],
    ),
    "guard_metrics": (
        """select x.account_owner, count(*) as accounts,
 max(x.vrr_value_weighted) - min(x.vrr_value_weighted) as vrr_spread,
 stddev_pop(x.vrr_value_weighted) as vrr_stddev,
 count(*) filter (where y.vrr_value_weighted < 0.25) as low_base_accounts,
 count(*) filter (where y.vrr_value_weighted < 0.25
   and y.vrr_value_weighted < x.vrr_value_weighted) as low_base_improved,
 avg((y.vrr_value_weighted < x.vrr_value_weighted)::int)
   filter (where y.vrr_value_weighted < 0.25) as low_base_improved_share
from settled as x
left join settled as y on y.cust_id = x.cust_id and y.month = x.month - interval 3 month
where x.month = (select max(month) from finished) and x.vrr_value_weighted is not null
group by x.account_owner""",
        ["vrr_spread", "vrr_stddev", "low_base_improved_share"],
    ),
    "activation_survival": (
        """select f.month, count(*) as activations, sum(alive::int)::bigint as still_active,
 avg(alive::int) as survival_share
from (select *, exists (select 1 from stg_feature_activity as a where a.cust_id = u.cust_id
        and a.product_id = u.product_id and a.feature_id = u.feature_id and a.is_active
        and a.month = (u.month + interval 3 month)::date) as alive from first_use as u) as f
where f.month + interval 3 month <= (select max(month) from calendar)
group by f.month""",
        ["survival_share"],
    ),
    "feature_value_share": (
        f"""select m.cust_id, m.product_id, m.month, f.feature_id, f.weight_share,
 m.licensed_value_usd * f.weight_share as feature_value_usd
from {FACT} as m inner join (select product_id, feature_id, feature_value_weight
  / sum(feature_value_weight) over (partition by product_id) as weight_share from features) as f
using (product_id)""",
        ["weight_share", "feature_value_usd"],
    ),
    "incremental_month_refresh": (f"select * from {FACT}", DOUBLES[FACT]),
    "coverage_unweighted": (
        """select cust_id, product_id, month, avg(is_active::int) as coverage_unweighted
from stg_feature_activity group by all""",
        ["coverage_unweighted"],
    ),
}
