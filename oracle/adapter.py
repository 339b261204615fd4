"""The seven raw tables from the TPC-H-like tables, in SQL."""

RAW = {
    "item": """
select l_suppkey as cust, p_type as sku, p_type || '-' || (p_size % 4) as feat,
       p_size % 4 as size_class, l_shipdate::date as day,
       date_trunc('month', l_shipdate)::date as mon, l_quantity as qty
from lineitem inner join part on p_partkey = l_partkey""",
    "customers": """
select s_suppkey::varchar || suffix as cust_id, s_name as cust_name, r_name as region,
       case when s_acctbal < 4500 then 'Mid-Market' else 'Enterprise' end as segment,
       n_name as industry, date '1990-01-01' + s_suppkey::integer as customer_since,
       behaviour_cohort,
       'OWNER_' || (s_suppkey % 6) as account_owner, s_suppkey % 33 = 5 as is_internal
from supplier inner join nation on n_nationkey = s_nationkey
inner join region on r_regionkey = n_regionkey
inner join (values ('', 'unlabelled'), ('-D', 'shelfware')) as account(suffix, behaviour_cohort)
   on suffix = '' or s_suppkey % 10 = 7""",
    "products": """
select p_type as product_id, p_type || ' SKU' as product_name,
       'PLATFORM_' || (length(p_type) % 3) as product_platform,
       case p_type when 'PROMO' then 'Essentials' when 'ECONOMY' then 'Essentials'
                   when 'STANDARD' then 'Advanced' when 'SMALL' then 'Advanced'
                   else 'Premium' end as sku_tier,
       case length(p_type) % 2 when 0 then 'licensed_units' else 'credits' end as consumption_model,
       min(p_retailprice) as list_price_per_unit
from part group by p_type""",
    "features": """
select p_type || '-' || n as feature_id, p_type as product_id,
       'Feature ' || p_type || '-' || n as feature_name,
       'Capability ' || p_type || '-' || n as feature_description,
       (['Core', 'Differentiator', 'Adjacent', 'Adjacent'])[n + 1] as feature_tier,
       ([3, 2, 1, 1])[n + 1]::bigint as feature_value_weight
from (select distinct p_type, p_size % 4 as n from part)""",
    "yearly": """
select cust, sku, yr, begun, 10 + (cust * 13 + yr * 7) % 60 as units,
       cust % 20 = 3 as unlimited, row_number() over (partition by cust, sku order by yr) as term_no
from (select cust, sku, year(day) as yr, min(day) as begun from item group by all)""",
    "entitlements": """
select concat_ws('-', cust, sku, yr, 'B') as entitlement_id, cust::varchar as cust_id,
       sku as product_id, units::bigint as units_purchased,
       case when not unlimited then (units * 12)::double end as licensed_amount,
       begun as start_date,
       (begun + interval 12 month - interval 1 day)::date as end_date,
       case term_no when 1 then 'New' else 'Renewal' end as contract_type,
       (['USD', 'EUR', 'GBP', 'USD', 'USD'])[cust % 5 + 1] as currency,
       ([1.0, 1.09, 1.27, 1.0, 1.0])[cust % 5 + 1]::double as fx_rate_to_usd,
       unlimited as is_unlimited
from yearly
union all
select concat_ws('-', cust, sku, yr, 'X'), cust::varchar, sku, (units * 2)::bigint,
       (units * 24)::double, (begun + interval 6 month)::date,
       (begun + interval 18 month - interval 1 day)::date, 'Expansion',
       (['USD', 'EUR', 'GBP', 'USD', 'USD'])[cust % 5 + 1],
       ([1.0, 1.09, 1.27, 1.0, 1.0])[cust % 5 + 1]::double, false
from yearly where (cust * 7 + yr) % 8 = 0 and not unlimited
union all
select distinct concat_ws('-', cust, sku, term), cust::varchar || '-D', sku, 10::bigint, 120::double,
       begin_day, end_day, kind, 'USD', 1::double, false
from item inner join (values
  ('S1', date '2000-03-10', date '2000-09-09', 'New'),
  ('S2', date '2001-01-10', date '2001-07-09', 'Renewal')) as idle(term, begin_day, end_day, kind)
   on cust % 10 = 7""",
    "holder": """
select r.cust, r.sku, r.mon, max(e.entitlement_id) as held
from (select distinct cust, sku, mon from item) as r
inner join entitlements as e
   on e.cust_id = r.cust::varchar and e.product_id = r.sku
  and e.start_date <= last_day(r.mon) and e.end_date >= r.mon
group by all""",
    "consumption_monthly": """
select h.held as entitlement_id, h.cust::varchar as cust_id, h.sku as product_id, h.mon as month,
       u.qty as consumed_units, e.licensed_amount / 12 as licensed_amount_month
from (select cust, sku, mon, sum(qty) as qty from item group by all) as u
inner join holder as h on h.cust = u.cust and h.sku = u.sku and h.mon = u.mon
inner join entitlements as e on e.entitlement_id = h.held
inner join (values (1), (2)) as copy(n)
   on n = 1 or (h.cust + month(h.mon) + year(h.mon)) % 50 = 0""",
    "feature_adoption_monthly": """
select h.held as entitlement_id, h.cust::varchar as cust_id, h.sku as product_id,
       case n when 1 then u.feat else case h.sku when 'PROMO' then 'SMALL-0' else 'PROMO-0' end
       end as feature_id,
       h.mon as month, true as is_active, u.cnt as usage_events, u.cnt as active_users
from (select cust, sku, feat, mon, count(*) as cnt from item group by all) as u
inner join holder as h on h.cust = u.cust and h.sku = u.sku and h.mon = u.mon
inner join (values (1), (2)) as copy(n)
   on n = 1 or (h.cust + month(h.mon) + year(h.mon)) % 37 = 0""",
    "in_term": """
select e.entitlement_id, e.cust_id, e.product_id, min(r.day) filter (where r.qty >= 25) as strong_day,
       min(r.day) filter (where r.size_class = 0) as core_day
from entitlements as e
inner join item as r
   on r.cust::varchar = e.cust_id and r.sku = e.product_id
  and r.day >= e.start_date and r.day <= e.end_date
group by all""",
    "deployment_events": """
select entitlement_id, cust_id, product_id, 'contract_start' as event_type, start_date as event_date
from entitlements
union all
select entitlement_id, cust_id, product_id, 'first_value', strong_day
from in_term where strong_day is not null
union all
select entitlement_id, cust_id, product_id, 'core_complete', core_day
from in_term where core_day is not null""",
}

DOUBLES = {
    "products": ["list_price_per_unit"],
    "entitlements": ["licensed_amount", "fx_rate_to_usd"],
    "consumption_monthly": ["consumed_units", "licensed_amount_month"],
}

TABLES = (
    "customers",
    "products",
    "features",
    "entitlements",
    "consumption_monthly",
    "feature_adoption_monthly",
    "deployment_events",
)
