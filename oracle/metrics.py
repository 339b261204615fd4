"""Source checks, single metrics and audit rows in SQL."""

from oracle.models import NAMES

REQUIRED = [
    ("customers", "cust_id"),
    ("products", "product_id"),
    ("features", "feature_id"),
    ("features", "product_id"),
    ("entitlements", "entitlement_id"),
    ("entitlements", "cust_id"),
    ("entitlements", "product_id"),
    ("consumption_monthly", "entitlement_id"),
    ("consumption_monthly", "month"),
    ("feature_adoption_monthly", "entitlement_id"),
    ("feature_adoption_monthly", "feature_id"),
    ("feature_adoption_monthly", "month"),
    ("deployment_events", "entitlement_id"),
]

TABLES = (
    "customers",
    "products",
    "features",
    "entitlements",
    "consumption_monthly",
    "feature_adoption_monthly",
    "deployment_events",
)

RAW_COUNTS = "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as n from {t}" for t in TABLES
)


def step(layer, model, action, note, rows_in, rows_out, removed, source):
    return (
        f"select '{layer}' as layer, '{model}' as model, '{action}' as action, "
        f"({rows_in})::bigint as rows_in, ({rows_out})::bigint as rows_out, "
        f"({removed})::bigint as rows_removed, {note} as note from {source}"
    )


STEPS = {
    "audit_dedupe": step(
        "stg", "stg_consumption", "dedupe",
        "'repeated contract-month usage rows removed'",
        "count(*)", "count(distinct (entitlement_id, month))",
        "count(*) - count(distinct (entitlement_id, month))", "consumption_monthly",
    ),
    "audit_internal": step(
        "stg", "stg_customers", "exclude internal", "'internal and test tenants left out'",
        "count(*)", "sum((not is_internal)::int)", "sum(is_internal::int)", "customers",
    ),
    "audit_currency": step(
        "stg", "stg_entitlements", "convert currency",
        "sum((currency <> 'USD')::int)::bigint || ' contracts converted to USD'",
        "null", "null", "0", "entitlements",
    ),
    "audit_unlimited": step(
        "stg", "stg_entitlements", "flag unlimited",
        "sum(is_unlimited::int)::bigint || ' contracts without a capacity, scored on coverage'",
        "null", "null", "0", "entitlements",
    ),
    "audit_zero_fill": step(
        "stg", "stg_consumption", "zero-fill",
        "sum(was_zero_filled::int)::bigint || ' contract-months without usage set to zero'",
        "null", "count(*)", "-sum(was_zero_filled::int)", "stg_consumption",
    ),
    "audit_unentitled": step(
        "stg", "stg_feature_activity", "drop unentitled",
        "'activity on features outside the SKU'",
        "count(*)", "sum(known::int)", "sum((not known)::int)",
        "(select exists (select 1 from features as f where f.feature_id = a.feature_id "
        "and f.product_id = a.product_id) as known from feature_adoption_monthly as a)",
    ),
    "audit_gap_months": step(
        "stg", "stg_entitlement_month", "exclude gap months",
        "'months without an active contract, not scored'", "null", "null", "count(*)",
        "(select cust_id, product_id, unnest(generate_series(min(month), max(month), "
        "interval 1 month))::date as month from stg_entitlement_month "
        "group by cust_id, product_id) as span "
        "anti join stg_entitlement_month using (cust_id, product_id, month)",
    ),
    "audit_incomplete": step(
        "int", "int_flags", "mark incomplete", "strftime(max(month), '%Y-%m') || ' still loading'",
        "null", "null", "count(*)", "int_flags where is_incomplete",
    ),
    "audit_flags": "\nunion all\n".join(
        step(
            "int", "int_flags", "flag raised",
            f"'{label}: ' || count(*) || ' customer-SKU-months'",
            "null", "null", "count(*)", f"int_flags where {flag}",
        )
        for flag, label in [
            ("flag_shelfware", "shelfware"),
            ("flag_spike_drop", "spike and drop"),
            ("flag_chronic_overage", "chronic overage"),
            ("flag_deploying", "deploying, not scored"),
        ]
    ),
}

BUILT = "\nunion all\n".join(
    f"select '{n.split('_')[0]}' as layer, '{n}' as model, 'model built' as action, "
    f"count(*) as rows_out from {n}"
    for n in NAMES
)


COLUMNS = "layer, model, action, rows_in, rows_out, rows_removed, note"
AUDIT = "\nunion all\n".join(
    [
        "select layer, model, action, null::bigint as rows_in, rows_out, null::bigint as rows_removed, "
        f"null::varchar as note from (\n{BUILT}\n)",
        *(f"select {COLUMNS} from (\n{sql}\n)" for sql in STEPS.values()),
    ]
)
#: The two registered runs: id, and seconds since 1970.
RUNS = "(values ('20020101060000', 1009864800::bigint), ('20020102060000', 1009951200::bigint)) as r(run_id, run_epoch)"


def fact(*columns: str, doubles: list[str] | None = None) -> tuple[str, list[str]]:
    sql = f"select cust_id, product_id, month, {', '.join(columns)} from mart_customer_sku_month"
    return sql, list(columns) if doubles is None else doubles


QUERIES: dict[str, tuple[str, list[str]]] = {
    "chk_required": (
        "\nunion all\n".join(
            f"select '{t}' as table_name, '{c}' as column_name, "
            f"count(*) - count({c}) as null_rows from {t}"
            for t, c in REQUIRED
        ),
        [],
    ),
    "load_parity": (
        "select table_name, n as source_rows, n as landed_rows, 0::bigint as lost_rows, "
        f"true as matches from (\n{RAW_COUNTS}\n)",
        [],
    ),
    "consumption_rate": fact("consumption_rate"),
    "overage_ratio": fact("overage_ratio"),
    "feature_coverage": fact("feature_coverage"),
    "vrr": fact("vrr"),
    "value_split": fact("licensed_value_usd", "realized_value_usd", "value_at_risk_usd"),
    "flag_shelfware": fact("flag_shelfware", doubles=[]),
    "flag_spike_drop": fact("flag_spike_drop", doubles=[]),
    "flag_chronic_overage": fact("flag_chronic_overage", doubles=[]),
    "flag_deploying": fact("flag_deploying", doubles=[]),
    "flag_unlimited": fact("flag_unlimited", doubles=[]),
    "is_incomplete": fact("is_incomplete", doubles=[]),
    "vrr_value_weighted": (
        "select month, vrr_value_weighted from mart_exec_summary",
        ["vrr_value_weighted"],
    ),
    "annualize": (
        "select month, annualized_var_usd from mart_exec_summary",
        ["annualized_var_usd"],
    ),
    "currency_normalize": (
        "select e.entitlement_id, e.currency, p.list_price_per_unit * case e.currency "
        "when 'EUR' then 1.09::double when 'GBP' then 1.27::double else 1::double end "
        "as price_per_unit_usd from entitlements as e inner join products as p "
        "using (product_id) inner join customers as c using (cust_id) where not c.is_internal",
        ["price_per_unit_usd"],
    ),
    "owner_quota": (
        "select account_owner, quarter, quota_usd, quota_attainment from mart_owner_recovery",
        ["quota_usd", "quota_attainment"],
    ),
    "audit_model_built": (BUILT, []),
    **{name: (sql, []) for name, sql in STEPS.items()},
    "audit_cleaning_view": ("\nunion all\n".join(f"({sql})" for sql in STEPS.values()), []),
    "audit_publish": (f"select run_id, run_epoch, {COLUMNS} from {RUNS}, (\n{AUDIT}\n)", []),
    "run_history": (f"select run_id, run_epoch from {RUNS} order by run_id desc limit 20", []),
    "audit_built_view": (
        f"select layer, model, rows_out as row_count from (\n{BUILT}\n)",
        [],
    ),
}
