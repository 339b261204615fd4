"""Declared schemas of the seven raw tables and of the audit log."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the raw tables.
RAW_COLUMNS: dict[str, str] = {
    "customers": (
        "cust_id string, cust_name string, region string, segment string, industry string, "
        "customer_since date, behaviour_cohort string, account_owner string, is_internal boolean"
    ),
    "products": (
        "product_id string, product_name string, product_platform string, sku_tier string, "
        "consumption_model string, list_price_per_unit double"
    ),
    "features": (
        "feature_id string, product_id string, feature_name string, feature_description string, "
        "feature_tier string, feature_value_weight bigint"
    ),
    "entitlements": (
        "entitlement_id string, cust_id string, product_id string, units_purchased bigint, "
        "licensed_amount double, start_date date, end_date date, contract_type string, "
        "currency string, fx_rate_to_usd double, is_unlimited boolean"
    ),
    "consumption_monthly": (
        "entitlement_id string, cust_id string, product_id string, month date, "
        "consumed_units double, licensed_amount_month double"
    ),
    "feature_adoption_monthly": (
        "entitlement_id string, cust_id string, product_id string, feature_id string, month date, "
        "is_active boolean, usage_events bigint, active_users bigint"
    ),
    "deployment_events": (
        "entitlement_id string, cust_id string, product_id string, event_type string, "
        "event_date date"
    ),
}

# Columns that must never be NULL.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("cust_id",),
    "products": ("product_id",),
    "features": ("feature_id", "product_id"),
    "entitlements": ("entitlement_id", "cust_id", "product_id"),
    "consumption_monthly": ("entitlement_id", "month"),
    "feature_adoption_monthly": ("entitlement_id", "feature_id", "month"),
    "deployment_events": ("entitlement_id",),
}

# The declared key of each raw table that has one.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("cust_id",),
    "products": ("product_id",),
    "features": ("feature_id",),
    "entitlements": ("entitlement_id",),
}

# The two monthly facts and the columns they are clustered by.
CLUSTERED: dict[str, tuple[str, ...]] = {
    "consumption_monthly": ("cust_id", "product_id"),
    "feature_adoption_monthly": ("cust_id", "product_id"),
}

AUDIT_COLUMNS = (
    "run_id string, run_ts timestamp, layer string, model string, action string, "
    "rows_in bigint, rows_out bigint, rows_removed bigint, note string"
)


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_COLUMNS[table])


def raw_tables() -> list[str]:
    return list(RAW_COLUMNS)
