"""Staging models: clean the raw tables and put them on the contract-month spine.

Months are first-of-month dates throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulluse.functions import metrics as m

PRODUCT_DIMS = ("product_name", "product_platform", "sku_tier", "consumption_model")


def customers(raw_customers: DataFrame) -> DataFrame:
    """Paying customers only. An unknown internal flag also keeps a tenant out."""
    return raw_customers.filter(~F.col("is_internal")).select(
        "cust_id",
        "cust_name",
        "region",
        "segment",
        "industry",
        "customer_since",
        "account_owner",
        "behaviour_cohort",
    )


def entitlements(
    raw_entitlements: DataFrame,
    products: DataFrame,
    kept_customers: DataFrame,
) -> DataFrame:
    """Contracts of kept customers with product attributes and the unit price in USD."""
    paying = raw_entitlements.join(kept_customers.select("cust_id"), "cust_id")
    priced = paying.join(products, "product_id")
    return priced.select(
        "entitlement_id",
        "cust_id",
        "product_id",
        "units_purchased",
        "licensed_amount",
        "start_date",
        "end_date",
        "contract_type",
        "currency",
        "is_unlimited",
        *PRODUCT_DIMS,
        m.usd_price(F.col("list_price_per_unit"), F.col("fx_rate_to_usd")).alias(
            "price_per_unit_usd"
        ),
    )


MonthWindow = tuple[Column, Column]


def data_window(consumption: DataFrame) -> MonthWindow:
    """First and last month with usage data, read once and used as literals from then on.

    Literals reach the scans of the monthly facts as pushed filters, and no
    later plan has to read the usage table again just for its months.
    """
    first, last = consumption.agg(F.min("month"), F.max("month")).collect()[0]
    return F.lit(first).cast("date"), F.lit(last).cast("date")


def active_span(contracts: DataFrame, window: MonthWindow) -> DataFrame:
    """Contracts active in the window, with the first month and the last day of that activity."""
    first, last = window
    dated = F.col("start_date").isNotNull() & F.col("end_date").isNotNull() & first.isNotNull()
    return (
        contracts.filter(dated)
        .withColumns(
            {
                "_from": F.greatest(F.trunc("start_date", "month"), first),
                "_to": F.least(F.col("end_date"), last),
            }
        )
        .filter(F.col("_from") <= F.col("_to"))
    )


def spread_months(contracts: DataFrame, window: MonthWindow) -> DataFrame:
    """One row per contract and calendar month in which it is active on any day.

    Only active months are generated, so the output is the spine itself and
    never contracts x window. The condition around the sequence keeps it valid
    wherever the optimizer puts the filter.
    """
    valid = F.col("_from") <= F.col("_to")
    months = F.when(valid, F.expr("sequence(_from, _to, interval 1 month)"))
    return (
        active_span(contracts, window)
        .withColumn("month", F.explode(months))
        .drop("_from", "_to")
    )


def last_active_month(contracts: DataFrame, window: MonthWindow) -> Column:
    """Last month of the spine, from the contracts alone, as a scalar subquery."""
    return active_span(contracts, window).agg(F.max(F.trunc("_to", "month"))).scalar()


def monthly_capacity() -> Column:
    return F.when(F.col("is_unlimited"), F.lit(None)).otherwise(m.monthly(F.col("licensed_amount")))


def months_by_pair(contracts: DataFrame, window: MonthWindow, *columns: str) -> DataFrame:
    """Contract-months with these columns of their contracts, the ones of a customer and SKU in one partition.

    Different contracts move, once each, and their months appear after the exchange. For results in which equal contracts
    count once.
    """
    pair = ("cust_id", "product_id")
    terms = contracts.select(*pair, "start_date", "end_date", *columns).distinct()
    return spread_months(terms.repartition(*pair), window)


def entitlement_month(contracts: DataFrame, window: MonthWindow) -> DataFrame:
    """The spine with monthly capacity and monthly contract value.

    Capacity is the entitled amount; money is units bought times unit price.
    """
    value = F.col("units_purchased") * F.col("price_per_unit_usd")
    return spread_months(contracts, window).select(
        "entitlement_id",
        "cust_id",
        "product_id",
        *PRODUCT_DIMS,
        "contract_type",
        "is_unlimited",
        "price_per_unit_usd",
        "units_purchased",
        "start_date",
        "end_date",
        "month",
        monthly_capacity().alias("licensed_amount_month"),
        m.monthly(value).alias("contract_value_month"),
    )


def consumption(spine: DataFrame, raw_consumption: DataFrame) -> DataFrame:
    """Usage on the spine: the largest of repeated records, zero where there is none.

    The maximum combines before the shuffle, so repeats of one contract-month
    never meet in one task.
    """
    usage = (
        raw_consumption.groupBy("entitlement_id", "month")
        .agg(F.max("consumed_units").alias("_used"))
        .withColumn("_seen", F.lit(True))
    )
    return spine.join(usage, ["entitlement_id", "month"], "left").select(
        "entitlement_id",
        "cust_id",
        "product_id",
        "month",
        "licensed_amount_month",
        "is_unlimited",
        "price_per_unit_usd",
        "contract_value_month",
        F.coalesce("_used", F.lit(0.0)).alias("consumed_units"),
        F.col("_seen").isNull().alias("was_zero_filled"),
    )


def booked(
    records: DataFrame, contracts: DataFrame, window: MonthWindow
) -> DataFrame:
    """Monthly records that fall on the spine, with the customer and SKU of their contract.

    Joining the contracts on their id and testing the month gives what joining
    the spine would, and shuffles one row per contract instead of one per
    contract-month.
    """
    month = F.col("month")
    terms = contracts.select("entitlement_id", "cust_id", "product_id", "start_date", "end_date")
    return (
        records.join(terms, "entitlement_id")
        .filter(
            (month == F.trunc(month, "month"))
            & month.between(F.trunc("start_date", "month"), F.col("end_date"))
            & month.between(*window)
        )
        .drop("start_date", "end_date")
    )


def feature_places(catalogue: DataFrame) -> DataFrame:
    """The catalogue with each feature's place in its SKU's bitmap: a word of 64 bits and the bit in it.

    Rows that repeat a feature share its place.
    """
    place = F.dense_rank().over(Window.partitionBy("product_id").orderBy("feature_id")) - 1
    return catalogue.withColumn("_place", place).select(
        *catalogue.columns,
        F.floor(F.col("_place") / 64).cast("int").alias("_word"),
        (F.col("_place") % 64).alias("_bit"),
    )


def feature_activity(
    spine: DataFrame,
    contracts: DataFrame,
    window: MonthWindow,
    features: DataFrame,
    raw_activity: DataFrame,
    together: Sequence[str] = (),
) -> DataFrame:
    """Every entitled feature of every contract-month; inactive unless a record says otherwise.

    A repeated activity record is kept as its own row. Equal records travel as
    one row with a count, so a contract that is loaded many times shuffles
    little. The untouched features are what the SKU's catalogue has beyond a
    bitmap of the recorded ones: a contract-month travels as one row for each 64
    features. Names, copies and untouched features appear after the last
    exchange; one that lays rows with the same ``together`` side by side comes
    before that. Records on features outside the SKU match nothing and drop.
    """
    seats = spine.select("entitlement_id", "cust_id", "product_id", "month")
    catalogue = features.select(
        "product_id", "feature_id", "feature_name", "feature_tier", "feature_value_weight"
    )
    records = raw_activity.select(
        "entitlement_id", "month", "feature_id", "is_active", "usage_events"
    )
    counted = records.groupBy(*records.columns).agg(F.count("*").alias("_copies"))
    places = feature_places(catalogue)
    recorded = booked(counted, contracts, window).join(
        places.select("product_id", "feature_id", "_word", "_bit").distinct(),
        ["product_id", "feature_id"],
    )
    used = recorded.select(
        *seats.columns,
        "_word",
        F.lit(None).cast("long").alias("_taken"),
        "_bit",
        F.coalesce("is_active", F.lit(False)).alias("is_active"),
        F.coalesce("usage_events", F.lit(0)).alias("usage_events"),
        "_copies",
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    seat = ["entitlement_id", "product_id", "month", "_word"]
    # The count is always positive; reading it makes the combined records one exchange for both uses.
    taken = recorded.groupBy(*seat).agg(F.bit_or(F.when(F.col("_copies") > 0, bit)).alias("_taken"))
    words = places.groupBy("product_id").agg(F.collect_set("_word").alias("_words"))
    unused = (
        seats.join(words, "product_id")
        .withColumn("_word", F.explode("_words"))
        .drop("_words")
        .join(taken, seat, "left")
        .select(
            *seats.columns,
            "_word",
            F.coalesce("_taken", F.lit(0).cast("long")).alias("_taken"),
            F.lit(None).cast("int").alias("_bit"),
            F.lit(False).alias("is_active"),
            F.lit(0).cast("long").alias("usage_events"),
            F.lit(1).cast("long").alias("_copies"),
        )
    )
    folded = used.unionByName(unused)
    if together:
        folded = folded.hint("rebalance", *[F.col(c) for c in together])
    return unfolded(folded, places)


def unfolded(folded: DataFrame, places: DataFrame) -> DataFrame:
    """The activity grid from its travelling form: a record has its feature's bit, a seat the bitmap of recorded ones.

    The catalogue is broadcast, so that the grid never passes an exchange.
    """
    entry = F.struct("_bit", "feature_id", "feature_name", "feature_tier", "feature_value_weight")
    entries = places.groupBy("product_id", "_word").agg(F.collect_list(entry).alias("_entries"))
    idle = lambda e: F.call_function("bit_get", F.col("_taken"), e["_bit"]) == 0
    own = lambda e: e["_bit"] == F.col("_bit")
    meant = F.filter("_entries", lambda e: F.when(F.col("_taken").isNull(), own(e)).otherwise(idle(e)))
    row = ["entitlement_id", "cust_id", "product_id", "month", "is_active", "usage_events"]
    return (
        folded.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .join(F.broadcast(entries), ["product_id", "_word"])
        .select(*row, F.explode(meant).alias("_entry"))
        .select(*row, "_entry.*")
        .select(
            *row[:4],
            "feature_id",
            "feature_name",
            "feature_tier",
            "feature_value_weight",
            *row[4:],
        )
    )


def feature_hits(
    contracts: DataFrame, window: MonthWindow, raw_activity: DataFrame
) -> DataFrame:
    """Activity per contract-month and feature, combined before it meets the contracts.

    ``records`` counts repeats, so the row counts of :func:`feature_activity`
    can be recovered without building it.
    """
    combined = raw_activity.groupBy("entitlement_id", "month", "feature_id").agg(
        F.count("*").alias("records"),
        F.count_if("is_active").alias("active_records"),
        F.sum("usage_events").alias("usage_events"),
    )
    return booked(combined, contracts, window)
