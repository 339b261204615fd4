"""The seven raw tables, derived from the TPC-H-like tables by fixed column rules.

A supplier plays the customer, a part type the SKU, a part-size class the
feature, and line items are usage; every line item is booked. Suppliers whose
number ends in 7 have a second, dormant account, with contracts on their SKUs
and no usage: the planted shelfware. Its two terms leave a renewal gap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fulluse.sources.schemas import raw_schema, raw_tables

Keep = Callable[[str, DataFrame], DataFrame]

SHELF_DIGIT = 7
DORMANT = "-D"
IDLE_TERMS = (
    ("S1", "2000-03-10", "2000-09-09", "New"),
    ("S2", "2001-01-10", "2001-07-09", "Renewal"),
)
STRONG_QUANTITY = 25


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in raw_schema(table)])


def _in(values: list[str]) -> Column:
    return F.col("p_type").isin(values)


class AdaptedTables(Mapping[str, DataFrame]):
    """Lazy mapping of raw table name to DataFrame.

    ``keep`` stores each table, and the usage that several are made of, so that
    one run derives it once and plans know how small the catalogue is.
    """

    def __init__(self, spark: SparkSession, folder: str, keep: Keep | None = None) -> None:
        self.spark = spark
        self.folder = folder
        self._keep = keep or (lambda name, df: df)
        self._built: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter(raw_tables())

    def __len__(self) -> int:
        return len(raw_tables())

    def __getitem__(self, table: str) -> DataFrame:
        if table not in raw_tables():
            raise KeyError(table)
        return self._memo(table, kept=True)

    def source(self, table: str) -> DataFrame:
        """The derivation itself, without storing its result."""
        return getattr(self, f"_{table}")()

    def _memo(self, name: str, kept: bool) -> DataFrame:
        if name not in self._built:
            df = self.source(name)
            self._built[name] = self._keep(name, df) if kept else df
        return self._built[name]

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    # Dimensions

    def _customers(self) -> DataFrame:
        number = F.col("s_suppkey")
        active = F.struct(F.lit("").alias("suffix"), F.lit("unlabelled").alias("cohort"))
        dormant = F.struct(F.lit(DORMANT).alias("suffix"), F.lit("shelfware").alias("cohort"))
        accounts = F.when(number % 10 == SHELF_DIGIT, F.array(active, dormant)).otherwise(
            F.array(active)
        )
        places = (
            self._read("nation")
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )
        df = (
            self._read("supplier")
            .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("*", F.inline(accounts))
            .select(
                F.concat(number, "suffix").alias("cust_id"),
                F.col("s_name").alias("cust_name"),
                F.col("r_name").alias("region"),
                F.when(F.col("s_acctbal") >= 4500, "Enterprise")
                .otherwise("Mid-Market")
                .alias("segment"),
                F.col("n_name").alias("industry"),
                F.date_add(F.lit("1990-01-01").cast("date"), number.cast("int")).alias(
                    "customer_since"
                ),
                F.col("cohort").alias("behaviour_cohort"),
                F.concat(F.lit("OWNER_"), number % 6).alias("account_owner"),
                (number % 33 == 5).alias("is_internal"),
            )
        )
        return _typed(df, "customers")

    def _products(self) -> DataFrame:
        kind, width = F.col("p_type"), F.length("p_type")
        df = (
            self._read("part")
            .groupBy("p_type")
            .agg(F.min("p_retailprice").alias("list_price_per_unit"))
            .select(
                kind.alias("product_id"),
                F.concat(kind, F.lit(" SKU")).alias("product_name"),
                F.concat(F.lit("PLATFORM_"), width % 3).alias("product_platform"),
                F.when(_in(["PROMO", "ECONOMY"]), "Essentials")
                .when(_in(["STANDARD", "SMALL"]), "Advanced")
                .otherwise("Premium")
                .alias("sku_tier"),
                F.when(width % 2 == 0, "licensed_units")
                .otherwise("credits")
                .alias("consumption_model"),
                "list_price_per_unit",
            )
        )
        return _typed(df, "products")

    def _features(self) -> DataFrame:
        size_class = F.col("size_class")
        name = F.concat_ws("-", "p_type", "size_class")
        df = (
            self._read("part")
            .select("p_type", (F.col("p_size") % 4).alias("size_class"))
            .distinct()
            .select(
                name.alias("feature_id"),
                F.col("p_type").alias("product_id"),
                F.concat(F.lit("Feature "), name).alias("feature_name"),
                F.concat(F.lit("Capability "), name).alias("feature_description"),
                F.when(size_class == 0, "Core")
                .when(size_class == 1, "Differentiator")
                .otherwise("Adjacent")
                .alias("feature_tier"),
                F.when(size_class == 0, 3).when(size_class == 1, 2).otherwise(1).alias(
                    "feature_value_weight"
                ),
            )
        )
        return _typed(df, "features")

    # Usage

    def _usage(self) -> DataFrame:
        """Line items per customer, SKU, feature and day."""
        items = self._read("lineitem").select(
            F.col("l_suppkey").alias("cust"),
            F.col("l_partkey").alias("p_partkey"),
            F.col("l_shipdate").cast("date").alias("day"),
            F.col("l_quantity").alias("quantity"),
        )
        parts = self._read("part").select(
            "p_partkey",
            F.col("p_type").alias("product_id"),
            (F.col("p_size") % 4).alias("size_class"),
        )
        size_class = F.col("size_class")
        return (
            items.join(parts, "p_partkey")
            .groupBy("cust", "product_id", "size_class", "day")
            .agg(
                F.count("*").alias("records"),
                F.sum("quantity").alias("units"),
                F.max("quantity").alias("peak"),
            )
            .select(
                "cust",
                "product_id",
                F.concat_ws("-", "product_id", size_class).alias("feature_id"),
                (size_class == 0).alias("is_core"),
                "day",
                "records",
                "units",
                "peak",
                F.trunc("day", "month").alias("month"),
            )
        )

    def usage(self) -> DataFrame:
        return self._memo("usage", kept=True)

    # Contracts

    def _entitlements(self) -> DataFrame:
        cust, year = F.col("cust"), F.col("year")
        unlimited = cust % 20 == 3
        by_pair = Window.partitionBy("cust", "product_id")
        yearly = (
            self.usage()
            .groupBy("cust", "product_id", F.year("day").alias("year"))
            .agg(F.min("day").alias("begun"))
            .withColumn("first_year", F.min("year").over(by_pair))
            .withColumn("units", 10 + (cust * 13 + year * 7) % 60)
            .withColumn("unlimited", unlimited)
        )
        expands = ((cust * 7 + year) % 8 == 0) & ~F.col("unlimited")
        kinds = F.when(expands, F.array(F.lit("B"), F.lit("X"))).otherwise(F.array(F.lit("B")))
        extra = F.col("kind") == "X"
        grown = yearly.withColumn("kind", F.explode(kinds)).select(
            F.concat_ws("-", cust, "product_id", year, "kind").alias("entitlement_id"),
            cust.alias("cust_id"),
            "product_id",
            F.when(extra, F.col("units") * 2).otherwise(F.col("units")).alias("units_purchased"),
            F.when(F.col("unlimited"), F.lit(None))
            .when(extra, F.col("units") * 24)
            .otherwise(F.col("units") * 12)
            .alias("licensed_amount"),
            F.when(extra, F.add_months("begun", 6)).otherwise(F.col("begun")).alias("start_date"),
            F.date_sub(
                F.when(extra, F.add_months("begun", 18)).otherwise(F.add_months("begun", 12)), 1
            ).alias("end_date"),
            F.when(extra, "Expansion")
            .when(year > F.col("first_year"), "Renewal")
            .otherwise("New")
            .alias("contract_type"),
            F.when(cust % 5 == 1, "EUR").when(cust % 5 == 2, "GBP").otherwise("USD").alias(
                "currency"
            ),
            F.when(cust % 5 == 1, 1.09).when(cust % 5 == 2, 1.27).otherwise(1.0).alias(
                "fx_rate_to_usd"
            ),
            F.col("unlimited").alias("is_unlimited"),
        )
        terms = F.array(
            *[
                F.struct(
                    F.lit(term).alias("term"),
                    F.lit(start).cast("date").alias("start_date"),
                    F.lit(end).cast("date").alias("end_date"),
                    F.lit(kind).alias("contract_type"),
                )
                for term, start, end, kind in IDLE_TERMS
            ]
        )
        idle = (
            self.usage()
            .filter(cust % 10 == SHELF_DIGIT)
            .select("cust", "product_id")
            .distinct()
            .select("*", F.inline(terms))
            .select(
                F.concat_ws("-", cust, "product_id", "term").alias("entitlement_id"),
                F.concat(cust, F.lit(DORMANT)).alias("cust_id"),
                "product_id",
                F.lit(10).alias("units_purchased"),
                F.lit(120.0).alias("licensed_amount"),
                "start_date",
                "end_date",
                "contract_type",
                F.lit("USD").alias("currency"),
                F.lit(1.0).alias("fx_rate_to_usd"),
                F.lit(False).alias("is_unlimited"),
            )
        )
        return _typed(grown, "entitlements").unionByName(_typed(idle, "entitlements"))

    # Facts

    def _phase(self) -> Column:
        return F.col("cust") + F.month("month") + F.year("month")

    def _booked(self) -> DataFrame:
        """Monthly usage by feature with the contract it is booked on: the last by id of those active in the month.

        Contracts and usage meet in one exchange by customer and SKU, and contracts get their months after it, so the
        contract-months never travel. Days, of which the calendar bounds how many a pair has, are added up to a row for
        each month and feature after that same exchange; ``consumed_units`` is that of all features, and one row of a
        month is its first.
        """
        pair, key = ["cust_id", "product_id"], ["cust_id", "product_id", "month"]
        held = Window.partitionBy(*key)
        daily = (
            self.usage()
            .filter(F.col("cust").isNotNull() & F.col("product_id").isNotNull() & F.col("month").isNotNull())
            .select(
                "cust",
                F.col("cust").cast("string").alias("cust_id"),
                "product_id",
                "feature_id",
                F.col("month").alias("_used"),
                "records",
                "units",
            )
        )
        contracts = self["entitlements"].select(
            *pair, "start_date", "end_date", F.struct("entitlement_id", "licensed_amount").alias("_contract")
        )
        active = F.expr("sequence(trunc(start_date, 'month'), end_date, interval 1 month)")
        months = F.when(F.col("_contract").isNotNull(), active).otherwise(F.array("_used"))
        return (
            contracts.unionByName(daily, allowMissingColumns=True)
            .repartition(*pair)
            .withColumn("month", F.explode(months))
            .withColumns(
                {
                    "_held": F.max("_contract").over(held),
                    "consumed_units": F.sum("units").over(held),
                    "is_first": F.col("feature_id") == F.min("feature_id").over(held),
                }
            )
            .filter(F.col("_contract").isNull() & F.col("_held").isNotNull())
            .groupBy("cust", *key, "feature_id", "consumed_units", "is_first", "_held")
            .agg(F.sum("records").alias("usage_events"))
            .select("cust", *key, "feature_id", "usage_events", "consumed_units", "is_first", "_held.*")
        )

    def booked(self) -> DataFrame:
        return self._memo("booked", kept=True)

    def _consumption_monthly(self) -> DataFrame:
        sent = F.when(self._phase() % 50 == 0, 2).otherwise(1)
        df = (
            self.booked()
            .filter("is_first")
            .withColumn("licensed_amount_month", F.col("licensed_amount") / 12.0)
            .withColumn("_sent", F.explode(F.sequence(F.lit(1), sent)))
        )
        return _typed(df, "consumption_monthly")

    def _feature_adoption_monthly(self) -> DataFrame:
        foreign = F.when(F.col("product_id") == "PROMO", "SMALL-0").otherwise("PROMO-0")
        seen = F.when(self._phase() % 37 == 0, F.array("feature_id", foreign)).otherwise(
            F.array("feature_id")
        )
        df = (
            self.booked()
            .withColumn("feature_id", F.explode(seen))
            .withColumns({"is_active": F.lit(True), "active_users": F.col("usage_events")})
        )
        return _typed(df, "feature_adoption_monthly")

    def _deployment_events(self) -> DataFrame:
        """Each contract's start, and the first strong and the first Core day of its term.

        Contracts and days meet in one exchange by customer and SKU, in the order of days; no months are spread. A day
        may have a row for each size class: what was seen last is the same.
        """
        pair = ["cust_id", "product_id"]
        strong = F.col("peak") >= STRONG_QUANTITY
        days = (
            self.usage()
            .filter(strong | F.col("is_core"))
            .filter(F.col("cust").isNotNull() & F.col("product_id").isNotNull() & F.col("day").isNotNull())
            .select(
                F.col("cust").cast("string").alias("cust_id"),
                "product_id",
                "day",
                strong.alias("strong"),
                F.col("is_core").alias("core"),
            )
        )
        terms = self["entitlements"].select("entitlement_id", *pair, "start_date", "end_date")
        # A contract sorts behind the days from its start on; what was seen last there is the first such day.
        order = Window.partitionBy(*pair).orderBy(F.desc("day"), "_is_contract")
        reached = (
            terms.withColumn("day", F.col("start_date"))
            .filter(F.col("day").isNotNull() & F.col("end_date").isNotNull())
            .withColumn("_is_contract", F.lit(True))
            .unionByName(days.withColumn("_is_contract", F.lit(False)), allowMissingColumns=True)
            .withColumns(
                {
                    step: F.last(F.when(F.col(mark), F.col("day")), ignorenulls=True).over(
                        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                    )
                    for step, mark in (("first_value", "strong"), ("core_complete", "core"))
                }
            )
            .filter("_is_contract")
            .groupBy("entitlement_id", *pair)
            .agg(
                *[
                    F.min(F.when(F.col(step) <= F.col("end_date"), F.col(step))).alias(step)
                    for step in ("first_value", "core_complete")
                ]
            )
        )
        steps = F.array(
            *[
                F.struct(F.lit(step).alias("event_type"), F.col(step).alias("event_date"))
                for step in ("first_value", "core_complete")
            ]
        )
        later = reached.select(
            "entitlement_id", "cust_id", "product_id", F.inline(steps)
        ).filter(F.col("event_date").isNotNull())
        begun = self["entitlements"].select(
            "entitlement_id",
            "cust_id",
            "product_id",
            F.lit("contract_start").alias("event_type"),
            F.col("start_date").alias("event_date"),
        )
        return _typed(begun.unionByName(later), "deployment_events")
