"""Incremental refresh: what a change of the raw tables reaches is read and planned, and nothing else.

Landing the raw tables leaves digests of their cells: month and bucket of contracts for the two monthly facts, bucket of
contracts or customers for the others. Comparing the digests of two landings gives the changed cells. They are carried
forward to the customer-SKU pairs and months of the base fact:

* a changed cell of a monthly fact reaches its month, for the pairs of its contracts;
* a changed contract, milestone or customer reaches all months of its pairs;
* a month that enters or leaves the data window reaches every pair active in it, and the month that was or becomes the
  last one reaches the pairs that have it.

Only the reached months of the raw facts are scanned. Flags look over all months of a pair, so a reached pair's other
months are needed too, but their factors are unchanged and come from the stored fact. Of the stored tables only months
in which a row differs are written. Rollups are small and made anew from the stored fact. A changed catalogue (SKUs or
features) reaches everything and is a full build.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fulluse.operators import intermediate, marts, staging
from fulluse.operators.intermediate import KEY, PAIR
from fulluse.plans import storage
from fulluse.plans.params import Params
from fulluse.plans.pipeline import Models
from fulluse.sources.schemas import raw_tables
from fulluse.sources.tables import union_all

BUCKETS = 256
FACTS = ("consumption_monthly", "feature_adoption_monthly")
CATALOGUE = ("products", "features")
BUCKET_KEY = {"customers": "cust_id"} | {
    t: "entitlement_id" for t in ("entitlements", "deployment_events", *FACTS)
}

FACT, ACTIVITY, ADOPTION = "mart_customer_sku_month", "stg_feature_activity", "mart_feature_adoption"
#: The tables that a store keeps up to date; the first two by month.
BY_MONTH = (FACT, ACTIVITY)
SMALL = ("stg_customers", "stg_entitlements")
ROLLUPS = ("mart_customer_adoption", "mart_product_adoption", "mart_owner_recovery", "mart_exec_summary")
DIGESTS = "raw_digests"


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def digests(raw: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, month, bucket, rows, digest: one row per cell; it changes when any row of the cell does.

    At most months times buckets rows for a table, whatever its size.
    """
    parts = []
    for table in raw_tables():
        df = raw[table]
        month = F.col("month") if table in FACTS else F.lit(None).cast("date")
        cell = bucket(BUCKET_KEY[table]) if table in BUCKET_KEY else F.lit(0)
        hashed = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
        parts.append(
            df.select(F.lit(table).alias("table_name"), month.alias("month"), cell.alias("bucket"), hashed.alias("h"))
            .groupBy("table_name", "month", "bucket")
            .agg(F.count("*").alias("rows"), F.sum("h").alias("digest"))
        )
    return union_all(parts)


def changed_cells(old: DataFrame, new: DataFrame) -> DataFrame:
    """table_name, month, bucket of cells that differ, in either direction."""
    cell = ["table_name", "month", "bucket"]
    tagged = old.withColumn("side", F.lit(1)).unionByName(new.withColumn("side", F.lit(-1)))
    return (
        tagged.groupBy(*cell, "rows", "digest")
        .agg(F.sum("side").alias("balance"))
        .filter("balance <> 0")
        .select(*cell)
        .distinct()
    )


Window = tuple[date | None, date | None]


def window_of(cells: DataFrame) -> Window:
    """First and last month with usage, from the digests alone."""
    used = cells.filter((F.col("table_name") == "consumption_monthly"))
    return tuple(used.agg(F.min("month"), F.max("month")).first())


def literals(window: Window) -> staging.MonthWindow:
    return tuple(F.lit(month).cast("date") for month in window)


def months_between(first: date | None, last: date | None) -> list[date]:
    if first is None or last is None:
        return []
    numbers = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [date(n // 12, n % 12 + 1, 1) for n in numbers]


def in_months(months: Sequence[date]) -> Column:
    return F.col("month").isin(list(months)) if months else F.lit(False)


@dataclass(frozen=True)
class Reach:
    """What a change reaches: pairs, months of the base fact and months of the activity grid."""

    pairs: DataFrame
    months: list[date]
    activity_months: list[date]
    window: Window


def spanned(contracts: DataFrame, window: Window) -> list[date]:
    """The months from the first to the last in which any of the contracts is active; bounded by the calendar."""
    span = staging.active_span(contracts, literals(window))
    return months_between(*span.agg(F.trunc(F.min("_from"), "month"), F.trunc(F.max("_to"), "month")).first())


def reach(
    cells: DataFrame, before: DataFrame, after: DataFrame, fact: DataFrame, old: Window, new: Window, work: storage.WorkFolder
) -> Reach:
    """``before`` and ``after`` are the contracts of kept customers, ``fact`` is the stored base fact."""
    either = before.select("entitlement_id", *PAIR, "start_date", "end_date").unionByName(
        after.select("entitlement_id", *PAIR, "start_date", "end_date")
    )
    either = either.withColumns({"_contract": bucket("entitlement_id"), "_customer": bucket("cust_id")})

    def of(tables: Sequence[str], column: str) -> DataFrame:
        hit = cells.filter(F.col("table_name").isin(list(tables))).select(F.col("bucket").alias(column)).distinct()
        return either.join(hit, column, "left_semi")

    whole = work.keep(
        "whole", of(("entitlements", "deployment_events"), "_contract").union(of(("customers",), "_customer")).select(*PAIR).distinct()
    )
    of_whole = either.join(whole, PAIR, "left_semi")
    touched = {
        r["table_name"]: r["months"]
        for r in cells.filter(F.col("table_name").isin(list(FACTS))).groupBy("table_name").agg(F.collect_set("month").alias("months")).collect()
    }
    known = set(months_between(*new))
    edges = set(months_between(*old)) ^ known
    spans = set(spanned(of_whole, new)) | set(spanned(of_whole, old))
    activity = set(touched.get("feature_adoption_monthly", ())) | edges | spans
    months = activity | set(touched.get("consumption_monthly", ()))
    # The month that was the last one is complete now, and the one that is the last no longer is.
    latest = [staging.active_span(c, literals(w)).agg(F.max(F.trunc("_to", "month"))).first()[0] for c, w in ((before, old), (after, new))]
    flipped = [x for x in latest if x is not None] if latest[0] != latest[1] else []
    pairs = of(FACTS, "_contract").select(*PAIR).union(whole)
    if edges:
        active = [
            staging.spread_months(either.drop("_contract", "_customer"), literals(w)).filter(in_months(sorted(edges))).select(*PAIR)
            for w in (old, new)
        ]
        pairs = pairs.union(active[0]).union(active[1])
    if flipped:
        pairs = pairs.union(fact.filter(F.col("month") >= min(flipped)).select(*PAIR))
    return Reach(work.keep("pairs", pairs.distinct()), sorted(months & known), sorted(activity & known), new)


def recomputed(raw: Mapping[str, DataFrame], contracts: DataFrame, found: Reach) -> DataFrame:
    """Factors of the reached pairs in the reached months, from those months of the raw facts."""
    window, months = literals(found.window), in_months(found.months)
    terms = contracts.join(found.pairs, PAIR, "left_semi")
    usage, activity = (raw[table].filter(months) for table in FACTS)
    spine = staging.entitlement_month(terms, window).filter(months)
    rates = intermediate.consumption_rate(staging.consumption(spine, usage))
    hits = staging.feature_hits(terms, window, activity)
    coverage = intermediate.feature_coverage(terms, window, hits, raw["features"]).filter(months)
    timing = intermediate.deployment(terms, raw["deployment_events"], window).filter(months)
    return marts.factors(rates, coverage, timing).select(*marts.FACTORS)


def stored_factors(fact: DataFrame, found: Reach) -> DataFrame:
    """Factors of the reached pairs in all other months, from the stored fact."""
    first, last = literals(found.window)
    rest = fact.filter(~in_months(found.months) & F.col("month").between(first, last))
    return rest.join(found.pairs, PAIR, "left_semi").select(
        *[F.col(marts.STORED_AS.get(c, c)).alias(c) for c in marts.FACTORS]
    )


class Store:
    """The base fact, the activity grid and the rollups in a folder, with the digests of what they were made from."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = Params()) -> None:
        self.spark, self.folder, self.params = spark, folder, params

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return storage.read_written(self.spark, self.path(name), like)

    def build(self, raw: Mapping[str, DataFrame]) -> None:
        """Everything, from the whole of the raw tables."""
        models = Models(raw, self.params, laid=True)
        for name in (*SMALL, *BY_MONTH):
            models.put(name, self._put(name, models[name]))
        for name in (ADOPTION, *ROLLUPS):
            self._put(name, models[name])
        self._put(DIGESTS, digests(raw))

    def _put(self, name: str, df: DataFrame) -> DataFrame:
        if name == ACTIVITY:
            # Laid by month while it is folded, so that the grid itself passes no exchange.
            order = (*storage.BY_MONTH, *storage.IN_MONTH)
            return storage.replace_table(df, self.path(name), (), order, month_folders=True)
        if name in BY_MONTH:
            return storage.replace_table(df, self.path(name), storage.BY_MONTH, storage.IN_MONTH, month_folders=True)
        return storage.replace_table(df, self.path(name))

    def refresh(self, raw: Mapping[str, DataFrame]) -> Reach | None:
        """Bring every table to what :meth:`build` over ``raw`` would write; None after a full build.

        The digests are written last: a refresh that was killed is simply run again.
        """
        work = storage.WorkFolder(self.spark, "refresh")
        new = work.keep(DIGESTS, digests(raw))
        old = self.read(DIGESTS, new)
        cells = work.keep("cells", changed_cells(old, new))
        if cells.filter(F.col("table_name").isin(list(CATALOGUE))).limit(1).count():
            self.build(raw)
            return None
        old_window, window = window_of(old), window_of(new)
        models = Models(raw, self.params, window=literals(window))
        contracts = work.keep("contracts", models["stg_entitlements"])
        models.put("stg_entitlements", contracts)
        fact = self.read(FACT, models[FACT])
        found = reach(cells, self.read("stg_entitlements", contracts), contracts, fact, old_window, window, work)
        latest = staging.last_active_month(contracts, literals(window))
        rows = marts.scored(
            recomputed(raw, contracts, found).unionByName(stored_factors(fact, found)),
            models["stg_customers"], raw["products"], latest, self.params,
        )
        rows = work.keep("rows", rows, storage.BY_MONTH, storage.IN_MONTH)
        self._replace_pairs(rows, fact, found, work)
        self._replace_activity(raw, contracts, found, old_window)
        self._replace_adoption(raw, contracts, found, work)
        for name in SMALL:
            self._put(name, models[name])
        models.put(FACT, self.read(FACT, fact))
        for name in ROLLUPS:
            self._put(name, models[name])
        self._put(DIGESTS, new)
        return found

    def _replace_pairs(self, rows: DataFrame, fact: DataFrame, found: Reach, work: storage.WorkFolder) -> None:
        """Write the months of the fact in which a row of the reached pairs differs."""
        rows = rows.select(*fact.columns)
        mine = fact.join(found.pairs, PAIR, "left_semi")
        differing = storage.differing_months(rows, mine)
        if not differing:
            return
        others = fact.filter(in_months(differing)).join(found.pairs, PAIR, "left_anti")
        merged = work.keep("merged", rows.filter(in_months(differing)).unionByName(others))
        storage.refresh_months(merged, self.path(FACT))
        left = {r["month"] for r in merged.select("month").distinct().collect()}
        storage.drop_months(self.spark, self.path(FACT), set(differing) - left)

    def _replace_activity(self, raw: Mapping[str, DataFrame], contracts: DataFrame, found: Reach, old: Window) -> None:
        window, months = literals(found.window), in_months(found.activity_months)
        spine = staging.entitlement_month(contracts, window).filter(months)
        grid = staging.feature_activity(
            spine, contracts, window, raw["features"], raw["feature_adoption_monthly"].filter(months), storage.BY_MONTH
        )
        if found.activity_months:
            storage.refresh_months(grid.filter(months), self.path(ACTIVITY), laid=True)
        held = spine.join(raw["features"], "product_id", "left_semi").select("month").distinct()
        emptied = set(found.activity_months) - {r["month"] for r in held.collect()}
        gone = set(months_between(*old)) - set(months_between(*found.window))
        storage.drop_months(self.spark, self.path(ACTIVITY), gone | emptied)

    def _replace_adoption(self, raw: Mapping[str, DataFrame], contracts: DataFrame, found: Reach, work: storage.WorkFolder) -> None:
        window, months = literals(found.window), in_months(found.activity_months)
        hits = staging.feature_hits(contracts, window, raw["feature_adoption_monthly"].filter(months))
        spine = staging.entitlement_month(contracts, window).filter(months)
        made = marts.feature_adoption(hits, spine, raw["features"])
        kept = self.read(ADOPTION, made).filter(~months & F.col("month").between(*window))
        self._put(ADOPTION, work.keep(ADOPTION, made.unionByName(kept)))
