"""The model graph: which table is built from which, lazily or written out."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fulluse.operators import audit, intermediate, marts, staging
from fulluse.plans import storage
from fulluse.plans.params import Params
from fulluse.sources.adapter import AdaptedTables
from fulluse.sources.schemas import AUDIT_COLUMNS, raw_tables

Keep = Callable[[str, DataFrame], DataFrame]

# Models in dependency order.
MODELS = (
    "stg_customers",
    "stg_entitlements",
    "stg_entitlement_month",
    "stg_consumption",
    "stg_feature_activity",
    "int_consumption_rate",
    "int_feature_coverage",
    "int_deployment",
    "int_flags",
    "mart_customer_sku_month",
    "mart_customer_adoption",
    "mart_product_adoption",
    "mart_feature_adoption",
    "mart_owner_recovery",
    "mart_exec_summary",
)

# Read by several models or queries, so worth writing once.
SHARED = (
    "stg_entitlements",
    "stg_consumption",
    "stg_feature_activity",
    "mart_customer_sku_month",
)

# Large tables that are mostly read one month at a time.
MONTH_ORDERED = ("stg_feature_activity", "mart_customer_sku_month")


class Models:
    """Raw tables and models by name, each built on first use.

    Without ``keep`` every model is one lazy plan over the raw tables. With it,
    the shared ones are written and read back. ``folder`` holds the audit
    history of such a run. A known ``window`` saves reading it from the usage.
    The activity grid of kept models, or with ``laid``, is laid by month before
    it unfolds.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        params: Params = Params(),
        keep: Keep | None = None,
        folder: str | None = None,
        window: staging.MonthWindow | None = None,
        laid: bool = False,
    ) -> None:
        self.raw = raw
        self._laid = laid or keep is not None
        self.folder = folder
        self.params = params
        self._keep = keep
        self._built: dict[str, DataFrame] = {}
        self._window = window

    def __getitem__(self, name: str) -> DataFrame:
        if name in raw_tables():
            return self.raw[name]
        if name not in self._built:
            df = getattr(self, f"_{name}")()
            if self._keep is not None and name in SHARED:
                df = self._keep(name, df)
            self._built[name] = df
        return self._built[name]

    def put(self, name: str, df: DataFrame) -> None:
        """Let later models read ``df`` as the named model."""
        self._built[name] = df

    def kept(self, name: str, made: Callable[[], DataFrame]) -> DataFrame:
        """A table beside the models, made on first use and written where these models write."""
        if name not in self._built:
            df = made()
            self._built[name] = self._keep(name, df) if self._keep is not None else df
        return self._built[name]

    def window(self) -> staging.MonthWindow:
        if self._window is None:
            self._window = staging.data_window(self["consumption_monthly"])
        return self._window

    def latest_month(self) -> Column:
        return staging.last_active_month(self["stg_entitlements"], self.window())

    def feature_hits(self) -> DataFrame:
        return staging.feature_hits(
            self["stg_entitlements"], self.window(), self["feature_adoption_monthly"]
        )

    def _stg_customers(self) -> DataFrame:
        return staging.customers(self["customers"])

    def _stg_entitlements(self) -> DataFrame:
        return staging.entitlements(
            self["entitlements"],
            self["products"],
            self["stg_customers"],
        )

    def _stg_entitlement_month(self) -> DataFrame:
        return staging.entitlement_month(self["stg_entitlements"], self.window())

    def _stg_consumption(self) -> DataFrame:
        return staging.consumption(self["stg_entitlement_month"], self["consumption_monthly"])

    def _stg_feature_activity(self) -> DataFrame:
        return staging.feature_activity(
            self["stg_entitlement_month"],
            self["stg_entitlements"],
            self.window(),
            self["features"],
            self["feature_adoption_monthly"],
            storage.BY_MONTH if self._laid else (),
        )

    def _int_consumption_rate(self) -> DataFrame:
        return intermediate.consumption_rate(self["stg_consumption"])

    def _int_feature_coverage(self) -> DataFrame:
        return intermediate.feature_coverage(
            self["stg_entitlements"],
            self.window(),
            self.feature_hits(),
            self["features"],
        )

    def _int_deployment(self) -> DataFrame:
        return intermediate.deployment(
            self["stg_entitlements"], self["deployment_events"], self.window()
        )

    def _int_flags(self) -> DataFrame:
        return intermediate.flags(
            self["int_consumption_rate"],
            self["int_deployment"],
            self.latest_month(),
            self.params,
        )

    def _mart_customer_sku_month(self) -> DataFrame:
        return marts.customer_sku_month(
            self["int_consumption_rate"],
            self["int_feature_coverage"],
            self["int_deployment"],
            self["stg_customers"],
            self["products"],
            self.latest_month(),
            self.params,
        )

    def _mart_customer_adoption(self) -> DataFrame:
        return marts.customer_adoption(self["mart_customer_sku_month"])

    def _mart_product_adoption(self) -> DataFrame:
        return marts.product_adoption(self["mart_customer_sku_month"])

    def _mart_feature_adoption(self) -> DataFrame:
        return marts.feature_adoption(
            self.feature_hits(),
            self["stg_entitlement_month"],
            self["features"],
        )

    def _mart_owner_recovery(self) -> DataFrame:
        return marts.owner_recovery(self["mart_customer_sku_month"], self.params)

    def _mart_exec_summary(self) -> DataFrame:
        return marts.exec_summary(self["mart_customer_sku_month"])


def refresh(raw: Mapping[str, DataFrame], folder: str, params: Params = Params()) -> None:
    """Bring every model of an earlier :func:`run` in ``folder`` to what a full run over ``raw`` would write.

    Added, changed and removed input reaches back: flags look over all months
    of a pair, and the month that was last before is no longer incomplete. So
    all models are planned over the whole history; the large month-foldered
    tables are written only in the months that differ.
    """
    models = Models(raw, params)
    for name in MODELS:
        df = models[name]
        if name in MONTH_ORDERED:
            path = f"{folder}/{name}"
            storage.replace_changed_months(df, path)
            models.put(name, storage.read_written(df.sparkSession, path, df))
        else:
            models.put(name, write_model(df, name, folder))


@dataclass(frozen=True)
class Run:
    models: Models
    audit: DataFrame


def write_model(
    df: DataFrame, name: str, folder: str, watched: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    path = f"{folder}/{name}"
    if name in MONTH_ORDERED:
        return storage.replace_table(
            df, path, storage.BY_MONTH, storage.IN_MONTH, month_folders=True, watched=watched
        )
    return storage.replace_table(df, path, watched=watched)


def run(
    raw: Mapping[str, DataFrame],
    folder: str,
    run_ts: datetime,
    params: Params = Params(),
) -> Run:
    """Rebuild every model under ``folder`` and publish the run in its audit history.

    Rows and flags are counted while the models are written.
    """
    models = Models(raw, params)
    seconds: dict[str, float] = {}
    taken: dict[str, dict[str, object]] = {}
    for name in MODELS:
        started = time.monotonic()
        seen = Observation(name)
        watched = lambda df, seen=seen, name=name: df.observe(seen, *audit.measures(name))
        models.put(name, write_model(models[name], name, folder, watched))
        seconds[name] = time.monotonic() - started
        taken[name] = seen.get
    rows = audit.full(models, MODELS, seconds, taken)
    stamped = audit.stamp(rows, run_ts)
    path = f"{folder}/pipeline_audit"
    publish_audit(stamped, path)
    return Run(models, audit.of_run(read_history(stamped.sparkSession, path), audit.run_id(run_ts)))


def publish_audit(stamped: DataFrame, path: str) -> None:
    """Put stamped audit rows into the history at ``path``, in the place of the same run."""
    storage.publish(stamped.withColumn(audit.RUN, audit.run_label(F.col("run_id"))), path, audit.RUN)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{AUDIT_COLUMNS}, {audit.RUN} string").parquet(path)


_SESSIONS: dict[tuple[str, str, str], Models] = {}


def session_models(spark: SparkSession, folder: str, params: Params = Params()) -> Models:
    """Models over the TPC-H-like tables in ``folder``; shared ones are written once per application.

    A month is read from few pages here, without an exchange of the widest rows: every file of the base fact is sorted
    by month, and the activity grid is laid by month before it unfolds.
    """
    key = (spark.sparkContext.applicationId, folder, repr(params))
    if key not in _SESSIONS:
        work = storage.WorkFolder(spark, "session")

        def keep(name: str, df: DataFrame) -> DataFrame:
            if name == "mart_customer_sku_month":
                return work.keep(name, df, within=(*storage.BY_MONTH, *storage.IN_MONTH))
            return work.keep(name, df)

        _SESSIONS[key] = Models(AdaptedTables(spark, folder, keep), params, keep, work.path)
    return _SESSIONS[key]
