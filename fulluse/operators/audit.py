"""What each step removed, added or marked, counted in one aggregate per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulluse.functions import dates as d
from fulluse.operators import staging
from fulluse.operators.intermediate import PAIR
from fulluse.sources.tables import union_all

if TYPE_CHECKING:
    from fulluse.plans.pipeline import Models

# The action names that readers of the audit filter on.
BUILT = "model built"
DEDUPE = "dedupe"
EXCLUDE_INTERNAL = "exclude internal"
CONVERT_CURRENCY = "convert currency"
FLAG_UNLIMITED = "flag unlimited"
ZERO_FILL = "zero-fill"
DROP_UNENTITLED = "drop unentitled"
EXCLUDE_GAPS = "exclude gap months"
MARK_INCOMPLETE = "mark incomplete"
FLAG_RAISED = "flag raised"

COLUMNS = ["layer", "model", "action", "rows_in", "rows_out", "rows_removed", "note"]


def entry(
    layer: str,
    model: str,
    action: str,
    note: Column,
    rows_in: Column | None = None,
    rows_out: Column | None = None,
    removed: Column | None = None,
) -> Column:
    def number(value: Column | None) -> Column:
        return (F.lit(None) if value is None else value).cast("long")

    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(model).alias("model"),
        F.lit(action).alias("action"),
        number(rows_in).alias("rows_in"),
        number(rows_out).alias("rows_out"),
        number(removed).alias("rows_removed"),
        note.alias("note"),
    )


#: What is counted of a model, besides its rows.
MEASURES: dict[str, Callable[[], dict[str, Column]]] = {
    "stg_consumption": lambda: {"filled": F.count_if("was_zero_filled")},
    "int_flags": lambda: {
        "late": F.count_if("is_incomplete"),
        "last": F.max(F.when(F.col("is_incomplete"), F.col("month"))),
        **{flag: F.count_if(flag) for flag in RAISED},
    },
}

#: Counts of models by name, as taken while they were written.
Taken = Mapping[str, Mapping[str, object]]


def measures(name: str) -> list[Column]:
    """The counts of one model, for one aggregate over it or to be observed while it is written."""
    more = MEASURES.get(name, dict)()
    return [F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in more.items()]]


def counted(models: Models, name: str, taken: Taken | None = None) -> DataFrame:
    """One row with the counts of a model: those taken at its write, else counted now."""
    if taken is None or name not in taken:
        return models[name].agg(*measures(name))
    one = models[name].sparkSession.range(1)
    return one.select(*[F.lit(value).alias(k) for k, value in taken[name].items()])


def entries(counts: DataFrame, *rows: Column) -> DataFrame:
    return counts.select(F.inline(F.array(*rows)))


def dedupe(consumption: DataFrame) -> DataFrame:
    counts = (
        consumption.groupBy("entitlement_id", "month")
        .agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.count("*").alias("kept"))
    )
    n, kept = F.col("n"), F.col("kept")
    note = F.lit("repeated contract-month usage rows removed")
    return entries(counts, entry("stg", "stg_consumption", DEDUPE, note, n, kept, n - kept))


def internal_customers(customers: DataFrame) -> DataFrame:
    counts = customers.agg(
        F.count("*").alias("n"), F.count_if(~F.col("is_internal")).alias("kept")
    )
    n, kept = F.col("n"), F.col("kept")
    note = F.lit("internal and test tenants left out")
    return entries(counts, entry("stg", "stg_customers", EXCLUDE_INTERNAL, note, n, kept, n - kept))


def contracts(entitlements: DataFrame) -> DataFrame:
    """Currency and unlimited-contract entries from one pass over the contracts."""
    counts = entitlements.agg(
        F.count_if(F.col("currency") != "USD").alias("foreign"),
        F.count_if("is_unlimited").alias("unlimited"),
    )
    none = F.lit(0)
    return entries(
        counts,
        entry(
            "stg",
            "stg_entitlements",
            CONVERT_CURRENCY,
            F.format_string("%d contracts converted to USD", "foreign"),
            removed=none,
        ),
        entry(
            "stg",
            "stg_entitlements",
            FLAG_UNLIMITED,
            F.format_string("%d contracts without a capacity, scored on coverage", "unlimited"),
            removed=none,
        ),
    )


def zero_fill(counts: DataFrame) -> DataFrame:
    note = F.format_string("%d contract-months without usage set to zero", "filled")
    return entries(
        counts,
        entry(
            "stg",
            "stg_consumption",
            ZERO_FILL,
            note,
            rows_out=F.col("n"),
            removed=-F.col("filled"),
        ),
    )


def unentitled(activity: DataFrame, features: DataFrame) -> DataFrame:
    """Both sides are counted per (feature, SKU) first, so the join is over catalogue-sized rows."""
    key = ["feature_id", "product_id"]
    seen = activity.groupBy(*key).agg(F.count("*").alias("seen"))
    listed = features.groupBy(*key).agg(F.count("*").alias("listed"))
    counts = seen.join(listed, key, "left").agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("seen") * F.col("listed")), F.lit(0)).alias("kept"),
    )
    n, kept = F.col("n"), F.col("kept")
    note = F.lit("activity on features outside the SKU")
    return entries(
        counts, entry("stg", "stg_feature_activity", DROP_UNENTITLED, note, n, kept, n - kept)
    )


def gap_months(spine: DataFrame) -> DataFrame:
    """Months between a pair's first and last active month in which no contract is active."""
    held = spine.select(*PAIR, "month").distinct()
    span = d.months_between_boundaries(F.max("month"), F.min("month")) + 1
    counts = (
        held.groupBy(*PAIR)
        .agg((span - F.count("*")).alias("gap"))
        .agg(F.coalesce(F.sum("gap"), F.lit(0)).alias("gaps"))
    )
    note = F.lit("months without an active contract, not scored")
    return entries(
        counts, entry("stg", "stg_entitlement_month", EXCLUDE_GAPS, note, removed=F.col("gaps"))
    )


# Flags that the audit counts, with their labels.
RAISED = {
    "flag_shelfware": "shelfware",
    "flag_spike_drop": "spike and drop",
    "flag_chronic_overage": "chronic overage",
    "flag_deploying": "deploying, not scored",
}


def flags(counts: DataFrame) -> DataFrame:
    """The incomplete month and the four flag counts."""
    label = d.month_label(F.col("last").cast("date"))
    note = F.concat(F.coalesce(label, F.lit("no month")), F.lit(" still loading"))
    return entries(
        counts,
        entry("int", "int_flags", MARK_INCOMPLETE, note, removed=F.col("late")),
        *[
            entry(
                "int",
                "int_flags",
                FLAG_RAISED,
                F.format_string(f"{label}: %d customer-SKU-months", flag),
                removed=F.col(flag),
            )
            for flag, label in RAISED.items()
        ],
    )


# One entry per source table; each yields the audit rows that this table answers.
CLEANING: dict[str, Callable[[Models, Taken | None], DataFrame]] = {
    "dedupe": lambda t, _: dedupe(t["consumption_monthly"]),
    "internal": lambda t, _: internal_customers(t["customers"]),
    "contracts": lambda t, _: contracts(t["entitlements"]),
    "zero_fill": lambda t, taken: zero_fill(counted(t, "stg_consumption", taken)),
    "unentitled": lambda t, _: unentitled(t["feature_adoption_monthly"], t["features"]),
    "gap_months": lambda t, _: gap_months(staging.months_by_pair(t["stg_entitlements"], t.window())),
    "flags": lambda t, taken: flags(counted(t, "int_flags", taken)),
}


def cleaning(models: Models, taken: Taken | None = None) -> DataFrame:
    return union_all([part(models, taken) for part in CLEANING.values()])


def models_built(
    models: Models,
    names: Sequence[str],
    seconds: Mapping[str, float] | None = None,
    taken: Taken | None = None,
) -> DataFrame:
    """Rows per model; the note holds the seconds a run took, when known."""
    parts = []
    for name in names:
        spent = (seconds or {}).get(name)
        note = F.lit(None if spent is None else f"{spent:.1f}s").cast("string")
        counts = counted(models, name, taken)
        parts.append(
            entries(counts, entry(name.split("_")[0], name, BUILT, note, rows_out=F.col("n")))
        )
    return union_all(parts)


def full(
    models: Models,
    names: Sequence[str],
    seconds: Mapping[str, float] | None = None,
    taken: Taken | None = None,
) -> DataFrame:
    """Every entry; counts that were ``taken`` while models were written are not counted again."""
    return models_built(models, names, seconds, taken).unionByName(cleaning(models, taken))


def run_id(run_ts: datetime) -> str:
    """The UTC second of the run."""
    return f"{run_ts:%Y%m%d%H%M%S}"


def stamp(rows: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the run columns."""
    return rows.select(
        F.lit(run_id(run_ts)).alias("run_id"),
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        *COLUMNS,
    )


def cleaning_view(log: DataFrame) -> DataFrame:
    """Cleaning steps of an audit, by layer and model."""
    return log.filter(F.col("action") != BUILT).select(*COLUMNS).orderBy("layer", "model", "note")


def built_view(log: DataFrame) -> DataFrame:
    """Models of an audit with rows and runtime."""
    return (
        log.filter(F.col("action") == BUILT)
        .select(
            "layer", "model", F.col("rows_out").alias("row_count"), F.col("note").alias("runtime")
        )
        .orderBy("model")
    )


#: The column that a history is partitioned by.
RUN = "run"


def run_label(run: str | Column) -> Column:
    """Not a number, so that it reads back as text from the folder's name."""
    return F.concat(F.lit("run-"), F.lit(run) if isinstance(run, str) else run)


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the newest run in an audit history; only its folder is read."""
    newest = history.agg(F.max(RUN)).scalar()
    return history.filter(F.col(RUN) == newest).drop(RUN)


def of_run(history: DataFrame, run: str) -> DataFrame:
    """Rows of a chosen run, by its id."""
    return history.filter(F.col(RUN) == run_label(run)).drop(RUN)


def run_history(history: DataFrame, runs: int = 20) -> DataFrame:
    return history.select("run_id", "run_ts").distinct().orderBy(F.desc("run_id")).limit(runs)
