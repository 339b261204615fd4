"""Written tables: replace, append, and the shared work folder of one application."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, else the warehouse: every executor reaches both."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def read_written(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


class WorkFolder:
    """Intermediate tables of one run. A written table cuts lineage and outlives executors."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark)}/fulluse/{label}-{uuid.uuid4().hex}"

    def keep(
        self, name: str, df: DataFrame, together: Sequence[str] = (), within: Sequence[str] = ()
    ) -> DataFrame:
        return replace_table(df, f"{self.path}/{name}", together, within)


def arranged(df: DataFrame, together: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows that share ``together`` side by side, sorted, in partitions of even size.

    Rebalancing lets Spark split a key that holds a large share of the rows
    (or of identical copies) and merge small ones, so files stay near the
    advisory size. The sort makes row-group statistics prune. Without
    ``together`` rows stay in their partitions and are only sorted there.
    """
    if not together:
        return df.sortWithinPartitions(*within) if within else df
    balanced = df.hint("rebalance", *[F.col(c) for c in together])
    return balanced.sortWithinPartitions(*together, *within)


def replace_table(
    df: DataFrame,
    path: str,
    together: Sequence[str] = (),
    within: Sequence[str] = (),
    month_folders: bool = False,
    watched: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Full-refresh write; running it again converges to the same table.

    ``watched`` may observe the rows as the last stage writes them, where each
    task counts once however often earlier stages had to run.
    """
    rows = arranged(df, together, within)
    writer = (watched(rows) if watched else rows).write.mode("overwrite")
    if month_folders:
        writer = writer.partitionBy("month")
    writer.parquet(path)
    return read_written(df.sparkSession, path, df)


# Layout of the large monthly tables: a query on one month reads few files.
BY_MONTH = ("month",)
IN_MONTH = ("cust_id", "product_id")


def refresh_months(df: DataFrame, path: str, laid: bool = False) -> None:
    """Replace only the months present in ``df``; other month folders stay as they are.

    Rows that are ``laid`` by month already are only sorted where they are.
    """
    rows = arranged(df, (), (*BY_MONTH, *IN_MONTH)) if laid else arranged(df, BY_MONTH, IN_MONTH)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )


def month_digests(df: DataFrame, name: str) -> DataFrame:
    """One row per month that changes when any of its rows does, whatever their order."""
    total = F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))
    return df.groupBy("month").agg(F.struct(F.count("*"), total).alias(name))


def replace_changed_months(df: DataFrame, path: str) -> None:
    """Make the month-foldered table at ``path`` equal to ``df``, writing only months in which any row differs.

    Folders of months that ``df`` no longer has are removed. The driver sees
    one row per month that changed.
    """
    spark = df.sparkSession
    differing = _differing(df, read_written(spark, path, df))
    written = [month for month, gone in differing if not gone]
    if written:
        refresh_months(df.filter(F.col("month").isin(written)), path)
    drop_months(spark, path, [month for month, gone in differing if gone])


def _differing(wanted: DataFrame, stored: DataFrame) -> list[tuple[date, bool]]:
    rows = (
        month_digests(wanted, "wanted")
        .join(month_digests(stored.select(*wanted.columns), "stored"), "month", "full")
        .filter(~F.col("wanted").eqNullSafe(F.col("stored")))
        .select("month", F.col("wanted").isNull().alias("gone"))
    )
    return [tuple(row) for row in rows.collect()]


def differing_months(wanted: DataFrame, stored: DataFrame) -> list[date]:
    """Months in which the two tables do not hold the same rows."""
    return sorted(month for month, _ in _differing(wanted, stored))


def drop_months(spark: SparkSession, path: str, months: Iterable[date]) -> None:
    """Remove month folders."""
    for month in months:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/month={month}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish(df: DataFrame, path: str, partition: str) -> None:
    """Add partitions to a table; one that is there already is replaced, so publishing again adds nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
