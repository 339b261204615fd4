"""Reading and landing the raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulluse.plans import storage
from fulluse.sources.schemas import CLUSTERED, REQUIRED, raw_schema, raw_tables


def read_raw(spark: SparkSession, folder: str, table: str, fmt: str = "csv") -> DataFrame:
    """Typed scan of one raw table, ``<folder>/<table>.csv`` or ``<folder>/<table>`` in Parquet.

    A header that does not match the schema, or a value that does not parse,
    fails the read instead of turning into shifted columns or NULLs.
    """
    reader = spark.read.schema(raw_schema(table))
    if fmt == "csv":
        return (
            reader.option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .csv(f"{folder}/{table}.csv")
        )
    return reader.parquet(f"{folder}/{table}")


def read_all(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {table: read_raw(spark, folder, table, fmt) for table in raw_tables()}


def land(source: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Replace every landed table; the two monthly facts are in month folders, sorted by customer and SKU."""
    return {
        table: storage.replace_table(
            df, f"{folder}/{table}", storage.BY_MONTH, CLUSTERED[table], month_folders=True
        )
        if table in CLUSTERED
        else storage.replace_table(df, f"{folder}/{table}")
        for table, df in source.items()
    }


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def required_nulls(raw: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per required column: one aggregate per table, one row per column."""
    parts = []
    for table, columns in REQUIRED.items():
        counts = raw[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        rows = F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
        )
        parts.append(counts.select(F.lit(table).alias("table_name"), F.inline(rows)))
    return union_all(parts)


def load_parity(source: Mapping[str, DataFrame], landed: Mapping[str, DataFrame]) -> DataFrame:
    """Rows at the source against rows that landed, per table."""
    counts = union_all(
        [
            storage.row_count(df, table).select(
                "table_name", F.lit(side).alias("side"), "rows"
            )
            for side, tables in (("source", source), ("landed", landed))
            for table, df in tables.items()
        ]
    )
    both = counts.groupBy("table_name").agg(
        F.sum(F.when(F.col("side") == "source", F.col("rows"))).alias("source_rows"),
        F.sum(F.when(F.col("side") == "landed", F.col("rows"))).alias("landed_rows"),
    )
    lost = F.col("source_rows") - F.col("landed_rows")
    return both.withColumn("lost_rows", lost).withColumn("matches", lost == 0)
