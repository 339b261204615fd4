from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pytest

from fulluse.plans.params import Params
from fulluse.plans.pipeline import Models
from fulluse.sources.schemas import raw_schema, raw_tables
from pyspark.sql import DataFrame, SparkSession


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def months(first: str, count: int) -> list[dt.date]:
    start = day(first)
    number = start.year * 12 + start.month - 1
    return [dt.date((number + i) // 12, (number + i) % 12 + 1, 1) for i in range(count)]


class Book:
    """A few contracts and their usage, written out by hand in tests."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: dict[str, list[tuple]] = {name: [] for name in raw_tables()}

    def customer(self, cust: str, internal: bool | None = False, **more: str) -> None:
        name = more.get("name", f"Customer {cust}")
        self.rows["customers"].append(
            (
                cust,
                name,
                more.get("region", "EU"),
                more.get("segment", "Enterprise"),
                "Retail",
                day("2020-01-01"),
                more.get("cohort", "normal"),
                more.get("owner", "OWNER_1"),
                internal,
            )
        )

    def sku(self, sku: str, price: float = 12.0, weights: tuple[int, ...] = (3, 2, 1)) -> None:
        self.rows["products"].append((sku, f"{sku} name", "P1", "T1", "credits", price))
        tiers = {3: "Core", 2: "Differentiator", 1: "Adjacent"}
        for i, weight in enumerate(weights):
            self.rows["features"].append(
                (f"{sku}-F{i}", sku, f"{sku} feature {i}", "text", tiers[weight], weight)
            )

    def contract(
        self,
        contract: str,
        cust: str,
        sku: str,
        start: str,
        end: str,
        units: int = 10,
        licensed: float | None = 120.0,
        unlimited: bool | None = False,
        currency: str = "USD",
        fx: float = 1.0,
    ) -> None:
        self.rows["entitlements"].append(
            (contract, cust, sku, units, licensed, day(start), day(end), "New", currency, fx, unlimited)
        )
        self.event(contract, cust, sku, "contract_start", start)

    def event(self, contract: str, cust: str, sku: str, kind: str, on: str) -> None:
        self.rows["deployment_events"].append((contract, cust, sku, kind, day(on)))

    def used(
        self, contract: str, cust: str, sku: str, month: dt.date, units: float, capacity: float = 10.0
    ) -> None:
        self.rows["consumption_monthly"].append((contract, cust, sku, month, units, capacity))

    def active(
        self,
        contract: str,
        cust: str,
        sku: str,
        feature: str,
        month: dt.date,
        active: bool | None = True,
        events: int | None = 5,
    ) -> None:
        self.rows["feature_adoption_monthly"].append(
            (contract, cust, sku, feature, month, active, events, events)
        )

    def window(self, first: str, count: int) -> None:
        """Fix the data window with usage of a contract nobody holds."""
        for month in months(first, count):
            self.used("none", "none", "none", month, 0.0)

    def raw(self) -> dict[str, DataFrame]:
        return {
            name: self.spark.createDataFrame(rows, raw_schema(name))
            for name, rows in self.rows.items()
        }

    def models(self, params: Params = Params()) -> Models:
        return Models(self.raw(), params)


@pytest.fixture
def book(spark: SparkSession) -> Book:
    return Book(spark)
