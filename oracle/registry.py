"""Query name to DuckDB SQL."""

from __future__ import annotations

from oracle import adapter, checks, insights, metrics, models
from oracle.compose import Chain


def statements() -> dict[str, str]:
    chain = Chain()
    chain.update(adapter.RAW)
    chain.update(models.MODELS)
    out: dict[str, str] = {}

    def publish(name: str, sql: str, doubles: list[str]) -> None:
        out[name] = chain.statement(sql, doubles)

    for table in adapter.TABLES:
        publish(f"src_{table}", f"select * from {table}", adapter.DOUBLES.get(table, []))
    for name in models.NAMES:
        publish(name, f"select * from {name}", models.DOUBLES.get(name, []))
    chain.add("spike_curve", checks.CURVE)
    chain.update(insights.PARTS)
    queries = {**metrics.QUERIES, **checks.QUERIES, **insights.QUERIES}
    for name, (sql, doubles) in queries.items():
        publish(name, sql, doubles)
    return out
