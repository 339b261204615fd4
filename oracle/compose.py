"""Chains named SELECTs into one WITH statement and rounds its doubles."""

from __future__ import annotations

import re
from collections.abc import Iterable

from oracle.rounding import rounded_sql

WORD = re.compile(r"[a-z_][a-z0-9_]*")
MONEY_SUM = re.compile(r"money_sum\(([^()]*)\)(\s+filter \(where [^()]*\))?")


def written_out(sql: str) -> str:
    """``money_sum(x)``, with its filter, as a sum of whole millionths."""
    return MONEY_SUM.sub(r"(sum(floor((\1) * 1e6 + 0.5)::bigint)\2::double / 1e6)", sql)


class Chain:
    """Named SELECTs that may mention each other; earlier names come first."""

    def __init__(self) -> None:
        self.parts: dict[str, str] = {}

    def add(self, name: str, sql: str) -> None:
        self.parts[name] = sql.strip()

    def update(self, parts: dict[str, str]) -> None:
        for name, sql in parts.items():
            self.add(name, sql)

    def _needed(self, sql: str) -> list[str]:
        found: set[str] = set()
        queue = [sql]
        while queue:
            for word in set(WORD.findall(queue.pop())):
                if word in self.parts and word not in found:
                    found.add(word)
                    queue.append(self.parts[word])
        return [name for name in self.parts if name in found]

    def statement(self, sql: str, doubles: Iterable[str] = ()) -> str:
        sql = sql.strip()
        ctes = ",\n".join(f"{n} as (\n{self.parts[n]}\n)" for n in self._needed(sql))
        rounded = ", ".join(f"{rounded_sql(c)} as {c}" for c in doubles)
        star = f"* replace ({rounded})" if rounded else "*"
        head = f"with {ctes}\n" if ctes else ""
        return written_out(f"{head}select {star} from (\n{sql}\n) as result")
