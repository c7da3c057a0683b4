"""Queries by name, each with the SQL it equals where SQL can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.rewrites import squish_sql, strip_sql
from tallyloom.session import ship

Query = Callable[[SparkSession, str], DataFrame]


#: Calls that SQL texts here may make, and the SQL each stands for.
MACROS: dict[str, Callable[[str], str]] = {
    "strip": strip_sql,
    "squish": squish_sql,
    "norm": lambda e: f"trim(regexp_replace(regexp_replace(upper(coalesce({e}, '')), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))",
}


def expanded(sql: str) -> str:
    """sql with its macros written out, inner ones first."""
    for name, write in MACROS.items():
        while (at := max(sql.rfind(f" {name}("), sql.rfind(f"({name}("))) >= 0:
            start = at + len(name) + 2
            end, depth = start, 1
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[end], 0)
                end += 1
            sql = sql[: at + 1] + write(sql[start : end - 1]) + sql[end:]
    return sql


def shipped(f: Query) -> Query:
    """f with this package at hand on the executors."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers the decorated query under name."""

        def register(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = shipped(f)
            if sql is not None:
                self.sql[name] = expanded(sql)
            return f

        return register
