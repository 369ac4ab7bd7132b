"""Named queries: a Spark builder, its output schema and the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.sources.role_sql import ROLE_SQL

SPARK_TYPES = {"l": "bigint", "d": "double", "s": "string"}
SQL_TYPES = {"l": "BIGINT", "d": "DOUBLE", "s": "VARCHAR"}


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.build(spark, sf_dir)
        return out.select(*[F.col(n).cast(SPARK_TYPES[t]).alias(n) for n, t in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(f'CAST({n} AS {SQL_TYPES[t]}) AS {n}' for n, t in self.columns)
        needed = _roles_in(self.sql)
        head = "WITH " + ", ".join(f"{n} AS ({ROLE_SQL[n]})" for n in needed) if needed else ""
        return f"{head} SELECT {casts} FROM ({self.sql}) AS checked"


def _roles_in(sql: str) -> list[str]:
    """Role views the SQL mentions, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in ROLE_SQL:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(ROLE_SQL[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


REGISTRY: dict[str, Query] = {}


def query(key: str, columns: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key``; columns read "name:l other:s"."""
    parsed = tuple(tuple(c.split(":")) for c in columns.split())

    def register(fn):
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, fn, parsed, sql)
        return fn

    return register
