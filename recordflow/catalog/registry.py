"""Query registry: a Spark builder and, where SQL can say it, an ANSI twin for DuckDB."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from recordflow.catalog.roles import ROLES, TABLES, spark_dialect

MODULES = ("basics", "relational", "values", "storage", "customers", "loans", "statements", "deposits", "masters")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None


class Inputs:
    """The driver's tables and the roles derived from them, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # Reading a file's schema and resolving a role are done once per query.
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def role(self, name: str) -> DataFrame:
        """A role is a plain SELECT over whole driver tables."""
        if name not in self._frames:
            text = spark_dialect(ROLES[name])
            used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
            self._frames[name] = self.spark.sql(text, **used)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name in ROLES:
            return self.role(name)
        raise AttributeError(name)


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a builder that takes ``Inputs``."""

    def add(build: Callable[[Inputs], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, build, sql)
        return build

    return add


def _load() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"recordflow.catalog.{module}")
    return _QUERIES


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: q.build(Inputs(spark, sf_dir))

    return {name: bind(q) for name, q in _load().items()}


def all_sql() -> dict[str, str]:
    return {name: q.sql for name, q in _load().items() if q.sql is not None}
