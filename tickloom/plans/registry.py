"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans.market import shown
from tickloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where one exists."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shown(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return build

    return register
