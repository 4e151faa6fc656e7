"""Queries by name, each with the SQL that a second engine checks it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortline.session import tune
from workload.standins import with_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str, *ctes: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name by default; ``ctes`` are the stand-ins in ``sql``."""

    def register(function: Query) -> Query:
        key = name or function.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        run.__name__ = key
        QUERIES[key] = run
        ORACLE[key] = with_ctes(sql, *ctes) if ctes else sql.strip()
        return function

    return register
