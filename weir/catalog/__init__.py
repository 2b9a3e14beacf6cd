"""Every operator as a query over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name; ``sql`` is its DuckDB equivalent."""

    def register(run: Run) -> Run:
        def in_utc_session(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[run.__name__] = Query(in_utc_session, sql)
        return run

    return register


def load_all() -> dict[str, Query]:
    from weir.catalog import aggregates, columns, filters, lookups, stored, streams  # noqa: F401

    return QUERIES
