"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.plans.views import CATALOG_SQL, CREDITS_SQL, Tables


class Query(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def register(name: str, run: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    """Add a query; without SQL only its rows can be looked at."""
    QUERIES[name] = Query(run, sql)


def over_views(sql: str) -> str:
    """SQL that may use the catalog and credits views."""
    body = sql.strip()
    views = f"WITH catalog AS ({CATALOG_SQL}), credits AS ({CREDITS_SQL})"
    return f"{views}, {body[5:]}" if body.upper().startswith("WITH ") else f"{views} {body}"


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Floating point columns to a fixed number of decimals, for comparison."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
