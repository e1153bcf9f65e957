"""Table and column profiles, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.functions import is_missing


def _per_column(df: DataFrame, measures: list[Column], value: str) -> DataFrame:
    """One aggregated row, turned into one row per column."""
    return df.agg(*measures).unpivot([], df.columns, "column", value)


def shape(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_profile(df: DataFrame) -> DataFrame:
    """Type and number of filled cells per column."""
    counts = _per_column(
        df, [F.count_if(~is_missing(df, c)).alias(c) for c in df.columns], "non_null"
    )
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return counts.select("column", types[F.col("column")].alias("type"), "non_null")


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First n rows in the given order (a distributed table has no file order)."""
    return df.orderBy(*order).limit(n)


def null_rate(df: DataFrame) -> DataFrame:
    """Percent missing per column, two decimals, columns without gaps left out."""
    rates = _per_column(
        df,
        [F.avg(is_missing(df, c).cast("double") * 100).alias(c) for c in df.columns],
        "null_rate",
    )
    return rates.filter("null_rate > 0").withColumn("null_rate", F.round("null_rate", 2))


def null_count(df: DataFrame) -> DataFrame:
    """Cells missing per column, zeros kept."""
    return _per_column(
        df, [F.count_if(is_missing(df, c)).alias(c) for c in df.columns], "null_count"
    )


def distinct_count(
    df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """Different values per column in one pass, a missing value being one of them.

    ``approx`` swaps the exact count, which shuffles the distinct values, for a
    fixed-size sketch that shuffles nothing but itself.
    """
    cols = list(cols or df.columns)
    count = F.approx_count_distinct if approx else F.count_distinct
    measures = [
        (count(F.col(f"`{c}`")) + F.coalesce(F.max(F.col(f"`{c}`").isNull().cast("long")), F.lit(0))).alias(c)
        for c in cols
    ]
    return df.select(*cols).agg(*measures).unpivot([], cols, "column", "n_distinct")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted different values."""
    return df.select(col).distinct().orderBy(col)


def value_counts(df: DataFrame, col: str, by: str = "value") -> DataFrame:
    """Rows per value, ordered by value or by falling count."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(col) if by == "value" else counts.orderBy(F.desc("count"), col)
