"""Repairs: fills, drops, duplicates and casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions import is_missing
from playbill.functions.text import NO_DATA
from playbill.operators.distribution import medians


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing cells take the most frequent value, the smallest one on a tie.

    The value comes from a grouped count and a top-1, so no task holds all the
    distinct values the way a single mode buffer would.
    """
    fills = {}
    for c in cols:
        common = (
            df.filter(~is_missing(df, c))
            .groupBy(c)
            .agg(F.count(F.lit(1)).alias("__n"))
            .orderBy(F.desc("__n"), F.asc(c))
            .limit(1)
            .select(c)
        )
        fills[c] = _filled(df, c, common.scalar())
    return df.withColumns(fills)


def fill_median(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Missing cells take the median, the mean of the middle two on an even count.

    Exact by default at any size, found by a few jobs up front (see
    ``distribution.medians``); ``approx`` takes one lazy sketch instead and gives
    a value that occurs in the column.
    """
    if approx:
        present = {c: F.when(~is_missing(df, c), F.col(f"`{c}`")) for c in cols}
        middle = {c: df.agg(F.percentile_approx(v, 0.5)).scalar() for c, v in present.items()}
    else:
        middle = {c: F.lit(v).cast("double") for c, v in medians(df, cols).items()}
    return df.withColumns({c: _filled(df, c, v) for c, v in middle.items()})


def _filled(df: DataFrame, name: str, value: Column) -> Column:
    return F.when(is_missing(df, name), value).otherwise(F.col(f"`{name}`"))


def fill_constant(df: DataFrame, values: Mapping[str, str | float | int | bool]) -> DataFrame:
    """Missing cells of the named columns take a constant such as ``No Data`` or 0."""
    return df.na.fill(dict(values))


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a gap anywhere, or in the named columns."""
    return df.na.drop("any", subset=list(cols) if cols is not None else None)


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact repeats; copies collapse before the shuffle."""
    return df.distinct()


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key in the given order, any remaining tie settled by all columns.

    The rank filter is planned as a group limit ahead of the shuffle, so a task
    sends at most one row per key however many copies a key has.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the named types."""
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items()})


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Text to numbers; what does not parse becomes null instead of an error."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(to) for c in cols})


def drop_sentinels(
    df: DataFrame, col: str, sentinels: Iterable[str] = ("", NO_DATA)
) -> DataFrame:
    """Drop rows whose value is a stand-in for missing; nulls fall out too."""
    return df.filter(~F.col(col).isin(*sentinels))
