"""Grouped counts, averages, trends, splits and ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.functions import bucket_label, first_number, is_missing, known, percent_of
from playbill.functions.numbers import SCORE_BELOW, SCORE_EDGES
from playbill.operators.derive import explode_list
from playbill.operators.filters import by_type
from playbill.operators.joins import with_group_total


def _rows() -> Column:
    return F.count(F.lit(1))


def count_by(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows per key or key combination."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(_rows().alias("count"))


def category_split(df: DataFrame, types: Sequence[str], col: str, type_col: str = "type") -> DataFrame:
    """Per type: rows per category and their percentage of all rows of the type.

    The null category counts in the total and is dropped after, so percentages
    may add up to less than 100. One grouped count serves all types.
    """
    return category_shares(count_by(by_type(df, type_col, list(types)), [type_col, col]), types, col, type_col)


def category_shares(counts: DataFrame, types: Sequence[str], col: str, type_col: str = "type") -> DataFrame:
    """The same from counts per type and category."""
    shares = with_group_total(counts, type_col, "count", max_groups=len(types))
    # the null category is dropped by its percent: a filter on the category itself
    # would reach below only one side of the join and undo the shared shuffle
    percent = F.when(F.col(col).isNotNull(), percent_of(F.col("count"), F.col("total")))
    return shares.select(type_col, col, "count", percent.alias("percent")).filter(
        "percent IS NOT NULL"
    )


def facet_counts(
    df: DataFrame, single: Mapping[str, Column], lists: Mapping[str, Column], type_col: str = "type"
) -> DataFrame:
    """(facet, type, key, count): rows per type and key of many facets, from one pass and one shuffle.

    ``single`` facets give each row one key (null too), ``lists`` one for each
    member of an array, repeats counted twice. Keys are text.
    """

    def cell(name: str, key: Column) -> Column:
        return F.struct(F.lit(name).alias("facet"), key.alias("key")).cast("struct<facet:string,key:string>")

    def cells(name: str, members: Column) -> Column:
        return F.transform(F.coalesce(members, F.array().cast("array<string>")), lambda m: cell(name, m))

    own = F.array(*[cell(n, c.cast("string")) for n, c in single.items()])
    members = [cells(n, c) for n, c in lists.items()]
    return df.select(type_col, F.inline(F.concat(own, *members))).groupBy("facet", type_col, "key").agg(_rows().alias("count"))


def trend(df: DataFrame, year_col: str, types: Sequence[str], type_col: str = "type") -> DataFrame:
    """Per type and year: rows and their percentage of all rows of the type, undated ones included."""
    return category_split(df, types, year_col, type_col)


def bucket_split(
    df: DataFrame,
    types: Sequence[str],
    col: str,
    edges: Sequence[tuple[float, str]] = SCORE_EDGES,
    below: str = SCORE_BELOW,
    null_label: str | None = None,
    type_col: str = "type",
) -> DataFrame:
    """Per type: rows per score range and their percentage; a null score is in the lowest range."""
    labelled = df.withColumn("bucket", bucket_label(F.col(col), edges, below, null_label))
    return category_split(labelled, types, "bucket", type_col)


def country_total(df: DataFrame, col: str = "countries", exploded: bool = True) -> DataFrame:
    """Titles per country: per list member, or with the raw text as key."""
    if exploded:
        members = explode_list(df.select(col), col, "country").filter("country != ''")
    else:
        members = df.select(F.col(col).alias("country")).filter("country IS NOT NULL")
    return count_by(members, "country")


def avg_by(
    df: DataFrame, key: str, col: str, min_count: int = 0, drop_null_scores: bool = False
) -> DataFrame:
    """Average and row count per key, keys with more than ``min_count`` rows only.

    The average skips nulls while the count takes all rows; ``drop_null_scores``
    removes rows without a value before both.
    """
    rows = df.filter(~is_missing(df, col)) if drop_null_scores else df
    stats = rows.groupBy(key).agg(F.avg(known(df, col)).alias("avg_score"), _rows().alias("count"))
    return stats.filter(F.col("count") > min_count)


def stats_by(df: DataFrame, key: str, col: str) -> DataFrame:
    """Average, sample deviation, extremes and count per key, over rows with a value."""
    return df.filter(~is_missing(df, col)).groupBy(key).agg(
        F.avg(col).alias("avg_score"),
        F.stddev_samp(col).alias("std_score"),
        F.min(col).alias("min_score"),
        F.max(col).alias("max_score"),
        _rows().alias("count"),
    )


def means_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Mean of several columns per key."""
    return df.groupBy(key).agg(*[F.avg(known(df, c)).alias(f"avg_{c}") for c in cols])


def pivot_sum(df: DataFrame, row: str, col: str, values: Sequence[str], v: str) -> DataFrame:
    """Named values of one column become columns holding sums, 0 where there is nothing."""
    wanted = df.filter(F.col(col).isin(*values))
    return wanted.groupBy(row).pivot(col, list(values)).agg(F.sum(v)).na.fill(0)


def type_ratio(
    df: DataFrame, key: str, types: Sequence[str], n: int = 10, type_col: str = "type"
) -> DataFrame:
    """Share of each named type among the rows of the n commonest keys.

    Rows of other types stay in the total and lower every share. A key without
    any of the named types is left out, after it took its place in the top n.

    Counts of all types sit in one aggregate, so ranking, totals and pivot need
    one shuffle of partial counts and a top-n; nothing is joined or windowed.
    """
    counts = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            _rows().alias("__total"),
            *[F.count_if(F.col(type_col) == t).alias(f"__n{i}") for i, t in enumerate(types)],
        )
        .orderBy(F.desc("__total"), key)
        .limit(n)
    )
    numbers = [F.col(f"__n{i}") for i in range(len(types))]
    return counts.filter(sum(numbers[1:], numbers[0]) > 0).select(
        key, *[(c / F.col("__total")).alias(t) for c, t in zip(numbers, types)]
    )


def ratio_of_counts(
    counts: DataFrame, key: str, types: Sequence[str], n: int = 10, type_col: str = "type"
) -> DataFrame:
    """:func:`type_ratio` from counts per key and type."""
    sums = [F.sum(F.when(F.col(type_col) == t, F.col("count")).otherwise(0)).alias(f"__n{i}") for i, t in enumerate(types)]
    known_keys = counts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("count").alias("__total"), *sums)
    top = known_keys.orderBy(F.desc("__total"), key).limit(n)
    numbers = [F.col(f"__n{i}") for i in range(len(types))]
    return top.filter(sum(numbers[1:], numbers[0]) > 0).select(key, *[(c / F.col("__total")).alias(t) for c, t in zip(numbers, types)])


def lengths(
    df: DataFrame,
    movie: str = "MOVIE",
    col: str = "duration",
    type_col: str = "type",
    keep_nulls: bool = False,
) -> DataFrame:
    """Movie lengths as numbers, from text or from a numeric column."""
    length = F.col(col)
    if df.schema[col].dataType.typeName() == "string":
        length = first_number(length)
    out = by_type(df, type_col, movie).select(length.cast("double").alias("duration"))
    return out if keep_nulls else out.filter("duration IS NOT NULL")
