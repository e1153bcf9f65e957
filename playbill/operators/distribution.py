"""Distribution summaries: exact medians, moments, histograms, fitted curves."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.functions import is_missing, known, normal_pdf

_ACCURACY = 10_000  # sketch accuracy: rank error at most 1 in 10,000
_GRID = [i / 200 for i in range(201)]  # quantiles asked for in a narrowing pass
_NEAR_MIDDLE = [0.5 - 4 / _ACCURACY, 0.5 + 4 / _ACCURACY]  # well beyond the sketch error
_SORTED_AT_ONCE = 100_000  # candidates that may be sorted in one cell


@dataclass
class _Search:
    """Where the middle ranks of a column still hide: strictly between lo and hi."""

    low: int  # zero-based middle ranks, equal on an odd count
    high: int
    lo: float | None  # None: no bound yet, infinities lie inside
    hi: float | None
    below: int  # rows up to and including lo
    inside: int  # rows strictly between lo and hi
    ends: tuple[float, float]  # values closer to the middle ranks, from a sketch of the rows inside


def _ends(grid: list[float], first: int, last: int, inside: int) -> tuple[float, float]:
    """Grid values two steps outside the given ranks of the rows inside."""
    steps = len(grid) - 1
    before = math.floor(first / inside * steps) - 2
    after = math.ceil((last + 1) / inside * steps) + 2
    return grid[max(before, 0)], grid[min(after, steps)]


def medians(
    df: DataFrame, cols: Sequence[str], sorted_at_once: int = _SORTED_AT_ONCE
) -> dict[str, float | None]:
    """Exact median per column, the mean of the middle two on an even count.

    Runs a few jobs, like a model fit. Each reads all columns at once and returns
    one row of fixed size: quantiles sketched in one job bound the middle ranks
    for the next, which counts exactly around the bounds and sketches again in
    between, a thousand times fewer rows at first and 40 times from then on. Once few candidates are left they are
    sorted. Values that repeat often are counted, never listed, so neither the
    number of rows nor of distinct values matters.
    """
    values = df.select(
        *[F.when(~is_missing(df, c), F.col(f"`{c}`")).cast("double").alias(c) for c in cols]
    )
    first = values.agg(
        *[F.struct(F.count(c), F.percentile_approx(c, _NEAR_MIDDLE, _ACCURACY)).alias(c) for c in cols]
    ).first()
    found: dict[str, float | None] = dict.fromkeys(cols)
    searches = {
        c: _Search((n - 1) // 2, n // 2, None, None, 0, n, tuple(near))
        for c, (n, near) in zip(cols, first)
        if n
    }
    while searches:
        in_range = {c: _inside(F.col(c), s.lo, s.hi) for c, s in searches.items()}
        rows = values.filter(reduce(or_, in_range.values()))
        steps = {}
        for c, s in searches.items():
            v = F.when(in_range[c], F.col(c))
            steps[c] = _sorted(v) if s.inside <= sorted_at_once else _counts(v, *s.ends)
        aggregated = rows.agg(*[step.alias(c) for c, step in steps.items()])
        picked = aggregated.select(
            *[
                F.array(F.get(c, F.lit(s.low - s.below)), F.get(c, F.lit(s.high - s.below))).alias(c)
                if s.inside <= sorted_at_once
                else F.col(c)
                for c, s in searches.items()
            ]
        ).first()
        for c, s in list(searches.items()):
            if s.inside <= sorted_at_once:
                found[c] = sum(picked[c]) / 2
                del searches[c]
                continue
            outcome = _narrowed(c, s, picked[c])
            if isinstance(outcome, _Search):
                searches[c] = outcome
            else:
                found[c] = outcome
                del searches[c]
    return found


def _inside(v: Column, lo: float | None, hi: float | None) -> Column:
    above = v.isNotNull() if lo is None else v > lo
    return above if hi is None else above & (v < hi)


def _sorted(v: Column) -> Column:
    return F.sort_array(F.collect_list(v))


def _counts(v: Column, lo: float, hi: float) -> Column:
    """Rows below, on, between and on two bounds, and what lies between."""
    between = F.when((v > lo) & (v < hi), v)
    return F.struct(
        F.count_if(v < lo), F.count_if(v == lo), F.count(between), F.count_if(v == hi),
        F.min(between), F.max(between), F.percentile_approx(between, _GRID, _ACCURACY),
    )


def _narrowed(c: str, s: _Search, counts) -> _Search | float:
    """The part that holds the middle ranks, or the median when a bound settles it."""
    lo, hi = s.ends
    under, at_lo, inside, at_hi, least, most, grid = counts
    past_lo = s.below + under + at_lo
    past_inside = past_lo + inside
    past_hi = past_inside + (at_hi if hi > lo else 0)
    if s.low < s.below + under or s.high >= past_hi:
        # The sketch was off; the exact counts say where the ranks are instead.
        if s.high < s.below + under:
            return _Search(s.low, s.high, s.lo, lo, s.below, under, (-math.inf, math.inf))
        if s.low >= past_hi:
            return _Search(s.low, s.high, hi, s.hi, past_hi, s.below + s.inside - past_hi, (-math.inf, math.inf))
        return _Search(s.low, s.high, s.lo, s.hi, s.below, s.inside, (-math.inf, math.inf))
    low = lo if s.low < past_lo else hi if s.low >= past_inside else None
    high = lo if s.high < past_lo else hi if s.high >= past_inside else None
    if low is None and high is None:
        closer = _ends(grid, s.low - past_lo, s.high - past_lo, inside)
        return _Search(s.low, s.high, lo, hi, past_lo, inside, closer)
    # a middle rank in between, next to one on a bound, is the largest or smallest there
    return ((most if low is None else low) + (least if high is None else high)) / 2


def moments(df: DataFrame, col: str) -> DataFrame:
    """Mean and sample standard deviation."""
    v = known(df, col)
    return df.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))


def _extent(df: DataFrame, col: str) -> Column:
    """Smallest and largest value as a one-row subquery."""
    v = known(df, col).cast("double")
    return df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()


def histogram(df: DataFrame, col: str, bins: int = 40, density: bool = True) -> DataFrame:
    """Equal-width bins from smallest to largest value, the last one closed.

    A constant column gets a range of width 1 around its value. Empty bins are
    kept. With ``density`` the bar areas add up to 1.
    """
    extent = _extent(df, col)
    one_value = F.col("e.lo") == F.col("e.hi")
    lo = F.when(one_value, F.col("e.lo") - 0.5).otherwise(F.col("e.lo"))
    hi = F.when(one_value, F.col("e.hi") + 0.5).otherwise(F.col("e.hi"))
    ranged = (
        df.select(known(df, col).cast("double").alias("v"), extent.alias("e"))
        .filter("v IS NOT NULL")
        .select("v", lo.alias("lo"), ((hi - lo) / bins).alias("width"))
    )
    guess = F.least(F.floor((F.col("v") - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    # the division may round across a bin edge; the edges themselves decide
    edge = lambda i: F.col("lo") + i * F.col("width")
    settled = (
        F.when(F.col("v") < edge(F.col("g")), F.col("g") - 1)
        .when((F.col("g") < bins - 1) & (F.col("v") >= edge(F.col("g") + 1)), F.col("g") + 1)
        .otherwise(F.col("g"))
    )
    counts = ranged.withColumn("g", guess).groupBy(settled.alias("bin"), "lo", "width").agg(
        F.count(F.lit(1)).alias("n")
    )
    # at most `bins` rows from here on
    table = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"),
        F.sum("n").alias("total"),
        F.max("lo").alias("lo"),
        F.max("width").alias("width"),
    ).filter("total IS NOT NULL")
    rows = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    count = F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("long")
    out = rows.select(
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        count.alias("count"),
        (count / (F.col("total") * F.col("width"))).alias("density"),
    )
    return out if density else out.drop("density")


def normal_curve(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Normal density fitted to the column, at even steps from its smallest to largest value."""
    v = known(df, col)
    fitted = df.agg(
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).cast("double").alias("lo"),
        F.max(v).cast("double").alias("hi"),
    )
    last = max(points - 1, 1)
    steps = fitted.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / last
    return steps.select(
        "point", x.alias("x"), normal_pdf(x, F.col("mean"), F.col("std")).alias("density")
    )
