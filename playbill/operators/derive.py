"""New columns from existing ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill import functions as fx
from playbill.functions.numbers import SCORE_BELOW, SCORE_EDGES
from playbill.functions.text import NO_DATA


def parse_date(df: DataFrame, col: str, fmt: str = "MMMM d, yyyy", out: str | None = None) -> DataFrame:
    """Text date to timestamp, null where it does not parse."""
    return df.withColumn(out or col, fx.text_date(F.col(col), fmt))


def year_of(df: DataFrame, col: str, out: str = "year") -> DataFrame:
    """Year of a date or timestamp."""
    return df.withColumn(out, F.year(col))


def decade_of(df: DataFrame, col: str, out: str = "decade") -> DataFrame:
    """First year of the decade."""
    return df.withColumn(out, fx.decade(F.col(col)))


def first_member(df: DataFrame, col: str, out: str = "main_genre", sentinel: str = NO_DATA) -> DataFrame:
    """First entry of list text."""
    return df.withColumn(out, fx.first_list_member(F.col(col), sentinel))


def strip_list_text(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """List text without brackets and quotes."""
    return df.withColumn(out or col, fx.strip_list_marks(F.col(col)))


def split_list(df: DataFrame, col: str, sep: str = ",", trim: bool = True, out: str | None = None) -> DataFrame:
    """List text to an array column."""
    return df.withColumn(out or col, fx.split_trimmed(F.col(col), sep, trim))


def explode_list(df: DataFrame, col: str, out: str, sep: str = ",", trim: bool = True) -> DataFrame:
    """One row per list member; null lists vanish and repeats count twice.

    Takes list text or an array column. ``trim=False`` keeps blanks around members.
    """
    members = F.col(col)
    if df.schema[col].dataType.typeName() != "array":
        members = fx.split_trimmed(members, sep, trim)
    elif trim:
        members = F.transform(members, lambda x: F.trim(x))
    return df.select("*", F.explode(members).alias("__member")).drop(out).withColumnRenamed("__member", out)


def extract_number(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """First run of digits as a number."""
    return df.withColumn(out or col, fx.first_number(F.col(col)))


def bucket(
    df: DataFrame,
    col: str,
    edges: Sequence[tuple[float, str]] = SCORE_EDGES,
    below: str = SCORE_BELOW,
    null_label: str | None = None,
    out: str = "bucket",
) -> DataFrame:
    """Range label of a number; null lands in the lowest range unless told otherwise."""
    return df.withColumn(out, fx.bucket_label(F.col(col), edges, below, null_label))


def percent_of(df: DataFrame, num: str, total: str, out: str = "percent") -> DataFrame:
    """One column as a percentage of another."""
    return df.withColumn(out, fx.percent_of(F.col(num), F.col(total)))


def rescale(df: DataFrame, col: str, shift: float = 0, scale: float = 1, out: str | None = None) -> DataFrame:
    """Shift and divide, to bring columns onto one axis."""
    return df.withColumn(out or col, fx.rescaled(F.col(col), shift, scale))


def percent_label(df: DataFrame, col: str, minimum: float = 0.05, decimals: int = 0, out: str = "label") -> DataFrame:
    """Share as percent text, blank when too small to label."""
    return df.withColumn(out, fx.percent_text(F.col(col), minimum, decimals))


def normal_density(df: DataFrame, x: str, mu: float, sd: float, out: str = "density") -> DataFrame:
    """Normal density at each value."""
    return df.withColumn(out, fx.normal_pdf(F.col(x), F.lit(float(mu)), F.lit(float(sd))))
