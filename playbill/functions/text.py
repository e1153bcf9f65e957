"""Text, list and date expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_DATA = "No Data"  # fixed value: the text that stands for a missing entry
LIST_MARKS = "[]'"  # fixed value: characters that wrap a list written as text


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating point columns (dataframe tools count both)."""
    col = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() in ("float", "double"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def known(df: DataFrame, name: str) -> Column:
    """The value, null where it is missing, so that aggregates leave it out."""
    return F.when(~is_missing(df, name), F.col(f"`{name}`"))


def text_date(col: Column, fmt: str = "MMMM d, yyyy") -> Column:
    """``September 9, 2019`` to a timestamp; text that is no such date becomes null."""
    return F.try_to_timestamp(F.trim(col), F.lit(fmt))


def strip_list_marks(col: Column) -> Column:
    """``['a', 'b']`` to ``a, b``."""
    return F.translate(col, LIST_MARKS, "")


def first_list_member(col: Column, sentinel: str = NO_DATA) -> Column:
    """First entry of list text; missing text or the sentinel gives the sentinel."""
    # An empty list leaves an empty entry, which a text file stores as nothing:
    # it reads back as missing, so it stays null here.
    bare = F.trim(col, F.lit(LIST_MARKS))
    first = F.trim(F.trim(F.split_part(bare, F.lit(","), F.lit(1))), F.lit("'"))
    return F.when(col.isNull() | (col == sentinel), F.lit(sentinel)).otherwise(
        F.when(first != "", first)
    )


def split_trimmed(col: Column, sep: str = ",", trim: bool = True) -> Column:
    """Separated text to an array, members trimmed unless asked otherwise."""
    # split() takes a regular expression, \\Q..\\E keeps the separator literal
    parts = F.split(col, "\\Q" + sep + "\\E")
    return F.transform(parts, lambda x: F.trim(x)) if trim else parts


def has_list_member(col: Column, member: str, sep: str = ",") -> Column:
    """True when the separated text lists exactly this member."""
    return F.array_contains(split_trimmed(col, sep), member)


def contains_ignoring_case(col: Column, text: str) -> Column:
    """Substring test without wildcards; null text is null, which a filter drops."""
    return F.contains(F.lower(col), F.lower(F.lit(text)))


def first_number(col: Column) -> Column:
    """First run of digits as a double; no digits gives null."""
    return F.regexp_extract(col, r"(\d+)", 1).try_cast("double")


def safe_key(col: Column) -> Column:
    """Blanks to underscores, for use in a path."""
    return F.replace(col, F.lit(" "), F.lit("_"))
