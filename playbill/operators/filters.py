"""Projections and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.functions import contains_ignoring_case, has_list_member

_IN_LIST_LIMIT = 1_000  # longer value lists are joined, not inlined into the plan


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select columns under new names, ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def by_type(df: DataFrame, col: str, wanted: str | Sequence[str]) -> DataFrame:
    """Rows of one type, or of any of several."""
    if isinstance(wanted, str):
        return df.filter(F.col(col) == wanted)
    return df.filter(F.col(col).isin(*wanted))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows with a value in the column."""
    return df.filter(F.col(col).isNotNull())


def in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is in a fixed list; a long list becomes a semi join.

    Values are compared in the column's type on both ways, and columns stay as they are.
    """
    kind = df.schema[col].dataType
    if len(values) <= _IN_LIST_LIMIT:
        return df.filter(F.col(col).isin(*[F.lit(v).cast(kind) for v in values]))
    listed = df.sparkSession.createDataFrame([(v,) for v in set(values)], [col])
    return df.join(listed.select(F.col(f"`{col}`").cast(kind)), col, "left_semi").select(*[df[f"`{c}`"] for c in df.columns])


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows in a closed range."""
    return df.filter(F.col(col).between(lo, hi))


def positive(df: DataFrame, col: str) -> DataFrame:
    """Rows with a value above zero; nulls fall out."""
    return df.filter(F.col(col) > 0)


def contains_ci(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose text contains another text, whatever the case."""
    return df.filter(contains_ignoring_case(F.col(col), text))


def has_member(df: DataFrame, col: str, member: str, sep: str = ",") -> DataFrame:
    """Rows whose list text holds exactly this member (``A1`` does not match ``A10``)."""
    return df.filter(has_list_member(F.col(col), member, sep))
