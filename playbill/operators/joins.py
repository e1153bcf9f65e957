"""Joins: enrichment, top-key filters, fixed label lists, attached totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000  # a side with at most this many short rows may be broadcast


def small_side(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast a side only when its row count is known to be small.

    Otherwise the planner decides from sizes, and AQE splits skewed partitions.
    """
    return F.broadcast(df) if max_rows is not None and max_rows <= BROADCAST_ROWS else df


def attach(
    df: DataFrame, other: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join on equal keys; rows without a partner get the defaults."""
    joined = df.join(other, on, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    )


def keep_top_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key is among the n commonest (ties: smaller key first); null is no key."""
    top = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.desc("__n"), key)
        .limit(n)
        .select(key)
    )
    return df.join(small_side(top, n), key, "left_semi")


def reindex(df: DataFrame, key: str, domain: Sequence[str], fill: Mapping[str, object] | None = None) -> DataFrame:
    """One row per label of a fixed, ordered list, with its position.

    Labels without a row get nulls, or the fill values. Expects one row per key,
    so what joins is no longer than the list.
    """
    labels = df.sparkSession.createDataFrame(
        list(enumerate(domain)), f"position int, `{key}` string"
    )
    wanted = df.filter(F.col(key).isin(*domain))
    rest = [c for c in df.columns if c != key]
    out = labels.join(wanted, key, "left").select("position", key, *rest)
    return out.na.fill(dict(fill)) if fill else out


def with_total(df: DataFrame, col: str | Column, out: str = "total") -> DataFrame:
    """Attach the sum of a column over all rows, as a scalar subquery in the same plan."""
    return df.withColumn(out, df.agg(F.sum(col)).scalar())


def with_group_total(
    df: DataFrame, key: str, col: str | Column, out: str = "total", max_groups: int | None = None
) -> DataFrame:
    """Attach the sum of a column over all rows with the same key.

    Summed first, joined after: the sums combine ahead of the shuffle and no task
    has to hold a whole group, as an unordered window would. ``max_groups`` is a
    bound on the number of keys the caller can prove.
    """
    # a groupBy on the key under another name keeps null keys, <=> matches them
    totals = df.groupBy(F.col(key).alias("__key")).agg(F.sum(col).alias(out))
    return df.join(
        small_side(totals, max_groups), F.col(key).eqNullSafe(F.col("__key")), "left"
    ).drop("__key")
