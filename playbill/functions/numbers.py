"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: lower bounds of the score ranges, their labels, and the label below all bounds
SCORE_EDGES = ((9, "9-10"), (8, "8-9"), (7, "7-8"), (6, "6-7"), (5, "5-6"))
SCORE_BELOW = "<5"


def decade(year: Column) -> Column:
    """1994 to 1990."""
    return (F.floor(year / 10) * 10).cast("int")


def bucket_label(
    col: Column,
    edges: Sequence[tuple[float, str]] = SCORE_EDGES,
    below: str = SCORE_BELOW,
    null_label: str | None = None,
) -> Column:
    """Label of the highest lower bound the value reaches.

    A null value lands in ``below`` unless ``null_label`` names another place.
    """
    branches = F.when(col.isNull(), F.lit(below if null_label is None else null_label))
    for lower, label in sorted(edges, reverse=True):
        branches = branches.when(col >= lower, F.lit(label))
    return branches.otherwise(F.lit(below))


def percent_of(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total``; an empty total gives null."""
    return part * 100 / F.nullif(total, F.lit(0))


def percent_text(share: Column, minimum: float = 0.05, decimals: int = 0) -> Column:
    """0.63 to ``63%``; blank at or below ``minimum``, where a label would not fit."""
    return F.when(share > minimum, F.format_string(f"%.{decimals}f%%", share * 100)).otherwise("")


def rescaled(col: Column, shift: float = 0, scale: float = 1) -> Column:
    """``(value - shift) / scale``."""
    return (col - shift) / scale


def normal_pdf(x: Column, mean: Column, std: Column) -> Column:
    """Normal density at ``x``; no spread gives null."""
    spread = F.nullif(std, F.lit(0.0))
    z = (x - mean) / spread
    return F.exp(-z * z / 2) / (spread * F.sqrt(2 * F.pi()))
