"""Helpers for code that runs inside Python tasks, and for shipping it there."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Text characters worked on at once inside a task; a longer text is its own batch.
BATCH_CHARS = 1_000_000


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where they share the driver's disk.

    On a cluster the package goes along with ``--py-files`` instead.
    """
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (_ROOT, env.get("PYTHONPATH")) if x)
    return spark


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of bounded size with their texts as strings; null text becomes empty."""
    for batch in batches:
        texts = [t if t is not None else "" for t in batch.column(column).to_pylist()]
        first = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > BATCH_CHARS:
                yield batch.slice(first, i - first), texts[first:i]
                first, size = i, 0
            size += len(t)
        if first < len(texts):
            yield batch.slice(first), texts[first:]


def map_text(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` whose function is found by the Python workers."""
    ready(df.sparkSession)
    return df.mapInArrow(fn, schema)
