"""What fits share: rows kept for repeated passes, and several fits at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.session import scratch_path, workers_find_package

PARALLEL_FITS = 4
# Rows of a partition of a fit, and the least number of partitions.
ROWS_PER_PARTITION, LEAST_PARTITIONS = 400_000, 8
# Like rows are counted where there are at most so many kinds of them, each of so many rows on
# average. A learner samples more rows than that for its bins, so up to here it sees every kind.
KINDS, ROWS_PER_KIND, KIND_PARTITIONS = 10_000, 4, 2
# Column with the number of rows that a row stands for.
WEIGHT = "__rows"


def in_order(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """The same rows in a layout that follows from the rows alone.

    Rows are dealt by a hash of the key to a number of partitions that depends on
    their count, and sorted there by all columns, so bagging, seeding and quantile
    samples of a learner come out the same however the rows lay before.
    """
    if partitions is None:
        partitions = max(LEAST_PARTITIONS, -(-df.count() // ROWS_PER_PARTITION))
    return df.repartition(partitions, key).sortWithinPartitions(key, *(c for c in df.columns if c != key))


@contextmanager
def held(df: DataFrame, key: str, partitions: int | None = None) -> Iterator[DataFrame]:
    """Persist raw columns, laid out by :func:`in_order`, while a block runs.

    Fits make many passes. Lost blocks are worked out again in the same order.
    """
    with kept(in_order(df, key, partitions)) as rows:
        yield rows


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Persist a table while a block runs (memory, then disk)."""
    rows = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once and read back, for jobs that read them again and again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def few_kinds(df: DataFrame, cols: Sequence[str]) -> tuple[bool, int]:
    """Whether rows are of few kinds, each of several rows, and the number of rows."""
    kinds, total = df.agg(F.approx_count_distinct(F.xxhash64(*cols)), F.count(F.lit(1))).first()
    return kinds <= KINDS and total >= ROWS_PER_KIND * kinds, total


def weighted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cols`` of all rows with a ``WEIGHT``: like rows as one where they are of few kinds, else each by itself.

    A learner that takes each row once learns the same from a row of weight n as
    from n such rows; one that draws rows does not.
    """
    if not few_kinds(df, cols)[0]:
        return df.select(*cols, F.lit(1.0).alias(WEIGHT))
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    return counted.repartition(KIND_PARTITIONS, *cols).sortWithinPartitions(*cols)


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    workers_find_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fit_each(spark: SparkSession, fit: Callable, items: Iterable, parallelism: int = PARALLEL_FITS) -> list:
    """Results of independent fits, in order, several of them sharing the cluster at a time.

    Small fits leave cores idle between their many short jobs. Every running fit
    keeps its own copy of the rows: use 1 where one fit fills the cluster.
    """
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(spark)(fit), list(items), chunksize=1)
