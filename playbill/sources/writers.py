"""Writing tables. Executors write in parallel; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.functions import safe_key


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Store a cleaned table."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.save(path)


def write_result(df: DataFrame, path: str, label: str | None = None, mode: str = "error") -> None:
    """Store a result as CSV with a header; ``label`` renames its first (key) column."""
    if label is not None:
        df = df.withColumnRenamed(df.columns[0], label)
    write_table(df, path, "csv", mode)


def write_partitioned(
    df: DataFrame, path: str, key: str, fmt: str = "parquet", mode: str = "error"
) -> None:
    """One folder per key, blanks in the folder name replaced by ``_``.

    The rebalance hint gathers small keys into few files and lets AQE split a
    key that holds much of the data over several tasks.
    """
    folder = f"{key}_key"
    keyed = df.withColumn(folder, safe_key(F.col(key))).hint("rebalance", folder)
    writer = keyed.write.mode(mode).format(fmt).partitionBy(folder)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.save(path)
