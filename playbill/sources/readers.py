"""Reading tables. Schemas are given, not inferred: inference costs a pass and drifts."""

from __future__ import annotations

import codecs

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_titles_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header, fields quoted by and escaped with ``"``.

    The header must name the columns of the schema in its order; a file that
    does not is an error, not a table with swapped columns.

    ``multiline`` allows line breaks inside quoted fields, at the price that a
    file can no longer be split between tasks: use it at the first ingest, on
    many files, and keep the cleaned table as Parquet.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", _charset(encoding))
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .csv(path)
    )


def _charset(name: str) -> str:
    """The name Spark knows for latin-1, which has many spellings."""
    return "ISO-8859-1" if codecs.lookup(name).name == "iso8859-1" else name


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """The first n columns by position."""
    return df.select(*df.columns[:n])


def read_result(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet", multiline: bool = True
) -> DataFrame:
    """A stored result. Parquet knows its schema, CSV needs one, and may have line breaks in its fields."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV result needs a schema")
        return read_titles_csv(spark, path, schema, multiline=multiline)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)
