"""Open a saved table by reference, optionally conformed to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from baton.operators.conform import conform
from baton.operators.rejects import conform_split


def open_table(spark: SparkSession, ref: str, format: str | None = None, **options) -> DataFrame:
    """The table ``ref`` as a frame.

    Without ``format`` it is a catalog lookup (tables and views); with one,
    ``ref`` is handed to that connector as its ``table`` option (for example
    a warehouse connector on the classpath).  An empty reference is an error.
    """
    if not ref or not str(ref).strip():
        raise ValueError("open_table needs a table reference")
    if format is None:
        return spark.read.table(ref)
    return spark.read.format(format).option("table", ref).options(**options).load()


def open_typed(spark: SparkSession, ref: str, schema: T.StructType | str,
               format: str | None = None, **options) -> DataFrame:
    """:func:`open_table` conformed to ``schema`` by field name."""
    return conform(open_table(spark, ref, format, **options), schema)


def open_typed_split(spark: SparkSession, ref: str, schema: T.StructType | str, format: str | None = None,
                     temp_dir: str | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """:func:`open_table` split by :func:`baton.conform_split` into the rows that fit ``schema``
    and those that do not, with the reasons."""
    return conform_split(open_table(spark, ref, format, **options), schema, temp_dir)
