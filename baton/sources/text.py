"""Re-open a saved text output as lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def open_text(spark: SparkSession, path: str) -> DataFrame:
    """``(value string)``, one row per line of the files under ``path``.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; uncompressed and splittable
    codecs are split across tasks by ``spark.sql.files.maxPartitionBytes``.
    """
    return spark.read.text(path)
