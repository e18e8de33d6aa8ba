"""Snapshots with files of a wanted size, clustered by columns.

How many bytes a row takes in a file is known once it is written: the rows are staged as they
come, without a shuffle, and then dealt into as many files as their bytes ask for.  With
``cluster_by`` the files are ranges of these columns, so that filters on them skip files; rows of
one value that exceed a file are spread over neighbouring ones by their place in the stage, so a
value that a third of all rows share makes many files and no long task.  Clustering changes how
well columns compress: if files come out at less than two thirds or more than one and a half
times the wanted size, they are dealt once more with the size now known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.operators.rowcodec import quote
from baton.session import delete_path

_PLACE = ("__baton_file", "__baton_row")
#: Smallest and largest mean size, against the wanted one, that is left as it is.
NEAR = (2 / 3, 1.5)


def data_bytes(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of the files with content below ``path``."""
    from baton.sources.files import file_sizes

    row = file_sizes(spark, path, recursive=True).agg(F.coalesce(F.sum("size_bytes"), F.lit(0)), F.count("*")).first()
    return row[0], row[1]


def dealt(staged: DataFrame, files: int, cluster_by: list[str]) -> DataFrame:
    """The staged rows in so many partitions of about equal numbers, in ranges of ``cluster_by``."""
    if not cluster_by:
        return staged.repartition(files)
    placed = staged.select("*", F.col("_metadata.file_name").alias(_PLACE[0]), F.col("_metadata.row_index").alias(_PLACE[1]))
    ordered = placed.repartitionByRange(files, *[quote(c) for c in cluster_by], *_PLACE)
    return ordered.drop(*_PLACE)


def write_sharded(staged: DataFrame, stage: str, write, path: str, target: int, cluster_by: list[str]) -> None:
    """``write`` (a frame, to ``path``) the staged rows in files of about ``target`` bytes."""
    spark = staged.sparkSession
    total, _ = data_bytes(spark, stage)
    files = max(1, round(total / target))
    write(dealt(staged, files, cluster_by), path)
    made, count = data_bytes(spark, path)
    if count > 1 or made > target:
        right = max(1, round(made / target))
        if not NEAR[0] <= made / max(count, 1) / target <= NEAR[1] and right != files:
            delete_path(spark, path)
            write(dealt(staged, right, cluster_by), path)
