"""Save a frame as plain text, one value per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baton.operators.rowcodec import quote


def save_text(df: DataFrame, path: str, column: str | None = None, mode: str = "errorifexists") -> None:
    """Write ``column`` (default: the only column) cast to string, one per line.

    A NULL would come back as an empty string and a line break would split a
    value in two, so either fails the task; use a ``json``/``utf8`` snapshot
    for such data.
    """
    if column is None:
        if len(df.columns) != 1:
            raise ValueError("save_text needs column= for a frame with several columns")
        column = df.columns[0]
    v = quote(column).cast("string")
    guarded = (F.when(v.isNull(), F.raise_error(F.lit("save_text: NULL value")).cast("string"))
               .when(v.contains("\n") | v.contains("\r"), F.raise_error(F.lit("save_text: line break in value")).cast("string"))
               .otherwise(v))
    df.select(guarded.alias("value")).write.mode(mode).text(path)
