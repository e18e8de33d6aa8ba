"""Conform a frame to a declared schema by field name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Reorder, project and cast ``df`` to ``schema`` matching fields by name.

    Nested structs (also inside arrays and maps) are matched by name too;
    extra fields are dropped, a missing nullable field becomes NULL.  It is
    strict: a missing required field, nullable into required, or an unsafe
    cast such as string into int is an analysis error.  Being a projection,
    it keeps column pruning and filter pushdown to the scan below it.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return df.to(schema)
