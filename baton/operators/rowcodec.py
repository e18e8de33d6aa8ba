"""Whole-row encode / decode between a frame and one base64 text line per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.functions.codec import (
    CODECS,
    check_json_schema,
    decode_utf8,
    encode_json,
    encode_utf8,
    from_wire,
    json_rows,
    json_text,
    to_wire,
    wire_type,
)

VALUE = "value"
_TEXT = "__baton_json"
KEYS = ("position", "name")


def quote(name: str):
    """A column reference that is safe for names with dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def check_codec(codec: str) -> None:
    if codec not in CODECS:
        raise ValueError(f"unknown text codec {codec!r}; choose one of {CODECS}")


def _check_keys(keys: str) -> None:
    if keys not in KEYS:
        raise ValueError(f"keys must be one of {KEYS}, got {keys!r}")


def encode_rows(df: DataFrame, codec: str = "json", keys: str = "position") -> DataFrame:
    """``(value string)``: one base64 token per row of ``df``.

    ``json`` carries the whole row (any schema :func:`check_json_schema`
    accepts).  Its top-level keys are the column positions (``"0"``,
    ``"1"``, ...) by default: the names live in the schema, and short keys
    make lines about half as long and parse about twice as fast;
    ``keys="name"`` writes the column names instead.  ``tagged`` is ``json``
    for all types: maps with other keys than strings, times and calendar
    intervals, which ``json`` refuses, are written in terms of others
    (:func:`wire_type`).  ``utf8`` carries a frame of exactly one string column.
    """
    check_codec(codec)
    if codec in ("json", "tagged"):
        _check_keys(keys)
        schema = wire_type(df.schema) if codec == "tagged" else df.schema
        check_json_schema(schema)
        cols = [to_wire(quote(f.name), f.dataType) if codec == "tagged" else quote(f.name) for f in df.schema.fields]
        row = F.struct(*[c.alias(str(i) if keys == "position" else f.name)
                         for i, (c, f) in enumerate(zip(cols, schema.fields))])
        named = T.StructType([T.StructField(str(i) if keys == "position" else f.name, f.dataType, True)
                              for i, f in enumerate(schema.fields)])
        return df.select(encode_json(row, named).alias(VALUE))
    fields = df.schema.fields
    if len(fields) != 1 or not isinstance(fields[0].dataType, T.StringType):
        raise ValueError("utf8 codec needs a frame with exactly one string column, got "
                         + df.schema.simpleString())
    return df.select(encode_utf8(quote(fields[0].name)).alias(VALUE))


def decode_rows(df: DataFrame, schema: T.StructType | str | None = None,
                codec: str = "json", column: str = VALUE, keys: str = "position",
                columns: list[str] | None = None, allow_missing: bool = False,
                alphabet: str = "standard") -> DataFrame:
    """Inverse of :func:`encode_rows`: lines of ``column`` back to typed rows.

    ``schema`` is that of the encoded rows.  ``columns`` decodes only some of
    them, in the order given: the parser skips the others.  Any line that does
    not hold exactly one such row (bad base64, cut-off or bad JSON, a blank
    line, text after the row, unknown, repeated or missing keys) fails the
    task, so a damaged snapshot never yields partial results;
    ``allow_missing`` reads missing keys as NULL instead.  ``alphabet="url"``
    also accepts the URL-safe base64 characters ``-`` and ``_``.
    """
    check_codec(codec)
    line = quote(column)
    if codec == "utf8":
        name = VALUE
        if schema is not None:
            st = _as_struct(schema)
            if len(st.fields) != 1 or not isinstance(st.fields[0].dataType, T.StringType):
                raise ValueError("utf8 codec decodes to exactly one string column")
            name = st.fields[0].name
        return df.select(decode_utf8(line, alphabet).alias(name))
    if schema is None:
        raise ValueError(f"{codec} codec needs the schema of the encoded rows")
    _check_keys(keys)
    st = _as_struct(schema)
    written = wire_type(st) if codec == "tagged" else st
    check_json_schema(written)
    place = {f.name: i for i, f in enumerate(st.fields)}
    wanted = st.names if columns is None else list(columns)
    unknown = [c for c in wanted if c not in place]
    if unknown:
        raise ValueError(f"no such columns in the encoded rows: {unknown}; there are {st.names}")

    def key(name: str) -> str:
        return name if keys == "name" else str(place[name])

    wire = T.StructType([T.StructField(key(c), written[c].dataType, True, st[c].metadata) for c in wanted])
    # The struct is unpacked by a one-element ``inline`` (a Generate), not by
    # field access on a projected column: a filter on a decoded field cannot
    # be pushed below a Generate, so each line is parsed once, not once for
    # the filter and again for the projection.
    texts = df.select(json_text(line, alphabet).alias(_TEXT))
    rows = texts.select(F.inline(json_rows(F.col(_TEXT), wire, [key(c) for c in st.names], allow_missing)))
    if codec == "tagged":
        return rows.select(*[from_wire(quote(key(c)), st[c].dataType).alias(c) for c in wanted])
    return rows.select(*[quote(key(c)).alias(c) for c in wanted])


def _as_struct(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    parsed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"expected a struct schema, got {schema!r}")
    return parsed
