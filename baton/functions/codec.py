"""Column expressions of the text row codec: one base64 token per row.

Everything here is a built-in Spark expression, so encoding and decoding run
inside whole-stage codegen on the executors; no Python touches the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON options both sides of the ``json`` codec must share.
# The default formats drop microseconds; ``XXXXX`` keeps the seconds of old
# local-mean-time offsets, so instants before 1900 come back exact.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Every key of a row is written, so a missing one shows damage.  The parser's
# own limits are lifted to what a row can hold: a string that was written can
# be read back.
ENCODE_OPTIONS = JSON_OPTIONS | {"ignoreNullFields": "false"}
DECODE_OPTIONS = {
    "mode": "FAILFAST",
    "maxStringLen": "2147483647",
    "maxNumLen": "1000000",
    "maxNestingDepth": "1000000",
}

CODECS = ("json", "tagged", "utf8")


def base64_line(binary: Column) -> Column:
    """Base64 of ``binary`` as one line.

    ``base64`` breaks its output every 76 characters with CRLF when
    ``spark.sql.chunkBase64String.enabled`` is on (the 4.x default); removing
    the breaks in the expression keeps one token per row whatever the setting.
    A plain substring ``replace`` is used: ``translate`` is ~15x slower here.
    """
    return F.replace(F.base64(binary), F.lit("\r\n"), F.lit(""))


def encode_utf8(col: Column) -> Column:
    """Base64 of the bytes of a string column, exactly; NULL fails the task."""
    guarded = F.when(col.isNull(), F.raise_error(
        F.lit("utf8 codec cannot encode NULL")).cast("string")).otherwise(col)
    return base64_line(guarded.cast("binary"))


def _valid_strings(c: Column, dt: T.DataType) -> Column | None:
    """Whether every string in ``c`` is valid UTF-8 (NULL counts as valid);
    None if the type holds no strings."""
    if isinstance(dt, (T.StringType, T.CharType, T.VarcharType)):
        return F.coalesce(F.is_valid_utf8(c), F.lit(True))
    if isinstance(dt, T.ArrayType):
        if _valid_strings(c, dt.elementType) is None:
            return None
        return F.coalesce(F.forall(c, lambda x: _valid_strings(x, dt.elementType)), F.lit(True))
    if isinstance(dt, T.MapType):
        return _valid_strings(F.map_entries(c), T.ArrayType(T.StructType(
            [T.StructField("key", dt.keyType), T.StructField("value", dt.valueType)])))
    if isinstance(dt, T.StructType):
        checks = [v for v in (_valid_strings(c.getField(f.name), f.dataType) for f in dt.fields) if v is not None]
        out = None
        for v in checks:
            out = v if out is None else out & v
        return out
    return None


def encode_json(struct: Column, schema: T.StructType | None = None) -> Column:
    """Base64 of the JSON text of a struct (a whole row).

    JSON is text: bytes that are not UTF-8 would be rewritten.  With the
    struct's ``schema`` such a string fails the task instead.
    """
    text = F.to_json(struct, ENCODE_OPTIONS)
    valid = None if schema is None else _valid_strings(struct, schema)
    if valid is not None:
        text = F.when(valid, text).otherwise(F.raise_error(
            F.lit("json codec: a string is not valid UTF-8; use the parquet codec")).cast("string"))
    return base64_line(F.encode(text, "UTF-8"))


def _unbase64_strict(line: Column, alphabet: str = "standard") -> Column:
    # to_binary raises on anything that is not base64 (unbase64 silently
    # returns empty bytes for URL-safe text); missing padding is accepted.
    if alphabet == "url":
        line = F.translate(line, "-_", "+/")
    elif alphabet != "standard":
        raise ValueError(f"alphabet must be 'standard' or 'url', got {alphabet!r}")
    return F.to_binary(line, F.lit("base64"))


def decode_utf8(line: Column, alphabet: str = "standard") -> Column:
    """Inverse of :func:`encode_utf8`, byte for byte; invalid base64 fails the task."""
    return _unbase64_strict(line, alphabet).cast("string")


def json_text(line: Column, alphabet: str = "standard") -> Column:
    """The JSON text of a line; a blank line or bad base64 fails the task."""
    guarded = F.when(line.isNull() | (line == ""), F.raise_error(
        F.lit("json codec: blank line in snapshot")).cast("string")).otherwise(line)
    return F.decode(_unbase64_strict(guarded, alphabet), "UTF-8")


def json_rows(text: Column, schema: T.StructType, keys: list[str] | None = None,
              allow_missing: bool = False) -> Column:
    """An array of the one struct that a JSON text holds; see :func:`decode_json`."""
    written = keys if keys is not None else schema.names
    in_order = F.lit(list(written)).cast("array<string>")
    names = F.lit(sorted(written)).cast("array<string>")

    def fail(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"json codec: {what}: "), F.substring(text, 1, 200)))

    def right(found: Column) -> Column:
        if allow_missing:
            return (F.size(F.array_except(found, names)) == 0) & (F.size(F.array_distinct(found)) == F.size(found))
        return (found == in_order) | (F.sort_array(found) == names)

    checked = F.element_at(F.transform(F.array(F.json_object_keys(text)), lambda found: (
        F.when(found.isNull(), fail("not a JSON object").cast("string"))
        .when(~right(found), fail("unexpected keys").cast("string")).otherwise(text))), 1)
    # A parser stops at the end of the first value.  Inside a wrapper that ends
    # in the text's own length, anything after the object breaks the wrapper.
    wire = T.StructType([T.StructField("row", schema), T.StructField("end", T.LongType())])
    wrapped = F.concat(F.lit('{"row":'), checked, F.lit(',"end":'), F.octet_length(text).cast("string"), F.lit("}"))
    return F.transform(F.array(F.from_json(wrapped, wire, DECODE_OPTIONS)), lambda r: F.when(
        r["end"] == F.octet_length(text), r["row"]).otherwise(fail("text after the object").cast(schema)))


def decode_json(line: Column, schema: T.StructType, keys: list[str] | None = None,
                allow_missing: bool = False, alphabet: str = "standard") -> Column:
    """Inverse of :func:`encode_json`, giving a struct of ``schema``.

    A line is one JSON object whose top-level keys are exactly ``keys``
    (default: the schema's; ``schema`` may hold only some of them, the rest is
    skipped).  Anything else fails the task: a blank line, bad base64, bad
    JSON, further text after the object, an unknown, repeated or missing key.
    ``allow_missing`` reads a missing key as NULL, for files of writers that
    leave NULL fields out.
    """
    return F.element_at(json_rows(json_text(line, alphabet), schema, keys, allow_missing), 1)


def check_json_schema(schema: T.DataType, where: str = "row") -> None:
    """Raise early for types the ``json`` codec cannot carry exactly.

    ``from_json`` rejects maps whose key is not a string, and duplicate field
    names would produce an ambiguous object, so neither is accepted.
    """
    if isinstance(schema, T.StructType):
        seen = set()
        for f in schema.fields:
            if f.name in seen:
                raise ValueError(f"json codec: duplicate field name {f.name!r} in {where}")
            seen.add(f.name)
            check_json_schema(f.dataType, f"{where}.{f.name}")
    elif isinstance(schema, T.ArrayType):
        check_json_schema(schema.elementType, f"{where}[]")
    elif isinstance(schema, T.MapType):
        if not isinstance(schema.keyType, (T.StringType, T.CharType, T.VarcharType)):
            raise ValueError(
                f"json codec: map key type {schema.keyType.simpleString()} at {where} "
                "is not a string; use the parquet codec")
        check_json_schema(schema.valueType, f"{where}{{}}")
    elif isinstance(schema, T.CalendarIntervalType):
        raise ValueError(f"json codec: calendar interval at {where} cannot be decoded")
    elif isinstance(schema, T.TimeType):
        raise ValueError(f"json codec: time at {where} cannot be decoded")


# The ``tagged`` codec: types that JSON has no form for, in terms of those that it has.

def wire_type(dt: T.DataType) -> T.DataType:
    """The type as which values of ``dt`` are written: a map whose keys are no strings as a list of
    ``{"k": ..., "v": ...}``, times and calendar intervals as their text, at any depth."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, wire_type(f.dataType), True, f.metadata) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(wire_type(dt.elementType))
    if isinstance(dt, T.MapType):
        if isinstance(dt.keyType, (T.StringType, T.CharType, T.VarcharType)):
            return T.MapType(dt.keyType, wire_type(dt.valueType))
        return T.ArrayType(T.StructType([T.StructField("k", wire_type(dt.keyType)), T.StructField("v", wire_type(dt.valueType))]))
    if isinstance(dt, (T.TimeType, T.CalendarIntervalType)):
        return T.StringType()
    return dt


def _same_on_wire(dt: T.DataType) -> bool:
    """Whether values of ``dt`` are written as they are."""
    if isinstance(dt, T.StructType):
        return all(_same_on_wire(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _same_on_wire(dt.elementType)
    if isinstance(dt, T.MapType):
        return isinstance(dt.keyType, (T.StringType, T.CharType, T.VarcharType)) and _same_on_wire(dt.valueType)
    return not isinstance(dt, (T.TimeType, T.CalendarIntervalType))


def to_wire(c: Column, dt: T.DataType) -> Column:
    """A value of ``dt`` as one of :func:`wire_type`; NULL stays NULL."""
    if _same_on_wire(dt):
        return c
    if isinstance(dt, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[to_wire(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: to_wire(x, dt.elementType))
    if isinstance(dt, T.MapType):
        if isinstance(wire_type(dt), T.MapType):
            return F.transform_values(c, lambda _, v: to_wire(v, dt.valueType))
        return F.transform(F.map_entries(c), lambda e: F.struct(
            to_wire(e["key"], dt.keyType).alias("k"), to_wire(e["value"], dt.valueType).alias("v")))
    return c.cast("string")


def from_wire(c: Column, dt: T.DataType) -> Column:
    """Inverse of :func:`to_wire`; text that is no time or interval, a list with a null entry, a
    null key or a repeated one fails the task."""
    if _same_on_wire(dt):
        return c

    def fail(what: str) -> Column:
        return F.raise_error(F.lit(f"tagged codec: {what}")).cast(dt)

    if isinstance(dt, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[from_wire(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: from_wire(x, dt.elementType))
    if isinstance(dt, T.MapType):
        if isinstance(wire_type(dt), T.MapType):
            return F.transform_values(c, lambda _, v: from_wire(v, dt.valueType))
        entries = F.transform(c, lambda e: F.struct(from_wire(e["k"], dt.keyType).alias("key"), from_wire(e["v"], dt.valueType).alias("value")))
        return F.when(F.exists(c, lambda e: e.isNull() | e["k"].isNull()), fail("a map entry without a key")).otherwise(F.map_from_entries(entries))
    value = c.try_cast(dt)
    return F.when(c.isNotNull() & value.isNull(), fail(f"not a {dt.simpleString()}")).otherwise(value)
