"""Conform a frame to a declared schema, keeping the rows that do not fit with the reasons why.

:func:`baton.conform` accepts only casts that cannot fail; here any cast that Spark knows is
tried, and a row whose value does not survive it is rejected instead of failing the job.  All
of it is built-in expressions: one projection of the input, no shuffle.

Rules, by field name and at any depth (structs, arrays, keys and values of maps):

* ``missing``: a required field that the input does not have (every row is rejected);
* ``null``: a null in a required field, a required element of an array or a map's value;
* ``cast``: a value that the wanted type cannot hold at all (``'x'`` as int, 300 as tinyint);
* ``lossy``: a number or time that the wanted type changes (1.5 as int, a time of day as date):
  cast back, it must be what it was.  Text is parsed and need not look the same after;
* ``repeated key``: two keys of a map that the cast makes equal.

Fields that the schema lacks are dropped from conformed rows; rejected rows keep them.
A missing optional field is null.  An empty frame gives two empty frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.operators.handover import snapshot
from baton.operators.rowcodec import _as_struct, quote

REASONS = "array<struct<field: string, reason: string, value: string>>"
_ROW, _INPUT, _REASONS = "row", "input", "reasons"


def _why(path: Column, reason: str, value: Column | None = None) -> Column:
    text = F.lit(None) if value is None else value
    return F.array(F.struct(path.alias("field"), F.lit(reason).alias("reason"), text.cast("string").alias("value"))).cast(REASONS)


def _none() -> Column:
    return F.array().cast(REASONS)


def _all(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else _none()


def _source(fields: list[T.StructField], name: str, exact: bool, where: str) -> T.StructField | None:
    """The input's field of that name, as the session compares names."""
    same = [f for f in fields if f.name == name] or [f for f in fields if not exact and f.name.lower() == name.lower()]
    if len(same) > 1:
        raise ValueError(f"several fields of {where or 'the input'} are called {name!r}")
    return same[0] if same else None


class _Fit:
    """The cast of values of one type to another, and what is wrong with a value."""

    def __init__(self, exact: bool):
        self.exact = exact

    def _pair(self, have: T.DataType, want: T.DataType, where: str) -> None:
        if isinstance(want, (T.CharType, T.VarcharType)):
            raise ValueError(f"{where}: a string of bounded length cannot be checked; use string")
        nested = (T.StructType, T.ArrayType, T.MapType)
        if (isinstance(have, nested) or isinstance(want, nested)) and type(have) is not type(want):
            raise ValueError(f"{where}: {have.simpleString()} is never a {want.simpleString()}")

    def cast(self, c: Column, have: T.DataType, want: T.DataType, where: str) -> Column:
        self._pair(have, want, where)
        if isinstance(want, T.StructType):
            parts = []
            for f in want.fields:
                of = _source(have.fields, f.name, self.exact, where)
                value = F.lit(None).cast(f.dataType) if of is None else self.cast(c[of.name], of.dataType, f.dataType, f"{where}.{f.name}")
                parts.append(value.alias(f.name))
            return F.when(c.isNotNull(), F.struct(*parts))
        if isinstance(want, T.ArrayType):
            return F.transform(c, lambda x: self.cast(x, have.elementType, want.elementType, f"{where}[]"))
        if isinstance(want, T.MapType):
            return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(
                self.cast(e["key"], have.keyType, want.keyType, f"{where}.key").alias("key"),
                self.cast(e["value"], have.valueType, want.valueType, f"{where}.value").alias("value"))))
        return c if have == want else c.try_cast(want)

    def wrong(self, c: Column, have: T.DataType, want: T.DataType, required: bool, path: Column, where: str) -> Column:
        """The reasons against a value, in the order of its fields and elements."""
        self._pair(have, want, where)
        if isinstance(want, T.StructType):
            inner = self.fields(have, want, lambda f: c[f.name], lambda name: F.concat(path, F.lit("." + name)), where)
        elif isinstance(want, T.ArrayType):
            inner = F.flatten(F.transform(c, lambda x, i: self.wrong(
                x, have.elementType, want.elementType, not want.containsNull,
                F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), f"{where}[]")))
        elif isinstance(want, T.MapType):
            keys = F.transform(F.map_keys(c), lambda k: self.cast(k, have.keyType, want.keyType, f"{where}.key"))
            inner = F.concat(
                F.flatten(F.transform(F.map_entries(c), lambda e: F.concat(
                    self.wrong(e["key"], have.keyType, want.keyType, True, F.concat(path, F.lit(".key")), f"{where}.key"),
                    self.wrong(e["value"], have.valueType, want.valueType, not want.valueContainsNull,
                               F.concat(path, F.lit(".value")), f"{where}.value")))),
                F.when(F.size(F.array_distinct(keys)) < F.size(keys), _why(path, "repeated key")).otherwise(_none()))
        elif have == want:
            inner = _none()
        else:
            cast = self.cast(c, have, want, where)
            inner = F.when(cast.isNull(), _why(path, "cast", c))
            measures = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
            if isinstance(have, measures) and isinstance(want, measures):
                inner = inner.when(~cast.try_cast(have).eqNullSafe(c), _why(path, "lossy", c))
            inner = inner.otherwise(_none())
        return F.when(c.isNull(), _why(path, "null") if required else _none()).otherwise(inner)

    def fields(self, have: T.StructType, want: T.StructType, column, path, where: str) -> Column:
        parts = []
        for f in want.fields:
            of = _source(have.fields, f.name, self.exact, where)
            if of is None:
                if not f.nullable:
                    parts.append(_why(path(f.name), "missing"))
                continue
            parts.append(self.wrong(column(of), of.dataType, f.dataType, not f.nullable, path(f.name), f"{where}.{f.name}".lstrip(".")))
        return _all(parts)


def judge_rows(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """``(row, input, reasons)`` for each row of ``df``: the conformed row (null if rejected), the
    row as it came (null if conformed), and what is wrong with it (empty if conformed).

    Pairs of types between which Spark has no cast are an error before any job, as are repeated
    names and strings of bounded length in the schema.
    """
    want = _as_struct(schema)
    names = df.columns
    if len(set(names)) < len(names):
        raise ValueError(f"the input has repeated names: {names}")
    fit = _Fit(df.sparkSession.conf.get("spark.sql.caseSensitive") == "true")
    rows = df.select(F.struct(*[quote(n) for n in names]).alias(_INPUT))
    given = F.col(_INPUT)
    judged = rows.select(_INPUT, fit.fields(df.schema, want, lambda f: given[f.name], F.lit, "").alias(_REASONS))
    fits = F.size(_REASONS) == 0
    # a cast is only evaluated where nothing is wrong: a repeated key would fail the task
    return judged.select(F.when(fits, fit.cast(given, df.schema, want, "")).alias(_ROW),
                         F.when(~fits, given).alias(_INPUT), _REASONS)


def conform_split(df: DataFrame, schema: T.StructType | str, temp_dir: str | None = None,
                  reasons: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """``(conformed, rejected)``: the rows that fit ``schema``, and the others as they came with a
    column ``reasons`` of (field, reason, value).

    The input is read and judged once and stored as a snapshot below ``temp_dir`` (as for
    :func:`baton.snapshot`), each row as the one or the other; both frames are scans of it, so
    together they are the input, whatever it would give if it were read again.  Fields that the
    schema requires come back nullable, as from any files.
    """
    if any(c == reasons or c.lower() == reasons.lower() for c in df.columns):
        raise ValueError(f"the input has a column {reasons!r}; name the reasons otherwise")
    stored = snapshot(judge_rows(df, schema), temp_dir)
    bad = F.size(_REASONS) > 0
    kept = stored.where(~bad).select(*[F.col(_ROW)[n].alias(n) for n in _as_struct(schema).names])
    left = stored.where(bad).select(*[F.col(_INPUT)[n].alias(n) for n in df.columns], F.col(_REASONS).alias(reasons))
    return kept, left
