"""Records of an RDD (rows, dicts, tuples) as Arrow batches, with the types that they need.

A task turns its records into columns a batch at a time: the Python types of a column are one
``set(map(type, ...))``, its values one Arrow array.  Each batch is one row of a staged table:
``at`` (its place in the RDD), ``kinds`` (its column types), ``n`` (records) and ``batch`` (Arrow
IPC).  The types of all batches form a lattice, from the missing one upwards; they are merged in a
tree, so that the RDD itself is read once.  Fields come in the order in which they first appear.  The staged batches are then decoded into the schema found, inside Arrow.
"""

from __future__ import annotations

import datetime
import decimal
import functools
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGED = "at bigint, kinds string, n bigint, batch binary"
#: Records and bytes of a batch, about.
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20

# The column type of each Python type, and that type in Arrow.
_ATOMS = {
    bool: "boolean", int: "bigint", float: "double", str: "string", bytes: "binary", bytearray: "binary",
    datetime.date: "date", datetime.datetime: "timestamp", datetime.timedelta: "interval day to second",
    decimal.Decimal: "decimal(38,18)",
}
_TYPES = {
    "boolean": (T.BooleanType(), pa.bool_()), "bigint": (T.LongType(), pa.int64()), "double": (T.DoubleType(), pa.float64()),
    "string": (T.StringType(), pa.string()), "binary": (T.BinaryType(), pa.binary()), "date": (T.DateType(), pa.date32()),
    "timestamp": (T.TimestampType(), pa.timestamp("us", "UTC")), "interval day to second": (T.DayTimeIntervalType(), pa.duration("us")),
    "decimal(38,18)": (T.DecimalType(38, 18), pa.decimal128(38, 18)),
}


def _named(value) -> bool:
    return isinstance(value, Row) and hasattr(value, "__fields__")


def _family(value) -> str:
    """The kind of a value without that of its parts."""
    if _named(value):
        return "struct"
    if isinstance(value, dict):
        return "map"
    if isinstance(value, (list, tuple)):
        return "array"
    if type(value) in _ATOMS:
        return _ATOMS[type(value)]
    raise TypeError(f"no column type for {type(value).__name__}; give a schema or use snapshot_rdd")


def _ddl(kind) -> str:
    if kind is None:
        return "void"
    if isinstance(kind, str):
        return kind
    if kind[0] == "struct":
        return "struct<" + ", ".join(f"`{n}`: {_ddl(k)}" for n, k in kind[1].items()) + ">"
    return f"{kind[0]}<{', '.join(_ddl(k) for k in kind[1:])}>"


def _different(a, b, where: str) -> TypeError:
    return TypeError(f"values of different types in {where}: {_ddl(a)} and {_ddl(b)}; give a schema")


def merged(a, b, where: str):
    """The least kind that holds both; different types are an error."""
    if a is None or b is None or a == b:
        return b if a is None else a
    if isinstance(a, (tuple, list)) and isinstance(b, (tuple, list)) and a[0] == b[0]:
        if a[0] == "struct":
            return ("struct", _merged_fields(a[1], b[1], where))
        return (a[0], *(merged(x, y, where) for x, y in zip(a[1:], b[1:])))
    raise _different(a, b, where)


def _merged_fields(a: dict, b: dict, where: str) -> dict:
    return {n: merged(a.get(n), b.get(n), f"{where}.{n}") for n in [*a, *(n for n in b if n not in a)]}


def _decimals(values: list) -> pa.Array:
    kind = _TYPES["decimal(38,18)"][1]
    try:
        return pa.array(values, kind)
    except pa.ArrowInvalid:  # more digits than the type has: rounded half up
        with decimal.localcontext(prec=100, rounding=decimal.ROUND_HALF_UP):
            return pa.array([None if v is None else v.quantize(decimal.Decimal("1e-18")) for v in values], kind)


def _atoms(kind: str, values: list, where: str) -> pa.Array:
    if kind == "timestamp":
        micros = T.TimestampType().toInternal  # naive ones are local time
        return pa.array([None if v is None else micros(v) for v in values], pa.int64()).cast(_TYPES[kind][1])
    if kind == "decimal(38,18)":
        return _decimals(values)
    try:
        return pa.array(values, _TYPES[kind][1])
    except OverflowError as e:
        raise ValueError(f"an integer beyond 64 bits in {where}") from e


def _offsets(values: list) -> tuple[pa.Array, pa.Array, list]:
    """Offsets of nested values, which of them are missing, and the others."""
    at, ends = 0, [0]
    for v in values:
        at += 0 if v is None else len(v)
        ends.append(at)
    return pa.array(ends, pa.int32()), pa.array([v is None for v in values], pa.bool_()), [v for v in values if v is not None]


def _fields_of(rows: list, where: str) -> dict[str, list]:
    """The columns of named rows; a field that a row lacks, or a missing row, gives None."""
    first = next(r.__fields__ for r in rows if r is not None)
    if all(r is not None and r.__fields__ == first for r in rows) and len(set(first)) == len(first):
        return dict(zip(first, map(list, zip(*rows))))
    plain = [{} if r is None else dict(zip(r.__fields__, r)) for r in rows]
    return {n: [r.get(n) for r in plain] for n in dict.fromkeys(chain.from_iterable(plain))}


def encode_column(values: list, where: str):
    """The kind of a column of Python values and its Arrow array."""
    found = set(map(type, values))
    found.discard(type(None))
    if not found:
        return None, pa.nulls(len(values))
    kinds = {_ATOMS.get(t) for t in found}
    if None in kinds:
        kinds = {_family(v) for v in values if v is not None}
    if len(kinds) > 1:
        raise _different(*sorted(kinds)[:2], where)
    kind = kinds.pop()
    if kind == "array":
        offsets, missing, some = _offsets(values)
        item, child = encode_column(list(chain.from_iterable(some)), where + "[]")
        return ("array", item), pa.ListArray.from_arrays(offsets, child, mask=missing)
    if kind == "map":
        offsets, missing, some = _offsets(values)
        keys = list(chain.from_iterable(some))
        if None in keys:
            raise ValueError(f"a map with a missing key in {where}")
        key, key_array = encode_column(keys, where + "'s keys")
        item, items = encode_column(list(chain.from_iterable(v.values() for v in some)), where + "'s values")
        return ("map", key, item), pa.MapArray.from_arrays(offsets, key_array, items, mask=missing)
    if kind == "struct":
        columns = {n: encode_column(c, f"{where}.{n}") for n, c in _fields_of(values, where).items()}
        array = pa.StructArray.from_arrays([a for _, a in columns.values()], list(columns), mask=pa.array([v is None for v in values], pa.bool_()))
        return ("struct", {n: k for n, (k, _) in columns.items()}), array
    return kind, _atoms(kind, values, where)


def _columns(rows: list) -> tuple[dict[str, list], int | None]:
    """The columns of a batch of records, and the width of those without names."""
    found = set(map(type, rows))
    if found == {dict}:
        names = dict.fromkeys(chain.from_iterable(rows))
        return {n: [r.get(n) for r in rows] for n in names}, None
    if all(_named(r) for r in rows):
        return _fields_of(rows, "the records"), None
    plain, width = [], None
    for r in rows:
        if isinstance(r, dict):
            plain.append(r)
        elif _named(r):
            plain.append(dict(zip(r.__fields__, r)))
        elif isinstance(r, (tuple, list)):
            if width not in (None, len(r)):
                raise ValueError(f"a record of {min(width, len(r))} fields for a schema of {max(width, len(r))}")
            width = len(r)
            plain.append(r)
        else:
            raise TypeError(f"not a record: {type(r).__name__}; wrap it in a tuple or use snapshot_rdd")
    if all(isinstance(r, (tuple, list)) for r in plain):
        return {f"_{i + 1}": list(c) for i, c in enumerate(zip(*plain))}, width
    named = [r if isinstance(r, dict) else {f"_{i + 1}": v for i, v in enumerate(r)} for r in plain]
    return {n: [r.get(n) for r in named] for n in dict.fromkeys(chain.from_iterable(named))}, width


def encode_records(part: int, rows: Iterable) -> Iterator[tuple[int, str, int, bytes]]:
    """The rows of the staged table for the records of one partition."""
    size, batch, at = 256, [], part << 32

    def staged(batch: list) -> tuple[int, str, int, bytes]:
        columns, width = _columns(batch)
        odd = [n for n in columns if not isinstance(n, str)]
        if odd:
            raise TypeError(f"field names must be text: {odd}")
        encoded = {n: encode_column(c, f"the records.{n}") for n, c in columns.items()}
        table = pa.RecordBatch.from_arrays([a for _, a in encoded.values()], list(encoded))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_batch(table)
        return at, json.dumps({"fields": {n: k for n, (k, _) in encoded.items()}, "width": width}), len(batch), sink.getvalue().to_pybytes()

    for row in rows:
        batch.append(row)
        if len(batch) >= size:
            out = staged(batch)
            size = max(1, min(BATCH_ROWS, len(batch) * 4, len(batch) * BATCH_BYTES // max(len(out[3]), 1)))
            batch, at = [], at + 1
            yield out
    if batch:
        yield staged(batch)


def _merged_kinds(a: str, b: str) -> str:
    x, y = json.loads(a), json.loads(b)
    if None not in (x["width"], y["width"]) and x["width"] != y["width"]:
        raise ValueError(f"a record of {min(x['width'], y['width'])} fields for a schema of {max(x['width'], y['width'])}")
    return json.dumps({"fields": _merged_fields(x["fields"], y["fields"], "the records"), "width": x["width"] if y["width"] is None else y["width"]})


def spark_type(kind) -> T.DataType:
    if isinstance(kind, str):
        return _TYPES[kind][0]
    if kind[0] == "struct":
        return T.StructType([T.StructField(n, spark_type(k)) for n, k in kind[1].items()])
    return (T.ArrayType if kind[0] == "array" else T.MapType)(*(spark_type(k) for k in kind[1:]))


def _arrow_type(kind) -> pa.DataType:
    if isinstance(kind, str):
        return _TYPES[kind][1]
    if kind[0] == "struct":
        return pa.struct([(n, _arrow_type(k)) for n, k in kind[1].items()])
    return (pa.list_ if kind[0] == "array" else pa.map_)(*(_arrow_type(k) for k in kind[1:]))


def merged_fields(staged: DataFrame) -> dict:
    """The kinds of all staged records by field, merged in a tree: by batch, by task, and the
    tasks' on the driver, which sees one for each of ``spark.sql.shuffle.partitions``."""
    kinds = staged.groupBy("kinds").agg(F.min("at").alias("at")).orderBy("at").select("kinds")
    each = kinds.rdd.mapPartitions(lambda rows: [functools.reduce(_merged_kinds, found)] if (found := [r[0] for r in rows]) else []).collect()
    if not each:
        raise ValueError("an empty RDD has no schema; give one")
    found = json.loads(functools.reduce(_merged_kinds, each))
    fields = found["fields"]
    if not fields:
        raise ValueError("an empty RDD has no schema; give one")
    unknown = [n for n, k in fields.items() if "void" in _ddl(k)]
    if unknown:
        raise TypeError(f"no value tells the type of {unknown}; give a schema")
    if found["width"] not in (None, len(fields)):
        raise ValueError(f"a record of {found['width']} fields for a schema of {len(fields)}")
    return fields


def _fitted(array: pa.Array, kind) -> pa.Array:
    """An array of a batch as one of the merged kind: missing fields and types are filled in."""
    want = _arrow_type(kind)
    if array.type == want:
        return array
    if pa.types.is_null(array.type):
        return pa.nulls(len(array), want)
    if kind[0] == "struct":
        have = {f.name for f in array.type}
        children = [_fitted(array.field(n), k) if n in have else pa.nulls(len(array), _arrow_type(k)) for n, k in kind[1].items()]
        return pa.StructArray.from_arrays(children, list(kind[1]), mask=array.is_null())
    if kind[0] == "array":
        return pa.ListArray.from_arrays(array.offsets, _fitted(array.values, kind[1]), mask=array.is_null())
    return pa.MapArray.from_arrays(array.offsets, _fitted(array.keys, kind[1]), _fitted(array.items, kind[2]), mask=array.is_null())


def decoder(fields: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over (n, batch) of the staged table: the records as columns of ``fields``."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for n, blob in zip(rows.column(0).to_pylist(), rows.column(1)):
                batch = pa.ipc.open_stream(blob.as_buffer()).read_next_batch()
                have = set(batch.schema.names)
                yield pa.RecordBatch.from_arrays([_fitted(batch.column(name), k) if name in have else pa.nulls(n, _arrow_type(k))
                                                  for name, k in fields.items()], list(fields))

    return decode
