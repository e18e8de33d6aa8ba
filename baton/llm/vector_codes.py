"""Vector code compression: product codes learned by active-entry Lloyd rounds.

Vectors become integers, ``floor(scale * x)``, and are cut into consecutive parts.  Each part
position has a codebook, which starts as that part of the rows with the smallest ids.  A round
assigns every part to its nearest entry and then moves each entry to the floored mean of its
parts.  The state of a row (its entries and their exact distances) is written once a round.
After the first round only the *active* work is done: a part whose entry did not move compares
the moved entries with its stored distance; a part whose entry moved is scanned again in full.
Both give the nearest entry, ties to the lower index.

Only codebooks and the sums of their entries reach the driver: ``entries * length`` numbers for
each vector length.  The rows are never shuffled; a round shuffles one sum for each component
of each entry and task.

Defined results: rows whose vector is null, or holds a null or non-finite component, are left
out.  Vectors of different lengths have codebooks of their own.  A length that the number of
parts does not divide gives the first parts one component more; a part without components has
entry 0 and distance 0.  Rows without an id take part, after all others; rows that share an id
are ordered by their vectors.  With fewer rows than entries there are as many entries as rows.
Components beyond what keeps a sum of squares within 64 bits (2**27 and more for lengths up to
64) are set to that bound, so no finite vector ends the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.llm.wire import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
#: Rows of one block of distances, which holds rows * entries * components numbers.
BLOCK = 2048

#: Of each vector length: one (entries, components) array for each part.
Codebooks = dict[int, list[np.ndarray]]


class Compressed(NamedTuple):
    """``codes``: (id, label, length, code binary, error), a byte for each part; ``codebooks`` by length."""

    codes: DataFrame
    codebooks: Codebooks


def whole_components(column: pa.ListArray, scale: float) -> tuple[np.ndarray, pa.ListArray]:
    """floor(scale * x) of the components of the vectors that are not null and finite throughout;
    their places, and the whole vectors."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    sizes, x = np.diff(offsets), column.values[offsets[0]:offsets[-1]]
    values = x.to_numpy(zero_copy_only=False).astype(np.float64)  # a null is not a number
    fine = np.asarray(column.is_valid())
    fine[np.repeat(np.arange(len(sizes)), sizes)[~np.isfinite(values)]] = False
    bits = np.minimum((60 - np.ceil(np.log2(np.maximum(sizes, 1)))) // 2, 30)
    most = np.repeat(2.0 ** bits, sizes)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(values * scale), -most, most)[np.repeat(fine, sizes)].astype(np.int32)
    at = np.flatnonzero(fine)
    return at, pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes[at])]).astype(np.int32), whole)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(id, label, v array<int>) of the vectors that take part."""
    ident, label, vector = (F.col(f"`{c}`") for c in (id_col, label_col, vector_col))
    kind = vectors.schema[vector_col].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        vector = vector.cast("array<double>")
    schema = T.StructType([T.StructField("id", vectors.schema[id_col].dataType), T.StructField("label", vectors.schema[label_col].dataType),
                           T.StructField("v", T.ArrayType(T.IntegerType()))])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, v = whole_components(batch.column(2), scale)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), v], names=["id", "label", "v"])

    return vectors.select(ident.alias("id"), label.alias("label"), vector.alias("vector")).mapInArrow(whole, schema)


def cuts(length: int, parts: int) -> np.ndarray:
    """The bounds of the parts of a vector."""
    size, more = divmod(length, parts)
    return np.cumsum([0] + [size + (p < more) for p in range(parts)])


def distances(v: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows and entries, exact: in doubles where all terms fit 53 bits."""
    top = int(np.abs(v).max(initial=0)) + int(np.abs(entries).max(initial=0))
    if max(v.shape[1], 1) * top * top < 1 << 52:
        a, b = v.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    step = v[:, None, :] - entries[None, :, :]
    return (step * step).sum(2)


def nearest(v: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its distance; ties to the lower index."""
    index, least = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
    for a in range(0, len(v), BLOCK):
        d = distances(v[a:a + BLOCK], entries)
        index[a:a + BLOCK] = at = d.argmin(1)
        least[a:a + BLOCK] = d[np.arange(len(at)), at]
    return index, least


def reassign(v: np.ndarray, index: np.ndarray, least: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`nearest` of entries of which some moved since ``index`` and ``least`` were found."""
    index, least = index.copy(), least.copy()
    lost = moved[index]
    index[lost], least[lost] = nearest(v[lost], entries)
    active = np.flatnonzero(moved)
    held = np.flatnonzero(~lost)
    if len(active) and len(held):
        at, d = nearest(v[held], entries[active])
        at = active[at]
        better = (d < least[held]) | ((d == least[held]) & (at < index[held]))
        index[held[better]], least[held[better]] = at[better], d[better]
    return index, least


def _rows_of_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) of the vectors of each length in a batch."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    sizes, flat = np.diff(offsets), column.values.to_numpy().astype(np.int64)
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        yield int(length), rows, flat[(offsets[rows][:, None] + np.arange(length)).astype(np.int64)]


def _fixed(code: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary())


def _assigned(rows: DataFrame, books: Codebooks, parts: int, before: Codebooks | None = None) -> DataFrame:
    """The state of all rows under ``books``; ``before``: the codebooks of the state they hold."""
    moved = {n: [np.any(new != old, axis=1) for new, old in zip(books[n], before[n])] for n in books} if before else None
    schema = T.StructType([f for f in rows.schema.fields if f.name not in ("code", "dist")]
                          + [T.StructField("code", T.BinaryType()), T.StructField("dist", T.ArrayType(T.LongType()))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            code, dist = np.zeros((batch.num_rows, parts), np.uint8), np.zeros((batch.num_rows, parts), np.int64)
            if moved:
                code[:] = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(-1, parts)
                dist[:] = batch.column(batch.schema.get_field_index("dist")).flatten().to_numpy().reshape(-1, parts)
            for length, at, v in _rows_of_length(batch.column(batch.schema.get_field_index("v"))):
                cut = cuts(length, parts)
                for p, entries in enumerate(books[length]):
                    mine = v[:, cut[p]:cut[p + 1]]
                    if moved:
                        code[at, p], dist[at, p] = reassign(mine, code[at, p].astype(np.int64), dist[at, p], entries, moved[length][p])
                    else:
                        code[at, p], dist[at, p] = nearest(mine, entries)
            lists = pa.ListArray.from_arrays(np.arange(0, dist.size + 1, parts, dtype=np.int32), dist.reshape(-1))
            kept = table.select([f.name for f in schema.fields[:-2]])
            yield from kept.append_column("code", _fixed(code)).append_column("dist", lists).combine_chunks().to_batches()

    return rows.mapInArrow(assign, schema)


def _moved(state: DataFrame, books: Codebooks, parts: int) -> Codebooks:
    """Each entry at the floored mean of the parts that are assigned to it; others stay."""
    sizes = {n: max(len(b[0]), 1) for n, b in books.items()}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros((n + parts, k), np.int64) for n, k in sizes.items()}
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("code")).to_pylist()), np.uint8).reshape(-1, parts)
            for length, at, v in _rows_of_length(batch.column(batch.schema.get_field_index("v"))):
                cut, k = cuts(length, parts), sizes[length]
                for p in range(parts):
                    mine = code[at, p]
                    total[length][length + p] += np.bincount(mine, minlength=k)
                    for i in range(cut[p], cut[p + 1]):  # exact: below 2**53 within a batch
                        total[length][i] += np.bincount(mine, weights=v[:, i], minlength=k).astype(np.int64)
        for length, t in total.items():
            i, e = np.nonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), length, np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(e.astype(np.int32)), pa.array(t[i, e])], names=["length", "i", "entry", "n"])

    each = state.select("v", "code").mapInArrow(sums, "length int, i int, entry int, n bigint")
    found = {(r.length, r.i, r.entry): int(r.n) for r in
             each.groupBy("length", "i", "entry").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()}
    out: Codebooks = {}
    for length, book in books.items():
        cut = cuts(length, parts)
        out[length] = [entries.copy() for entries in book]
        for p, entries in enumerate(out[length]):
            for e in range(len(entries)):
                n = found.get((length, length + p, e), 0)
                if n:
                    entries[e] = [found.get((length, i, e), 0) // n for i in range(cut[p], cut[p + 1])]
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> Compressed:
    """The code of every vector and the codebooks after ``rounds`` rounds."""
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("a code holds one byte for each part: 1 to 256 entries, at least one part")
    rows = stored(quantised(vectors, id_col, vector_col, label_col, scale))
    books: Codebooks = {}
    for (length,) in rows.select(F.size("v")).distinct().collect():
        first = rows.where(F.size("v") == length).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
        v, cut = np.array([r.v for r in first], np.int64).reshape(len(first), length), cuts(length, parts)
        books[length] = [v[:, cut[p]:cut[p + 1]] for p in range(parts)]
    state = _assigned(rows, books, parts)
    for _ in range(rounds):
        state = stored(state)
        new = _moved(state, books, parts)
        state, books = _assigned(state, new, parts, before=books), new
    error = F.aggregate("dist", F.lit(0).cast("bigint"), lambda a, d: a + d)
    return Compressed(state.select("id", "label", F.size("v").alias("length"), "code", error.alias("error")), books)
