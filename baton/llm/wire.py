"""Chunks of documents, and packed messages between chunks and hash partitions.

The operators here need, per window or n-gram of a 100 TB corpus, one small
fact that other documents decide.  A row per window would multiply the corpus,
so the exchange is done in blocks: documents are dealt by hash into bounded
*chunks*, each chunk sends one packed blob per *part* (a hash range of the
n-grams, their copies within the chunk already merged) and each part answers
with one blob per chunk.  Both directions are ordinary Spark shuffles.  In one
plan every use of the chunked texts reads the same shuffle.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.session import new_snapshot_path

#: Text bytes of a chunk, growing with the corpus between these bounds.
CHUNK_BYTES = (4 << 20, 32 << 20)
MESSAGE = "dst int, src int, blob binary"
MESSAGE_ARROW = pa.schema([("dst", pa.int32()), ("src", pa.int32()), ("blob", pa.binary())])


def pack(*arrays: np.ndarray) -> bytes:
    """Numpy arrays as one compressed blob; bytes of equal weight lie together."""
    z = zstandard.ZstdCompressor(level=1)
    out = [struct.pack("<H", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes()
        c = z.compress(raw)
        if len(c) >= len(raw):
            out.append(struct.pack("<2sBqq", a.dtype.str[1:].encode(), 0, len(a), len(raw)) + raw)
        else:
            out.append(struct.pack("<2sBqq", a.dtype.str[1:].encode(), 1, len(a), len(c)) + c)
    return b"".join(out)


def unpack(blob) -> list[np.ndarray]:
    """The arrays of :func:`pack`."""
    blob = memoryview(blob)
    z = zstandard.ZstdDecompressor()
    (n,), at, out = struct.unpack_from("<H", blob, 0), 2, []
    for _ in range(n):
        kind, packed, length, size = struct.unpack_from("<2sBqq", blob, at)
        at += 19
        dtype = np.dtype("<" + kind.decode())
        raw = blob[at:at + size]
        at += size
        if packed:
            raw = z.decompress(raw, max_output_size=max(length * dtype.itemsize, 1))
        a = np.frombuffer(raw, np.uint8)
        if dtype.itemsize > 1:
            a = np.ascontiguousarray(a.reshape(dtype.itemsize, length).T).reshape(-1)
        out.append(a.view(dtype) if length else np.zeros(0, dtype))
    return out


def sort_by_part(part: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by part, and the n_parts + 1 offsets in it."""
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(n_parts + 1))


def messages(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2] for r in rows], pa.binary())], schema=MESSAGE_ARROW)


def incoming(table: pa.Table) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(sender, arrays) of each message, by sender."""
    src = table.column("src").to_numpy()
    blobs = table.column("blob")
    for i in np.argsort(src, kind="stable"):
        yield int(src[i]), unpack(blobs[int(i)].as_py())


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of the given lengths laid end to end: (item, place in the item) of each element."""
    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    item = np.repeat(np.arange(len(lengths)), lengths)
    return item, np.arange(total) - np.repeat(ends - lengths, lengths)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """All bytes of the text column, from one aggregate."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0


def n_chunks(spark: SparkSession, total: int) -> int:
    """Chunks for so many bytes: bounded in size, and enough to keep all tasks busy."""
    each = min(max(CHUNK_BYTES[0], total // 4000), CHUNK_BYTES[1])
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // each), 1)


def chunked(docs: DataFrame, id_col: str, text_col: str, chunks: int, keep: bool = False) -> DataFrame:
    """(chunk, id, h, text[, rest]): documents dealt evenly by a hash of id and text.
    ``rest`` holds all other columns as one struct, whatever their names."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    cols = [ident.alias("id"), F.xxhash64(text).alias("h"), text.alias("text")]
    if keep:
        others = [c for c in docs.columns if c not in (id_col, text_col)]
        rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]
        cols.append((F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("c"))).alias("rest"))
    out = docs.select(*cols)
    return out.select(F.pmod(F.xxhash64("id", "h"), F.lit(chunks)).cast("int").alias("chunk"), *out.columns)


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's documents by (id, nulls last; text hash): the same order at every use."""
    ids = table.column("id")
    missing = np.asarray(ids.is_null())
    value = ids.fill_null(0).to_numpy()
    order = np.lexsort((table.column("h").to_numpy(), value, missing))
    if (order == np.arange(len(order))).all():
        return table.combine_chunks()
    return table.take(pa.array(order)).combine_chunks()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: the lineage is cut
    by files that every executor can read."""
    path = new_snapshot_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
