"""Open a snapshot written by :func:`baton.sinks.write_snapshot` (or any
committed Parquet / base64-text folder) as a frame."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.operators.conform import conform
from baton.operators.digest_tree import BUCKET
from baton.operators.rowcodec import _as_struct, decode_rows, quote
from baton.session import path_exists, read_small_file
from baton.sinks.snapshot import MANIFEST, PARQUET


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The snapshot's codec and schema, or ``None`` for a foreign folder."""
    text = read_small_file(spark, path.rstrip("/") + "/" + MANIFEST)
    return json.loads(text) if text else None


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str | None,
                  codec: str = PARQUET, keys: str = "position", columns: list[str] | None = None,
                  allow_missing: bool = False, buckets: list[int] | None = None, keep_bucket: bool = False) -> DataFrame:
    """The lazy scan of ``path`` decoded with ``codec``; no checks.  ``buckets``: only the files
    of these buckets of a digest tree."""
    if codec == PARQUET:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(_as_struct(schema))  # skips footer inference
        df = reader.parquet(path)
        if (buckets is not None or keep_bucket) and BUCKET not in df.columns:  # without rows there is no bucket
            df = df.withColumn(BUCKET, F.lit(None).cast("int"))
        if buckets is not None:
            df = df.where(F.col(BUCKET).isin(buckets))
        if BUCKET in df.columns and not keep_bucket:
            df = df.drop(BUCKET)
        return df if columns is None else df.select(*[quote(c) for c in columns])
    return decode_rows(spark.read.text(path), schema, codec, keys=keys, columns=columns, allow_missing=allow_missing)


def open_snapshot(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  codec: str | None = None, keys: str = "position", allow_missing: bool = False,
                  buckets: list[int] | None = None) -> DataFrame:
    """A lazy frame over the stored rows of ``path``; of some ``buckets`` only, if it was written
    in buckets (``digest_by``).

    The rows are always decoded with the schema they were written with, from
    the snapshot's manifest.  ``schema`` then picks columns by name, in its
    order, and conforms them to its types (see :func:`baton.conform`); a column
    that was not written is an error.  Only the picked columns are decoded.

    A folder without a manifest (a foreign writer's) is opened only on its
    ``_SUCCESS``, as ``codec``, with ``schema`` as that of its rows; JSON lines
    there are keyed as ``keys`` says.  A half-written snapshot is refused.
    The plan's only leaf is the scan of ``path``, so the frame does not
    recompute or follow its source.
    """
    manifest = read_manifest(spark, path)
    if manifest is None:
        if not path_exists(spark, path.rstrip("/") + "/_SUCCESS"):
            raise FileNotFoundError(f"no committed snapshot at {path} (no manifest, no _SUCCESS)")
        return read_snapshot(spark, path, schema, codec or PARQUET, keys, allow_missing=allow_missing)
    if codec is not None and codec != manifest["codec"]:
        raise ValueError(f"{path} was written with codec {manifest['codec']!r}, not {codec!r}")
    if manifest["schema"] is None:
        raise ValueError(f"{path} holds objects without a schema; use open_rdd_snapshot")
    if buckets is not None and "tree" not in manifest:
        raise ValueError(f"{path} was not written in buckets")
    written = T.StructType.fromJson(manifest["schema"])
    old = int(manifest.get("version", 1)) < 3  # NULL fields were left out
    asked = None if schema is None else _as_struct(schema)
    if asked is not None:
        absent = [n for n in asked.names if n not in written.names]
        if absent:
            raise ValueError(f"{path} has no columns {absent}; it has {written.names}")
    df = read_snapshot(spark, path, written, manifest["codec"], manifest.get("keys", "name"),
                       None if asked is None else asked.names, allow_missing or old, buckets)
    return df if asked is None else conform(df, asked)
