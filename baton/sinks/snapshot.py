"""Write a frame as a durable snapshot at a fresh path."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baton.operators.rowcodec import check_codec, encode_rows, quote
from baton.session import delete_path, new_snapshot_path, path_exists, write_small_file

PARQUET = "parquet"
PICKLE = "pickle"  # RDDs of objects only
MANIFEST = "_manifest.json"  # hidden from readers of the snapshot folder
MANIFEST_VERSION = 3  # 2: json lines keyed by column position; 3: NULL fields are written too


def write_snapshot(df: DataFrame, temp_dir: str | None = None, codec: str = PARQUET,
                   partitions: int | None = None,
                   max_records_per_file: int | None = None,
                   compression: str | None = None, digest_by: list[str] | None = None,
                   buckets: int = 256, target_file_bytes: int | None = None,
                   cluster_by: list[str] | None = None) -> str:
    """Materialise ``df`` under ``temp_dir`` (default: the session's
    ``spark.checkpoint.dir``) and return the new path.

    ``parquet`` keeps the columns typed and splittable, so later filters and
    projections reach the scan.  ``json`` / ``utf8`` write one base64 line per
    row (portable text).  The write keeps the input partitioning: no shuffle
    unless ``partitions`` asks for one; ``max_records_per_file`` bounds file
    size without a shuffle.  ``compression`` is passed to the writer (for
    text, an unsplittable codec such as ``gzip`` means one reader task per
    file, so bound the files too).  Output goes through Spark's commit
    protocol, so a lost executor only re-runs its tasks and a failed job
    leaves no ``_SUCCESS`` and no manifest.

    ``digest_by``, a list of SQL expressions over the columns (an empty one is
    the whole row), puts the rows into ``buckets`` folders by a hash of their
    values and stores a tree of digests of these, for
    :func:`baton.snapshot_diff`.  This shuffles the rows once, with files of
    AQE's advisory size and hot buckets split, and reads them back once.

    ``target_file_bytes`` gives files of about that size, and ``cluster_by``
    makes each of them a range of these columns (see :mod:`baton.sinks.shards`):
    the rows are written twice and shuffled once for it.
    """
    from baton.operators import digest_tree
    from baton.sinks import shards

    spark = df.sparkSession
    if codec != PARQUET:
        check_codec(codec)
    src = df if partitions is None else df.repartition(partitions)
    if digest_by is not None:
        if codec != PARQUET or partitions is not None:
            raise ValueError("digest_by goes with the parquet codec and its own partitions")
        digest_tree.check_tree(df, digest_by, buckets)
        src = src.withColumn(digest_tree.BUCKET, digest_tree.bucket_column(src, digest_by, buckets)).hint("rebalance", F.col(digest_tree.BUCKET))
    if cluster_by and target_file_bytes is None:
        raise ValueError("cluster_by needs target_file_bytes")
    if target_file_bytes is not None:
        if target_file_bytes < 1 or digest_by is not None or partitions is not None or max_records_per_file:
            raise ValueError("target_file_bytes must be positive, and is another layout than partitions, max_records_per_file and digest_by")
        if cluster_by and codec != PARQUET:
            raise ValueError("cluster_by goes with the parquet codec")
        df.select(*[quote(c) for c in cluster_by or []])  # raises for a name that is none
    out = src if codec == PARQUET else encode_rows(src, codec)

    def write(frame: DataFrame, where: str) -> None:
        writer = frame.write.mode("errorifexists")
        if digest_by is not None:
            writer = writer.partitionBy(digest_tree.BUCKET)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
        if compression:
            writer = writer.option("compression", compression)
        if codec == PARQUET:
            writer.parquet(where)
        else:
            writer.text(where)

    path = new_snapshot_path(spark, temp_dir)
    try:
        if target_file_bytes is None:
            write(out, path)
        else:
            stage = new_snapshot_path(spark, temp_dir)
            try:
                write(out, stage)
                staged = spark.read.schema(out.schema).parquet(stage) if codec == PARQUET else spark.read.text(stage)
                shards.write_sharded(staged, stage, write, path, target_file_bytes, cluster_by or [])
            finally:
                delete_path(spark, stage)
        tree = None
        if digest_by is not None:
            from baton.sources.snapshot import read_snapshot

            tree = digest_tree.build_tree(spark, path, read_snapshot(spark, path, df.schema, keep_bucket=True), digest_by, buckets)
        write_manifest(spark, path, codec, df.schema.json(), tree)
    except BaseException:
        delete_path(spark, path)  # this call's own new folder
        raise
    return path


def write_manifest(spark, path: str, codec: str, schema_json: str | None, tree: dict | None = None) -> None:
    """Record codec and schema (None for objects), and the digest tree if there is one, next to
    the data, after the data committed."""
    doc = json.dumps({"version": MANIFEST_VERSION, "codec": codec, "keys": "position",
                      "schema": schema_json and json.loads(schema_json)} | ({} if tree is None else {"tree": tree}))
    write_small_file(spark, path.rstrip("/") + "/" + MANIFEST, doc)


def release_snapshot(spark, path: str) -> None:
    """Delete a snapshot written by :func:`write_snapshot` once no frame
    needs it any more.  Only folders carrying the snapshot manifest are
    deleted, so a mistyped path cannot remove other data."""
    from baton.session import delete_path, path_exists

    if not path_exists(spark, path.rstrip("/") + "/" + MANIFEST):
        raise ValueError(f"{path} is not a snapshot written by write_snapshot")
    delete_path(spark, path)
