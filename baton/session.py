"""Where snapshots live, and small file-system helpers.

Snapshots must sit on storage that every executor and every later session can
read, so the default root is the shared folder the cluster names in
``spark.checkpoint.dir``.  Where none is named, the caller must name one.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession

SNAPSHOT_PREFIX = "snapshot-"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError(
            "spark.checkpoint.dir is not set: set it, or pass temp_dir=, to storage "
            "all executors share (HDFS, object store)")
    return root


def new_snapshot_path(spark: SparkSession, temp_dir: str | None = None) -> str:
    """A fresh, never reused location ``<root>/snapshot-<application>-<uuid>``."""
    root = temp_dir or checkpoint_root(spark)
    return root + ("" if root.endswith("/") else "/") + f"{SNAPSHOT_PREFIX}{application_tag(spark)}-{uuid.uuid4().hex}"


def application_tag(spark: SparkSession) -> str:
    """A short name of the running application, the same in all its sessions."""
    return hashlib.sha1(spark.sparkContext.applicationId.encode()).hexdigest()[:12]


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    # the session's configuration: the context's, and what was set on the session
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the session's Hadoop file system."""
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` holding ``text`` (UTF-8); fails if it exists.  For
    metadata only: no Spark job, one file-system call from the driver."""
    p, fs = _hadoop_path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_small_file(spark: SparkSession, path: str) -> str | None:
    """The UTF-8 text of a small metadata file, or ``None`` if absent."""
    p, fs = _hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


class Entry(NamedTuple):
    """One entry of a folder; ``modified`` in milliseconds."""

    name: str
    folder: bool
    modified: int


def _missing(error: Exception) -> bool:
    """Whether a file system call failed because there is no such file."""
    cause = getattr(error, "java_exception", None)
    return cause is not None and cause.getClass().getName() == "java.io.FileNotFoundException"


def list_folder(spark: SparkSession, path: str) -> list[Entry]:
    """The entries of a folder; none if it is not there.  For folders of metadata and snapshots,
    not for data files by the million."""
    p, fs = _hadoop_path(spark, path)
    try:
        found = fs.listStatus(p)
    except Exception as e:
        if not _missing(e):
            raise
        return []
    return [Entry(s.getPath().getName(), bool(s.isDirectory()), s.getModificationTime()) for s in found]


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; ``FileNotFoundError`` if it is not there."""
    p, fs = _hadoop_path(spark, path)
    try:
        done = fs.rename(p, _hadoop_path(spark, to)[0])
    except Exception as e:
        if not _missing(e):
            raise
        done = False
    if not done:
        raise FileNotFoundError(f"cannot rename {path}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path``; used only to release a snapshot on request."""
    p, fs = _hadoop_path(spark, path)
    return bool(fs.delete(p, True))
