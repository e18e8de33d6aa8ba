"""Files as a table: listing, sizes and contents of what a glob matches.

Files with content come from a ``binaryFile`` scan, whose tasks are spread over
the cluster; listing and sizes prune the content, so no byte is read.  Such a
scan never shows empty files, folders or hidden names (``_x``, ``.x``): the
session's file system is asked for those, one status at a time, which is what
the driver does before any file scan, too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.session import _hadoop_path

_LISTING = "path string, modified timestamp, size_bytes bigint, is_dir boolean"
# The characters that Hadoop globs give a meaning.
_GLOB_CHARACTERS = re.compile(r"([\\{}\[\]*?^])")


def _matches(spark: SparkSession, glob: str) -> Iterator:
    """The statuses of the entries a glob matches."""
    p, fs = _hadoop_path(spark, glob)
    statuses = fs.globStatus(p)
    for i in range(len(statuses) if statuses is not None else 0):
        yield statuses[i]


def _hidden(path: str) -> bool:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.startswith(("_", "."))


def _special(spark: SparkSession, glob: str) -> tuple[list[tuple], list[str]]:
    """Of a glob's matches: those no scan shows (path, modified ms, size, folder), and the
    paths of the files that one reads."""
    odd, full = [], []
    for s in _matches(spark, glob):
        path, size, folder = s.getPath().toString(), s.getLen(), bool(s.isDirectory())
        if folder or size == 0 or _hidden(path):
            odd.append((path, s.getModificationTime(), 0 if folder else size, folder))
        else:
            full.append(path)
    return odd, full


def _scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A scan of exactly these files: their names are not globs again."""
    return spark.read.format("binaryFile").load([_GLOB_CHARACTERS.sub(r"\\\1", p) for p in paths])


def list_files(spark: SparkSession, glob: str, strict: bool = False) -> DataFrame:
    """``(path, modified, size_bytes, is_dir)`` for every entry ``glob`` matches.

    Paths are fully qualified (``scheme:/...``); folders have size 0.  No match
    gives an empty frame, or ``FileNotFoundError`` when ``strict``.
    """
    odd, full = _special(spark, glob)
    if strict and not odd and not full:
        raise FileNotFoundError(f"nothing matches {glob}")
    rest = spark.createDataFrame(odd, "path string, modified_ms bigint, size_bytes bigint, is_dir boolean").select(
        "path", F.timestamp_millis("modified_ms").alias("modified"), "size_bytes", "is_dir")
    if not full:
        return rest
    scan = _scan(spark, full).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size_bytes"), F.lit(False).alias("is_dir"))
    return scan.unionByName(rest) if odd else scan


def file_sizes(spark: SparkSession, glob: str, strict: bool = False, recursive: bool = False) -> DataFrame:
    """``(path, size_bytes)`` of the matched files (folders are left out).

    ``recursive`` gives the files below matched folders, too, at any depth: the files a
    scan reads, so neither empty nor hidden ones.  No path passes through Python then.
    """
    if not recursive:
        return list_files(spark, glob, strict).where(~F.col("is_dir")).select("path", "size_bytes")
    try:
        scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if strict:
            raise FileNotFoundError(f"no file matches {glob}") from e
        return spark.createDataFrame([], "path string, size_bytes bigint")
    return scan.select("path", F.col("length").alias("size_bytes"))


def read_files(spark: SparkSession, glob: str, strict: bool = False) -> DataFrame:
    """``(path, content)``: the bytes of each matched file, one row per file.

    The files that are read are exactly those the glob matched: their names are
    taken literally.  A file must fit one task
    (``spark.sql.sources.binaryFile.maxLength``, 2 GiB at most); empty files
    give empty content; folders are left out.  No file source reads a hidden
    name with content (``_x``, ``.x``), so matching one is an error rather than a
    row less.
    """
    odd, full = _special(spark, glob)
    files = [r for r in odd if not r[3]]
    hidden = [r[0] for r in files if r[2]]
    if hidden:
        raise ValueError(f"{glob} matches hidden files, which Spark does not read: {hidden[:5]}")
    if strict and not files and not full:
        raise FileNotFoundError(f"no file matches {glob}")
    empty = spark.createDataFrame([(r[0], bytearray()) for r in files], "path string, content binary")
    if not full:
        return empty
    scan = _scan(spark, full).select("path", "content")
    return scan.unionByName(empty) if files else scan
