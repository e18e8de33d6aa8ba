"""Trees of files as a table, walked and read by tasks: no path passes through the driver.

A walk starts as one row, the part of the glob before its first pattern.  Each round is a job:
tasks list their folders and give entries that match and folders to go on with.  Once there are
enough folders for all tasks (``SPREAD``), each task walks its subtrees to the end; so a deep tree
takes a few jobs, not one for each level.  Rounds are stored in the checkpoint folder, so a lost
executor costs its folders only.

Files come back as ranges of bounded size, in order by path and offset, of which each is one read
at its place; so a file may be larger than a row (2 GiB), and one large file is read by many tasks.

Tasks reach the storage through :mod:`baton.storage`, not through Spark's readers: a store that
only Hadoop's file systems know raises ``ValueError``; :func:`baton.list_files` lists it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.session import _hadoop_path, new_snapshot_path
from baton.storage import filesystem, open_input

#: Folders for each of the session's task slots from which on tasks walk whole subtrees.
SPREAD = 4
RANGE_BYTES, TASK_BYTES = 64 << 20, 256 << 20
_FOUND = "pending boolean, path string, step int, modified timestamp, size_bytes bigint, is_dir boolean"
_ARROW = pa.schema([("pending", pa.bool_()), ("path", pa.string()), ("step", pa.int32()), ("modified", pa.timestamp("us", "UTC")),
                    ("size_bytes", pa.int64()), ("is_dir", pa.bool_())])
# The characters that Hadoop globs give a meaning.
_PATTERN = re.compile(r"[\\{}\[\]*?]")


def glob_regex(pattern: str) -> str:
    """A regular expression for one segment of a Hadoop glob."""
    out, i, depth = [], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            if i == len(pattern):
                raise ValueError(f"a backslash ends the glob {pattern!r}")
            out.append(re.escape(pattern[i]))
        elif c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        elif c == "[":
            end = pattern.find("]", i + 2)
            if end < 0:
                raise ValueError(f"a class of characters does not end in the glob {pattern!r}")
            inner = pattern[i + 1:end]
            negated = inner[0] in "^!"
            out.append("[" + "^" * negated + inner[negated:].replace("\\", "\\\\").replace("[", "\\[").replace("^", "\\^") + "]")
            i = end
        else:
            out.append(re.escape(c))
        i += 1
    if depth:
        raise ValueError(f"braces do not close in the glob {pattern!r}")
    return "".join(out)


def split_glob(path: str) -> tuple[str, list[str]]:
    """The folder before the first segment with a pattern, and the segments from there on."""
    if re.search(r"\{[^}]*/", path):
        raise ValueError(f"braces over several levels are not supported: {path}")
    head, segments = path.rstrip("/") or "/", []
    while _PATTERN.search(head):
        head, _, last = head.rpartition("/")
        segments.insert(0, last)
    return head or "/", segments


def _prefix(uri: str) -> str:
    """What stands before a path of the tasks' file system in a qualified path."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return "file:"
    return f"{parts.scheme}://" + (parts.netloc if parts.scheme in ("hdfs", "webhdfs") else "")


class _Walk:
    """Expands folders by the segments of a glob, within a task."""

    def __init__(self, start: str, segments: list[str], recursive: bool):
        self.store, self.start = filesystem(start)
        self.prefix = _prefix(start)
        self.names = [re.compile(glob_regex(s), re.DOTALL) for s in segments]
        self.recursive = recursive

    def _row(self, info: fs.FileInfo, pending: bool, step: int) -> tuple:
        folder = info.type == fs.FileType.Directory
        path = info.path if pending else self.prefix + info.path
        micros = None if info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1000  # file systems agree on milliseconds
        return pending, path, step, micros, 0 if folder else info.size, folder

    def expand(self, path: str, step: int) -> Iterator[tuple]:
        """The entries of one folder: those that match, and those to go on with."""
        if step < 0:  # the start itself
            info = self.store.get_file_info(self.start.rstrip("/") or "/")
            if info.type == fs.FileType.NotFound:
                return
            if not self.names:
                yield self._row(info, False, 0)
            if info.type == fs.FileType.Directory and (self.names or self.recursive):
                yield self._row(info, True, 0)
            return
        try:
            found = self.store.get_file_info(fs.FileSelector(path, recursive=False))
        except FileNotFoundError:  # it went meanwhile
            return
        last = step >= len(self.names) - 1
        for info in found:
            if step < len(self.names) and not self.names[step].fullmatch(info.base_name):
                continue
            folder = info.type == fs.FileType.Directory
            if last:
                yield self._row(info, False, step)
            if folder and (not last or self.recursive):
                yield self._row(info, True, step + 1)


def walk_files(spark: SparkSession, glob: str, recursive: bool = False, strict: bool = False, temp_dir: str | None = None) -> DataFrame:
    """``(path, modified, size_bytes, is_dir)`` of every entry that ``glob`` matches, like
    :func:`baton.list_files`, hidden names and empty files included, but listed by tasks.

    ``recursive`` also gives all that lies below matched folders.  No match gives an empty frame,
    or ``FileNotFoundError`` when ``strict``.
    """
    p, hadoop = _hadoop_path(spark, glob)
    start, segments = split_glob(str(hadoop.makeQualified(p).toString()))
    for s in segments:
        glob_regex(s)  # an error in the glob is one here, too
    try:
        filesystem(start)
    except (OSError, ValueError) as e:
        raise ValueError(f"tasks cannot list {start}: {e}") from e
    root = new_snapshot_path(spark, temp_dir)
    slots = spark.sparkContext.defaultParallelism

    def lister(whole: bool):
        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walk, rows = _Walk(start, segments, recursive), []

            def batch() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(c, t if t != _ARROW.field("modified").type else pa.int64()).cast(t)
                                                  for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
                rows.clear()
                return out

            for b in batches:
                for path, step in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    todo = [(path, step)]
                    while todo:
                        for row in walk.expand(*todo.pop()):
                            if whole and row[0]:
                                todo.append((row[1], row[2]))
                            else:
                                rows.append(row)
                                if len(rows) >= 10_000:
                                    yield batch()
            if rows:
                yield batch()

        return expand

    todo, n, level, rounds = spark.createDataFrame([("", -1)], "path string, step int"), 1, 0, []
    while n:
        whole = n >= SPREAD * slots
        listed = todo.repartition(min(n, 64 * slots)).mapInArrow(lister(whole), _FOUND)
        listed.write.parquet(f"{root}/level={level}")
        rounds.append(spark.read.schema(_FOUND).parquet(f"{root}/level={level}"))
        todo = rounds[-1].where("pending").select("path", "step")
        n, level = todo.count(), level + 1
    found = spark.read.schema(_FOUND).parquet(*[f"{root}/level={i}" for i in range(level)]).where(~F.col("pending"))
    if strict and found.isEmpty():
        raise FileNotFoundError(f"nothing matches {glob}")
    return found.select("path", "modified", "size_bytes", "is_dir")


def read_ranges(spark: SparkSession, glob: str, range_bytes: int = RANGE_BYTES, recursive: bool = False, strict: bool = False,
                temp_dir: str | None = None) -> DataFrame:
    """``(path, offset, size_bytes, content)``: the bytes of each matched file in ranges of at most
    ``range_bytes``, whose order is that of ``offset``; ``size_bytes`` is the whole file's.

    Any file can be read, whatever its size and name; an empty one is one empty range.  A file that
    became shorter since it was listed fails the task.
    """
    if not 1 <= range_bytes < 1 << 31:
        raise ValueError(f"range_bytes must be positive and fit a row, got {range_bytes}")
    files = walk_files(spark, glob, recursive, temp_dir=temp_dir).where(~F.col("is_dir"))
    total, n = files.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)), F.count("*")).first()
    if strict and not n:
        raise FileNotFoundError(f"no file matches {glob}")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size_bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    ranges = files.select("path", "size_bytes", F.explode(starts).alias("offset"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, offset in zip(*(c.to_pylist() for c in batch.columns)):
                with open_input(path) as file:
                    content = file.read_at(min(range_bytes, size - offset), offset) if size else b""
                if len(content) != min(range_bytes, size - offset):
                    raise OSError(f"{path} is shorter than when it was listed")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([offset], pa.int64()), pa.array([size], pa.int64()),
                                                  pa.array([content], pa.binary())], names=["path", "offset", "size_bytes", "content"])

    return ranges.repartition(tasks).mapInArrow(read, "path string, offset bigint, size_bytes bigint, content binary")
