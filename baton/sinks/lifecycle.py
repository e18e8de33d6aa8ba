"""Leases on snapshots, and the sweep that removes those which nobody holds.

A reader that needs a snapshot for longer than the sweep's age takes a lease: a small file with
its expiry in its name, in the snapshot's folder.  A running job can hold all snapshots that its
application makes, those of the operators included, with one lease at the root.  The sweep
removes snapshots that are old enough and under no lease that still runs.

A lease and a removal that meet are told apart without locks: the reader first writes its lease
and then looks for the mark of a sweep; the sweep first writes its mark and then looks for
leases.  So at least one of them sees the other: the reader then gives up with
``FileNotFoundError``, the sweep leaves the snapshot alone.  A marked snapshot is renamed before
it is deleted, so that it is never half there under its own name (on stores that rename at once).
A sweep that died leaves marks, which the next one treats as its own.

All of this is metadata: a few file-system calls on the driver for each snapshot, no data.
Times are the driver's clock and the file system's; ``older_than`` should exceed their difference.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from baton.session import (
    SNAPSHOT_PREFIX,
    application_tag,
    checkpoint_root,
    delete_path,
    list_folder,
    path_exists,
    rename_path,
    write_small_file,
)
from baton.sinks.snapshot import MANIFEST

LEASES, EXPIRING = "_leases", "_expiring"
#: Ages in seconds: of snapshots, and of folders whose writer has not finished.
OLDER_THAN, UNFINISHED = 24 * 3600.0, 7 * 24 * 3600.0


def _committed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{MANIFEST}") or path_exists(spark, f"{path}/_SUCCESS")


class Lease:
    """One reader's hold on a snapshot, or on all of an application's; also a context manager."""

    def __init__(self, spark: SparkSession, folder: str, seconds: float, snapshot: str | None = None):
        self._spark, self._folder, self._snapshot, self._id = spark, folder, snapshot, uuid.uuid4().hex
        self._file: str | None = None
        self.renew(seconds)

    def renew(self, seconds: float) -> None:
        """Hold for so many seconds from now on; ``FileNotFoundError`` if a sweep came first."""
        file = f"{self._folder}/{self._id}.{int((time.time() + seconds) * 1000)}"
        if file != self._file:
            try:
                write_small_file(self._spark, file, "")
            except Exception as e:
                if self._snapshot and not _committed(self._spark, self._snapshot):  # the folder went meanwhile
                    raise FileNotFoundError(f"the snapshot at {self._snapshot} is being removed") from e
                raise
            before, self._file = self._file, file
            if before:
                delete_path(self._spark, before)
        path = self._snapshot
        if path and (path_exists(self._spark, f"{path}/{EXPIRING}") or not _committed(self._spark, path)):
            self.release()
            if all(e.name == LEASES for e in list_folder(self._spark, path)) and not list_folder(self._spark, self._folder):
                delete_path(self._spark, path)  # it was removed, and is only this lease's folder now
            raise FileNotFoundError(f"the snapshot at {path} is being removed")

    def release(self) -> None:
        if self._file:
            delete_path(self._spark, self._file)
            self._file = None

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def _held(spark: SparkSession, folder: str) -> bool:
    """Whether a lease in the folder has not run out."""
    now = time.time() * 1000
    return any(e.name.rsplit(".", 1)[-1].isdigit() and int(e.name.rsplit(".", 1)[-1]) > now for e in list_folder(spark, folder))


def lease_snapshot(spark: SparkSession, path: str, seconds: float = 3600.0) -> Lease:
    """Hold the snapshot at ``path``: no sweep removes it before the lease is released or runs out.

    ``FileNotFoundError`` if there is none, or if a sweep is removing it.
    """
    path = path.rstrip("/")
    if not _committed(spark, path):
        raise FileNotFoundError(f"no committed snapshot at {path}")
    return Lease(spark, f"{path}/{LEASES}", seconds, path)


def hold_application(spark: SparkSession, temp_dir: str | None = None, seconds: float = 24 * 3600.0) -> Lease:
    """Hold all snapshots under ``temp_dir`` (default: the session's checkpoint folder) that this
    application made or will make."""
    root = (temp_dir or checkpoint_root(spark)).rstrip("/")
    return Lease(spark, f"{root}/{LEASES}/{application_tag(spark)}", seconds)


def sweep_snapshots(spark: SparkSession, temp_dir: str | None = None, older_than: float = OLDER_THAN,
                    unfinished_after: float = UNFINISHED, dry_run: bool = False) -> DataFrame:
    """Remove the snapshots under ``temp_dir`` (default: the session's checkpoint folder) that were
    written more than ``older_than`` seconds ago and that no lease holds.

    All folders of the library's making are swept, also the tables between the steps of its
    operators; nothing else is touched.  A folder without ``_SUCCESS`` or manifest, whose writer
    may still be at work, must be ``unfinished_after`` seconds old.  Returns
    ``(path, age_seconds, outcome)``: ``removed`` (or ``would be removed``), ``held``, ``young``.
    """
    root = (temp_dir or checkpoint_root(spark)).rstrip("/")
    out = []
    for entry in list_folder(spark, root):
        if not entry.folder or not entry.name.startswith((SNAPSHOT_PREFIX, "_expired-" + SNAPSHOT_PREFIX)):
            continue
        path = f"{root}/{entry.name}"
        if entry.name.startswith("_expired-"):  # of a sweep that died
            if not dry_run:
                delete_path(spark, path)
            continue
        inside = list_folder(spark, path)
        # a lease changes the folder, but not what was written into it
        age = time.time() - max([e.modified for e in inside if e.name not in (LEASES, EXPIRING)], default=entry.modified) / 1000
        finished = any(e.name in (MANIFEST, "_SUCCESS") for e in inside)
        tag = entry.name.removeprefix(SNAPSHOT_PREFIX).split("-")[0]

        def held() -> bool:
            return _held(spark, f"{path}/{LEASES}") or _held(spark, f"{root}/{LEASES}/{tag}")

        if age < (older_than if finished else max(older_than, unfinished_after)):
            outcome = "young"
        elif held():
            outcome = "held"
        elif dry_run:
            outcome = "would be removed"
        else:
            outcome = _remove(spark, root, entry.name, held)
        out.append((path, float(age), outcome))
    return spark.createDataFrame(out, "path string, age_seconds double, outcome string")


def _remove(spark: SparkSession, root: str, name: str, held) -> str:
    mark = f"{root}/{name}/{EXPIRING}"
    try:
        write_small_file(spark, mark, "")
    except Exception:
        if not path_exists(spark, mark):  # else it is another sweep's, maybe of one that died
            if _committed(spark, f"{root}/{name}"):
                raise
            return "removed"  # by another sweep, just now
    if held():
        delete_path(spark, mark)
        return "held"
    gone = f"{root}/_expired-{name}"
    try:
        rename_path(spark, f"{root}/{name}", gone)
    except FileNotFoundError:
        if path_exists(spark, f"{root}/{name}"):
            raise
    delete_path(spark, gone)
    return "removed"
