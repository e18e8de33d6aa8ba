"""Lineage-cutting handover: materialise, then re-open the stored rows.

The write is eager (a Spark job), the read back is lazy.  Every call writes
to its own new path, so nothing is overwritten or shared between calls, and
the returned frame neither recomputes its source nor follows later changes
to it.  Executor loss during the write only re-runs the lost tasks; after
the write, the frame depends on storage alone.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, CancelledError, Future, ThreadPoolExecutor, wait

from pyspark import RDD, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from baton.functions.objects import pickle_line, same_fields, unpickle_line
from baton.functions.records import STAGED, decoder, encode_records, merged_fields, spark_type
from baton.operators.rowcodec import _as_struct
from baton.session import delete_path, new_snapshot_path
from baton.sinks.snapshot import PARQUET, PICKLE, write_manifest, write_snapshot
from baton.sources.snapshot import read_manifest, read_snapshot

DEFAULT_ASYNC_WORKERS = 4
_pool: ThreadPoolExecutor | None = None
_pool_lock = threading.Lock()


def snapshot(df: DataFrame, temp_dir: str | None = None, codec: str = PARQUET,
             partitions: int | None = None, max_records_per_file: int | None = None,
             compression: str | None = None, **layout) -> DataFrame:
    """Write ``df`` as a snapshot and return a frame over the stored rows; ``layout`` as for
    :func:`write_snapshot`."""
    path = write_snapshot(df, temp_dir, codec, partitions, max_records_per_file, compression, **layout)
    out = read_snapshot(df.sparkSession, path, df.schema, codec)
    out._baton_path = path
    return out


def snapshot_path(handed: DataFrame | RDD) -> str:
    """Where the rows of a frame or RDD that a handover returned are stored, for
    :func:`baton.open_snapshot` elsewhere or :func:`baton.release_snapshot`."""
    path = getattr(handed, "_baton_path", None)
    if path is None:
        raise ValueError("not the result of a handover (a frame derived from one has no folder of its own)")
    return path


def _default_pool() -> ThreadPoolExecutor:
    global _pool
    with _pool_lock:
        if _pool is None:
            _pool = ThreadPoolExecutor(max_workers=DEFAULT_ASYNC_WORKERS,
                                       thread_name_prefix="baton-snapshot")
        return _pool


class SnapshotFuture(Future):
    """The result of :func:`snapshot_async`; :meth:`cancel` also ends a write that runs."""

    def __init__(self, spark: SparkSession):
        super().__init__()
        self._spark, self._asked = spark, threading.Event()
        self._tag = f"baton-snapshot-{uuid.uuid4().hex}"

    def cancel(self, timeout: float = 60.0) -> bool:
        """Cancel the write, running or not: its jobs end and its folder is removed before this
        returns True.  False if it is done already, or does not end within ``timeout`` seconds."""
        if super().cancel():
            return True
        self._asked.set()
        until = time.monotonic() + timeout
        while not self.done() and time.monotonic() < until:
            self._spark.sparkContext.cancelJobsWithTag(self._tag)  # again: a write may be between its jobs
            wait([self], 0.1)
        return self.cancelled()

    def cancelled(self) -> bool:
        return super().cancelled() or (self.done() and isinstance(super().exception(), CancelledError))

    def _run(self, write: Callable[[], DataFrame]) -> None:
        if not self.set_running_or_notify_cancel():
            return
        context = self._spark.sparkContext
        context.addJobTag(self._tag)
        context.setInterruptOnCancel(True)
        try:
            out = write()
            if self._asked.is_set():  # asked for between the last job and here
                delete_path(self._spark, out._baton_path)
                raise CancelledError
            self.set_result(out)
        except BaseException as e:
            if self._asked.is_set() and not isinstance(e, CancelledError):
                self._wait_for_tasks()
                e = CancelledError(f"cancelled: {e}")
            self.set_exception(e)
        finally:
            context.removeJobTag(self._tag)
            context.setInterruptOnCancel(False)

    def _wait_for_tasks(self, timeout: float = 30.0) -> None:
        """Until no task of the cancelled jobs runs: one that does could still write."""
        tracker, until = self._spark.sparkContext.statusTracker(), time.monotonic() + timeout
        while time.monotonic() < until:
            jobs = [tracker.getJobInfo(j) for j in self._jobs()]
            stages = [tracker.getStageInfo(s) for j in jobs if j is not None for s in j.stageIds]
            if not any(s is not None and s.numActiveTasks for s in stages):
                return
            time.sleep(0.05)

    def _jobs(self) -> list[int]:
        return list(self._spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(self._tag))


def snapshot_async(df: DataFrame, temp_dir: str | None = None, codec: str = PARQUET,
                   executor: ThreadPoolExecutor | None = None, pool: str | None = None,
                   **kwargs) -> SnapshotFuture:
    """:func:`snapshot` from a driver thread; returns a ``Future[DataFrame]``.

    Several calls run their write jobs concurrently on the same cluster;
    the thread inherits the caller's job group and scheduler pool, or runs
    in the scheduler ``pool`` given (with ``spark.scheduler.mode=FAIR``,
    concurrent writes then share executors evenly).  A failed write
    surfaces as the future's exception.  Cancelling the future ends its jobs,
    which carry a tag of their own, and removes what was written; other
    writes are not touched.
    """
    future = SnapshotFuture(df.sparkSession)

    def run():
        def write():
            if pool is not None:
                df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            return snapshot(df, temp_dir, codec, **kwargs)

        future._run(write)

    (executor or _default_pool()).submit(inheritable_thread_target(df.sparkSession)(run))
    return future


def snapshot_all(frames, temp_dir: str | None = None, codec: str = PARQUET,
                 executor: ThreadPoolExecutor | None = None, pool: str | None = None,
                 cancel_rest: bool = False, **kwargs) -> list[DataFrame]:
    """Snapshot several frames at once; waits for all, raises the first failure.  With
    ``cancel_rest`` a failure cancels the writes that are not done yet."""
    futures = [snapshot_async(df, temp_dir, codec, executor, pool, **kwargs) for df in frames]
    if cancel_rest:
        done, rest = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in done if f.exception() is not None), None)
        if failed is not None:
            for f in rest:
                f.cancel()
            raise failed.exception()
    errors = [f.exception() for f in futures]
    for err in errors:
        if err is not None:
            raise err
    return [f.result() for f in futures]


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def rdd_to_frame(rdd: RDD, schema: T.StructType | str | None = None, temp_dir: str | None = None,
                 codec: str = PARQUET, spark: SparkSession | None = None) -> DataFrame:
    """Hand an RDD of rows, tuples or dicts over as a snapshotted frame of ``schema``.

    The write blocks; the read back is lazy.  Without ``schema`` it is inferred
    from *all* rows: every key of any dict is a column (NULL where a row has
    none), and values of different types in one column are an error.  The RDD
    is read once for that: its tasks write their records as Arrow batches with
    the types these need, and the staged batches are decoded once the types of
    all of them are merged.  With ``schema``, a row with a field that the schema
    lacks is an error.
    """
    session = _session(spark)
    if schema is None:
        return _records_to_frame(rdd, temp_dir, codec, session)
    st = _as_struct(schema)
    checked = rdd.map(same_fields(st.names))
    return snapshot(session.createDataFrame(checked, st), temp_dir, codec)


def _records_to_frame(rdd: RDD, temp_dir: str | None, codec: str, session: SparkSession) -> DataFrame:
    stage = new_snapshot_path(session, temp_dir)
    try:
        session.createDataFrame(rdd.mapPartitionsWithIndex(encode_records), STAGED, verifySchema=False).write.parquet(stage)
        staged = session.read.schema(STAGED).parquet(stage)
        fields = merged_fields(staged)
        schema = T.StructType([T.StructField(n, spark_type(k)) for n, k in fields.items()])
        return snapshot(staged.select("n", "batch").mapInArrow(decoder(fields), schema), temp_dir, codec)
    finally:
        delete_path(session, stage)


def snapshot_rdd(rdd: RDD, temp_dir: str | None = None, spark: SparkSession | None = None) -> RDD:
    """Hand over an RDD of arbitrary Python objects with the ``pickle`` codec.

    One base64 line per element; the returned RDD reads those lines back, as
    :func:`open_rdd_snapshot` does in any other session.
    """
    session = _session(spark)
    path = new_snapshot_path(session, temp_dir)
    try:
        rdd.map(pickle_line).saveAsTextFile(path)
        write_manifest(session, path, PICKLE, None)
    except BaseException:
        delete_path(session, path)
        raise
    return open_rdd_snapshot(session, path)


def open_rdd_snapshot(spark: SparkSession, path: str) -> RDD:
    """The objects that :func:`snapshot_rdd` stored under ``path``.

    Only folders with such a manifest are opened: loading a pickle runs code.
    """
    manifest = read_manifest(spark, path)
    if manifest is None or manifest["codec"] != PICKLE:
        raise ValueError(f"{path} is not a snapshot of objects")
    out = spark.sparkContext.textFile(path).map(unpickle_line)
    out._baton_path = path
    return out
