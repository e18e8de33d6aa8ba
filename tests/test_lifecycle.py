"""Leases, the expiry sweep, and cancelled writes."""

from __future__ import annotations

import os
import threading
import time
from concurrent.futures import CancelledError, ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from baton import (
    hold_application,
    lease_snapshot,
    open_snapshot,
    snapshot,
    snapshot_all,
    snapshot_async,
    snapshot_path,
    sweep_snapshots,
    write_snapshot,
)
from baton.session import new_snapshot_path


def local(path):
    return path.removeprefix("file:")


def outcomes(df):
    return {r.path: r.outcome for r in df.collect()}


def test_sweep_removes_what_nobody_holds(spark, tmp_dir):
    a, b = (write_snapshot(spark.range(n), tmp_dir) for n in (10, 20))
    other = os.path.join(tmp_dir, "keep")
    spark.range(3).write.parquet(other)
    table = new_snapshot_path(spark, tmp_dir)  # as operators store tables between their steps
    spark.range(4).write.parquet(table)
    lease = lease_snapshot(spark, b, 600)
    assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=3600)) == {a: "young", b: "young", table: "young"}
    assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0, dry_run=True)) == {a: "would be removed", b: "held", table: "would be removed"}
    assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)) == {a: "removed", b: "held", table: "removed"}
    assert open_snapshot(spark, b).count() == 20 and sorted(os.listdir(tmp_dir)) == sorted(["keep", os.path.basename(b)])
    with pytest.raises(FileNotFoundError):
        lease_snapshot(spark, a)
    lease.release()
    assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)) == {b: "removed"} and os.listdir(tmp_dir) == ["keep"]
    with pytest.raises(FileNotFoundError):
        lease.renew(60)
    assert os.listdir(tmp_dir) == ["keep"]  # a late lease leaves no folder
    assert sweep_snapshots(spark, tmp_dir + "/none").count() == 0


def test_leases_run_out_and_are_renewed(spark, tmp_dir):
    path = write_snapshot(spark.range(5), tmp_dir)
    with lease_snapshot(spark, path, 0.5) as lease:
        lease.renew(600)
        time.sleep(0.6)
        assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)) == {path: "held"}
        lease.renew(0.2)
        time.sleep(0.4)
        assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)) == {path: "removed"}


def test_an_application_holds_all_it_makes(spark, tmp_dir):
    before = write_snapshot(spark.range(5), tmp_dir)
    with hold_application(spark, tmp_dir, 600):
        after = write_snapshot(spark.newSession().range(5), tmp_dir)
        foreign = f"{tmp_dir}/snapshot-0123456789ab-{'0' * 32}"
        spark.range(3).write.parquet(foreign)
        assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)) == {before: "held", after: "held", foreign: "removed"}
    assert set(outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)).values()) == {"removed"}


def test_unfinished_writes_and_dead_sweeps(spark, tmp_dir):
    writing = new_snapshot_path(spark, tmp_dir)
    os.makedirs(f"{writing}/_temporary/0")
    marked = write_snapshot(spark.range(5), tmp_dir)  # a sweep died between its mark and the removal
    open(f"{local(marked)}/_expiring", "w").close()
    half = f"{tmp_dir}/_expired-snapshot-x"  # or within the removal
    os.makedirs(half)
    with pytest.raises(FileNotFoundError, match="being removed"):
        lease_snapshot(spark, marked)
    with pytest.raises(FileNotFoundError):
        lease_snapshot(spark, writing)
    assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0)) == {writing: "young", marked: "removed"}
    assert os.listdir(tmp_dir) == [os.path.basename(writing)]
    assert outcomes(sweep_snapshots(spark, tmp_dir, older_than=0, unfinished_after=0)) == {writing: "removed"}


def test_readers_and_sweeps_at_once(spark, tmp_dir):
    paths = [write_snapshot(spark.range(1000), tmp_dir) for _ in range(12)]
    refused, read, wrong = [], [], []
    stop = threading.Event()

    def sweep():
        try:
            while not stop.is_set():
                sweep_snapshots(spark, tmp_dir, older_than=0)
        except Exception as e:
            wrong.append(repr(e)[:300])

    def reader(path):
        try:
            with lease_snapshot(spark, path, 600):
                df = open_snapshot(spark, path)
                for _ in range(2):
                    if df.agg(F.sum("id")).first()[0] != 499_500:
                        wrong.append(path)
                read.append(path)
        except FileNotFoundError:
            refused.append(path)
        except Exception as e:  # a leased snapshot must stay whole
            wrong.append(repr(e)[:300])

    leased = lease_snapshot(spark, paths[0], 600)
    sweepers = [threading.Thread(target=sweep) for _ in range(2)]
    with ThreadPoolExecutor(6) as pool:
        list(map(lambda t: t.start(), sweepers))
        list(pool.map(reader, paths))
    stop.set()
    for t in sweepers:
        t.join()
    assert wrong == [] and len(read) + len(refused) == 12 and paths[0] in read
    leased.release()
    sweep_snapshots(spark, tmp_dir, older_than=0)
    assert os.listdir(tmp_dir) == []


# --- cancelled writes -----------------------------------------------------------------

def slow(spark, n=8, seconds=20):
    def wait(batches):
        for b in batches:
            for _ in range(seconds * 10):
                time.sleep(0.1)
            yield b

    return spark.range(n).repartition(n).mapInArrow(wait, "id bigint")


def test_a_cancelled_write_leaves_nothing_and_others_finish(spark, tmp_dir):
    doomed = snapshot_async(slow(spark, 3), tmp_dir + "/a")
    other = snapshot_async(spark.range(100).repartition(2), tmp_dir + "/b")
    while not (os.path.exists(tmp_dir + "/a") and os.listdir(tmp_dir + "/a")):
        time.sleep(0.05)
    began = time.monotonic()
    assert doomed.cancel() and time.monotonic() - began < 15
    assert doomed.cancelled() and doomed.done() and os.listdir(tmp_dir + "/a") == []
    with pytest.raises(CancelledError):
        doomed.result()
    assert other.result().count() == 100 and not other.cancelled() and not other.cancel()
    time.sleep(1)
    assert os.listdir(tmp_dir + "/a") == []  # no late task wrote again
    assert snapshot(spark.range(5), tmp_dir + "/a").count() == 5  # and the session goes on


def test_cancel_before_the_start_and_after_the_end(spark, tmp_dir):
    with ThreadPoolExecutor(1) as pool:
        first = snapshot_async(spark.range(20).repartition(1), tmp_dir, executor=pool)
        queued = snapshot_async(spark.range(20), tmp_dir, executor=pool)
        assert queued.cancel() or queued.done()
        assert first.result().count() == 20
        assert not first.cancel() and not first.cancelled() and first.result().count() == 20
    kept = {os.path.basename(local(snapshot_path(f.result()))) for f in (first, queued) if not f.cancelled()}
    assert set(os.listdir(tmp_dir)) == kept


def test_a_failure_cancels_the_rest(spark, tmp_dir):
    bad = spark.range(2).select(F.raise_error(F.lit("no")).alias("v"))
    began = time.monotonic()
    with pytest.raises(Exception, match="no"):
        snapshot_all([slow(spark, 2), bad, slow(spark, 2)], tmp_dir, cancel_rest=True)
    assert time.monotonic() - began < 18 and os.listdir(tmp_dir) == []
