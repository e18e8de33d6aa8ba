"""Handover (T1-T3), snapshots (K1, S4) and their invariants."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from baton import (
    open_snapshot,
    open_text,
    rdd_to_frame,
    same_rows,
    save_text,
    snapshot,
    snapshot_all,
    snapshot_async,
    snapshot_rdd,
    write_snapshot,
)
from baton.plans import reads_only
from baton.sources import read_manifest
from tests.conftest import SF0001


def ints(spark):
    return spark.createDataFrame([(i,) for i in range(1, 11)], "value int")


def values(df):
    return sorted(r[0] for r in df.collect())


def local(path):
    return path.split(":", 1)[-1] if path.startswith("file:") else path


@pytest.mark.parametrize("codec", ["parquet", "json"])
def test_ints_handover(spark, tmp_dir, codec):
    out = snapshot(ints(spark), tmp_dir, codec)
    assert values(out) == list(range(1, 11))
    assert out.schema["value"].dataType.simpleString() == "int"


def test_ints_there_and_back(spark, tmp_dir):
    first = snapshot(ints(spark), tmp_dir)
    back = rdd_to_frame(first.rdd, first.schema, tmp_dir, spark=spark)
    assert values(back) == list(range(1, 11))


def test_ints_from_rdd(spark, tmp_dir):
    rdd = spark.sparkContext.parallelize([(i,) for i in range(1, 11)], 3)
    out = rdd_to_frame(rdd, "value int", tmp_dir, spark=spark)
    assert values(out) == list(range(1, 11))


def test_example_pipeline_doubles_and_saves_text(spark, tmp_dir):
    handed = snapshot(ints(spark), tmp_dir)
    target = os.path.join(tmp_dir, "out")
    save_text(handed.select((F.col("value") * 2).alias("v")), target)
    assert sorted(values(open_text(spark, target)), key=int) == [str(2 * i) for i in range(1, 11)]


def test_int_strings_saved_as_text_reopen(spark, tmp_dir):
    target = os.path.join(tmp_dir, "strings")
    save_text(ints(spark).select(F.col("value").cast("string")), target)
    assert sorted(values(open_text(spark, target))) == sorted(str(i) for i in range(1, 11))


def test_save_text_rejects_null_and_newline(spark, tmp_dir):
    for i, bad in enumerate([None, "a\nb", "a\rb"]):
        df = spark.createDataFrame([("ok",), (bad,)], "value string")
        with pytest.raises(Exception):
            save_text(df, os.path.join(tmp_dir, f"bad{i}"))


def test_result_reads_only_the_snapshot(spark, tmp_dir):
    src = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    path = write_snapshot(src.select("l_orderkey", "l_quantity"), tmp_dir)
    out = open_snapshot(spark, path)
    assert reads_only(out, path)
    assert out.count() == src.count()


def test_source_change_does_not_reach_result(spark, tmp_dir):
    src_path = os.path.join(tmp_dir, "src")
    ints(spark).write.parquet(src_path)
    handed = snapshot(spark.read.parquet(src_path), tmp_dir)
    spark.createDataFrame([(99,)], "value int").write.mode("overwrite").parquet(src_path)
    assert values(handed) == list(range(1, 11))


def test_each_call_gets_its_own_path_with_success_and_manifest(spark, tmp_dir):
    a = write_snapshot(ints(spark), tmp_dir)
    b = write_snapshot(ints(spark), tmp_dir, codec="json")
    assert a != b
    for p in (a, b):
        assert os.path.exists(os.path.join(local(p), "_SUCCESS"))
    assert read_manifest(spark, b)["codec"] == "json"
    assert values(open_snapshot(spark, b)) == list(range(1, 11))


def test_snapshot_freezes_nondeterministic_input(spark, tmp_dir):
    import random
    # rand()/uuid() are seeded once per plan and replay; this does not
    fresh = F.udf(lambda: random.random(), "double").asNondeterministic()
    src = spark.range(200).select("id", fresh().alias("r"))
    handed = snapshot(src, tmp_dir)
    first, second = sorted(handed.collect()), sorted(handed.collect())
    assert first == second  # two reads of the snapshot agree
    assert not same_rows(src, handed)  # re-running the source would not


def test_json_text_snapshot_has_one_base64_line_per_row(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    path = write_snapshot(docs, tmp_dir, codec="json")
    lines = spark.read.text(path)
    assert lines.count() == docs.count()
    assert lines.where(~F.col("value").rlike(r"^[A-Za-z0-9+/]+=*$")).count() == 0
    assert same_rows(open_snapshot(spark, path), docs)


def test_open_refuses_uncommitted_folder(spark, tmp_dir):
    path = os.path.join(tmp_dir, "partial")
    ints(spark).write.parquet(path)
    os.remove(os.path.join(path, "_SUCCESS"))
    with pytest.raises(FileNotFoundError):
        open_snapshot(spark, path)


def test_open_foreign_committed_folder(spark, tmp_dir):
    path = os.path.join(tmp_dir, "foreign")
    ints(spark).write.parquet(path)
    assert values(open_snapshot(spark, path)) == list(range(1, 11))


def test_partitions_and_records_per_file(spark, tmp_dir):
    df = spark.range(1000).select(F.col("id").cast("int").alias("value"))
    p1 = write_snapshot(df, tmp_dir, partitions=4)
    files = [f for f in os.listdir(local(p1)) if f.startswith("part-")]
    assert len(files) == 4
    p2 = write_snapshot(df.coalesce(1), tmp_dir, max_records_per_file=300)
    files = [f for f in os.listdir(local(p2)) if f.startswith("part-")]
    assert len(files) == 4
    assert open_snapshot(spark, p2).count() == 1000


def test_async_snapshots_run_and_fail_like_sync(spark, tmp_dir):
    futures = [snapshot_async(ints(spark).select((F.col("value") + k).alias("value")), tmp_dir)
               for k in range(3)]
    got = [values(f.result(timeout=300)) for f in futures]
    assert got == [list(range(1 + k, 11 + k)) for k in range(3)]
    bad = ints(spark).select(F.when(F.col("value") == 5, F.raise_error(F.lit("boom")))
                             .otherwise(F.col("value")).alias("value"))
    fut = snapshot_async(bad, tmp_dir)
    with pytest.raises(Exception):
        fut.result(timeout=300)


def test_snapshot_all(spark, tmp_dir):
    a, b = snapshot_all([ints(spark), ints(spark).select((F.col("value") * 10).alias("value"))],
                        tmp_dir, codec="json")
    assert values(a) == list(range(1, 11))
    assert values(b) == [10 * i for i in range(1, 11)]


def test_pickle_codec_objects(spark, tmp_dir):
    objs = [(1, "a"), {"k": [1, 2]}, None, b"\x00\xff", "line\nbreak"]
    back = snapshot_rdd(spark.sparkContext.parallelize(objs, 2), tmp_dir, spark=spark)
    got = back.collect()
    assert len(got) == len(objs)
    for o in objs:
        assert o in got


def test_empty_frame(spark, tmp_dir):
    empty = spark.createDataFrame([], "a int, b string")
    pq = snapshot(empty, tmp_dir)
    assert pq.count() == 0 and pq.schema.simpleString() == "struct<a:int,b:string>"
    path = write_snapshot(empty, tmp_dir, codec="json")
    assert spark.read.text(path).count() == 0
    assert open_snapshot(spark, path).schema.simpleString() == "struct<a:int,b:string>"


def test_duplicates_kept(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    for codec in ("parquet", "json"):
        assert values(snapshot(df, tmp_dir, codec)) == [1, 1, 2]


def test_text_snapshot_with_compression(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    path = write_snapshot(docs, tmp_dir, codec="json", compression="gzip", max_records_per_file=50)
    assert any(f.endswith(".gz") for f in os.listdir(local(path)))
    assert same_rows(open_snapshot(spark, path), docs)


def test_snapshot_survives_task_retries(tmp_dir):
    import subprocess
    import sys
    script = os.path.join(os.path.dirname(__file__), "scripts", "retry_snapshot.py")
    out = subprocess.run([sys.executable, script, tmp_dir], capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" in out.stdout, out.stderr[-3000:]


def _slow(batches):
    import time as _t
    _t.sleep(3)
    yield from batches


def test_async_snapshots_overlap(spark, tmp_dir):
    import time
    frames = [spark.range(0, 10, numPartitions=1).mapInPandas(_slow, "id long") for _ in range(2)]
    snapshot(frames[0], tmp_dir)  # warm the path once
    t0 = time.time()
    a, b = snapshot_all(frames, tmp_dir)
    elapsed = time.time() - t0
    assert a.count() == 10 and b.count() == 10
    assert elapsed < 5.5, f"writes did not overlap: {elapsed:.1f}s for two 3s jobs"


def test_open_refuses_a_contradicting_codec(spark, tmp_dir):
    path = write_snapshot(ints(spark), tmp_dir, codec="json")
    with pytest.raises(ValueError):
        open_snapshot(spark, path, codec="parquet")
    assert values(open_snapshot(spark, path, codec="json")) == list(range(1, 11))


def test_async_in_a_scheduler_pool(spark, tmp_dir):
    a, b = snapshot_all([ints(spark), ints(spark)], tmp_dir, pool="handover")
    assert values(a) == values(b) == list(range(1, 11))
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_special_column_names(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2.0)], "`a b` int, `x,y;z` string, `k=v` double")
    for codec in ("parquet", "json"):
        out = snapshot(df, tmp_dir, codec)
        assert out.columns == ["a b", "x,y;z", "k=v"]
        assert same_rows(df, out)


def test_release_snapshot_only_deletes_snapshots(spark, tmp_dir):
    from baton import release_snapshot
    path = write_snapshot(ints(spark), tmp_dir)
    release_snapshot(spark, path)
    assert not os.path.exists(local(path))
    other = os.path.join(tmp_dir, "keep")
    ints(spark).write.parquet(other)
    with pytest.raises(ValueError):
        release_snapshot(spark, other)
    assert os.path.exists(other)


def test_rdd_schema_comes_from_all_rows(spark, tmp_dir):
    sc = spark.sparkContext
    got = rdd_to_frame(sc.parallelize([{"a": 1}, {"a": 2, "b": 3}], 2), temp_dir=tmp_dir)
    assert sorted((r.a, r.b) for r in got.collect()) == [(1, None), (2, 3)] or {r.b for r in got.collect()} == {None, 3}
    assert got.columns == ["a", "b"]
    from pyspark.sql import Row
    for rows in ([(1,), (2.5,)], [Row(v=1), Row(v=2.5), Row(v="x")], [([1],), (["x"],)], [({"k": 1},), ({"k": "v"},)]):
        with pytest.raises(Exception, match="different types"):
            rdd_to_frame(sc.parallelize(rows, len(rows)), temp_dir=tmp_dir)
    with pytest.raises(ValueError, match="empty"):
        rdd_to_frame(sc.parallelize([], 2), temp_dir=tmp_dir)
    with pytest.raises(TypeError, match="no value"):
        rdd_to_frame(sc.parallelize([(1, None)]), temp_dir=tmp_dir)
    nested = rdd_to_frame(sc.parallelize([Row(x=Row(y=1, z=[1.5]), m={"a": 1}), Row(x=Row(y=2, z=[]), m={})], 2), temp_dir=tmp_dir)
    assert nested.schema.simpleString() == "struct<x:struct<y:bigint,z:array<double>>,m:map<string,bigint>>"


def test_rdd_rows_may_not_have_fields_the_schema_lacks(spark, tmp_dir):
    sc = spark.sparkContext
    got = rdd_to_frame(sc.parallelize([{"a": 1}, {"b": "x"}]), "a int, b string", tmp_dir)
    assert sorted(tuple(r) for r in got.collect() if r.a) == [(1, None)]
    with pytest.raises(Exception, match="not in the schema"):
        rdd_to_frame(sc.parallelize([{"a": 1, "z": 2}]), "a int", tmp_dir)
    with pytest.raises(Exception, match="2 fields"):
        rdd_to_frame(sc.parallelize([(1, 2)]), "a int", tmp_dir)


def test_rdd_snapshot_reopens_by_path_and_can_be_released(spark, tmp_dir):
    from baton import open_rdd_snapshot, open_snapshot, release_snapshot, snapshot_path
    objs = [{"k": 1}, ("a", None), 3.5]
    path = snapshot_path(snapshot_rdd(spark.sparkContext.parallelize(objs, 2), tmp_dir, spark))
    assert sorted(map(repr, open_rdd_snapshot(spark.newSession(), path).collect())) == sorted(map(repr, objs))
    with pytest.raises(ValueError):
        open_snapshot(spark, path)
    release_snapshot(spark, path)
    assert not os.path.exists(local(path))
    with pytest.raises(ValueError):
        open_rdd_snapshot(spark, path)


def test_snapshot_path_and_failed_writes(spark, tmp_dir):
    from baton import release_snapshot, snapshot_path
    out = snapshot(ints(spark), tmp_dir)
    assert open_snapshot(spark, snapshot_path(out)).count() == 10
    with pytest.raises(ValueError):
        snapshot_path(out.where("true"))
    release_snapshot(spark, snapshot_path(out))
    assert os.listdir(tmp_dir) == []
    with pytest.raises(Exception):
        snapshot(spark.range(2).selectExpr("raise_error('no') AS v"), tmp_dir)
    with pytest.raises(Exception):
        snapshot_rdd(spark.sparkContext.parallelize([1]).map(lambda x: x / 0), tmp_dir, spark)
    assert os.listdir(tmp_dir) == []  # nothing is left of them


def test_requested_schema_picks_by_name(spark, tmp_dir):
    df = spark.createDataFrame([(1, 10), (2, None)], "a int, b int")
    for codec in ("json", "parquet"):
        path = write_snapshot(df, tmp_dir, codec=codec)
        assert sorted(tuple(r) for r in open_snapshot(spark, path, "b int, a int").collect() if r.b) == [(10, 1)]
        assert {r.b for r in open_snapshot(spark, path, "b bigint").collect()} == {10, None}
        with pytest.raises(ValueError, match="zz"):
            open_snapshot(spark, path, "zz int, a int")


def test_one_column_of_a_text_snapshot_is_decoded_alone(spark, tmp_dir):
    from baton.plans import plan_text
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    path = write_snapshot(li, tmp_dir, codec="json")
    one = open_snapshot(spark, path, "l_orderkey bigint")
    text = plan_text(one, "simple")
    assert text.count("from_json(") == 1 and "StructType(StructField(0,LongType,true))" in text
    assert one.groupBy().sum().first() == li.select("l_orderkey").groupBy().sum().first()


def test_snapshots_of_the_last_format_still_open(spark, tmp_dir):
    import json

    from baton.functions import JSON_OPTIONS
    from baton.functions.codec import base64_line
    path = os.path.join(tmp_dir, "old")
    row = F.to_json(F.struct(F.lit(None).cast("int").alias("0"), F.lit("x").alias("1")), JSON_OPTIONS)  # without the NULL field
    spark.range(1).select(base64_line(F.encode(row, "UTF-8")).alias("value")).write.text(path)
    schema = spark.createDataFrame([], "a int, b string").schema
    with open(f"{path}/_manifest.json", "w") as fh:
        json.dump({"version": 2, "codec": "json", "keys": "position", "schema": json.loads(schema.json())}, fh)
    assert open_snapshot(spark, path).collect() == [(None, "x")]
