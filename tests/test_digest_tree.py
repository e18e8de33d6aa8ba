"""Snapshots in buckets with digest trees, and the comparison that reads only unequal ones."""

from __future__ import annotations

import json
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from baton import frame_diff, open_snapshot, release_snapshot, snapshot, snapshot_diff, write_snapshot
from baton.operators import digest_tree
from baton.sources import read_manifest

SCHEMA = "k int, s string, x double, a array<array<int>>, m map<string,int>, `a b` struct<`c-d`: int, e: string>, day date"


def rows(n, seed=1):
    rng = random.Random(seed)

    def one(i):
        maybe = lambda v: None if rng.random() < 0.2 else v
        return (maybe(i % 37), maybe(rng.choice(["x", "", "é"])), maybe(rng.choice([0.0, -0.0, float("nan"), 1.5])),
                maybe([maybe([i % 3, None][:rng.randint(0, 2)]) for _ in range(rng.randint(0, 2))]), maybe({"p": i % 2, "q": None}),
                maybe((maybe(i % 5), maybe("v"))), None)

    return [one(i) for i in range(n)]


def seen(df):
    return Counter(repr(r) for r in df.collect())


@pytest.mark.parametrize("by", [[], ["k"], ["k % 5", "upper(s)"], ["`a b`.`c-d`", "x"]])
def test_equals_the_full_comparison(spark, tmp_dir, by):
    base = rows(400)
    rng = random.Random(3)
    other = [r for r in base if r[0] != 7] + rows(20, 5) + [base[3]] * 6
    rng.shuffle(other)
    left = spark.createDataFrame(base, SCHEMA)
    right = spark.createDataFrame(other, SCHEMA).repartition(3).select(*reversed(left.columns))  # columns in another order
    a, b = (write_snapshot(df, tmp_dir, digest_by=by, buckets=16) for df in (left, right))
    want = seen(frame_diff(left, right, exact=True))
    assert len(want) > 20
    assert seen(snapshot_diff(spark, a, b)) == want == seen(snapshot_diff(spark, left, b))
    assert seen(snapshot_diff(spark, a, b, expand=True)) == seen(frame_diff(left, right, exact=True, expand=True))
    assert seen(open_snapshot(spark, a)) == seen(left) and open_snapshot(spark, a).columns == left.columns
    assert read_manifest(spark, a)["tree"]["root"] != read_manifest(spark, b)["tree"]["root"]


def test_equal_snapshots_have_equal_trees(spark, tmp_dir):
    df = spark.createDataFrame(rows(300), SCHEMA)
    a = write_snapshot(df, tmp_dir, digest_by=["k"])
    b = write_snapshot(df.orderBy(F.rand(4)).repartition(5), tmp_dir, digest_by=["k"])
    assert read_manifest(spark, a)["tree"] == read_manifest(spark, b)["tree"]
    assert snapshot_diff(spark, a, b).isEmpty() and snapshot_diff(spark, df, b).isEmpty()
    for n in (1, 2):  # swapped nulls and one copy more are seen
        c = write_snapshot(df.limit(1).union(df) if n == 1 else df.withColumn("s", F.coalesce("s", F.lit(""))), tmp_dir, digest_by=["k"])
        assert not snapshot_diff(spark, a, c).isEmpty()


def test_only_unequal_buckets_are_read(tmp_path):
    script = os.path.join(os.path.dirname(__file__), "scripts", "tree_bytes.py")
    out = subprocess.run([sys.executable, script, "/root/testdata/sf0.1", str(tmp_path)], capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    got = json.loads(out.stdout.strip().splitlines()[-1])
    assert got["equal"] and 0.005 < got["share"] < 0.02
    assert got["tree"] < 0.05 * got["held"] and got["none"] == 0 and got["exact"] > 0.9 * got["held"], got


def test_hot_buckets_and_empty_frames(spark, tmp_dir):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("v").alias("v"))
    a = write_snapshot(hot, tmp_dir, digest_by=["k"], buckets=8)
    assert snapshot_diff(spark, hot, a).isEmpty() and open_snapshot(spark, a).count() == 30_000
    assert sorted(map(tuple, snapshot_diff(spark, hot.where("id <> 3" if "id" in hot.columns else "k <> 4"), a).collect())) == [(4, "v", "right_only", 1)]
    none = write_snapshot(hot.limit(0), tmp_dir, digest_by=["k"], buckets=8)
    assert open_snapshot(spark, none).count() == 0 and open_snapshot(spark, none).columns == ["k", "v"]
    assert snapshot_diff(spark, a, none).agg(F.sum("n")).first()[0] == 30_000
    assert snapshot_diff(spark, none, none).isEmpty() and snapshot_diff(spark, hot.limit(0), none).isEmpty()
    assert snapshot(hot, tmp_dir, digest_by=[]).count() == 30_000


def test_other_trees_compare_in_full(spark, tmp_dir):
    df = spark.range(50).withColumn("v", F.col("id") % 3)
    plain = write_snapshot(df, tmp_dir)
    a = write_snapshot(df, tmp_dir, digest_by=["v"], buckets=4)
    b = write_snapshot(df.where("id <> 9"), tmp_dir, digest_by=["v"], buckets=5)
    for left, right, n in ((plain, a, 0), (a, plain, 0), (a, b, 1), (plain, b, 1), (df, plain, 0)):
        assert snapshot_diff(spark, left, right).count() == n
    with pytest.raises(TypeError, match="types differ"):
        snapshot_diff(spark, df.selectExpr("cast(id as int) id", "v"), a)
    with pytest.raises(ValueError, match="columns differ"):
        snapshot_diff(spark, df.select("id"), a)
    with pytest.raises(ValueError, match="not written in buckets"):
        open_snapshot(spark, plain, buckets=[1])
    release_snapshot(spark, a)
    with pytest.raises(FileNotFoundError):
        snapshot_diff(spark, df, a)


def test_what_cannot_have_a_tree(spark, tmp_dir):
    df = spark.range(3)
    for bad in ({"buckets": 0}, {"buckets": 10**6}, {"codec": "json"}, {"partitions": 3}):
        with pytest.raises(ValueError):
            write_snapshot(df, tmp_dir, **({"digest_by": ["id"]} | bad))
    with pytest.raises(ValueError, match="called"):
        write_snapshot(df.withColumnRenamed("id", digest_tree.BUCKET), tmp_dir, digest_by=[])
    with pytest.raises(Exception, match="(?i)nothere"):
        write_snapshot(df, tmp_dir, digest_by=["nothere"])
    from pyspark.ml.linalg import Vectors
    udt = spark.createDataFrame([(Vectors.dense([1.0]),)], ["v"])
    with pytest.raises(TypeError, match="tell the values"):
        write_snapshot(udt, tmp_dir, digest_by=[])
    assert os.listdir(tmp_dir) == []
    # a sum beyond a long equals no other: unequal, never falsely equal
    many = digest_tree.leaves(spark.range(3).withColumn("id", F.lit(1)), F.lit(0))
    assert many.first().n == 3 and many.first().s0.isdigit()
