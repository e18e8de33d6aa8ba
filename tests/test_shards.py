"""Snapshots with files of a wanted size, clustered by columns."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from baton import open_snapshot, same_rows, snapshot, snapshot_path, write_snapshot


def sizes(path):
    path = path.removeprefix("file:")
    return [os.path.getsize(f) for f in glob.glob(f"{path}/part-*")]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, another tenth a second one."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, "warm").otherwise(F.concat(F.lit("k"), (n * 7919) % 5000))
    return spark.range(400_000).select(key.alias("a key"), n, F.sha2(n.cast("string"), 256).alias("v"), (n % 7).alias("w")).repartition(6)


@pytest.mark.parametrize("cluster", [None, ["a key"], ["w", "a key"]])
@pytest.mark.parametrize("target", [300_000, 2_000_000])
def test_files_are_near_the_target(spark, tmp_dir, skewed, cluster, target):
    out = snapshot(skewed, tmp_dir, target_file_bytes=target, cluster_by=cluster)
    found = sizes(snapshot_path(out))
    assert len(found) > 3 and all(target / 2 <= s <= target * 2 for s in found), (len(found), min(found), max(found))
    assert out.dtypes == skewed.dtypes and same_rows(out, skewed)
    assert len(os.listdir(tmp_dir)) == 1  # the stage is gone
    if cluster == ["a key"]:
        ranges = out.groupBy(F.input_file_name().alias("f")).agg(F.min("a key").alias("a"), F.max("a key").alias("b")).orderBy("a", "b").collect()
        assert all(x.b <= y.a for x, y in zip(ranges, ranges[1:]))  # a file is a range
        assert sum(r.a == r.b == "hot" for r in ranges) >= len(ranges) // 4  # and the hot key is many files


def test_clustering_that_compresses_is_dealt_again(spark, tmp_dir):
    # in arrival order these columns hardly compress; in ranges they nearly vanish
    n = F.col("id")
    df = spark.range(600_000).select(F.sha2(((n * 7919) % 3000).cast("string"), 512).alias("s"), n % 2).repartition(5)
    found = sizes(write_snapshot(df, tmp_dir, target_file_bytes=100_000, cluster_by=["s"]))
    assert len(found) > 2 and 100_000 / 2 <= sum(found) / len(found) <= 200_000


def test_text_codecs_small_and_empty_frames(spark, tmp_dir, skewed):
    path = write_snapshot(skewed.limit(50_000), tmp_dir, codec="json", target_file_bytes=1_000_000)
    found = sizes(path)
    assert len(found) > 3 and all(500_000 <= s <= 2_000_000 for s in found) and open_snapshot(spark, path).count() == 50_000
    small = write_snapshot(skewed.limit(10), tmp_dir, target_file_bytes=1 << 30, cluster_by=["id"])
    assert len(sizes(small)) == 1 and open_snapshot(spark, small).count() == 10
    none = snapshot(skewed.limit(0), tmp_dir, target_file_bytes=1000, cluster_by=["id"])
    assert none.count() == 0 and none.dtypes == skewed.dtypes


def test_layouts_that_exclude_each_other(spark, tmp_dir):
    df = spark.range(3)
    for bad in ({"cluster_by": ["id"]}, {"target_file_bytes": 0}, {"target_file_bytes": 9, "partitions": 2}, {"target_file_bytes": 9, "digest_by": []},
                {"target_file_bytes": 9, "max_records_per_file": 2}, {"target_file_bytes": 9, "cluster_by": ["id"], "codec": "json"}):
        with pytest.raises(ValueError):
            write_snapshot(df, tmp_dir, **bad)
    with pytest.raises(Exception, match="(?i)nothere"):
        write_snapshot(df, tmp_dir, target_file_bytes=9, cluster_by=["nothere"])
    with pytest.raises(Exception, match="lost"):
        write_snapshot(df.withColumn("x", F.raise_error(F.lit("lost")).cast("int")), tmp_dir, target_file_bytes=9)
    assert os.listdir(tmp_dir) == []
