"""Multiset comparison (V1)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from baton import frame_diff, same_rows
from baton.plans import plan_text


def test_equal_frames_have_empty_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x"), (1, "x")], "k int, v string").select("v", "k")
    assert frame_diff(a, b).count() == 0
    assert same_rows(a, b)


def test_counts_surplus_per_side(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (3,)], "k int")
    got = sorted(tuple(r) for r in frame_diff(a, b).collect())
    assert got == [(1, "left_only", 2), (2, "left_only", 1), (3, "right_only", 2)]
    assert not same_rows(a, b)


def test_expand_replicates_across_chunks(spark):
    a = spark.range(10).select(F.lit(7).alias("k")).unionByName(spark.range(1).select(F.lit(8).alias("k")))
    b = spark.range(1).select(F.lit(7).alias("k"))
    rows = frame_diff(a, b, expand=True, chunk_rows=4).collect()
    assert sorted(tuple(r) for r in rows) == [(7, "left_only")] * 9 + [(8, "left_only")]


def test_maps_compare_by_content(spark):
    a = spark.range(1).selectExpr("map('a', 1, 'b', 2) AS m", "array(map('x', map('y', 1))) AS n")
    b = spark.range(1).selectExpr("map('b', 2, 'a', 1) AS m", "array(map('x', map('y', 1))) AS n")
    assert same_rows(a, b)
    c = spark.range(1).selectExpr("map('b', 3, 'a', 1) AS m", "array(map('x', map('y', 1))) AS n")
    assert not same_rows(a, c)


def test_nan_and_null_compare_equal_to_themselves(spark):
    df = spark.createDataFrame([(float("nan"), None), (0.0, 1)], "d double, i int")
    assert same_rows(df, df.select("i", "d"))


def test_column_mismatch_raises(spark):
    with pytest.raises(ValueError):
        frame_diff(spark.range(1), spark.range(1).withColumnRenamed("id", "x"))


def test_one_shuffle_with_partial_counts(spark):
    a = spark.range(1000).select((F.col("id") % 3).alias("k"))
    plan = plan_text(frame_diff(a, a, exact=True))
    assert plan.count("+- Exchange") == 1 and "hashpartitioning" in plan
    assert "partial_sum" in plan


def test_hot_row_is_combined_before_the_shuffle(tmp_path):
    import json
    import os
    import subprocess
    import sys
    script = os.path.join(os.path.dirname(__file__), "scripts", "hot_row_shuffle.py")
    out = subprocess.run([sys.executable, script, "/root/testdata/sf0.001", str(tmp_path)],
                         capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert line, out.stderr[-3000:]
    stats = json.loads(line[-1])
    hot = stats["hot_copies"]
    assert stats["diff"][0][2:] == ["left_only", hot] and len(stats["diff"]) == 1
    # the copies collapse map-side: at most one record per map task survives
    assert stats["shuffle_records_written"] <= stats["input_rows"] - hot + 16
    # and no reduce task receives the hot group's copies
    assert stats["max_records_read_by_one_task"] < hot


def test_variant_columns_compare_by_content(spark):
    a = spark.range(2).selectExpr("id", "parse_json('{\"b\": 1, \"a\": [true, null]}') AS v")
    b = spark.range(2).selectExpr("id", "parse_json('{\"a\": [true, null], \"b\": 1}') AS v")
    c = spark.range(2).selectExpr("id", "parse_json('{\"a\": [true, null], \"b\": 2}') AS v")
    assert same_rows(a, b)
    assert frame_diff(a, c).count() == 4


@pytest.mark.parametrize("left,right", [
    ("1", "'1'"),
    ("9007199254740993", "CAST(9007199254740992 AS DOUBLE)"),
    ("CAST('0.1000000000000000001' AS DECIMAL(38,19))", "CAST(0.1 AS DOUBLE)"),
    ("DATE'2020-01-01'", "TIMESTAMP'2020-01-01 00:00:00'"),
    ("1", "'abc'"),
    ("named_struct('x', 1)", "named_struct('x', 1L)"),
])
def test_other_types_are_not_equal(spark, left, right):
    a, b = spark.range(1).selectExpr(f"{left} AS v"), spark.range(1).selectExpr(f"{right} AS v")
    with pytest.raises(TypeError):
        same_rows(a, b)


def test_widen_compares_different_types(spark):
    a, b = spark.range(3).selectExpr("CAST(id AS INT) AS v"), spark.range(3)
    assert frame_diff(a, b.withColumnRenamed("id", "v"), widen=True).count() == 0


@pytest.mark.parametrize("exact", [False, True])
def test_values_that_grouping_calls_equal(spark, exact):
    zero, minus = spark.range(1).selectExpr("CAST(0.0 AS DOUBLE) AS v"), spark.range(1).selectExpr("CAST('-0.0' AS DOUBLE) AS v")
    got = frame_diff(zero, minus, exact=exact).collect()
    assert sorted((str(r.v), r.side) for r in got) == [("-0.0", "right_only"), ("0.0", "left_only")]
    date = spark.range(1).selectExpr("to_variant_object(named_struct('d', DATE'2020-01-01')) AS v")
    text = spark.range(1).selectExpr("to_variant_object(named_struct('d', '2020-01-01')) AS v")
    assert not same_rows(date, text, exact=exact)
    assert same_rows(date, date, exact=exact)


def test_columns_called_n_and_side(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "n int, side string")
    b = spark.createDataFrame([(2, "y")], "n int, side string")
    out = frame_diff(a, b)
    assert out.columns == ["left_n", "left_side", "side", "n"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", "left_only", 2), (2, "y", "right_only", 1)]
    assert frame_diff(a, b, expand=True).columns == ["n", "left_side", "side"]
    assert frame_diff(a, b, expand=True).count() == 3
    assert frame_diff(out, out).count() == 0  # the diff of a diff


def test_digests_shuffle_a_tenth_of_the_bytes(tmp_path):
    import json
    import os
    import subprocess
    import sys
    script = os.path.join(os.path.dirname(__file__), "scripts", "diff_shuffle.py")
    out = subprocess.run([sys.executable, script, "/root/testdata/sf0.01", str(tmp_path)], capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert line, out.stderr[-3000:]
    got = json.loads(line[-1])
    assert got["digest"] * 10 < got["exact"]


@pytest.mark.parametrize("left,right", [
    ("CAST(1 AS INT) AS a, CAST(NULL AS INT) AS b", "CAST(NULL AS INT) AS a, 1 AS b"),
    ("CAST(array() AS ARRAY<INT>) AS a", "CAST(NULL AS ARRAY<INT>) AS a"),
    ("array(1, NULL) AS a", "array(1) AS a"),
    ("array(NULL, 1) AS a", "array(1, NULL) AS a"),
    ("array(1, 2) AS a, array(3) AS b", "array(1) AS a, array(2, 3) AS b"),
    ("array(array(1, 2), array(3)) AS a", "array(array(1), array(2, 3)) AS a"),
    ("named_struct('x', 1, 'y', CAST(NULL AS INT)) AS a", "named_struct('x', CAST(NULL AS INT), 'y', 1) AS a"),
    ("named_struct('x', CAST(NULL AS INT)) AS a", "CAST(NULL AS STRUCT<x: INT>) AS a"),
    ("array(CAST(NULL AS STRUCT<x: INT>)) AS a", "array(named_struct('x', CAST(NULL AS INT))) AS a"),
    ("map('k', CAST(NULL AS INT)) AS a, 1 AS b", "map('k', 1) AS a, CAST(NULL AS INT) AS b"),
    ("CAST(map() AS MAP<STRING, INT>) AS a", "CAST(NULL AS MAP<STRING, INT>) AS a"),
    ("map('k', array(1), 'l', array(2, 3)) AS a", "map('k', array(1, 2), 'l', array(3)) AS a"),
    ("CAST(1 AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b", "CAST(NULL AS DOUBLE) AS a, CAST(1 AS DOUBLE) AS b"),
])
def test_rows_whose_bare_hashes_agree(spark, left, right):
    a, b = spark.sql(f"SELECT {left}"), spark.sql(f"SELECT {right}")
    assert not same_rows(a, b)
    assert not same_rows(a, b, exact=True)
    assert sorted(r.side for r in frame_diff(a, b).collect()) == ["left_only", "right_only"]
    assert same_rows(a, a) and same_rows(b, b)


def test_struct_fields_whose_names_differ_in_case(spark):
    a = spark.sql("SELECT named_struct('x', 1, 'X', CAST(NULL AS INT)) AS s")
    b = spark.sql("SELECT named_struct('x', CAST(NULL AS INT), 'X', 1) AS s")
    assert same_rows(a, a)
    assert not same_rows(a, b)
