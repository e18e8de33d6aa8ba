"""Conforming with rejects: each rule, nested fields, and that both outputs are the input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton import conform_split, judge_rows


def reasons(df, schema):
    out = {}
    for i, r in enumerate(judge_rows(df, schema).collect()):
        assert (r["row"] is None) == bool(r["reasons"]) and (r["input"] is None) != bool(r["reasons"])
        out[i] = [(x["field"], x["reason"], x["value"]) for x in r["reasons"]]
    return out


@pytest.mark.parametrize("value,have,want,reason", [
    ("x", "string", "int", "cast"),
    (" 7 ", "string", "int", None),
    (300, "int", "tinyint", "cast"),
    (1.5, "double", "int", "lossy"),
    (2.0, "double", "int", None),
    (float("nan"), "double", "float", None),
    (0.1, "double", "float", "lossy"),
    (2 ** 53 + 1, "bigint", "double", "lossy"),
    (None, "double", "int", None),
    ("2020-02-30", "string", "date", "cast"),
    ("2020-02-29", "string", "date", None),
    ("maybe", "string", "boolean", "cast"),
    (5, "int", "string", None),
])
def test_one_value(spark, value, have, want, reason):
    df = spark.createDataFrame([(value,)], f"v {have}")
    got = reasons(df, f"v {want}")[0]
    assert [r[:2] for r in got] == ([("v", reason)] if reason else [])


def test_time_of_day_as_date_is_lossy(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2020-01-02 00:00:00'), (TIMESTAMP '2020-01-02 03:00:00') AS t(v)").coalesce(1)
    assert [[r[:2] for r in x] for x in reasons(df, "v date").values()] == [[], [("v", "lossy")]]


def test_required_and_missing(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "k int, `a.b` string").coalesce(1)
    want = T.StructType([T.StructField("K", T.LongType(), False), T.StructField("a.b", T.StringType(), False)])
    assert reasons(df, want) == {0: [("a.b", "null", None)], 1: []}
    gone = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("other", T.IntegerType(), False)])
    assert reasons(df, gone) == {i: [("other", "missing", None)] for i in range(2)}


def test_nested_reasons_name_their_place(spark):
    df = spark.sql("""SELECT array(named_struct('x', '1', 'y', 0), named_struct('x', 'q', 'y', 1), NULL) AS a,
                             map('1', 'b', '01', 'c', 'z', 'd') AS m, named_struct('s', named_struct('t', 1.5D)) AS s""")
    got = reasons(df, "a array<struct<x: int>>, m map<int, string>, s struct<s: struct<t: int, u: string>>")[0]
    assert got == [("a[1].x", "cast", "q"), ("m.key", "cast", "z"), ("m", "repeated key", None), ("s.s.t", "lossy", "1.5")]
    fine = spark.sql("SELECT array(named_struct('y', 0, 'x', '1')) AS a, map('1', '2') AS m")
    row = judge_rows(fine, "m map<int, int>, a array<struct<x: int, more: date>>").first()["row"]
    assert row["m"] == {1: 2} and [tuple(x) for x in row["a"]] == [(1, None)]


def test_never_castable_is_an_error_before_any_job(spark):
    df = spark.sql("SELECT array(1) AS a, 1 AS b")
    for wanted in ("a int", "b array<int>", "b varchar(3)", "b date"):
        with pytest.raises(Exception):
            judge_rows(df, wanted)
    with pytest.raises(ValueError):
        judge_rows(spark.sql("SELECT 1 AS a, 2 AS a"), "a int")
    with pytest.raises(ValueError):
        conform_split(spark.sql("SELECT 1 AS reasons"), "reasons int")


def test_split_adds_up_to_an_input_that_changes(spark, tmp_dir):
    # a random input: were it read twice, the two outputs would not add up
    df = spark.range(2000, numPartitions=4).select("id", F.when(F.rand() < 0.3, F.lit("no")).otherwise(F.col("id").cast("string")).alias("v"), F.lit(1).alias("extra"))
    kept, left = conform_split(df, "v bigint, id int", tmp_dir)
    assert kept.columns == ["v", "id"] and left.columns == ["id", "v", "extra", "reasons"]
    ids = [r["id"] for r in kept.collect()] + [r["id"] for r in left.collect()]
    assert sorted(ids) == list(range(2000)) and 0 < left.count() < 2000
    assert kept.where("v <> id").count() == 0 and left.where("v <> 'no'").count() == 0


def test_empty(spark, tmp_dir):
    kept, left = conform_split(spark.createDataFrame([], "a string"), "a int, b date", tmp_dir)
    assert kept.schema.simpleString() == "struct<a:int,b:date>" and kept.count() == left.count() == 0
