"""The tagged codec: types that JSON has no form for come back exactly."""

from __future__ import annotations

import base64

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton import decode_rows, encode_rows, frame_diff, open_snapshot, snapshot, snapshot_path


def test_maps_of_every_key_type_round_trip(spark, tmp_dir):
    df = spark.sql("""SELECT map(1, 'a', 2, NULL) AS i, map(1.5D, 1, double('NaN'), 2, double('-Infinity'), 3) AS d,
        map(X'00FF', array(map(true, 1), NULL)) AS b, map(DATE '0001-01-01', map('s', map(2, 3))) AS da,
        map(TIMESTAMP '1850-06-01 12:00:00.000001', 1) AS ts, map(named_struct('x', 1, 'y', CAST(NULL AS STRING)), 1) AS st,
        map(array(1, NULL), 1) AS arr, CAST(map() AS MAP<INT, INT>) AS e, CAST(NULL AS MAP<INT, INT>) AS n,
        map(12345678901234567890.123456789012345678BD, 1) AS dec, CAST(NULL AS STRUCT<m: MAP<INT, INT>>) AS sn, 'plain' AS `a b.c`""")
    for keys in ("position", "name"):
        back = decode_rows(encode_rows(df, "tagged", keys=keys), df.schema, "tagged", keys=keys)
        assert back.schema.simpleString() == df.schema.simpleString()
        assert frame_diff(df, back).count() == 0
    handed = snapshot(df, tmp_dir, codec="tagged")
    assert frame_diff(df, open_snapshot(spark, snapshot_path(handed))).count() == 0
    some = open_snapshot(spark, snapshot_path(handed), "st map<struct<x: int, y: string>, int>, i map<int, string>")
    assert frame_diff(df.select("st", "i"), some).count() == 0


def test_plain_types_are_written_as_by_json(spark):
    df = spark.sql("SELECT 1 AS a, map('k', array(1)) AS m, named_struct('x', 1.5D) AS s")
    assert encode_rows(df, "tagged").first() == encode_rows(df, "json").first()


def test_calendar_intervals(spark):
    df = spark.sql("""SELECT explode(array(make_interval(1, -2, 3, -4, 5, -6, 7.000008), make_interval(), make_interval(0, 0, 0, 0, 0, 0, -0.000001),
        CAST('178956970 years 7 months 2147483647 days 2562047788 hours 54.775807 seconds' AS INTERVAL),
        CAST('-178956970 years -8 months -2147483648 days -2562047788 hours -54.775808 seconds' AS INTERVAL),
        NULL)) AS i""").select("i", F.array("i").alias("a"), F.create_map(F.lit(1), F.col("i")).alias("m"))
    back = decode_rows(encode_rows(df, "tagged"), df.schema, "tagged")
    digest = F.xxhash64("i", F.element_at("a", 1), F.element_at("m", 1))
    assert sorted(r[0] for r in back.select(digest).collect()) == sorted(r[0] for r in df.select(digest).collect())


def test_times(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        df = spark.sql("SELECT TIME '12:34:56.123456' AS t, TIME '00:00:00' AS z, map(TIME '23:59:59.999999', TIME '01:02:03.4') AS m, CAST(NULL AS TIME(3)) AS n")
        lines = encode_rows(df, "tagged")
        back = decode_rows(lines, df.schema, "tagged")
        assert back.schema.simpleString() == df.schema.simpleString()
        texts = [F.col(c).cast("string") for c in ("t", "z", "n")] + [F.map_keys("m")[0].cast("string"), F.map_values("m")[0].cast("string")]
        assert back.select(*texts).collect() == df.select(*texts).collect()
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


@pytest.mark.parametrize("text,schema", [
    ('{"0":[{"k":1,"v":2},{"k":1,"v":3}]}', "m map<int, int>"),
    ('{"0":[{"v":2}]}', "m map<int, int>"),
    ('{"0":[null]}', "m map<int, int>"),
    ('{"0":"three days or so"}', "i interval"),
    ('{"0":{"1":2}}', "m map<int, int>"),
])
def test_damaged_values_fail(spark, text, schema):
    df = spark.createDataFrame([(base64.b64encode(text.encode()).decode(),)], "value string")
    with pytest.raises(Exception):
        decode_rows(df, schema, "tagged").select(F.xxhash64(F.map_keys("m")) if "map" in schema else F.xxhash64("i")).collect()


SCHEMA = T.StructType([T.StructField("m", T.MapType(T.LongType(), T.MapType(T.DateType(), T.StringType()))),
                       T.StructField("a", T.ArrayType(T.MapType(T.BooleanType(), T.DoubleType())))])
text = st.none() | st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=10)
rows = st.tuples(st.none() | st.dictionaries(st.integers(-(2 ** 63), 2 ** 63 - 1), st.none() | st.dictionaries(st.dates(), text, max_size=3), max_size=3),
                 st.none() | st.lists(st.none() | st.dictionaries(st.booleans(), st.none() | st.floats()), max_size=3))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(rows, min_size=1, max_size=30))
def test_random_rows_round_trip(spark, batch):
    df = spark.createDataFrame(batch, SCHEMA)
    assert frame_diff(df, decode_rows(encode_rows(df, "tagged"), SCHEMA, "tagged")).count() == 0
