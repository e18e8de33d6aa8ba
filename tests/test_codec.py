"""Row codec (P1, P2): fidelity over all types, schema guards, corrupt lines."""

from __future__ import annotations

import base64

import pytest
from pyspark.sql import functions as F

from baton import decode_rows, encode_rows, frame_diff, snapshot, write_snapshot
from baton.functions import decode_utf8, encode_utf8

ALL_TYPES = """
 CAST({i} AS INT) AS i, CAST({d} AS DOUBLE) AS d, CAST({f} AS FLOAT) AS f,
 CAST({dec} AS DECIMAL(38,18)) AS dec, CAST({ts} AS TIMESTAMP) AS ts,
 CAST({ntz} AS TIMESTAMP_NTZ) AS ntz, CAST({da} AS DATE) AS da, CAST({bin} AS BINARY) AS bin,
 CAST({arr} AS ARRAY<INT>) AS arr, CAST({m} AS MAP<STRING,STRING>) AS m,
 CAST({s} AS STRUCT<x:STRING>) AS s, CAST({str} AS STRING) AS str,
 CAST({itv} AS INTERVAL DAY TO SECOND) AS itv
"""

ROWS = [
    dict(i="1", d="1.5", f="2.5", dec="'12345678901234567890.123456789012345678'",
         ts="'2020-01-02 03:04:05.123456'", ntz="'2020-01-02 03:04:05.123456'", da="'2020-01-02'",
         bin="X'00FF'", arr="array(1, 2, NULL)", m="map('a', 'x', 'b', NULL)",
         s="named_struct('x', 'y')", str="'héllo \"q\"\\n\\ttab ☃'",
         itv="INTERVAL '1 02:03:04.123456' DAY TO SECOND"),
    dict(i="NULL", d="NULL", f="NULL", dec="NULL", ts="NULL", ntz="NULL", da="NULL", bin="NULL",
         arr="NULL", m="NULL", s="NULL", str="NULL", itv="NULL"),
    dict(i="-2147483648", d="double('NaN')", f="float('-Infinity')", dec="'-0.000000000000000001'",
         ts="'0001-01-01 00:00:00'", ntz="'9999-12-31 23:59:59.999999'", da="'0001-01-01'",
         bin="X''", arr="array()", m="map()", s="named_struct('x', '')", str="''",
         itv="INTERVAL '-3 00:00:00.000001' DAY TO SECOND"),
    dict(i="2147483647", d="double('Infinity')", f="float('NaN')", dec="'99999999999999999999.999999999999999999'",
         ts="'1850-06-01 12:00:00.000001'", ntz="'1969-12-31 23:59:59.999999'", da="'9999-12-31'",
         bin="X'0102030405060708090A0B0C0D0E0F101112131415161718191A1B1C1D1E1F202122232425262728292A2B2C2D2E2F30313233343536373839'",
         arr="array(NULL)", m="map('k', '')", s="CAST(named_struct('x', NULL) AS STRUCT<x:STRING>)",
         str="repeat('long text ', 40)", itv="INTERVAL '0 00:00:00' DAY TO SECOND"),
]


def exprs(sql_select):
    # split on top-level commas
    out, depth, cur = [], 0, ""
    for ch in sql_select:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    if cur.strip():
        out.append(cur.strip())
    return out


def all_types_df(spark):
    df = None
    for r in ROWS:
        one = spark.range(1).selectExpr(*exprs(ALL_TYPES.format(**r)))
        df = one if df is None else df.unionByName(one)
    return df


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("codec", ["json", "parquet"])
def test_all_types_round_trip_exact(spark, tmp_dir, tz, codec):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        src = all_types_df(spark)
        assert src.count() == 4
        back = snapshot(src, tmp_dir, codec)
        assert back.schema.simpleString() == src.schema.simpleString()
        assert frame_diff(src, back).count() == 0
        assert frame_diff(back, src).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_microseconds_of_driver_events_survive(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    back = snapshot(ev, tmp_dir, "json")
    assert frame_diff(ev, back).count() == 0
    assert back.where(F.expr("unix_micros(CAST(ts AS TIMESTAMP)) % 1000 != 0")).count() > 0


def test_base64_has_no_line_breaks_for_long_rows(spark):
    spark.conf.set("spark.sql.chunkBase64String.enabled", "true")
    df = spark.createDataFrame([("x" * 500,)], "value string")
    line = encode_rows(df, "utf8").first()[0]
    assert "\r" not in line and "\n" not in line
    assert base64.b64decode(line).decode() == "x" * 500


def test_utf8_codec_matches_plain_base64(spark):
    texts = ["", "ala ma kota", "zółw \U0001F600", "a\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    enc = [r[0] for r in encode_rows(df, "utf8").collect()]
    assert enc == [base64.b64encode(t.encode()).decode() for t in texts]
    back = decode_rows(encode_rows(df, "utf8"), codec="utf8")
    assert sorted(r[0] for r in back.collect()) == sorted(texts)


def test_utf8_codec_rejects_null_and_wrong_shape(spark):
    df = spark.createDataFrame([("a",), (None,)], "value string")
    with pytest.raises(Exception):
        encode_rows(df, "utf8").collect()
    with pytest.raises(ValueError):
        encode_rows(spark.createDataFrame([(1,)], "value int"), "utf8")
    with pytest.raises(Exception):
        spark.range(1).select(encode_utf8(F.lit(None).cast("string"))).collect()


def test_json_codec_rejects_int_key_map_parquet_accepts(spark, tmp_dir):
    df = spark.range(1).selectExpr("map(1, 'a') AS m")
    with pytest.raises(ValueError):
        encode_rows(df, "json")
    with pytest.raises(ValueError):
        write_snapshot(df, tmp_dir, codec="json")
    back = snapshot(df, tmp_dir, "parquet")
    assert back.first()[0] == {1: "a"}


def test_json_codec_rejects_duplicate_names(spark):
    df = spark.range(1).selectExpr("1 AS a", "2 AS a")
    with pytest.raises(ValueError):
        encode_rows(df, "json")
    nested = spark.range(1).selectExpr("named_struct('x', 1, 'x', 2) AS s")
    with pytest.raises(ValueError):
        encode_rows(nested, "json")


@pytest.mark.parametrize("line", [
    "!!!notb64",
    "__-_",
    "",
    base64.b64encode(b'{"a": 1, "b": "xyz"}').decode()[:-7],
    base64.b64encode(b'{"a": 1, "b": ').decode(),
    base64.b64encode(b'not json').decode(),
])
def test_corrupt_lines_raise(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception):
        decode_rows(df, "a int, b string", "json").collect()


def test_corrupt_utf8_line_raises(spark):
    df = spark.createDataFrame([("!!!notb64",)], "value string")
    with pytest.raises(Exception):
        df.select(decode_utf8(F.col("value"))).collect()


def test_decode_needs_schema_for_json(spark):
    with pytest.raises(ValueError):
        decode_rows(spark.createDataFrame([("e30=",)], "value string"), None, "json")


def test_unknown_codec(spark, tmp_dir):
    with pytest.raises(ValueError):
        write_snapshot(spark.range(1), tmp_dir, codec="avro")


def test_json_keys_by_position_or_name(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, `b.c` string")
    line = encode_rows(df, "json").first()[0]
    assert base64.b64decode(line).decode() == '{"0":1,"1":"a"}'
    named = encode_rows(df, "json", keys="name")
    assert base64.b64decode(named.first()[0]).decode() == '{"a":1,"b.c":"a"}'
    for keys, lines in (("position", encode_rows(df, "json")), ("name", named)):
        back = decode_rows(lines, df.schema, "json", keys=keys)
        assert back.columns == ["a", "b.c"]
        assert frame_diff(df, back).count() == 0
    with pytest.raises(ValueError):
        encode_rows(df, "json", keys="other")


def test_filtered_text_snapshot_decodes_each_line_once(spark, tmp_dir):
    from baton.plans import plan_text
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    back = snapshot(orders, tmp_dir, "json")
    q = back.where(F.col("o_totalprice") > 1000).select("o_orderkey")
    assert plan_text(q, "simple").count("from_json(") == 1
    assert q.count() == orders.where(F.col("o_totalprice") > 1000).count()


@pytest.mark.parametrize("codec", ["json", "parquet"])
def test_user_defined_types_round_trip(spark, tmp_dir, codec):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0])), (2, Vectors.sparse(3, [0], [5.0]))], ["id", "v"])
    back = snapshot(df, tmp_dir, codec)
    assert sorted((r.id, r.v) for r in back.collect()) == sorted((r.id, r.v) for r in df.collect())


@pytest.mark.parametrize("codec", ["json", "parquet"])
def test_variant_and_year_month_interval_round_trip(spark, tmp_dir, codec):
    df = spark.range(3).selectExpr(
        "id", "make_ym_interval(CAST(id AS INT) - 1, -3) AS ym",
        "parse_json('{\"a\": [1, 2.5, \"x\"], \"b\": null}') AS v")
    back = snapshot(df, tmp_dir, codec)
    assert back.schema.simpleString() == df.schema.simpleString()
    # variant is not comparable, so compare it through its JSON text
    as_text = [F.col("id"), F.col("ym"), F.to_json("v").alias("v")]
    assert frame_diff(df.select(*as_text), back.select(*as_text)).count() == 0


def _line(text):
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


@pytest.mark.parametrize("text", [
    "{}", " ", '{"0":1}', '{"7":1}', '{"0":1,"0":2,"1":"x"}', '{"a":1,"b":"x"}', '{"0":1,"1":"a"}{"0":2,"1":"b"}',
    '{"0":1,"1":"a"} garbage', '{"0":1,"1":"a"},{"0":2,"1":"b"}', '{"0":1,"1":"a"}} x', "[1]", "null", '{"0":"zz","1":"a"}',
])
def test_lines_that_do_not_hold_exactly_one_row_raise(spark, text):
    df = spark.createDataFrame([(_line(text),)], "value string")
    with pytest.raises(Exception):
        decode_rows(df, "a int, b string", "json").collect()


def test_keys_in_another_order_and_missing_keys(spark):
    df = spark.createDataFrame([(_line('{"b":"x","a":1}'),)], "value string")
    assert decode_rows(df, "a int, b string", keys="name").first() == (1, "x")
    part = spark.createDataFrame([(_line('{"b":"x"}'),)], "value string")
    with pytest.raises(Exception):
        decode_rows(part, "a int, b string", keys="name").collect()
    assert decode_rows(part, "a int, b string", keys="name", allow_missing=True).first() == (None, "x")
    with pytest.raises(Exception):
        decode_rows(part, "a int", keys="name", allow_missing=True).collect()


def test_very_long_strings_come_back(spark, tmp_dir):
    df = spark.range(1).selectExpr("repeat('x', 25 * 1024 * 1024) AS t")
    assert snapshot(df, tmp_dir, "json").select(F.length("t")).first()[0] == 25 * 1024 * 1024


def test_strings_that_are_not_utf8(spark, tmp_dir):
    flat = spark.range(1).selectExpr("CAST(X'61FF62' AS STRING) AS t")
    for codec in ("utf8", "parquet"):
        assert snapshot(flat, tmp_dir, codec).select(F.hex("t")).first()[0] == "61FF62"
    for df in (flat, spark.range(1).selectExpr("array(named_struct('z', CAST(X'61FF62' AS STRING))) AS n"),
               spark.range(1).selectExpr("map(CAST(X'FF' AS STRING), 'v') AS m")):
        with pytest.raises(Exception, match="not valid UTF-8"):
            snapshot(df, tmp_dir, "json")


def test_url_safe_lines(spark):
    raw = bytes(range(200, 256)).hex() + "??>>~~"
    line = base64.urlsafe_b64encode(("ÿþ" + raw + "\u07ff\u0fff").encode()).decode()
    df = spark.createDataFrame([(line,)], "value string")
    assert decode_rows(df, codec="utf8", alphabet="url").first()[0] == "ÿþ" + raw + "\u07ff\u0fff"
    with pytest.raises(ValueError):
        decode_rows(df, codec="utf8", alphabet="other")


def test_time_columns_are_rejected_early(spark):
    from pyspark.sql import types as T
    from baton.functions import check_json_schema
    with pytest.raises(ValueError, match="time"):
        check_json_schema(T.StructType([T.StructField("t", T.TimeType())]))
