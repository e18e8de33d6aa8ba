"""Property tests: random rows survive every codec exactly."""

from __future__ import annotations

import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from baton import decode_rows, encode_rows, frame_diff

SCHEMA = T.StructType([
    T.StructField("i", T.LongType()),
    T.StructField("d", T.DoubleType()),
    T.StructField("s", T.StringType()),
    T.StructField("b", T.BinaryType()),
    T.StructField("dec", T.DecimalType(20, 6)),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("da", T.DateType()),
    T.StructField("arr", T.ArrayType(T.StringType())),
    T.StructField("m", T.MapType(T.StringType(), T.LongType())),
    T.StructField("st", T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType())])),
])

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40)
doubles = st.floats(allow_nan=True, allow_infinity=True)
rows = st.tuples(
    st.none() | st.integers(-(2 ** 63), 2 ** 63 - 1),
    st.none() | doubles,
    st.none() | text,
    st.none() | st.binary(max_size=30),
    st.none() | st.decimals(min_value=-(10 ** 13), max_value=10 ** 13, places=6,
                            allow_nan=False, allow_infinity=False),
    st.none() | st.datetimes(min_value=dt.datetime(1, 1, 1), max_value=dt.datetime(9999, 12, 31)),
    st.none() | st.dates(min_value=dt.date(1, 1, 1), max_value=dt.date(9999, 12, 31)),
    st.none() | st.lists(st.none() | text, max_size=4),
    st.none() | st.dictionaries(text, st.none() | st.integers(-(2 ** 63), 2 ** 63 - 1), max_size=3),
    st.none() | st.tuples(st.none() | doubles, st.none() | text),
)


def _fix(r):
    r = list(r)
    if r[4] is not None:
        r[4] = decimal.Decimal(r[4]).quantize(decimal.Decimal("0.000001"))
    if r[3] is not None:
        r[3] = bytearray(r[3])
    return tuple(r)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(rows, min_size=1, max_size=40))
def test_json_codec_round_trips_random_rows(spark, batch):
    df = spark.createDataFrame([_fix(r) for r in batch], SCHEMA)
    for keys in ("position", "name"):
        back = decode_rows(encode_rows(df, "json", keys=keys), SCHEMA, "json", keys=keys)
        assert frame_diff(df, back).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(text, min_size=1, max_size=60))
def test_utf8_codec_round_trips_random_text(spark, batch):
    df = spark.createDataFrame([(t,) for t in batch], "value string")
    back = decode_rows(encode_rows(df, "utf8"), codec="utf8")
    assert sorted(r[0] for r in back.collect()) == sorted(batch)


small_rows = st.tuples(st.none() | st.integers(0, 3), st.sampled_from(["a", "b", None]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(small_rows, max_size=60), st.lists(small_rows, max_size=60))
def test_frame_diff_matches_counter_subtraction(spark, left, right):
    from collections import Counter
    schema = "k int, v string"
    lf, rf = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = {(r.k, r.v, r.side): r.n for r in frame_diff(lf, rf).collect()}
    lc, rc = Counter(left), Counter(right)
    want = {**{(*row, "left_only"): n for row, n in (lc - rc).items()},
            **{(*row, "right_only"): n for row, n in (rc - lc).items()}}
    assert got == want
    expanded = Counter((r.k, r.v, r.side) for r in frame_diff(lf, rf, expand=True, chunk_rows=3).collect())
    assert dict(expanded) == want
