"""Handing over RDDs of records without a schema: read once, encoded as Arrow batches."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from baton import rdd_to_frame
from baton.functions import records

VALUES = {
    "flag": st.booleans(), "n": st.integers(-2**63, 2**63 - 1), "x": st.floats(), "s": st.text(st.characters(exclude_categories=["Cs"])),
    "b": st.binary() | st.binary().map(bytearray), "day": st.dates(), "span": st.timedeltas(dt.timedelta(-10**6), dt.timedelta(10**6)),
    "at": st.datetimes(dt.datetime(1971, 1, 1), dt.datetime(2100, 1, 1), timezones=st.sampled_from([None, dt.timezone.utc, dt.timezone(dt.timedelta(hours=5))])),
    "money": st.decimals(allow_nan=False, allow_infinity=False, min_value=-10**15, max_value=10**15, places=9),
    "list": st.lists(st.none() | st.lists(st.integers(0, 9))), "map": st.dictionaries(st.text("ab"), st.none() | st.floats(allow_nan=False)),
    "row": st.none() | st.builds(Row(*("u", "v")), st.none() | st.text("xy"), st.lists(st.booleans())),
}


def plain(v):
    """A value as its column gives it back."""
    if isinstance(v, Row):
        return tuple(plain(x) for x in v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, dt.datetime):
        return v.timestamp()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


#: One value of each type, so that every column has one.
FULL = {"flag": True, "n": 1, "x": 0.5, "s": "é", "b": b"\x00", "day": dt.date(1, 1, 1), "span": dt.timedelta(0, 1, 2), "at": dt.datetime(2020, 1, 1),
        "money": decimal.Decimal("1.5"), "list": [[1]], "map": {"k": 1.0}, "row": Row(u="x", v=[True])}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.fixed_dictionaries({}, optional={k: st.none() | v for k, v in VALUES.items()}), max_size=20), parts=st.integers(1, 4))
def test_any_records_come_back(spark, tmp_dir, rows, parts):
    rows = [r | {"id": i} for i, r in enumerate([*rows, FULL])]
    got = {r["id"]: r for r in rdd_to_frame(spark.sparkContext.parallelize(rows, parts), temp_dir=tmp_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        for name in VALUES:
            assert plain(got[r["id"]][name]) == plain(r.get(name)), name


def test_an_rdd_is_read_once(spark, tmp_dir):
    read = spark.sparkContext.accumulator(0)

    def seen(i):
        read.add(1)
        return {"i": i} if i % 3 else {"i": i, "more": [str(i)]}

    out = rdd_to_frame(spark.sparkContext.parallelize(range(30_000), 5).map(seen), temp_dir=tmp_dir)
    assert read.value == 30_000  # the write is done
    assert out.where("more[0] = i").count() == 10_000 and out.count() == 30_000 and read.value == 30_000
    assert len(os.listdir(tmp_dir)) == 1  # nothing is left of the stage


def test_the_written_codec_and_failures(spark, tmp_dir):
    sc = spark.sparkContext
    out = rdd_to_frame(sc.parallelize([{"a": 1}, {"b": "x"}], 2), temp_dir=tmp_dir, codec="json")
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, None), (None, "x")]
    before = os.listdir(tmp_dir)
    for rows, error in (([{"a": 1}, {"a": "x"}], "different types"), ([{"a": 1}, {"a": 2.0}], "different types"), ([{"a": 1}, {"a": True}], "different types"),
                        ([{"a": [1]}, {"a": {"k": 1}}], "different types"), ([{"a": [1, "x"]}], "different types"), ([Row(a=Row(b=1)), Row(a=Row(b="x"))], "different types"),
                        ([{"a": 2**63}], "64 bits"), ([{"a": {None: 1}}], "missing key"), ([{"a": object()}], "no column type"), ([{"a": [1 + 2j]}], "no column type"),
                        ([(1, 2), (1,)], "a record of 1 fields"), ([(1,), {"x": 1}], "a record of 1 fields"), ([5], "not a record"), ([{1: 2}], "must be text"),
                        ([{}, {}], "empty RDD"), ([{"a": None}], "no value"), ([{"a": []}], "no value"), ([{"a": {}}], "no value")):
        for parts in (1, len(rows)):
            with pytest.raises(Exception, match=error):
                rdd_to_frame(sc.parallelize(rows, parts), temp_dir=tmp_dir)
    assert os.listdir(tmp_dir) == before


def test_types_fill_in_across_batches(spark, tmp_dir, monkeypatch):
    # what one batch does not know another tells, at every depth
    rows = [{"a": []}, {"a": [None]}, {"a": [{}]}, {"a": [{"k": None}]}, {"a": [{"k": Row(x=None)}]}, {"a": [{"k": Row(y=[])}, None]},
            {"a": [{"k": Row(x=1.5, y=[dt.date(2020, 1, 1)])}]}, {}]
    out = rdd_to_frame(spark.sparkContext.parallelize([r | {"i": i} for i, r in enumerate(rows)], 8), temp_dir=tmp_dir)
    assert dict(out.dtypes)["a"] == "array<map<string,struct<x:double,y:array<date>>>>"
    got = [r.a for r in sorted(out.collect(), key=lambda r: r.i)]
    assert got == [[], [None], [{}], [{"k": None}], [{"k": (None, None)}], [{"k": (None, [])}, None], [{"k": (1.5, [dt.date(2020, 1, 1)])}], None]


def test_mixed_records_and_long_decimals(spark, tmp_dir):
    rows = [Row(a=1, b="x"), {"b": "y", "c": decimal.Decimal("0.1234567890123456785")}, Row(c=decimal.Decimal(7), a=None)]
    out = rdd_to_frame(spark.sparkContext.parallelize(rows, 1), temp_dir=tmp_dir)
    assert out.columns == ["a", "b", "c"]
    assert {tuple(r) for r in out.collect()} == {(1, "x", None), (None, "y", decimal.Decimal("0.123456789012345679")), (None, None, decimal.Decimal(7))}


def test_batches_are_bounded_by_bytes():
    big = [{"s": "x" * 300_000, "i": i} for i in range(400)]
    sizes = [len(b) for _, _, _, b in records.encode_records(0, big)]
    assert sum(n for _, _, n, _ in records.encode_records(0, big)) == 400 and max(sizes[1:]) < 2 * records.BATCH_BYTES
    # the same records whichever way they are cut
    small = [{"i": i} for i in range(25_000)]
    assert [n for _, _, n, _ in records.encode_records(3, small)][:2] == [256, 1024]
