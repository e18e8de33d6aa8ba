"""Taps and files as a table (S1-S3, S5-S7, P3, P4)."""

from __future__ import annotations

import os

import pytest

from baton import conform, file_sizes, list_files, open_table, open_typed, read_files, resolve_path
from tests.conftest import SF0001


def touch(path, data=b""):
    with open(path, "wb") as fh:
        fh.write(data)


def test_glob_matches_full_paths(spark, tmp_dir):
    d = os.path.join(tmp_dir, "test")
    os.makedirs(d)
    for n in ("foo1", "foo2", "foo3", "foobar"):
        touch(os.path.join(d, n))
    got = sorted(r.path for r in list_files(spark, f"{d}/foo[1-9]").collect())
    assert len(got) == 3
    assert [p.split(":", 1)[1] for p in got] == [f"{d}/foo{i}" for i in (1, 2, 3)]
    assert all(p.startswith("file:") for p in got)


def test_glob_without_match_is_empty_unless_strict(spark, tmp_dir):
    assert list_files(spark, f"{tmp_dir}/nothing*").count() == 0
    assert list_files(spark, f"{tmp_dir}/nothing*").columns == ["path", "modified", "size_bytes", "is_dir"]
    assert file_sizes(spark, f"{tmp_dir}/missing").count() == 0
    with pytest.raises(Exception):
        file_sizes(spark, f"{tmp_dir}/missing", strict=True)


def test_text_blob_read_and_size(spark, tmp_dir):
    p = os.path.join(tmp_dir, "foobar")
    touch(p, "ala ma kota".encode("utf-8"))
    row = read_files(spark, p).first()
    assert bytes(row.content).decode("utf-8") == "ala ma kota"
    assert file_sizes(spark, p).first().size_bytes == 11


def test_empty_files_and_folders(spark, tmp_dir):
    d = os.path.join(tmp_dir, "mix")
    os.makedirs(os.path.join(d, "sub"))
    touch(os.path.join(d, "empty"))
    touch(os.path.join(d, "full"), b"abc")
    listed = {r.path.split(":", 1)[1]: r for r in list_files(spark, f"{d}/*").collect()}
    assert sorted(listed) == [f"{d}/empty", f"{d}/full", f"{d}/sub"]
    assert [listed[k].is_dir for k in sorted(listed)] == [False, False, True]
    assert listed[f"{d}/full"].size_bytes == 3 and listed[f"{d}/empty"].size_bytes == 0
    sizes = {r.path.split(":", 1)[1]: r.size_bytes for r in file_sizes(spark, f"{d}/*").collect()}
    assert sizes == {f"{d}/empty": 0, f"{d}/full": 3}
    contents = {r.path.split(":", 1)[1]: bytes(r.content) for r in read_files(spark, f"{d}/*").collect()}
    assert contents == {f"{d}/empty": b"", f"{d}/full": b"abc"}


def test_contents_are_read_by_a_distributed_scan(spark):
    from baton.plans import plan_text
    text = plan_text(read_files(spark, f"{SF0001}/*.parquet"))
    assert "binaryFile" in text or "BinaryFile" in text


def test_open_table_and_typed(spark):
    spark.read.parquet(f"{SF0001}/nation.parquet").createOrReplaceTempView("t_nation")
    assert open_table(spark, "t_nation").count() == 25
    typed = open_typed(spark, "t_nation", "n_name string, n_nationkey bigint")
    assert typed.columns == ["n_name", "n_nationkey"]
    assert typed.schema["n_nationkey"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        open_table(spark, "")
    with pytest.raises(ValueError):
        open_table(spark, "   ")


def test_typed_open_keeps_pruning(spark):
    from baton.plans import plan_text
    spark.read.parquet(f"{SF0001}/lineitem.parquet").createOrReplaceTempView("t_lineitem")
    typed = open_typed(spark, "t_lineitem", "l_orderkey bigint, l_quantity double").where("l_quantity > 49")
    text = plan_text(typed)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "GreaterThan(l_quantity,49.0)" in text


def test_conform_rules(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, extra double")
    out = conform(df, "b string, a bigint, missing string")
    assert out.columns == ["b", "a", "missing"]
    assert out.first() == ("a", 1, None)
    nested = spark.range(1).selectExpr("named_struct('y', 2, 'x', 1) AS s")
    assert conform(nested, "s struct<x: int, y: int>").first()[0].asDict() == {"x": 1, "y": 2}
    with pytest.raises(Exception):
        conform(df, "b int")  # string -> int is not a safe cast
    from pyspark.sql import types as T
    required = T.StructType([T.StructField("nope", T.StringType(), False)])
    with pytest.raises(Exception):
        conform(df, required)


@pytest.mark.parametrize("base,other,expected", [
    ("/bar", "/test/foo", "/test/foo"),
    ("bar", "/test/foo", "/test/foo"),
    ("/bar", "", "/bar"),
    ("bar", "", "bar"),
    ("/bar", "test/foo", "/bar/test/foo"),
    ("bar", "test/foo", "bar/test/foo"),
    ("", "x", "x"),
])
def test_resolve_path(spark, base, other, expected):
    df = spark.createDataFrame([(base, other)], "base string, other string")
    assert df.select(resolve_path("base", "other")).first()[0] == expected


def test_resolve_path_is_the_hadoop_join(spark):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    bases = ["/bar", "bar", "/bar/", "/", "/a/b", "file:///a//b", "hdfs://h/a/", "hdfs://h", "s3://b/x/../y", "/a/./b//c/..", "a/b/..", "file:/a"]
    others = ["/test/foo", "test/foo", "x//y/", "c", "../x", "./x", "x/../y", "..", "../..", "../../..", "s3://bucket", "s3://bucket/",
              "gs://bucket/k/../z", "file:/q", "file:///q/r", "/", "/..", "/a/../b", "x/.", "//host/p", "a b", "...", ".x", "x..", "%20"]
    pairs = [(b, o, path(path(b), path(o)).toString()) for b in bases for o in others]
    df = spark.createDataFrame(pairs, "b string, o string, want string").withColumn("got", resolve_path("b", "o"))
    assert [tuple(r) for r in df.where("got <> want OR got IS NULL").collect()] == []


@pytest.mark.parametrize("other", ["file:x", "x:y"])
def test_resolve_path_rejects_a_relative_path_with_a_scheme(spark, other):
    with pytest.raises(Exception, match="relative path with a scheme"):
        spark.createDataFrame([("/a", other)], "b string, o string").select(resolve_path("b", "o")).collect()


def test_read_files_takes_names_literally(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/sub")
    for name in ("x[1].bin", "x1.bin", "a{b,c}.bin", "q?.bin", "plain.bin"):
        touch(f"{tmp_dir}/{name}", name.encode())
    got = {bytes(r.content).decode(): os.path.basename(r.path) for r in read_files(spark, f"{tmp_dir}/*").collect()}
    assert sorted(got) == ["a{b,c}.bin", "plain.bin", "q?.bin", "x1.bin", "x[1].bin"]
    assert read_files(spark, f"{tmp_dir}/*").count() == 5
    assert {r.size_bytes for r in file_sizes(spark, f"{tmp_dir}/x*").collect()} == {8, 6}


def test_read_files_does_not_skip_hidden_matches(spark, tmp_dir):
    touch(f"{tmp_dir}/_hid.bin", b"x")
    assert list_files(spark, f"{tmp_dir}/_hid.bin").first().size_bytes == 1
    with pytest.raises(ValueError, match="hidden"):
        read_files(spark, f"{tmp_dir}/_hid.bin")


def test_listing_reads_no_content(spark):
    from baton.plans import plan_text
    text = plan_text(file_sizes(spark, f"{SF0001}/*.parquet"))
    assert "ReadSchema: struct<path:string,length:bigint>" in text


def test_open_table_through_a_connector(spark):
    from pyspark.sql.datasource import DataSource, DataSourceReader

    class Numbers(DataSource):
        @classmethod
        def name(cls):
            return "numbers_for_test"

        def schema(self):
            return "i int, t string"

        def reader(self, schema):
            table, n = self.options["table"], int(self.options["n"])

            class Reader(DataSourceReader):
                def read(self, partition):
                    return iter([(i, table) for i in range(n)])

            return Reader()

    spark.dataSource.register(Numbers)
    assert [tuple(r) for r in open_table(spark, "tab", format="numbers_for_test", n="2").collect()] == [(0, "tab"), (1, "tab")]
    assert open_typed(spark, "tab", "i bigint", format="numbers_for_test", n="3").count() == 3


def test_file_sizes_of_tables_that_are_folders(spark, tmp_path):
    from baton.plans import catalog
    root = tmp_path / "a +b"
    counts = {}
    for t in catalog.FILES:
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        counts[t] = rows.count()
        rows.repartition(3).write.parquet(f"{root}/{t}.parquet")
    got = {r.name: (r.sizes_agree, r.n_rows) for r in catalog.queries()["file_sizes_agree"](spark, str(root)).collect()}
    assert got == {t: (True, n) for t, n in counts.items()}
