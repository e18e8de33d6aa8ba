"""The registered queries: each operator run over whole driver tables.

Every entry is a function ``(spark, sf_dir) -> DataFrame`` paired with a
DuckDB query over the same tables that must give the same rows.  Snapshot
writes are eager (they run while the query is built, as a handover does);
everything after them is a lazy frame over the stored rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.functions import decode_utf8, encode_utf8, resolve_path
from baton.operators import (
    conform,
    conform_split,
    decode_rows,
    encode_rows,
    frame_diff,
    open_rdd_snapshot,
    rdd_to_frame,
    snapshot,
    snapshot_all,
    snapshot_async,
    snapshot_diff,
    snapshot_path,
    snapshot_rdd,
)
from baton.session import list_folder, new_snapshot_path
from baton.sinks import lease_snapshot, release_snapshot, save_text, sweep_snapshots, write_snapshot
from baton.sources import file_sizes, list_files, open_snapshot, open_table, open_text, open_typed, open_typed_split, read_files, read_ranges, walk_files

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = " ".join(oracle.split())
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Expose a driver table in the catalog as ``baton_<name>``."""
    ref = f"baton_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(ref)
    return ref


FILES = ("lineitem", "orders", "documents", "pages")


def _file_name(col) -> Column:
    return F.regexp_extract(col, r"([^/]+)[.]parquet(?:/[^/]+)?$", 1)


# --- T1 + P5: the README example, hand over then map --------------------------

@register("handover_double", """
    SELECT l_orderkey, l_linenumber, l_quantity * 2 AS quantity_x2 FROM lineitem""")
def handover_double(spark, sf_dir):
    handed = snapshot(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
    return handed.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("quantity_x2"))


# --- K1 + S4 (+ P1/P2): snapshot codecs ---------------------------------------

@register("snapshot_parquet_roundtrip", "SELECT * FROM embeddings")
def snapshot_parquet_roundtrip(spark, sf_dir):
    return snapshot(table(spark, sf_dir, "embeddings"))


@register("snapshot_json_roundtrip", "SELECT * FROM orders")
def snapshot_json_roundtrip(spark, sf_dir):
    return snapshot(table(spark, sf_dir, "orders"), codec="json")


@register("snapshot_json_events", "SELECT * FROM events")
def snapshot_json_events(spark, sf_dir):
    # ts carries microseconds, which the default JSON format would drop
    return snapshot(table(spark, sf_dir, "events"), codec="json")


@register("snapshot_json_documents", "SELECT * FROM documents")
def snapshot_json_documents(spark, sf_dir):
    # multi-line texts: still one line per row on disk
    return snapshot(table(spark, sf_dir, "documents"), codec="json")


@register("snapshot_json_pages", "SELECT * FROM pages")
def snapshot_json_pages(spark, sf_dir):
    return snapshot(table(spark, sf_dir, "pages"), codec="json")


@register("snapshot_json_embeddings", "SELECT * FROM embeddings")
def snapshot_json_embeddings(spark, sf_dir):
    return snapshot(table(spark, sf_dir, "embeddings"), codec="json")


@register("snapshot_utf8_text", "SELECT text FROM documents")
def snapshot_utf8_text(spark, sf_dir):
    return snapshot(table(spark, sf_dir, "documents").select("text"), codec="utf8")


@register("snapshot_tagged_maps", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS quantity, l_shipdate AS shipped
    FROM lineitem""")
def snapshot_tagged_maps(spark, sf_dir):
    # an order's lines as a map from numbers to quantities, keyed by a struct in turn; through text
    # lines and back, then flat again
    line = F.create_map("l_linenumber", F.create_map(F.struct("l_shipdate", "l_orderkey"), F.col("l_quantity")))
    handed = snapshot(table(spark, sf_dir, "lineitem").select(line.alias("m")), codec="tagged")
    outer = handed.select(F.explode("m").alias("line", "inner"))
    flat = outer.select("line", F.explode("inner").alias("k", "quantity"))
    return flat.select("k.l_orderkey", F.col("line").cast("bigint").alias("line"), "quantity", F.col("k.l_shipdate").alias("shipped"))


@register("tagged_intervals", """
    SELECT event_id, epoch_us(TIMESTAMP '1970-01-01' + to_months(CAST(user_id % 50 AS INTEGER)) + (ts - TIMESTAMP '1970-01-01')) AS micros,
           CAST(user_id % 50 AS BIGINT) AS months FROM events""")
def tagged_intervals(spark, sf_dir):
    # instants as calendar intervals since 1970, encoded and decoded, and added to a day again
    since = F.expr("make_interval(0, CAST(user_id % 50 AS INT), 0, 0, 0, 0, CAST(unix_micros(CAST(ts AS TIMESTAMP)) / CAST(1000000 AS DECIMAL(20, 6)) AS DECIMAL(18, 6)))")
    rows = table(spark, sf_dir, "events").select("event_id", since.alias("since"))
    back = decode_rows(encode_rows(rows, "tagged"), rows.schema, "tagged")
    return back.select("event_id", F.expr("unix_micros(CAST(TIMESTAMP_NTZ '1970-01-01 00:00:00' + since AS TIMESTAMP))").alias("micros"),
                       F.expr("extract(YEAR FROM since) * 12 + extract(MONTH FROM since)").cast("bigint").alias("months"))


@register("snapshot_foreign_open", "SELECT * FROM part")
def snapshot_foreign_open(spark, sf_dir):
    # a folder written by plain Spark: no manifest, opened on its _SUCCESS
    path = new_snapshot_path(spark)
    table(spark, sf_dir, "part").write.parquet(path)
    return open_snapshot(spark, path)


@register("snapshot_reopen_manifest", "SELECT * FROM conversations")
def snapshot_reopen_manifest(spark, sf_dir):
    # reopened by path alone, as another session would: codec and schema
    # come from the snapshot's manifest
    path = write_snapshot(table(spark, sf_dir, "conversations"), codec="json")
    return open_snapshot(spark, path)


@register("snapshot_bounded_files", "SELECT * FROM events")
def snapshot_bounded_files(spark, sf_dir):
    # files bounded by rows and gzip-compressed: each file is one reader task
    return snapshot(table(spark, sf_dir, "events"), codec="json",
                    max_records_per_file=25_000, compression="gzip")


@register("snapshot_sharded", """
    SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linenumber <= 3 THEN 'hot' ELSE l_returnflag END AS mode FROM lineitem""")
def snapshot_sharded(spark, sf_dir):
    # files of about 256 kB, clustered by a column of which one value holds most rows
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.when(F.col("l_linenumber") <= 3, "hot").otherwise(F.col("l_returnflag")).alias("mode"))
    return snapshot(li, target_file_bytes=256 << 10, cluster_by=["mode", "l_orderkey"])


@register("snapshot_json_subset", "SELECT l_quantity, l_orderkey, l_shipdate FROM lineitem")
def snapshot_json_subset(spark, sf_dir):
    # three of eleven columns, in another order: only those are decoded
    li = table(spark, sf_dir, "lineitem")
    path = write_snapshot(li, codec="json")
    return open_snapshot(spark, path, T.StructType([li.schema[c] for c in ("l_quantity", "l_orderkey", "l_shipdate")]))


@register("text_foreign_names", "SELECT * FROM orders")
def text_foreign_names(spark, sf_dir):
    # a folder of another writer: no manifest, lines keyed by column name
    orders = table(spark, sf_dir, "orders")
    path = new_snapshot_path(spark)
    encode_rows(orders, keys="name").write.text(path)
    return open_snapshot(spark, path, orders.schema, "json", keys="name")


@register("text_lines_decode", "SELECT * FROM orders")
def text_lines_decode(spark, sf_dir):
    # how another session reads a text snapshot: open the lines, decode them
    # with the schema it was handed
    orders = table(spark, sf_dir, "orders")
    path = write_snapshot(orders, codec="json")
    return decode_rows(open_text(spark, path), orders.schema, "json")


# --- T2: concurrent handovers --------------------------------------------------

@register("snapshot_async_pair", """
    SELECT s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
    UNION ALL
    SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer""")
def snapshot_async_pair(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    cus = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"))
    a, b = snapshot_all([sup, cus], codec="json")
    return a.unionByName(b)


@register("snapshot_async_cancelled", "SELECT c_custkey, c_acctbal, CAST(0 AS BIGINT) AS left_behind FROM customer")
def snapshot_async_cancelled(spark, sf_dir):
    # two writes at once, of which one is cancelled: it leaves nothing, the other is whole
    root = new_snapshot_path(spark)
    doomed = snapshot_async(table(spark, sf_dir, "lineitem").repartition(4), root, codec="json")
    kept = snapshot_async(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"))
    if not doomed.cancel():  # it was done already
        release_snapshot(spark, snapshot_path(doomed.result()))
    return kept.result().withColumn("left_behind", F.lit(len(list_folder(spark, root))).cast("bigint"))


# --- K1: lifecycle ---------------------------------------------------------------

@register("snapshot_sweep", """
    SELECT n_nationkey, n_name, 'held' AS outcome, CAST(2 AS BIGINT) AS swept FROM nation""")
def snapshot_sweep(spark, sf_dir):
    # of three snapshots a sweep removes the two that nobody holds
    root = new_snapshot_path(spark)
    nation = table(spark, sf_dir, "nation")
    paths = [write_snapshot(nation.select("n_nationkey", "n_name"), root) for _ in range(3)]
    with lease_snapshot(spark, paths[1], 600):
        rows = sweep_snapshots(spark, root, older_than=0).collect()
    outcome = {r.path: r.outcome for r in rows}
    return open_snapshot(spark, paths[1]).select("n_nationkey", "n_name", F.lit(outcome[paths[1]]).alias("outcome"),
                                                 F.lit(sum(o == "removed" for o in outcome.values())).cast("bigint").alias("swept"))


# --- T3: RDD handovers -----------------------------------------------------------

@register("rdd_handover", "SELECT * FROM nation")
def rdd_handover(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    return rdd_to_frame(nation.rdd, nation.schema, spark=spark)


@register("rdd_pickle_handover", "SELECT p_partkey, p_name FROM part")
def rdd_pickle_handover(spark, sf_dir):
    objs = table(spark, sf_dir, "part").select("p_partkey", "p_name").rdd.map(
        lambda r: {"key": r[0], "name": r[1]})
    back = snapshot_rdd(objs, spark=spark)
    return spark.createDataFrame(back.map(lambda d: (d["key"], d["name"])),
                                 "p_partkey bigint, p_name string")


@register("rdd_dict_handover", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN l_quantity END AS quantity FROM lineitem")
def rdd_dict_handover(spark, sf_dir):
    # dicts of which some lack a key; the schema is inferred from all of them
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    dicts = li.rdd.map(lambda r: {"l_orderkey": r[0], "l_linenumber": r[1]} | ({"quantity": r[2]} if r[1] > 1 else {}))
    out = rdd_to_frame(dicts, spark=spark)
    return out.select("l_orderkey", F.col("l_linenumber").cast(li.schema["l_linenumber"].dataType).alias("l_linenumber"), "quantity")


@register("rdd_nested_handover", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 > 1 THEN o_totalprice END AS total,
           CAST(o_orderkey % 3 AS BIGINT) AS n_tags, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS first_date FROM orders""")
def rdd_nested_handover(spark, sf_dir):
    # rows, lists and maps inside of dicts; some records lack fields, at the top and below, so that
    # no task sees the whole type of every one
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")

    def record(r):
        n = r[0] % 3
        info = Row(status=r[1], total=r[2]) if n > 1 else Row(status=r[1]) if n else None
        return {"key": r[0], "tags": [{"date": r[3]}] * n} | ({"info": info} if n else {})

    out = rdd_to_frame(orders.rdd.map(record), spark=spark)
    return out.select(F.col("key").alias("o_orderkey"), "info.status", "info.total", F.size("tags").cast("bigint").alias("n_tags"),
                      F.get("tags", F.lit(0))["date"].cast(orders.schema["o_orderdate"].dataType).alias("first_date"))


@register("rdd_pickle_reopen", "SELECT p_partkey, p_name FROM part")
def rdd_pickle_reopen(spark, sf_dir):
    objs = table(spark, sf_dir, "part").select("p_partkey", "p_name").rdd.map(lambda r: {"key": r[0], "name": r[1]})
    path = snapshot_path(snapshot_rdd(objs, spark=spark))
    again = open_rdd_snapshot(spark, path)  # by its path alone, as another session would
    return spark.createDataFrame(again.map(lambda d: (d["key"], d["name"])), "p_partkey bigint, p_name string")


@register("handover_there_and_back", "SELECT * FROM customer")
def handover_there_and_back(spark, sf_dir):
    first = snapshot(table(spark, sf_dir, "customer"), codec="json")
    return rdd_to_frame(first.rdd, first.schema, spark=spark)


# --- P1 / P2: the row codec on its own ----------------------------------------

@register("encode_names", "SELECT p_partkey, to_base64(encode(p_name)) AS value FROM part")
def encode_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", encode_utf8(F.col("p_name")).alias("value"))


@register("decode_names", "SELECT p_partkey, p_name FROM part")
def decode_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    lines = part.select("p_partkey", encode_utf8(F.col("p_name")).alias("value"))
    return lines.select("p_partkey", decode_utf8(F.col("value")).alias("p_name"))


@register("decode_rows_lineitem", "SELECT * FROM lineitem")
def decode_rows_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return decode_rows(encode_rows(li, "json"), li.schema, "json")


# --- K2 + S1: saved text ---------------------------------------------------------

@register("text_reopen", "SELECT c_name AS value FROM customer")
def text_reopen(spark, sf_dir):
    path = new_snapshot_path(spark)
    save_text(table(spark, sf_dir, "customer").select("c_name"), path)
    return open_text(spark, path)


@register("text_reopen_doubled", "SELECT CAST(l_linenumber * 2 AS VARCHAR) AS value FROM lineitem")
def text_reopen_doubled(spark, sf_dir):
    # README example end to end: hand over, double, save as text, re-open
    handed = snapshot(table(spark, sf_dir, "lineitem").select("l_linenumber"))
    path = new_snapshot_path(spark)
    save_text(handed.select((F.col("l_linenumber") * 2).alias("v")), path)
    return open_text(spark, path)


# --- S2 / S3 / P3: catalog tables ----------------------------------------------------

@register("table_open", "SELECT * FROM nation")
def table_open(spark, sf_dir):
    return open_table(spark, _view(spark, sf_dir, "nation"))


@register("typed_open", "SELECT n_name, CAST(n_nationkey AS BIGINT) AS n_nationkey FROM nation")
def typed_open(spark, sf_dir):
    return open_typed(spark, _view(spark, sf_dir, "nation"), "n_name string, n_nationkey bigint")


@register("typed_open_lineitem", """
    SELECT l_shipdate, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
    FROM lineitem""")
def typed_open_lineitem(spark, sf_dir):
    schema = "l_shipdate timestamp_ntz, l_orderkey bigint, l_linenumber bigint, l_quantity double"
    return open_typed(spark, _view(spark, sf_dir, "lineitem"), schema)


@register("conform_nested", """
    SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS total FROM orders""")
def conform_nested(spark, sf_dir):
    # nested fields matched by name: the struct is built in another order,
    # with an extra field; the conformed struct is then flattened
    src = table(spark, sf_dir, "orders").select(
        F.struct(F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("date"),
                 F.col("o_orderstatus").alias("status")).alias("info"),
        "o_orderkey")
    typed = conform(src, "o_orderkey bigint, info struct<status: string, total: double>")
    return typed.select("o_orderkey", "info.status", "info.total")


def _orders_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a date as a list of its parts and a priority as code and name, all text."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("total"),
        F.split(F.date_format("o_orderdate", "yyyy-MM-dd"), "-").alias("day"),
        F.struct(F.split("o_orderpriority", "-", 2).alias("parts"), F.col("o_custkey").alias("customer")).alias("info"))


@register("conform_accepted", """
    SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS total, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders WHERE o_totalprice = floor(o_totalprice)""")
def conform_accepted(spark, sf_dir):
    kept, _ = conform_split(_orders_parts(spark, sf_dir), "o_orderkey bigint, total bigint, day array<int>")
    return kept.select("o_orderkey", "total", F.col("day")[0].alias("year"), F.col("day")[1].alias("month"))


@register("conform_rejected", """
    SELECT o_orderkey, 'total' AS field, 'lossy' AS reason, NULL AS value FROM orders WHERE o_totalprice <> floor(o_totalprice)
    UNION ALL
    SELECT o_orderkey, 'info.parts[1]', 'cast', substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) FROM orders""")
def conform_rejected(spark, sf_dir):
    wanted = "o_orderkey bigint, total bigint, day array<int>, info struct<parts: array<int>, customer: string, later: date>"
    _, left = conform_split(_orders_parts(spark, sf_dir), wanted)
    why = left.select("o_orderkey", F.inline("reasons"))
    return why.select("o_orderkey", "field", "reason", F.when(F.col("reason") == "cast", F.col("value")).alias("value"))


@register("typed_open_split", """
    SELECT p_partkey, p_name, CAST(p_partkey > 127 AS INTEGER) + CAST(p_retailprice <> floor(p_retailprice) AS INTEGER) AS n_reasons
    FROM part""")
def typed_open_split(spark, sf_dir):
    ref = _view(spark, sf_dir, "part")
    kept, left = open_typed_split(spark, ref, "p_partkey tinyint, p_name string, p_retailprice int")
    kept = kept.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_name", F.lit(0).alias("n_reasons"))
    left = left.select("p_partkey", "p_name", F.size("reasons").alias("n_reasons"))
    return kept.unionByName(left)


# --- S5 / S6 / S7: files as a table ----------------------------------------------

@register("rows_per_file", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in FILES))
def rows_per_file(spark, sf_dir):
    # which rows came from which listed file: the listing joined to the tables' own scans
    listed = list_files(spark, f"{sf_dir.rstrip('/')}/*.parquet").select(_file_name("path").alias("name")).distinct()
    counts = None
    for t in FILES:
        one = table(spark, sf_dir, t).groupBy(_file_name(F.col("_metadata.file_path")).alias("name")).agg(F.count("*").alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    return listed.hint("merge").join(counts.hint("merge"), "name")


@register("file_sizes_agree", " UNION ALL ".join(
    f"SELECT '{t}' AS name, true AS sizes_agree, count(*) AS n_rows FROM {t}" for t in FILES))
def file_sizes_agree(spark, sf_dir):
    # the listed size of each file is the size its scan sees; a table is a file or a folder of them
    listed = file_sizes(spark, f"{sf_dir.rstrip('/')}/*.parquet", recursive=True)
    seen = None
    for t in FILES:
        p = F.col("_metadata.file_path")  # escaped, as paths of a listing are not
        one = table(spark, sf_dir, t).groupBy(F.lit(t).alias("name"), F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))).alias("path")).agg(
            F.max("_metadata.file_size").alias("size"), F.count("*").alias("n"))
        seen = one if seen is None else seen.unionByName(one)
    return seen.hint("merge").join(listed.hint("merge"), "path", "left").groupBy("name").agg(
        F.bool_and(F.coalesce(F.col("size_bytes") == F.col("size"), F.lit(False))).alias("sizes_agree"), F.sum("n").alias("n_rows"))


@register("file_contents", "SELECT p_partkey, p_name AS content FROM part")
def file_contents(spark, sf_dir):
    # a table saved as one file per row group, read back as bytes and split into its lines again
    path = new_snapshot_path(spark)
    part = table(spark, sf_dir, "part")
    save_text(part.select(F.concat_ws("\t", "p_partkey", "p_name").alias("line")), path)
    lines = read_files(spark, f"{path}/part-*").select(F.explode(F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n")).alias("line"))
    pair = F.split("line", "\t")
    return lines.where("line <> ''").select(pair[0].cast("bigint").alias("p_partkey"), pair[1].alias("content"))


@register("file_tree", """
    SELECT l_returnflag, l_linestatus, true AS sizes_agree, count(*) AS n_rows FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def file_tree(spark, sf_dir):
    # a table saved as a tree of folders, walked by tasks: the files of each folder and their rows
    path = new_snapshot_path(spark)
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").write.partitionBy("l_returnflag", "l_linestatus").parquet(path)
    listed = walk_files(spark, f"{path}/l_returnflag=*/l_linestatus=*/*.parquet").select(F.url_decode(F.regexp_extract("path", "([^/]+)$", 1)).alias("file"), "size_bytes")
    seen = spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus", F.url_decode(F.col("_metadata.file_name")).alias("file")).agg(
        F.max("_metadata.file_size").alias("size"), F.count("*").alias("n"))
    # a task's files in different folders may share a name, but then not a size
    pairs = seen.hint("merge").join(listed.hint("merge"), [seen["file"] == listed["file"], seen["size"] == listed["size_bytes"]], "left")
    each = pairs.groupBy("l_returnflag", "l_linestatus", seen["file"]).agg(F.max("n").alias("n"), F.count("size_bytes").alias("found"))
    return each.groupBy("l_returnflag", "l_linestatus").agg(F.bool_and(F.col("found") > 0).alias("sizes_agree"), F.sum("n").alias("n_rows"))


@register("file_ranges", "SELECT p_partkey, p_name AS content FROM part")
def file_ranges(spark, sf_dir):
    # text files read in ranges that cut lines, joined to lines again: each range gives its part up
    # to the first line end to the range before
    path = new_snapshot_path(spark)
    save_text(table(spark, sf_dir, "part").select(F.concat_ws("\t", "p_partkey", "p_name").alias("line")), path)
    # a line no longer than a range lies in two of them at most
    longest = open_text(spark, path).agg(F.max(F.octet_length("value"))).first()[0] or 0
    size = max(1000, longest + 1)
    text = read_ranges(spark, f"{path}/part-*", range_bytes=size).where("size_bytes > 0").select("path", "offset", "content")
    head = F.substring_index(F.col("content").cast("string"), "\n", 1)
    nexts = text.select("path", (F.col("offset") - size).alias("offset"), head.cast("binary").alias("head")).where("offset >= 0")
    joined = text.hint("merge").join(nexts.hint("merge"), ["path", "offset"], "left")
    own = F.when(F.col("offset") == 0, F.col("content")).otherwise(F.substr("content", F.octet_length(head) + 2))
    lines = joined.select(F.explode(F.split(F.concat(own, F.coalesce("head", F.lit(b""))).cast("string"), "\n")).alias("line")).where("line <> ''")
    pair = F.split("line", "\t")
    return lines.select(pair[0].cast("bigint").alias("p_partkey"), pair[1].alias("content"))


# --- P4: path resolution -----------------------------------------------------------

@register("path_resolve", """
    SELECT p_partkey,
           CASE p_size % 3 WHEN 0 THEN '/data/'
                           WHEN 1 THEN '/' || p_brand
                           ELSE '/data/' || p_brand END AS resolved
    FROM part""")
def path_resolve(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    other = (F.when(F.col("p_size") % 3 == 0, F.lit(""))
             .when(F.col("p_size") % 3 == 1, F.concat(F.lit("/"), F.col("p_brand")))
             .otherwise(F.col("p_brand")))
    return part.select("p_partkey", resolve_path(F.lit("/data/"), other).alias("resolved"))


@register("path_resolve_dots", """
    SELECT p_partkey,
           CASE p_size % 4 WHEN 0 THEN '/data/' || p_brand
                           WHEN 1 THEN '/' || p_brand
                           WHEN 2 THEN 's3://' || replace(p_brand, '#', '')
                           ELSE '/data/set/' || p_brand END AS resolved
    FROM part""")
def path_resolve_dots(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    other = (F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("../"), F.col("p_brand")))
             .when(F.col("p_size") % 4 == 1, F.concat(F.lit("../../"), F.col("p_brand")))
             .when(F.col("p_size") % 4 == 2, F.concat(F.lit("s3://"), F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))))
             .otherwise(F.concat(F.lit("./x/../"), F.col("p_brand"))))
    return part.select("p_partkey", resolve_path(F.lit("/data/set"), other).alias("resolved"))


# --- V1: multiset diff ---------------------------------------------------------------

@register("handover_diff", """
    SELECT o_orderkey, 'left_only' AS side, CAST(1 AS BIGINT) AS n
    FROM orders WHERE o_orderstatus <> 'F'""")
def handover_diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    left = orders.select("o_orderkey")
    right = snapshot(orders.where(F.col("o_orderstatus") == "F").select("o_orderkey"))
    return frame_diff(left, right)


@register("handover_diff_counts", """
    SELECT l_returnflag, l_linestatus, 'left_only' AS side, CAST(COUNT(*) AS BIGINT) AS n
    FROM lineitem WHERE l_discount >= 0.05
    GROUP BY l_returnflag, l_linestatus""")
def handover_diff_counts(spark, sf_dir):
    # few distinct rows, many copies each: counted, not replicated
    li = table(spark, sf_dir, "lineitem")
    left = li.select("l_returnflag", "l_linestatus")
    right = snapshot(li.where(F.col("l_discount") < 0.05).select("l_returnflag", "l_linestatus"), codec="json")
    return frame_diff(left, right)


@register("handover_verify", """
    SELECT *, 'left_only' AS side, CAST(0 AS BIGINT) AS n FROM lineitem WHERE false""")
def handover_verify(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return frame_diff(li, snapshot(li, codec="json"))


@register("handover_verify_counts", """
    SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'right_only' ELSE 'left_only' END AS side,
           CAST(count(*) * (3 - l_linenumber) AS BIGINT) AS n
    FROM lineitem WHERE l_linenumber <= 2 GROUP BY l_orderkey, l_linenumber""")
def handover_verify_counts(spark, sf_dir):
    # a handover that went wrong in a known way: one kind of row three times, another missing
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    wrong = li.where(F.col("l_linenumber") != 2)
    for _ in range(2):
        wrong = wrong.unionByName(li.where(F.col("l_linenumber") == 1))
    return frame_diff(li, snapshot(wrong))


@register("handover_diff_expand", """
    SELECT l_returnflag, l_linestatus, 'right_only' AS side FROM lineitem WHERE l_discount >= 0.05""")
def handover_diff_expand(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    left = snapshot(li.where(F.col("l_discount") < 0.05).select("l_returnflag", "l_linestatus"))
    return frame_diff(left, li.select("l_returnflag", "l_linestatus"), expand=True, chunk_rows=1000)


@register("handover_diff_map", """
    SELECT o_orderkey, o_orderpriority AS priority, 'left_only' AS side, CAST(1 AS BIGINT) AS n
    FROM orders WHERE o_orderstatus = 'P'""")
def handover_diff_map(spark, sf_dir):
    # rows with a map column, whose entries are in another order on the other side
    orders = table(spark, sf_dir, "orders")
    left = orders.select("o_orderkey", F.create_map(F.lit("p"), "o_orderpriority", F.lit("c"), "o_orderstatus").alias("m"))
    right = orders.where(F.col("o_orderstatus") != "P").select(
        "o_orderkey", F.create_map(F.lit("c"), "o_orderstatus", F.lit("p"), "o_orderpriority").alias("m"))
    out = frame_diff(left, snapshot(right))
    return out.select("o_orderkey", F.element_at(F.filter("m", lambda e: e["key"] == "p"), 1)["value"].alias("priority"), "side", "n")


@register("handover_diff_nested", """
    SELECT o_orderkey, side, CAST(1 AS BIGINT) AS n
    FROM orders, (VALUES ('left_only'), ('right_only')) AS s(side) WHERE o_orderstatus <> 'O'""")
def handover_diff_nested(spark, sf_dir):
    # a handover that moved nulls and array bounds about: a null to the next column, an empty
    # array to null, an element to the next array, by the key's rest; open orders stay as they are
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 3).alias("kind"))
    key, none = F.col("o_orderkey"), F.lit(None).cast("bigint")
    nothing = F.lit(None).cast("array<bigint>")

    def rows(moved):
        a = F.when(moved & (F.col("kind") == 0), none).otherwise(key)
        b = F.when(moved & (F.col("kind") == 0), key)
        c = F.when(~moved | (F.col("kind") != 1), F.array().cast("array<bigint>")).otherwise(nothing)
        d = F.when(moved & (F.col("kind") == 2), F.array(F.array(key), F.array(key, key))).otherwise(F.array(F.array(key, key), F.array(key)))
        return orders.select(a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))

    out = frame_diff(rows(F.lit(False)), snapshot(rows(F.col("o_orderstatus") != "O")))
    return out.select(F.col("d")[0][0].alias("o_orderkey"), "side", "n")


@register("handover_tree_diff", """
    SELECT *, CAST(1 AS BIGINT) AS n FROM (
      SELECT o_orderkey, o_totalprice, 'left_only' AS side FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1995-03'
      UNION ALL
      SELECT o_orderkey, o_totalprice + 1, 'right_only' FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1995-03' AND o_orderstatus <> 'F')""")
def handover_tree_diff(spark, sf_dir):
    # two snapshots in buckets by month, of which one month was changed and partly lost: found
    # from their digest trees, and only that bucket is read on both sides
    orders = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM") == "1995-03"
    by = ["date_format(o_orderdate, 'yyyy-MM')"]
    first = write_snapshot(orders, digest_by=by)
    changed = orders.where(~month | (F.col("o_orderstatus") != "F")).withColumn(
        "o_totalprice", F.when(month, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return snapshot_diff(spark, first, write_snapshot(changed, digest_by=by)).select("o_orderkey", "o_totalprice", "side", "n")


@register("handover_tree_verify", """
    SELECT l_orderkey, l_linenumber, l_quantity, 'left_only' AS side, CAST(1 AS BIGINT) AS n FROM lineitem WHERE l_orderkey % 997 = 5""")
def handover_tree_verify(spark, sf_dir):
    # a live table against its snapshot, from which some orders are missing
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    path = write_snapshot(li.where("l_orderkey % 997 <> 5"), digest_by=["l_orderkey"], buckets=128)
    return snapshot_diff(spark, li, path)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
