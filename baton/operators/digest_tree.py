"""A tree of digests over the buckets of a snapshot, for verification that reads only what differs.

A snapshot written with ``digest_by`` lies in buckets, one folder each: the hash of the values of
some SQL expressions over its columns (of the whole row, if there are none).  The leaf of a
bucket is its number of rows and the sums of four 64-bit hashes of each row; an inner node is the
SHA-256 of the leaves of neighbouring buckets; the root is that of the nodes.  Root and nodes (at
most ``NODES``) lie in the manifest, the leaves in a small table next to the data.

Two snapshots with the same expressions and number of buckets are compared from the root down: if
the roots are equal no table is read; else only leaves below unequal nodes are, and of the data
only the unequal buckets.  A change is found in few buckets if the expressions keep together what
changes together: a day, a tenant, a range of keys.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.functions.row_forms import form, hashed_whole, marked, renamed
from baton.operators.rowcodec import quote

BUCKET = "baton_bucket"
LEAVES = "_digests"
BUCKETS, MOST_BUCKETS, NODES = 256, 10_000, 256
_SUMS = [f"s{i}" for i in range(8)]


def _marked_columns(df: DataFrame, columns: dict[str, Column]) -> list[Column]:
    """Columns in the form that hashes tell apart."""
    kinds = df.select(*[c.alias(n) for n, c in columns.items()]).schema
    forms = {n: form(c, kinds[n].dataType) for n, c in columns.items()}
    formed = df.select(*[c.alias(n) for n, c in forms.items()]).schema
    unknown = [n for n in columns if not hashed_whole(formed[n].dataType)]
    if unknown:
        raise TypeError(f"digests cannot tell the values of {unknown} apart; write the snapshot without")
    named = {n: renamed(formed[n].dataType) for n in columns}
    return [marked(forms[n].cast(named[n]), named[n]) for n in columns]


def bucket_column(df: DataFrame, by: list[str], buckets: int) -> Column:
    """The bucket of each row of ``df``."""
    columns = {f"e{i}": F.expr(text) for i, text in enumerate(by)} if by else {n: quote(n) for n in sorted(df.columns)}
    return F.pmod(F.xxhash64(F.struct(*_marked_columns(df, columns))), F.lit(buckets)).cast("int")


def check_tree(df: DataFrame, by: list[str], buckets: int) -> None:
    """Raise early where a snapshot cannot have a digest tree."""
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}, got {buckets}")
    if BUCKET in df.columns:
        raise ValueError(f"a column is called {BUCKET} already")
    _marked_columns(df, {n: quote(n) for n in df.columns})
    bucket_column(df, by, buckets)


def leaves(df: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, n, s0, ..., s7): rows and sums of the halves of four row hashes of each bucket.  A
    sum that no long holds is a value that equals no other."""
    names = sorted(n for n in df.columns if n != BUCKET)
    row = F.struct(*_marked_columns(df, {n: quote(n) for n in names}))
    hashed = df.select(bucket.alias("bucket"), row.alias("row")).select(
        "bucket", *[F.xxhash64(F.lit(i), F.col("row"), F.lit(i)).alias(f"h{i}") for i in range(4)])
    halves = [h for i in range(4) for h in (F.col(f"h{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"h{i}", 32))]
    odd = F.lit(f"beyond a long {uuid.uuid4().hex}")
    return hashed.groupBy("bucket").agg(F.count("*").alias("n"), *[F.try_sum(h).alias(s) for h, s in zip(halves, _SUMS)]).select(
        "bucket", "n", *[F.coalesce(F.col(s).cast("string"), odd).alias(s) for s in _SUMS])


def node_of(buckets: int) -> Column:
    return F.floor(F.col("bucket") / F.lit(-(-buckets // NODES))).cast("int")


def nodes(leaf_table: DataFrame, buckets: int) -> dict[str, str]:
    """The inner nodes over the leaves: their digests by number."""
    line = F.concat_ws(":", F.lpad(F.col("bucket").cast("string"), 9, "0"), "n", *_SUMS)
    rows = leaf_table.groupBy(node_of(buckets).alias("node")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), ","), 256).alias("digest"))
    return {str(r.node): r.digest for r in rows.collect()}


def root(node_digests: dict[str, str]) -> str:
    return hashlib.sha256(",".join(f"{k}:{node_digests[k]}" for k in sorted(node_digests, key=int)).encode()).hexdigest()


def build_tree(spark: SparkSession, path: str, stored: DataFrame, by: list[str], buckets: int) -> dict:
    """Write the leaves of the rows stored under ``path``; the manifest's entry of the tree."""
    leaves(stored, F.col(BUCKET)).write.parquet(f"{path.rstrip('/')}/{LEAVES}")
    found = nodes(open_leaves(spark, path), buckets)
    return {"by": list(by), "buckets": buckets, "nodes": found, "root": root(found)}


def open_leaves(spark: SparkSession, path: str) -> DataFrame:
    schema = "bucket int, n bigint, " + ", ".join(f"{s} string" for s in _SUMS)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{LEAVES}")


def unequal(a: DataFrame, b: DataFrame) -> list[int]:
    """The buckets whose leaves differ; one without rows has none."""
    left, right = (df.select("bucket", F.struct("n", *_SUMS).alias(side)) for df, side in ((a, "l"), (b, "r")))
    rows = left.join(right, "bucket", "full").where(~F.col("l").eqNullSafe(F.col("r")))
    return sorted(r[0] for r in rows.select("bucket").collect())
