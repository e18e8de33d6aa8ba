"""Comparison with a snapshot that reads only what its digest tree calls different."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.functions.row_forms import plain
from baton.operators.diff import frame_diff
from baton.operators.digest_tree import bucket_column, leaves, node_of, open_leaves, unequal
from baton.sources.snapshot import open_snapshot, read_manifest


def snapshot_diff(spark: SparkSession, left: str | DataFrame, right: str, expand: bool = False) -> DataFrame:
    """:func:`baton.frame_diff` of a snapshot (its path) or a frame with the snapshot at ``right``.

    Where both snapshots have digest trees over the same expressions and buckets, only leaves
    below unequal nodes and rows of unequal buckets are read.  A frame is read once for its own
    leaves, and then again for the buckets that differ; so it should be one that can be read
    twice.  Without such trees it is a plain ``frame_diff`` of everything.  Rows count as equal if
    their four 64-bit hashes are, as in ``frame_diff``.
    """
    manifest = read_manifest(spark, right) or {}
    tree = manifest.get("tree")
    theirs = open_snapshot(spark, right)
    mine = left if isinstance(left, DataFrame) else open_snapshot(spark, left)
    own = None if isinstance(left, DataFrame) else (read_manifest(spark, left) or {}).get("tree")
    same_types = {f.name: plain(f.dataType) for f in mine.schema} == {f.name: plain(f.dataType) for f in theirs.schema}
    comparable = isinstance(left, DataFrame) or (own is not None and tree is not None and (own["by"], own["buckets"]) == (tree["by"], tree["buckets"]))
    if tree is None or not comparable or not same_types or len(set(mine.columns)) != len(mine.columns):
        return frame_diff(mine, theirs, expand=expand)
    buckets = tree["buckets"]
    if own is None:
        different = unequal(leaves(mine, bucket_column(mine, tree["by"], buckets)), open_leaves(spark, right))
    elif own["root"] == tree["root"]:
        different = []
    else:
        changed = [int(k) for k in own["nodes"].keys() | tree["nodes"].keys() if own["nodes"].get(k) != tree["nodes"].get(k)]
        different = unequal(*(open_leaves(spark, p).where(node_of(buckets).isin(changed)) for p in (left, right)))
    if not different:
        return frame_diff(mine.where(F.lit(False)), theirs.where(F.lit(False)), expand=expand, exact=True)
    if isinstance(left, DataFrame):
        mine = mine.where(bucket_column(mine, tree["by"], buckets).isin(different))
    else:
        mine = open_snapshot(spark, left, buckets=different)
    return frame_diff(mine, open_snapshot(spark, right, buckets=different), expand=expand, exact=True)
