"""Exact top-k search by inner product: tiled matrix products, selection per tile, tree merging.

Vectors become integers, ``floor(scale * x)``.  Queries and candidates are dealt into tiles
of bounded size; every pair of a query tile and a candidate tile is one matrix product, from
which each query keeps its best k.  The lists of a query are then merged in a tree: first
groups of tiles, then the groups' results, so that no task gathers more than ``FAN`` lists of
a query at a time.

Defined results: vectors that are null, or hold a null or non-finite component, take no part,
nor do rows without an id; vectors are compared with those of their own length only; of
several rows with one id the smallest vector (by its components in order) counts.  Scores are
exact: products are taken in doubles while they stay below 2**53, else in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a candidate tile and of a query tile.
SHARD_ROWS, QUERY_ROWS = 4096, 512
#: Lists merged by one step of the tree.
FAN = 32
_LISTS = "query_id bigint, tile int, vec_id array<bigint>, score array<bigint>"


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)  # all ties of the last place
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    if not q.shape[1]:
        return np.zeros((len(q), len(v)), np.int64)
    top = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0)) * q.shape[1]
    if top < 2 ** 53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if top >= 2 ** 63:
        raise OverflowError("an inner product may exceed 64 bits")
    return q @ v.T


def quantised(column: Column, scale: float) -> Column:
    """floor(scale * x) of each component; null unless all are finite."""
    x = column.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.when(x.isNotNull() & fine, F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
          scale: float = 64.0, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, fan: int = FAN) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` where ``is_query`` (a
    condition on the id, named ``vec_id``) holds, its k highest-scoring other rows."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), quantised(F.col(f"`{vector_col}`"), scale).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-sizes["q"] // query_rows))

    def tiles(df: DataFrame, n: int, seed: int) -> DataFrame:
        """Rows of one length in tiles of bounded size, as parallel lists."""
        dealt = df.select(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int").alias("tile"), F.size("v").alias("d"), "vec_id", "v")
        packed = dealt.groupBy("tile", "d").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
        return packed.select("tile", "d", F.col("rows.vec_id").alias("ids"), F.col("rows.v").alias("vs"))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    shard = tiles(rows, shards, 1).select(F.col("tile").alias("shard"), "d", F.col("ids").alias("c_ids"), F.col("vs").alias("c_vs"), every(blocks).alias("block"))
    block = tiles(rows.where(is_query), blocks, 2).select(F.col("tile").alias("block"), "d", F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"), every(shards).alias("shard"))
    pairs = shard.join(block.hint("shuffle_hash"), ["block", "shard", "d"])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                tile = batch.column(at["shard"])[r].as_py()
                c_ids = batch.column(at["c_ids"])[r].values.to_numpy()
                q_ids = batch.column(at["q_ids"])[r].values.to_numpy()
                score = _product(_matrix(batch.column(at["q_vs"])[r].values), _matrix(batch.column(at["c_vs"])[r].values))
                ids, scores = [], []
                for i, own in enumerate(q_ids):
                    other = c_ids != own
                    mine, s = c_ids[other], score[i][other]
                    best = _best(mine, s, k)
                    ids.append(mine[best])
                    scores.append(s[best])
                yield pa.RecordBatch.from_arrays([
                    pa.array(q_ids), pa.array(np.full(len(q_ids), tile, np.int32)),
                    pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.int64()))],
                    names=["query_id", "tile", "vec_id", "score"])

    lists = pairs.mapInArrow(products, _LISTS)
    # tree merging: fan lists of a query at a time, best k of each group in order
    while True:
        shards = -(-shards // fan)
        best = F.slice(F.array_sort(F.flatten(F.collect_list(F.arrays_zip(F.transform("score", lambda s: -s).alias("s"), F.col("vec_id").alias("i"))))), 1, k)
        merged = lists.groupBy("query_id", F.floor(F.col("tile") / fan).cast("int").alias("tile")).agg(best.alias("best"))
        if shards <= 1:
            break
        lists = merged.select("query_id", "tile", F.col("best.i").alias("vec_id"), F.transform("best.s", lambda s: -s).alias("score"))
    return merged.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.i").alias("vec_id"), (-F.col("b.s")).alias("score"))
