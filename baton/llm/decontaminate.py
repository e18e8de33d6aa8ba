"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is ``width`` consecutive words of a benchmark item (an item of fewer words is one
window).  It is contained in a document where the document holds all its words in order, so
all of a window's shingles must occur there and its *prefix* of one shingle, the rarest by
the global order, is enough to find every place (prefix filter for full containment):

1. count each item shingle in all documents: this orders them by rarity;
2. keep for each distinct window its rarest shingle and that shingle's offset;
3. find the kept shingles in the documents; the offset fixes where the window would start
   and end, which must lie within the document (length and positional bounds); the words of
   that stretch are then compared in full, as bytes of the words' hashes, 64 bits each.

Items are handled in blocks of a bounded number of windows.  Only a block is broadcast, and
a larger benchmark takes more passes over the documents, each without a shuffle of text;
the hits of several passes meet per document afterwards.

Defined results: null text has no words; a null item or one without words matches nothing;
items with a null id take no part; rows with equal ids are judged one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.llm.text import ALNUM, U64, flat, lower, slices, word_hashes, word_spans
from baton.llm.wire import ragged

#: Windows in one broadcast block: at most about 100 bytes each, 20 MB.
BLOCK_WINDOWS = 200_000


def item_words(text: str | None) -> np.ndarray:
    """The hashes of an item's words."""
    data, offsets = flat(pa.array([text], pa.string()))
    data = lower(data)
    start, end, _ = word_spans(data, offsets, ALNUM)
    return word_hashes(data, start, end)


def roll(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words (across documents too: callers bound the places)."""
    n = max(len(words) - k + 1, 0)
    h = np.zeros(n, U64)
    for j in range(k):
        h = (h ^ words[j:j + n]) * U64(0x9E3779B97F4A7C15)
        h ^= h >> U64(29)
    return h


class Windows:
    """The distinct windows of a block of items, grouped by length."""

    def __init__(self, items: list[tuple[int, np.ndarray]], width: int, shingle: int):
        self.width, self.shingle = width, shingle
        by_words: dict[bytes, set[int]] = {}
        for item, words in items:
            size = min(len(words), width)
            if size:
                for i in range(len(words) - size + 1):
                    by_words.setdefault(words[i:i + size].tobytes(), set()).add(item)
        #: per length: (words of each window, one row each; the items that hold it)
        self.groups: list[tuple[int, int, np.ndarray, list[list[int]]]] = []
        for size in sorted({len(k) // 8 for k in by_words}):
            keys = sorted(k for k in by_words if len(k) == 8 * size)
            rows = np.frombuffer(b"".join(keys), U64).reshape(len(keys), size)
            self.groups.append((size, min(shingle, size), rows, [sorted(by_words[k]) for k in keys]))

    def shingles(self) -> dict[int, np.ndarray]:
        """The distinct shingles by their number of words."""
        out: dict[int, list[np.ndarray]] = {}
        for size, k, rows, _ in self.groups:
            out.setdefault(k, []).extend(roll(rows[:, j:j + k].reshape(-1), k)[::k] for j in range(size - k + 1))
        return {k: np.unique(np.concatenate(v)) for k, v in out.items()}

    def prefixes(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        """(length, shingle words, windows, items, sorted prefix shingles, window of each, offset of each)."""
        out = []
        for size, k, rows, items in self.groups:
            known, seen = counts[k]
            all_of = np.stack([roll(rows[:, j:j + k].reshape(-1), k)[::k] for j in range(size - k + 1)], axis=1)
            rarity = seen[np.searchsorted(known, all_of)]
            offset = np.lexsort((all_of, rarity), axis=1)[:, 0]  # rarest first, ties by the shingle's hash
            prefix = all_of[np.arange(len(rows)), offset]
            order = np.argsort(prefix, kind="stable")
            out.append((size, k, rows, items, prefix[order], order, offset[order]))
        return out


def _occurrences(h: np.ndarray, sought: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Where h holds one of the sorted sought values; a bitmap sorts out most places."""
    place = np.flatnonzero(table[(h >> U64(64 - bits)).astype(np.int64)])
    if not len(place):
        return place
    at = np.minimum(np.searchsorted(sought, h[place]), len(sought) - 1)
    return place[sought[at] == h[place]]


def _bitmap(sought: np.ndarray, bits: int = 18) -> np.ndarray:
    table = np.zeros(1 << bits, bool)
    table[(sought >> U64(64 - bits)).astype(np.int64)] = True
    return table


def _tokenise(column):
    data, offsets = flat(column)
    data = lower(data)
    start, end, bounds = word_spans(data, offsets, ALNUM)
    return word_hashes(data, start, end), bounds


def shingle_counts(docs: DataFrame, text_col: str, wanted: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """How often each wanted shingle (of one block) occurs in all documents: one pass, and a
    row for each shingle and task that saw it."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    maps = {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        total = {k: np.zeros(len(v), np.int64) for k, v in wanted.items()}
        for batch in batches:
            for piece in slices(batch, "text"):
                words, _ = _tokenise(piece.column(0))
                for k, sought in wanted.items():
                    if k not in maps:
                        maps[k] = _bitmap(sought)
                    h = roll(words, k)  # shingles over a document's edge too: this is only an order
                    at = np.searchsorted(sought, h[_occurrences(h, sought, maps[k], 18)])
                    total[k] += np.bincount(at, minlength=len(sought))
        for k, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)), pa.array(n[some])],
                                             names=["k", "i", "n"])

    rows = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "k int, i int, n bigint")
            .groupBy("k", "i").agg(F.sum("n").alias("n")).collect())  # at most the block's shingles
    out = {k: (v, np.zeros(len(v), np.int64)) for k, v in wanted.items()}
    for r in rows:
        out[r["k"]][1][r["i"]] = r["n"]
    return out


def _hits(words: np.ndarray, bounds: np.ndarray, prefixes, maps) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, list]]]:
    """Which words of some documents are hit, and (document, window, items) of the contained windows."""
    change = np.zeros(len(words) + 1, np.int64)
    found = []
    for (size, k, rows, items, sought, window, offset), table in zip(prefixes, maps):
        h = roll(words, k)
        place = _occurrences(h, sought, table, 18)
        if not len(place):
            continue
        lo, hi = np.searchsorted(sought, h[place], "left"), np.searchsorted(sought, h[place], "right")
        item, nth = ragged(hi - lo)
        j = lo[item] + nth
        begin = place[item] - offset[j]
        doc = np.searchsorted(bounds, place[item], side="right") - 1
        fits = (begin >= bounds[doc]) & (begin + size <= bounds[doc + 1])
        begin, doc, j = begin[fits], doc[fits], j[fits]
        for c in range(size):  # verify in full
            equal = words[begin + c] == rows[window[j], c]
            begin, doc, j = begin[equal], doc[equal], j[equal]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + size, -1)
        if len(begin):
            pair = np.unique(np.stack([doc, window[j]]), axis=1)
            found.append((pair[0], pair[1], items))
    return np.cumsum(change[:-1]) > 0, found


def _digest(items: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = 10, shingle: int = 3, keep: bool = False,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """For each document (doc_id, n_words, n_hit, n_items, items_sha256, contaminated): the words
    inside any window of an item, and the items with such windows.

    ``keep`` gives the input's columns and only those documents without a hit instead.
    """
    spark = docs.sparkSession
    blocks: list[list[tuple[int, np.ndarray]]] = [[]]
    size = 0
    chosen = items.select(F.col(f"`{item_col}`").cast("bigint").alias("i"), F.col(f"`{item_text_col}`").alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    for r in chosen.toLocalIterator():  # a partition at a time
        words = item_words(r["t"])
        if size + len(words) > block_windows and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append((r["i"], words))
        size += len(words)
        if len(blocks) > 1:
            break
    if len(blocks) > 1:
        return _in_passes(docs, chosen, id_col, text_col, width, shingle, keep, block_windows)
    names = docs.columns
    sent = _block(docs, text_col, blocks[0], width, shingle)
    read = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       *([F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")] if keep else []))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = sent.value
        maps = [_bitmap(p[4]) for p in prefixes]
        for batch in batches:
            for piece in slices(batch, "text"):
                words, bounds = _tokenise(piece.column(0))
                hit, found = _hits(words, bounds, prefixes, maps)
                n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[bounds])
                if keep:
                    yield pa.RecordBatch.from_arrays([piece.column(2).filter(pa.array(n_hit == 0))], names=["row"])
                    continue
                held: dict[int, set[int]] = {}
                for doc, window, of in found:
                    for d, w in zip(doc.tolist(), window.tolist()):
                        held.setdefault(d, set()).update(of[w])
                yield _result(piece.column(1), np.diff(bounds), n_hit, held)

    if keep:
        out = read.mapInArrow(judge, T.StructType([read.schema["row"]]))
        return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
    return read.mapInArrow(judge, RESULT)


RESULT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _result(ids, n_words, n_hit, held: dict[int, set[int]]) -> pa.RecordBatch:
    n = len(n_words)
    none = _digest(set())
    return pa.RecordBatch.from_arrays([
        ids, pa.array(n_words.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
        pa.array([len(held.get(d, ())) for d in range(n)], pa.int64()),
        pa.array([_digest(held[d]) if d in held else none for d in range(n)], pa.string()), pa.array(n_hit > 0)],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _block(docs: DataFrame, text_col: str, items, width: int, shingle: int):
    """The prefix table of a block of items, broadcast."""
    windows = Windows(items, width, shingle)
    wanted = windows.shingles()
    counts = shingle_counts(docs, text_col, wanted) if wanted else {}
    return docs.sparkSession.sparkContext.broadcast(windows.prefixes(counts))


def _in_passes(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, width: int, shingle: int, keep: bool,
               block_windows: int) -> DataFrame:
    """Several blocks: each pass adds its hit ranges and items to the documents it hits.

    Documents carry their text, so it is written once, with the hits of the passes in a
    column of packed ranges; nothing is joined.
    """
    names = docs.columns
    base = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row"),
                       F.array().cast("array<bigint>").alias("ranges"), F.array().cast("array<bigint>").alias("items"))
    schema = base.schema

    def one_pass(df: DataFrame, sent) -> DataFrame:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            prefixes = sent.value
            maps = [_bitmap(p[4]) for p in prefixes]
            for batch in batches:
                for piece in slices(batch, "text"):
                    words, bounds = _tokenise(piece.column(0))
                    hit, found = _hits(words, bounds, prefixes, maps)
                    held: dict[int, set[int]] = {}
                    for doc, window, of in found:
                        for d, w in zip(doc.tolist(), window.tolist()):
                            held.setdefault(d, set()).update(of[w])
                    ranges, ids = piece.column(3).to_pylist(), piece.column(4).to_pylist()
                    for d, got in held.items():
                        change = np.diff(np.concatenate([[0], hit[bounds[d]:bounds[d + 1]].astype(np.int8), [0]]))
                        ranges[d] = ranges[d] + np.stack([np.flatnonzero(change == 1), np.flatnonzero(change == -1)], axis=1).reshape(-1).tolist()
                        ids[d] = sorted(set(ids[d]) | got)
                    yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), piece.column(2),
                                                      pa.array(ranges, pa.list_(pa.int64())), pa.array(ids, pa.list_(pa.int64()))],
                                                     names=["text", "id", "row", "ranges", "items"])

        return df.mapInArrow(add, schema)

    block: list[tuple[int, np.ndarray]] = []
    size = 0
    out = base
    for r in items.toLocalIterator():
        words = item_words(r["t"])
        if size + len(words) > block_windows and block:
            out = one_pass(out, _block(docs, text_col, block, width, shingle))
            block, size = [], 0
        block.append((r["i"], words))
        size += len(words)
    out = one_pass(out, _block(docs, text_col, block, width, shingle))
    if keep:
        return out.where(F.size("items") == 0).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                _, bounds = _tokenise(piece.column(0))
                n_words, n_hit = np.diff(bounds), np.zeros(piece.num_rows, np.int64)
                held = {}
                for d, (ranges, ids) in enumerate(zip(piece.column(3).to_pylist(), piece.column(4).to_pylist())):
                    if ids:
                        change = np.zeros(n_words[d] + 1, np.int64)
                        np.add.at(change, np.array(ranges[::2]), 1)
                        np.add.at(change, np.array(ranges[1::2]), -1)
                        n_hit[d] = int((np.cumsum(change) > 0).sum())
                        held[d] = set(ids)
                yield _result(piece.column(1), n_words, n_hit, held)

    return out.mapInArrow(close, RESULT)
