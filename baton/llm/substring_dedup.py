"""Substring dedup: remove every word of a word sequence that occurs more than once.

Suffixes are grouped over the cluster by content-chosen anchors (``anchors``).  Inside a
group, variable-length prefixes split them further: a prefix is extended by a word until
at most ``SUBTREE`` suffixes share it.  Each of these sets becomes one suffix tree, built
from the root downwards: a node's suffixes are split by their next word, and a suffix that
is alone becomes a leaf.  Internal nodes as deep as a window are the maximal repeats.

Defined results: a null text has no words; texts of fewer words than a window lose
nothing; equal rows remove each other's repeated words, as any two documents do.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from baton.llm.anchors import HOT_ANCHOR, covered, remove_repeats
from baton.llm.text import NOT_SPACE, U64, flat, word_hashes, word_spans

#: Suffixes of one tree, held in memory together.
SUBTREE = 1 << 18


def _split(node: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Children of nodes by next symbol: (order, child of each in that order, size of its child)."""
    order = np.argsort((node << 32) | symbol, kind="stable")
    a, b = node[order], symbol[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    child = np.cumsum(new) - 1
    return order, child, np.bincount(child)[child] if len(child) else child


def prefix_sets(sym: np.ndarray, pos: np.ndarray, depth: int, limit: int = SUBTREE):
    """(suffixes, prefix length) of each set: suffixes with one prefix, lengthened while the set is too large."""
    todo = [(pos, 0)]
    while todo:
        at, d = todo.pop()
        if len(at) <= limit or d == depth:
            yield at, d
            continue
        order, child, _ = _split(np.zeros(len(at), np.int64), sym[at + d])
        at = at[order]
        edges = np.append(np.flatnonzero(np.diff(child, prepend=-1)), len(at))
        small: list[np.ndarray] = []
        held = 0
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi - lo > limit:
                todo.append((at[lo:hi], d + 1))
            else:  # short prefixes travel together
                if held + hi - lo > limit:
                    yield np.concatenate(small), d
                    small, held = [], 0
                small.append(at[lo:hi])
                held += hi - lo
        if small:
            yield np.concatenate(small), d


def deep_nodes(sym: np.ndarray, at: np.ndarray, known: int, depth: int) -> np.ndarray:
    """The suffixes below internal nodes of the given depth, of one subtree."""
    node = np.zeros(len(at), np.int64)
    for d in range(known, depth):
        if not len(at):
            break
        order, child, size = _split(node, sym[at + d])
        inner = size > 1  # a suffix that is alone is a leaf: its path goes on to no repeat
        at, node = at[order][inner], child[inner]
    return at


def repeated_windows(group, left, right, n_windows, values, total, earliest) -> np.ndarray:
    """For each window of each span: whether another span holds the same words."""
    length = left + right + 1
    ends = np.cumsum(length)
    start = ends - length
    depth = int(left[0] + right[0] + 2 - n_windows[0])
    sym = np.empty(int(ends[-1]), np.int64)
    gram_at = start + left
    body = np.ones(len(sym), bool)
    body[gram_at] = False
    words = np.unique(values, return_inverse=True)[1]
    sym[body] = words
    sym[gram_at] = words.max(initial=0) + 1 + np.unique(group, return_inverse=True)[1]
    item = np.repeat(np.arange(len(length)), n_windows)
    place = np.arange(len(item)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    pos = start[item] + place
    flag_at = np.zeros(len(sym), np.int64)
    flag_at[pos] = np.arange(len(pos))
    out = np.zeros(len(pos), bool)
    for at, known in prefix_sets(sym, pos, depth):
        if known == depth:
            deep = at if len(at) > 1 else at[:0]
        else:
            # sets that hold several short prefixes are told apart from their first word on
            deep = deep_nodes(sym, at, known, depth)
        out[flag_at[deep]] = True
    return out


def _words(table: pa.Table):
    data, offsets = flat(table.column("text"))
    start, end, bounds = word_spans(data, offsets, NOT_SPACE)
    tokens = word_hashes(data, start, end)
    return tokens, bounds, tokens & U64((1 << 48) - 1)


def _rows(table: pa.Table, replies: pa.Table, width: int, with_text: bool) -> pa.Table:
    data, offsets = flat(table.column("text"))
    start, end, bounds = word_spans(data, offsets, NOT_SPACE)
    removed = covered(replies, len(start), width)
    n = len(offsets) - 1
    gone = np.diff(np.concatenate([[0], np.cumsum(removed)])[bounds])
    kept = np.flatnonzero(~removed)
    doc = np.searchsorted(bounds, kept, side="right") - 1
    # a space takes the place of the separator after each kept word but a document's last
    follows = np.zeros(len(kept), bool)
    follows[:-1] = doc[1:] == doc[:-1]
    change = np.zeros(len(data) + 1, np.int8)
    np.add.at(change, start[kept], 1)
    np.add.at(change, end[kept], -1)
    mask = np.cumsum(change[:-1], dtype=np.int8) > 0
    out = data.copy()
    gap = end[kept[follows]]
    mask[gap] = True
    out[gap] = 0x20
    at = np.concatenate([[0], np.cumsum(mask)])[offsets]
    view = memoryview(np.ascontiguousarray(out[mask]))
    cut = [view[at[i]:at[i + 1]] for i in range(n)]
    cols = {"doc_id": table.column("id"), "n_words": pa.array(np.diff(bounds).astype(np.int64)), "n_removed": pa.array(gone.astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in cut], pa.string())}
    if with_text:
        cols["text"] = pa.array([bytes(c).decode("utf-8", "replace") for c in cut], pa.string())
    return pa.table(cols)


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35,
                with_text: bool = False, hot: int = HOT_ANCHOR, chunks: int | None = None) -> DataFrame:
    """For each document (doc_id, n_words, n_removed, kept_sha256[, text]): every word of a
    ``width``-word sequence that also starts elsewhere is removed, the kept words joined by spaces.

    Words are compared by 48 bits of a hash around a gram compared by 64 bits, so a wrong
    match needs two windows that differ in one word and a collision of that word's hash.
    """
    gram = min(width // 2 + 1, width - 1)

    def finish(t, r):
        return _rows(t, r, width, with_text)

    docs = docs.withColumn(id_col, docs[f"`{id_col}`"].cast("bigint"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", text string" if with_text else "")
    return remove_repeats(docs, id_col, text_col, _words, repeated_windows, finish, schema, width, gram,
                          earlier_only=False, hot=hot, chunks=chunks)
