"""Suffix-array dedup: remove bytes covered by a long string that also starts earlier.

Suffixes are grouped over the cluster by content-chosen anchors (``anchors``).  In each
group the suffixes are sorted by bucket-pointer refinement: buckets of equal first q
symbols get the bucket's place as its identifier, and each bucket is refined by sorting
on the identifiers found ``depth`` symbols later.  Identifiers are replaced as soon as a
bucket is refined, so buckets that come later in the same pass reuse the finer ones.
Neighbours in the suffix array with a common prefix of the full length hold the same
string; the occurrence of the smallest document and place stays.

Defined results: a null text is empty; texts shorter than ``width`` bytes lose nothing;
documents with a null id come last in the order; rows with the same id are ordered by a
hash of their text; equal rows keep the bytes of one of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from baton.llm.anchors import HOT_ANCHOR, covered, remove_repeats
from baton.llm.text import BYTE_VALUE, flat

#: Suffixes refined before their new bucket pointers are put in place.
BLOCK = 1 << 15


def bucket_pointer_refinement(sym: np.ndarray, depth: int) -> np.ndarray:
    """The start places of all suffixes of ``sym`` (small non-negative integers), sorted by
    at least their first ``depth`` symbols."""
    n = len(sym)
    bits = max(int(sym.max(initial=0)) + 2, 2).bit_length()
    q = max(1, min(62 // bits, depth))
    code = np.zeros(n, np.int64)
    padded = np.concatenate([sym.astype(np.int64) + 1, np.zeros(q, np.int64)])  # past the end sorts first
    for i in range(q):
        code = (code << bits) | padded[i:i + n]
    sa = np.argsort(code, kind="stable")
    new = np.ones(n, bool)
    new[1:] = code[sa[1:]] != code[sa[:-1]]
    pointer = np.zeros(n + 1, np.int64)  # 1 + first place of the suffix's bucket; 0 past the end
    pointer[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    del code
    h = q
    while h < depth:
        head = pointer[sa]
        crowd = np.zeros(n, bool)
        crowd[1:] = head[1:] == head[:-1]
        crowd[:-1] |= crowd[1:]
        places = np.flatnonzero(crowd)
        if not len(places):
            break
        heads = head[places]
        a = 0
        while a < len(places):
            b = min(a + BLOCK, len(places))
            b = int(np.searchsorted(heads, heads[b - 1], side="right"))  # whole buckets
            at = places[a:b]
            suffix = sa[at]
            later = pointer[np.minimum(suffix + h, n)]
            order = np.lexsort((later, heads[a:b]))
            suffix, later, bucket = suffix[order], later[order], heads[a:b]
            split = np.ones(b - a, bool)
            split[1:] = (later[1:] != later[:-1]) | (bucket[1:] != bucket[:-1])
            sa[at] = suffix
            pointer[suffix] = np.maximum.accumulate(np.where(split, at, 0)) + 1
            a = b
        h *= 2
    return sa


def first_holders(group, left, right, n_windows, values, total, earliest) -> np.ndarray:
    """For each window of each span: whether an earlier span holds the same string."""
    length = left + right + 1
    ends = np.cumsum(length)
    start = ends - length
    dense = np.unique(group, return_inverse=True)[1]
    depth = int(left[0] + right[0] + 2 - n_windows[0])  # symbols of a window, its gram counted as one
    sym = np.empty(int(ends[-1]), np.int32)
    gram_at = start + left
    body = np.ones(len(sym), bool)
    body[gram_at] = False
    sym[body] = values
    sym[gram_at] = 256 + dense
    sa = bucket_pointer_refinement(sym, depth)
    owner = np.full(len(sym), -1, np.int32)
    item = np.repeat(np.arange(len(length)), n_windows)
    place = np.arange(len(item)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    owner[start[item] + place] = item
    flag_at = np.full(len(sym), -1, np.int64)
    flag_at[start[item] + place] = np.arange(len(item))
    sa = sa[owner[sa] >= 0]
    same = np.zeros(len(sa), bool)  # as the one before, over the whole window
    check = np.arange(1, len(sa))
    for i in range(depth):
        check = check[sym[sa[check] + i] == sym[sa[check - 1] + i]]
    same[check] = True
    cls = np.cumsum(~same) - 1
    least = np.full(int(cls[-1]) + 1 if len(cls) else 0, np.iinfo(np.int64).max)
    mine = earliest[owner[sa]]
    np.minimum.at(least, cls, mine)
    out = np.zeros(len(item), bool)
    out[flag_at[sa]] = least[cls] < mine
    return out


def _bytes(table: pa.Table):
    data, offsets = flat(table.column("text"))
    return BYTE_VALUE[data], offsets, data


def _removed(table: pa.Table, replies: pa.Table, width: int):
    data, offsets = flat(table.column("text"))
    removed = covered(replies, len(data), width)
    return data, offsets, removed


def _rows(table: pa.Table, replies: pa.Table, width: int, with_text: bool) -> pa.Table:
    data, offsets, removed = _removed(table, replies, width)
    n = len(offsets) - 1
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    if len(data):
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begins[edge] = removed[edge]

    def per_doc(mask):
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])

    kept = data[~removed]
    gone = per_doc(removed)
    at = offsets - np.concatenate([[0], np.cumsum(gone)])
    view = memoryview(np.ascontiguousarray(kept))
    cut = [view[at[i]:at[i + 1]] for i in range(n)]
    cols = {"doc_id": table.column("id"), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(gone.astype(np.int64)),
            "n_spans": pa.array(per_doc(begins).astype(np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in cut], pa.string())}
    if with_text:
        # a character that lost some of its bytes goes whole
        text = [bytes(c).decode("utf-8", "ignore") if g else bytes(c).decode("utf-8", "replace") for c, g in zip(cut, gone)]
        missing = np.asarray(table.column("text").is_null())
        cols["text"] = pa.array([None if m else t for t, m in zip(text, missing)], pa.string())
        cols["rest"] = table.column("rest")
    return pa.table(cols)


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100,
                with_text: bool = False, hot: int = HOT_ANCHOR, chunks: int | None = None) -> DataFrame:
    """For each document (doc_id, n_bytes, n_removed, n_spans, kept_sha256): every byte that is
    covered by a ``width``-byte string which also starts earlier is removed.

    ``with_text`` adds the remaining text and ``rest``, a struct of the other columns.
    The grams are a little over half a window, so that neighbouring anchors overlap.
    """
    gram = min(width // 2 + 1, width - 1)

    def tokenise(t):
        return _bytes(t)

    def finish(t, r):
        return _rows(t, r, width, with_text)

    docs = docs.withColumn(id_col, docs[f"`{id_col}`"].cast("bigint"))
    schema = T.StructType.fromDDL("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    if with_text:
        rest = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(f for f in docs.schema.fields if f.name not in (id_col, text_col))]
        schema = schema.add("text", T.StringType()).add("rest", T.StructType(rest or [T.StructField("c", T.StringType())]))
    return remove_repeats(docs, id_col, text_col, tokenise, first_holders, finish, schema, width, gram,
                          earlier_only=True, keep=with_text, hot=hot, chunks=chunks)
