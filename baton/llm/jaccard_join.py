"""N-gram Jaccard join under several global orders, and the groups its links form.

Two documents link when the Jaccard similarity of their sets of word shingles reaches a
threshold t.  Under any global order of shingles, two such sets share one of the first
``n - ceil(t n) + 1`` shingles of each (the prefix).  Several orders must all say so:

* every order is by rarity first (the number of documents that hold a shingle, in classes that
  grow by half powers of two) and by a hash of its own among equals, so the prefix of a document
  without copies consists of shingles that nobody else has, and meets nobody;
* the numbers come from an exchange of each chunk's distinct shingles, cut to 32 bits within
  their part (``wire``): shingles that fall together count together, which is an order, too;
* prefixes meet by shingle in hash parts, as packed lists; equal sets of one chunk are merged
  before.

Groups of copies make lists of thousands that are all linked, so pairs are not listed first:

1. in each list of the first order every document is paired with one representative (of
   similar size); of its pairs that share many prefix shingles, the ``CLOSEST`` are verified and
   give components;
2. in lists of the first order that still hold several components, every document is paired with
   its nearest one of another component; these pairs are verified and join components, again and
   again until none of them links or at most ``FEW`` documents have such a pair.  A document
   without one never gets one later, as components only grow, so the rounds after the first, and
   step 3, read the documents of the first round's pairs;
3. of the documents that are left, all pairs of different components that the lists of every order
   hold, that pass the bounds and share as many prefix shingles as two linked sets must, are verified.

Two large components that link are thus joined by few of their pairs before step 3 lists all.

The bounds never drop a link.  Before any list, a document must have enough shingles that others
hold for an overlap with one of them.  In steps 2 and 3 sizes must be similar, and parity bitmaps
(a bit flips with every shingle that hashes to it) may differ in no more bits than sets that link
differ in shingles: those of the whole sets, and those of the prefixes under each order, which
must have enough in common under all of them at once.  So a list gives few pairs that do not link,
however many documents of other components it holds.

After this every pair that could link was either verified or lies within one component, so
the components are exactly those of all links.  Verification compares the whole sets.
Components come from alternating large-star and small-star steps, as joins.

Defined results: a document of fewer words than a shingle has its whole sequence as one;
without words, or text, it has the empty set and links with nothing; rows that share an id
are one node; a null id is nobody's smallest id, and a component of only such has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baton.llm.text import NOT_SPACE, U64, flat, lower, mix, shingles, slices, word_hashes, word_spans
from baton.llm.wire import MESSAGE, chunked, in_order, incoming, messages, n_chunks, pack, sort_by_part, stored, text_bytes, unpack

#: Bits of the filter that keeps documents without a candidate from the second read: 8 MB.
FILTER_BITS = 26
_RANGES = 64
#: Representatives that step 1 verifies a member with; steps 2 and 3 find every link beyond these.
CLOSEST = 3
#: Documents with open pairs, in all, that step 3 may list all pairs of without more rounds of step 2.
FEW = 512
#: 64-bit words of the least parity bitmap; bits, growing with the set between these bounds.
PARITY_WORDS = 8
BITMAP_BITS = (64 * PARITY_WORDS, 1 << 15)
_BLOBS = "kind int, dst int, blob binary"


def shingle_sets(column, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of a batch, sorted; the places in them of each document's, ascending;
    and the n + 1 offsets of the documents."""
    data, offsets = flat(column)
    data = lower(data)
    start, end, bounds = word_spans(data, offsets, NOT_SPACE)
    h, at = shingles(word_hashes(data, start, end), bounds, k)
    known, place = np.unique(h, return_inverse=True)
    wide = max(len(known), 1)
    both = np.sort(np.repeat(np.arange(len(at) - 1), np.diff(at)) * wide + place)  # np.unique hashes, which takes many times as long
    both = both[np.diff(both, prepend=-1) > 0]
    return known, both % wide, np.searchsorted(both, np.arange(len(at)) * wide)


def _node(ident: Column, text: Column) -> Column:
    """A document's node: its id, or a hash of its text (far from any id) where it has none."""
    return F.coalesce(ident, F.xxhash64(F.lit("a document without an id"), F.coalesce(text, F.lit("")), text.isNull()))


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["kind", "dst", "blob"])


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def rarity_class(holders: np.ndarray) -> np.ndarray:
    """0 for a shingle of one document, else a class that grows with the number of documents."""
    return np.where(holders > 1, 1 + np.floor(2 * np.log2(np.maximum(holders, 2))), 0).clip(0, 62).astype(np.uint8)


def prefixes(h: np.ndarray, at: np.ndarray, classes: np.ndarray, seed: int, percent: int):
    """(document, order key) of the shared shingles in the prefix of each set under one global
    order: what only one document holds comes first and can meet nobody."""
    n = np.diff(at)
    doc = np.repeat(np.arange(len(n)), n)
    shared = classes > 0
    left = prefix_length(n, percent) - np.bincount(doc[~shared], minlength=len(n))
    some = np.flatnonzero(shared & (left > 0)[doc])
    doc = doc[some]
    key = (classes[some].astype(U64) << U64(58)) | (mix(h[some], seed=seed) >> U64(6))
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    keep = np.arange(len(doc)) - np.searchsorted(doc, doc) < left[doc]
    return doc[keep], key[keep]


def shared_needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles the prefixes of two sets of sizes n and m share at least if the sets link.

    The sets then have ``overlap >= t (n + m) / (1 + t)`` shingles in common.  The j-th of these
    in the global order has at most ``n - overlap + j - 1`` shingles of the first set before it,
    so the first ``prefix - n + overlap`` of them lie in that set's prefix, likewise for the other.
    """
    overlap = -(-percent * (n + m) // (100 + percent))
    return np.minimum(prefix_length(n, percent) - n, prefix_length(m, percent) - m) + overlap


def _counted(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, times=None):
    """Distinct pairs, smaller node first, with their sizes and how often they come."""
    swap = a > b
    a, b, n, m = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, m, n), np.where(swap, n, m)
    order = np.lexsort((b, a))
    a, b, n, m = a[order], b[order], n[order], m[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    times = np.ones(len(a), np.int64) if times is None else times[order]
    return a[first], b[first], n[first], m[first], np.add.reduceat(times, first) if len(first) else times


def star_pairs(group: np.ndarray, n: np.ndarray, node: np.ndarray, percent: int):
    """In each group (sorted by size) pairs of a representative and each member of similar size, counted."""
    reps, members = [], []
    i = np.arange(len(group))
    while len(i):
        new = np.ones(len(i), bool)
        new[1:] = group[i[1:]] != group[i[:-1]]
        rep = i[np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))]
        near = n[i] * percent <= n[rep] * 100
        link = near & (node[i] != node[rep])
        reps.append(rep[link])
        members.append(i[link])
        i = i[~near]
    r = np.concatenate(reps) if reps else np.zeros(0, np.int64)
    m = np.concatenate(members) if members else np.zeros(0, np.int64)
    return _counted(node[r], node[m], n[r], n[m])


def bitmap_bytes(n: np.ndarray, percent: int) -> np.ndarray:
    """Bytes of the bitmaps of sets of n shingles: powers of two, about four bits for each
    shingle in which two linked sets may differ."""
    most = 2 * n * (100 - percent) / (100 + percent)
    steps = np.ceil(np.log2(np.maximum(4 * most / BITMAP_BITS[0], 1)))
    return np.minimum(BITMAP_BITS[0] * 2 ** steps, BITMAP_BITS[1]).astype(np.int64) // 8


def parity(h: np.ndarray, at: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """The parity bitmaps of the documents' hashes: a bit flips with every hash whose low bits are
    its number.  With a ``size`` in bytes for each they follow one another; else each is a row of
    ``PARITY_WORDS`` words."""
    sizes = np.full(len(at) - 1, 8 * PARITY_WORDS) if size is None else size
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    bit = (mix(h, seed=25) & (sizes[doc] * 8 - 1).astype(U64)).astype(np.int64)
    odd = np.bincount((np.cumsum(sizes) - sizes)[doc] * 8 + bit, minlength=int(sizes.sum()) * 8) & 1
    bits = np.packbits(odd.astype(np.uint8), bitorder="little")
    return bits.view(U64).reshape(-1, PARITY_WORDS) if size is None else bits


class Bitmaps:
    """The bitmaps of the documents of a task, several of one size for each document; ``doc`` is
    that of each entry of the lists."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, each: int, doc: np.ndarray):
        self.raw, self.offsets, self.each, self.doc = raw, offsets, each, doc
        self.size = np.diff(offsets) // each
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All bitmaps of at least this size, folded to it, and each document's place in them."""
        if size not in self.folded:
            place, parts, at = np.full(len(self.size), -1), [], 0
            for wide in np.unique(self.size[self.size >= size]):
                rows = np.flatnonzero(self.size == wide)
                whole = self.raw[(self.offsets[rows][:, None] + np.arange(wide * self.each))].reshape(len(rows), self.each, wide // size, size)
                parts.append(np.bitwise_xor.reduce(whole, axis=2))  # the parity of fewer bits
                place[rows] = at + np.arange(len(rows))
                at += len(rows)
            self.folded[size] = place, np.ascontiguousarray(np.concatenate(parts)).view(U64)
        return self.folded[size]

    def distances(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """In how many bits the bitmaps of the entries i and j differ: a row for each bitmap."""
        i, j = self.doc[i], self.doc[j]
        out = np.zeros((self.each, len(i)), np.int64)
        size = np.minimum(self.size[i], self.size[j])
        for one in np.unique(size):
            place, bits = self._of(int(one))
            some = np.flatnonzero(size == one)
            for at in range(0, len(some), 1 << 14):
                k = some[at:at + (1 << 14)]
                out[:, k] = np.bitwise_count(bits[place[i[k]]] ^ bits[place[j[k]]]).sum(axis=2, dtype=np.int64).T
        return out


def _open_pairs(group, n, free, comp, bits, percent: int, prefix=()):
    """(i, j, distance) of the pairs of different components in each list (sorted by size) that
    pass the bounds.  ``free``: how many shingles of a set others hold; ``bits``: a row of words for
    each entry, or :class:`Bitmaps` of the sets and of their prefixes, whose lengths are ``prefix``."""
    maps = bits if isinstance(bits, Bitmaps) else Bitmaps(
        np.ascontiguousarray(bits).view(np.uint8).reshape(-1), np.arange(len(bits) + 1) * bits.shape[1] * 8, 1, np.arange(len(bits)))
    i, step = np.arange(len(group)), 1
    while len(i):
        i = i[i + step < len(group)]
        j = i + step
        near = (group[i] == group[j]) & (n[j] * percent <= n[i] * 100)  # sizes ascend: no later one is nearer
        i, j = i[near], j[near]
        overlap = -(-percent * (n[i] + n[j]) // (100 + percent))
        ok = (comp[i] != comp[j]) & (np.minimum(free[i], free[j]) >= overlap)
        a, b, overlap = i[ok], j[ok], overlap[ok]
        apart = maps.distances(a, b)
        fits = apart[0] <= n[a] + n[b] - 2 * overlap
        needed = shared_needed(n[a], n[b], percent)
        for length, differ in zip(prefix, apart[1:]):  # two prefixes with so many in common differ in the others at most
            fits &= differ <= length[a] + length[b] - 2 * needed
        if fits.any():
            yield a[fits], b[fits], apart[0][fits]
        step += 1


def cross_pairs(group, n, free, node, comp, bits, percent: int, prefix=()):
    """All such pairs, counted."""
    got: list[tuple] = []
    held = 0
    for a, b, _ in _open_pairs(group, n, free, comp, bits, percent, prefix):
        got.append((node[a], node[b], n[a], n[b], np.ones(len(a), np.int64)))
        held += len(a)
        if held > 1 << 20:
            got = [_counted(*(np.concatenate(x) for x in zip(*got)))]
            held = len(got[0][0])
    return _counted(*(np.concatenate(x) for x in zip(*got))) if got else (node[:0], node[:0], n[:0], n[:0], n[:0])


def nearest_pairs(group, n, free, node, comp, bits, percent: int, prefix=()):
    """Of such pairs the one of least distance for each member of a group, counted."""
    least = np.full(len(group), np.iinfo(np.int64).max)
    other = np.full(len(group), -1)
    for a, b, d in _open_pairs(group, n, free, comp, bits, percent, prefix):
        for x, y in ((a, b), (b, a)):
            better = d < least[x]
            least[x[better]], other[x[better]] = d[better], y[better]
    i = np.flatnonzero(other >= 0)
    j = other[i]
    return _counted(node[i], node[j], n[i], n[j])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for the nodes of edges (a, b)."""
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        # large star: larger neighbours point to the smallest in the neighbourhood
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node itself point to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        pairs = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


class _Join:
    """The steps of one join; see the module's description."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, orders: int):
        self.k, self.percent, self.orders = k, percent, orders
        self.spark = docs.sparkSession
        ident, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")
        self.texts = docs.select(_node(ident, text).alias("node"), ident.isNull().alias("missing"), text.alias("text"))
        self.parts = n_chunks(self.spark, text_bytes(docs, text_col))

    def lists(self) -> DataFrame:
        """Rows of kind 0 (lists of documents that share a prefix shingle), 1 (star pairs),
        2 (id, size and whether the id is missing of each document), 3 (pairs of equal sets) and
        4 (shared shingles, prefix lengths and bitmaps of the documents that may link)."""
        k, percent, orders, parts = self.k, self.percent, self.orders, self.parts
        texts = chunked(self.texts, "node", "text", parts, keep=True).select("chunk", "id", "h", "text", F.col("rest.c0").alias("missing"))

        def distinct(table: pa.Table):
            """The sets of a chunk, and how its distinct shingles are sent: sorted by part and 32 bits."""
            known, place, at = shingle_sets(table.column("text"), k)
            key = ((mix(known, seed=41) % U64(parts)) << U64(32)) | (mix(known, seed=42) >> U64(32))
            order = np.argsort(key)
            key = key[order]
            return known, place, at, (key & U64(0xFFFFFFFF)).astype(np.uint32), order, np.searchsorted(key, np.arange(parts + 1).astype(U64) << U64(32))

        def ask(table: pa.Table) -> pa.Table:
            if not table.num_rows:
                return messages([])
            known, place, _, short, order, cut = distinct(in_order(table))
            holders = np.bincount(place, minlength=len(known)).astype(np.uint32)[order]
            return messages((p, table.column("chunk")[0].as_py(), pack(np.diff(short[cut[p]:cut[p + 1]], prepend=np.uint32(0)), holders[cut[p]:cut[p + 1]]))
                            for p in np.flatnonzero(np.diff(cut)).tolist())

        def count(table: pa.Table) -> pa.Table:
            got = list(incoming(table))
            if not got:
                return messages([])
            _, place = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint32) for _, a in got]), return_inverse=True)
            classes = rarity_class(np.bincount(place, weights=np.concatenate([a[1] for _, a in got])))[place]
            ends = np.cumsum([len(a[0]) for _, a in got])
            return messages((src, table.column("dst")[0].as_py(), pack(classes[e - len(a[0]):e])) for (src, a), e in zip(got, ends))

        def send(table: pa.Table, replies: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _blobs([])
            home = table.column("chunk")[0].as_py() % parts  # any part will do for what is not a prefix
            table = in_order(table)
            known, place, at, _, order, cut = distinct(table)
            classes = np.zeros(len(order), np.uint8)
            for p, (c,) in incoming(replies):
                classes[order[cut[p]:cut[p + 1]]] = c
            h, classes = known[place], classes[place]
            node = table.column("id").to_numpy()
            n = np.diff(at)
            doc = np.repeat(np.arange(len(n)), n)
            free = np.bincount(doc[classes > 0], minlength=len(n))
            rows = [(2, home, pack(node, n.astype(np.int32), table.column("missing").to_numpy().astype(np.uint8)))]
            some = np.flatnonzero(n)
            if len(some):
                one, two = np.add.reduceat(mix(h, seed=21), at[some]), np.add.reduceat(mix(h, seed=22), at[some])
                _, first, same = np.unique(np.stack([one, two, n[some].astype(U64)]), axis=1, return_index=True, return_inverse=True)
                rep = some[first[same.reshape(-1)]]
                again = rep != some
                if again.any():
                    rows.append((3, home, pack(node[rep[again]], node[some[again]])))
                stays = np.zeros(len(n), bool)
                stays[some[first]] = True
                stays &= free >= -(-n * percent // 100)  # others have too few shingles in common with all others together
                inner = np.repeat(stays, n)
                h, classes, n, node, free = h[inner], classes[inner], n[stays], node[stays], free[stays]
                at = np.concatenate([[0], np.cumsum(n)])
                size = bitmap_bytes(n, percent)
                bitmaps, lengths = [parity(h, at, size)], []
                for o in range(orders):
                    doc, key = prefixes(h, at, classes, 31 + o, percent)
                    lengths.append(np.bincount(doc, minlength=len(n)).astype(np.int32))
                    bitmaps.append(parity(key, np.concatenate([[0], np.cumsum(lengths[-1])]), size))
                    by, split = sort_by_part((mix(key, seed=23) % U64(parts)).astype(np.int64), parts)
                    for p in np.flatnonzero(np.diff(split)).tolist():
                        i = by[split[p]:split[p + 1]]
                        rows.append((0, o * parts + p, pack(key[i], node[doc[i]], n[doc[i]].astype(np.int32))))
                if len(n):
                    rows.append((4, home, pack(node, size.astype(np.int32), free.astype(np.int32), *lengths, *bitmaps)))
            return _blobs(rows)

        def meet(t: pa.Table) -> pa.Table:
            dst = t.column("dst")[0].as_py()
            kinds = t.column("kind").to_numpy()
            blobs = t.column("blob")
            rows = [(int(kinds[i]), dst, blobs[int(i)].as_py()) for i in np.flatnonzero(kinds > 0)]
            got = [unpack(blobs[int(i)].as_py()) for i in np.flatnonzero(kinds == 0)]
            if got:
                key, node, n = (np.concatenate(x) for x in zip(*got))
                order = np.lexsort((node, n, key))
                key, node, n = key[order], node[order], n[order].astype(np.int64)
                new = np.ones(len(key), bool)
                new[1:] = key[1:] != key[:-1]
                group = np.cumsum(new) - 1
                many = np.bincount(group)[group] > 1
                if many.any():
                    group, node, n = np.unique(group[many], return_inverse=True)[1], node[many], n[many]
                    rows.append((0, dst, pack(np.diff(group, prepend=0).astype(np.uint8), node, n.astype(np.int32))))
                    if dst < parts:
                        rows.append((1, dst, pack(*star_pairs(group, n, node, percent))))
            return _blobs(rows)

        asked = texts.groupBy("chunk").applyInArrow(ask, MESSAGE)
        replies = asked.groupBy("dst").applyInArrow(count, MESSAGE)
        sent = texts.groupBy("chunk").cogroup(replies.groupBy("dst")).applyInArrow(send, _BLOBS)
        return stored(sent.groupBy("dst").applyInArrow(meet, _BLOBS))

    @staticmethod
    def pairs(blobs: DataFrame) -> DataFrame:
        """The pairs (a, b) packed in blobs."""
        def open_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    a, b = unpack(blob.as_py())[:2]
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        return blobs.select("blob").mapInArrow(open_up, "a bigint, b bigint")

    @staticmethod
    def counted(blobs: DataFrame) -> DataFrame:
        """(a, b, n, m, times): the counted pairs packed in blobs, summed over all parts."""
        def open_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in unpack(blob.as_py())], names=["a", "b", "n", "m", "times"])

        rows = blobs.select("blob").mapInArrow(open_up, "a bigint, b bigint, n bigint, m bigint, times bigint")
        return rows.groupBy("a", "b").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.sum("times").alias("times"))

    @staticmethod
    def closest(stars: DataFrame) -> DataFrame:
        """The star pairs of each member with the ``CLOSEST`` representatives that it shares most
        with.  A member of a large group meets one in every list that it is in, and one link ties
        it to the group; what the others would join is left to steps 2 and 3, which are exact."""
        a_is_member = F.col("m") < F.col("n")  # the smaller set represents, then the smaller node, "a"
        member, other = F.when(a_is_member, F.col("a")).otherwise(F.col("b")), F.when(a_is_member, F.col("b")).otherwise(F.col("a"))
        by = Window.partitionBy("member").orderBy(F.desc("times"), "other")
        ranked = stars.select("a", "b", "times", member.alias("member"), other.alias("other")).withColumn("rank", F.row_number().over(by))
        return ranked.where(F.col("rank") <= CLOSEST)

    def needed(self):
        """:func:`shared_needed` of the columns n and m."""
        t = self.percent
        overlap = F.floor((t * (F.col("n") + F.col("m")) + 99 + t) / (100 + t))
        return F.least(*[1 - F.floor((F.col(c) * t + 99) / 100) for c in ("n", "m")]) + overlap

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles): the packed sets of the given nodes (and of few others)."""
        k, bits = self.k, FILTER_BITS
        each = (1 << bits) // _RANGES

        def mark(t: pa.Table) -> pa.Table:
            bit = (mix(t.column("node").to_numpy().view(U64), seed=24) >> U64(64 - bits)).astype(np.int64)
            r = int(bit[0] // each)
            field = np.zeros(each, bool)
            field[bit - r * each] = True
            return _blobs([(0, r, pack(np.packbits(field)))])

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bit = (mix(batch.column(0).to_numpy().view(U64), seed=24) >> U64(64 - bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((bit // each).astype(np.int32))], names=["node", "r"])

        field = np.zeros(1 << bits, bool)
        for r in nodes.select("node").mapInArrow(ranges, "node bigint, r int").groupBy("r").applyInArrow(mark, _BLOBS).collect():
            field[r["dst"] * each:(r["dst"] + 1) * each] = np.unpackbits(unpack(r["blob"])[0]).astype(bool)
        sent = self.spark.sparkContext.broadcast(np.packbits(field))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            field = sent.value
            for batch in batches:
                bit = mix(batch.column(0).to_numpy().view(U64), seed=24) >> U64(64 - bits)
                byte = field[(bit >> U64(3)).astype(np.int64)]
                hit = (byte >> (U64(7) - (bit & U64(7))).astype(np.uint8)) & 1
                batch = batch.filter(pa.array(hit.astype(bool)))
                for piece in slices(batch, "text"):
                    known, place, at = shingle_sets(piece.column(1), k)
                    h = known[place]
                    blobs = [pack(h[at[i]:at[i + 1]]) for i in range(piece.num_rows)]
                    yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(blobs, pa.binary())], names=["node", "shingles"])

        return self.texts.select("node", "text").mapInArrow(read, "node bigint, shingles binary")

    @staticmethod
    def nodes_of(pairs: DataFrame) -> DataFrame:
        """(node): the nodes of the pairs (a, b)."""
        return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()

    def verified(self, candidates: DataFrame, sets: DataFrame) -> DataFrame:
        """The candidate pairs (a, b) whose sets, as of :meth:`sets`, reach the threshold."""
        percent = self.percent

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fine = np.zeros(batch.num_rows, bool)
                left, right = batch.column(2), batch.column(3)
                for i in range(batch.num_rows):
                    x, y = unpack(left[i].as_buffer())[0], unpack(right[i].as_buffer())[0]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    fine[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                some = batch.filter(pa.array(fine))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1)], names=["a", "b"])

        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        # "b" is the larger node, mostly one of few of its representative "a": join the even side first
        pairs = candidates.hint("merge").join(b.hint("merge"), "b").hint("merge").join(a.hint("merge"), "a")
        return pairs.select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint").distinct()

    def details(self, lists: DataFrame) -> DataFrame:
        """(node, free, prefix, bits): what the bounds need of each document that may link."""
        orders = self.orders

        def open_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    node, size, free, *rest = unpack(blob.as_py())
                    prefix, maps = np.stack(rest[:orders], axis=1).reshape(-1), [m.tobytes() for m in rest[orders:]]
                    ends = np.cumsum(size.astype(np.int64))
                    bits = [b"".join(m[e - k:e] for m in maps) for e, k in zip(ends.tolist(), size.tolist())]
                    lists = pa.ListArray.from_arrays(np.arange(0, len(prefix) + 1, orders, dtype=np.int32), prefix)
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(free), lists, pa.array(bits, pa.binary())], names=["node", "free", "prefix", "bits"])

        return lists.where("kind = 4").select("blob").mapInArrow(open_up, "node bigint, free int, prefix array<int>, bits binary")

    def open_entries(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """(dst, node, n, lists): the members of lists that hold several components, next to which
        (in size) there is one of another component; a node's lists of one part together."""
        percent = self.percent

        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    step, node, n = unpack(batch.column(1)[i].as_buffer())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), batch.column(0)[i].as_py(), np.int32)), pa.array(np.cumsum(step.astype(np.int32)).astype(np.int32)),
                                                      pa.array(node), pa.array(n)], names=["dst", "list", "node", "n"])

        def several(t: pa.Table) -> pa.Table:
            group, node, n, comp = (t.column(c).to_numpy().astype(np.int64) for c in ("list", "node", "n", "root"))
            by = np.lexsort((node, n, group))
            group, node, n, comp = group[by], node[by], n[by], comp[by]
            keep = np.zeros(len(group), bool)
            if len(group) > 1:  # runs of similar sizes; one with a single component is closed
                cut = np.ones(len(group), bool)
                cut[1:] = (group[1:] != group[:-1]) | (n[1:] * percent > n[:-1] * 100)
                run = np.cumsum(cut) - 1
                first = np.flatnonzero(cut)[run]
                keep = np.bincount(run, weights=comp != comp[first])[run] > 0
            group, node, n = group[keep], node[keep], n[keep]
            by = np.lexsort((group, node))
            node, n, group = node[by], n[by], group[by].astype(np.int32)
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
            at = np.concatenate([first, [len(node)]]).astype(np.int32)
            return pa.table([pa.array(np.full(len(first), t.column("dst")[0].as_py(), np.int32)), pa.array(node[first]), pa.array(n[first].astype(np.int32)),
                             pa.ListArray.from_arrays(at, group)], names=["dst", "node", "n", "lists"])

        rows = lists.where("kind = 0").select("dst", "blob").mapInArrow(entries, "dst int, list int, node bigint, n int")
        rows = rows.join(roots.hint("shuffle_hash"), "node", "left").select("dst", "list", "node", "n", F.coalesce("root", "node").alias("root"))
        return rows.groupBy("dst").applyInArrow(several, "dst int, node bigint, n int, lists array<int>")

    def cross(self, entries: DataFrame, details: DataFrame, roots: DataFrame, nearest: bool) -> DataFrame:
        """(a, b): the pairs of steps 2 (``nearest``) or 3."""
        percent, parts, orders = self.percent, self.parts, self.orders
        choose = nearest_pairs if nearest else cross_pairs

        def pairs_of(t: pa.Table) -> pa.Table:
            t = t.combine_chunks()
            order = t.column("dst")[0].as_py() // parts
            node, n, comp, free = (t.column(c).to_numpy().astype(np.int64) for c in ("node", "n", "root", "free"))
            lists, prefix = t.column("lists").combine_chunks(), t.column("prefix").combine_chunks()
            doc = np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy()))
            group = lists.flatten().to_numpy().astype(np.int64)
            by = np.lexsort((node[doc], n[doc], group))
            doc = doc[by]
            lengths = prefix.flatten().to_numpy().astype(np.int64).reshape(-1, orders)
            pairs = choose(group[by], n[doc], free[doc], node[doc], comp[doc], Bitmaps(*flat(t.column("bits")), 1 + orders, doc), percent, lengths[doc].T)
            return pa.table([pa.array(x) for x in pairs] + [pa.array(np.full(len(pairs[0]), order, np.int32))], names=["a", "b", "n", "m", "times", "o"])

        known = details.join(roots.hint("shuffle_hash"), "node", "left").select("node", "free", "prefix", "bits", F.coalesce("root", "node").alias("root"))
        rows = entries.join(known.hint("shuffle_hash"), "node").select("dst", "node", "n", "lists", "free", "prefix", "bits", "root")
        pairs = rows.groupBy("dst").applyInArrow(pairs_of, "a bigint, b bigint, n bigint, m bigint, times bigint, o int")
        if nearest:
            return pairs.select("a", "b").distinct()
        pairs = pairs.groupBy("a", "b", "o").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.sum("times").alias("times"))
        pairs = pairs.where(F.col("times") >= self.needed())
        return pairs.groupBy("a", "b").agg(F.count("*").alias("orders")).where(F.col("orders") == orders).select("a", "b")

    def joined(self, entries: DataFrame, details: DataFrame, roots: DataFrame) -> DataFrame:
        """The components ``roots`` after steps 2 and 3."""
        def joined_by(found: DataFrame) -> DataFrame:
            return stored(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found)))

        sets, nearest = None, True
        while nearest:
            # sets that link meet in the lists of every order, so those of the first have all their nodes
            more = stored(self.cross(entries.where(F.col("dst") < self.parts), details, roots, True))
            nodes = stored(self.nodes_of(more))
            left = nodes.count()
            if not left:
                break
            if sets is None:
                entries, details = (stored(x.join(nodes, "node", "left_semi")) for x in (entries, details))
                sets = stored(self.sets(nodes))
            nearest = left > FEW
            if nearest:
                found = stored(self.verified(more, sets))
                nearest = bool(found.head(1))
            if not nearest:
                found = stored(self.verified(self.cross(entries, details, roots, False), sets))
            if nearest or found.head(1):
                roots = joined_by(found)
        return roots

    def run(self) -> tuple[DataFrame, DataFrame]:
        """(id, whether it is missing, size) of each document; (node, root) of those with links."""
        lists = self.lists()
        equal = self.pairs(lists.where("kind = 3"))
        # representatives differ from list to list, so a third of the shared shingles is enough here
        stars = self.counted(lists.where("kind = 1")).where(3 * F.col("times") >= self.needed())
        stars = stored(self.closest(stars).select("a", "b"))
        links = self.verified(stars, stored(self.sets(self.nodes_of(stars)))).union(equal)
        roots = stored(components(links))
        roots = self.joined(stored(self.open_entries(lists, roots)), self.details(lists), roots)

        def notes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for blob in batch.column(0):
                    node, n, missing = unpack(blob.as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(missing.astype(bool)), pa.array(n.astype(np.int64))], names=["node", "missing", "n"])

        return lists.where("kind = 2").select("blob").mapInArrow(notes, "node bigint, missing boolean, n bigint"), roots


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90,
                       orders: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document: links join sets whose Jaccard
    similarity is at least ``percent`` / 100."""
    notes, roots = _Join(docs, id_col, text_col, shingle, percent, orders).run()
    rows = notes.join(roots.hint("shuffle_hash"), "node", "left").select("node", "missing", "n", F.coalesce("root", "node").alias("root"))
    least = rows.where(~F.col("missing")).join(roots.select(F.col("root").alias("r")).distinct(), F.col("root") == F.col("r"), "left_semi")
    least = least.groupBy("root").agg(F.min("node").alias("least"))
    own = F.when(~F.col("missing"), F.col("node"))
    return rows.join(least, "root", "left").select(own.alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("least", own).alias("component_id"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
                         orders: int = 2) -> DataFrame:
    """The documents with the smallest id of their group, and those without links.

    Rows that share an id are one document: all of them stay or go.  A document without an id
    gives way to any that has one; of several without, one stays for each text that is.
    """
    notes, roots = _Join(docs, id_col, text_col, shingle, percent, orders).run()
    members = notes.select("node", "missing").distinct().join(roots.hint("shuffle_hash"), "node")
    stays = members.groupBy("root").agg(F.min(F.struct("missing", "node"))["node"].alias("stays"))
    gone = members.join(stays, "root").where("node <> stays").select(F.col("node").alias("__gone"))
    node = _node(docs[f"`{id_col}`"].cast("bigint"), docs[f"`{text_col}`"])
    return docs.join(gone, node == F.col("__gone"), "left_anti")
