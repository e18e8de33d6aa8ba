"""Repeated windows of tokens over a whole corpus, found through content-chosen anchors.

A window of ``width`` tokens holds ``width - gram + 1`` grams of ``gram`` tokens;
its *anchor* is the gram of least hash, the leftmost among equals.  Equal windows
have equal anchors at equal places, so only windows whose anchor occurs twice can
repeat, and equal windows meet when suffixes are grouped by their anchor's gram.
Neighbouring windows share an anchor: one *span* stands for all of them.

Five steps, all in one plan over chunks (see ``wire``):

1. each chunk sends the distinct anchors it holds, with counts;
2. parts of the anchor space answer, for each, whether it occurs twice (and
   whether it is hot);
3. chunks send the distinct spans around repeated anchors: the tokens left and
   right of the gram, the number of copies, and where the first copy is;
4. a kernel decides for the windows of each part which are to be removed;
5. chunks cover the tokens of those windows.

Copies are merged within each chunk before both shuffles, so a passage that a
third of all documents hold costs one record per chunk.  An anchor that still
has more than ``hot`` copies, with different surroundings, would make one large
group: its windows are sent one by one instead, dealt by a 128-bit hash of the
whole window, which merges again in each chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from baton.llm.text import SEGMENT, U64, mix, powers, prefix_hash, range_hash
from baton.llm.wire import MESSAGE, chunked, in_order, incoming, messages, n_chunks, pack, ragged, sort_by_part, text_bytes

_LOW = U64((1 << 20) - 1)
#: Copies of one anchor in the corpus beyond which its windows are dealt one by one.
HOT_ANCHOR = 200_000
#: Spans whose surroundings are gathered at a time.
SLICE = 1 << 14
_BASE2 = 0xD6E8FEB86659FD93


def find_anchors(tokens: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """(at, first, last, key) of each run of windows that share an anchor: its place, the
    first and last window start, and the gram's hash.  Windows stay inside a document."""
    n, reach = len(tokens), width - gram + 1
    out: list[tuple[np.ndarray, ...]] = []
    for b in range(0, max(n - width + 1, 0), SEGMENT):
        part = tokens[b:min(b + SEGMENT + width - 1, n)]
        starts = len(part) - width + 1
        ok = np.zeros(starts + 1, np.int32)  # how many document bounds each window crosses
        cut = bounds[np.searchsorted(bounds, b, side="right"):np.searchsorted(bounds, b + len(part), side="left")] - b
        np.add.at(ok, np.maximum(np.minimum(cut - width + 1, starts), 0), 1)
        np.add.at(ok, np.minimum(cut, starts), -1)
        valid = np.cumsum(ok[:-1]) == 0
        if not valid.any():
            continue
        h = prefix_hash(part)
        grams = len(part) - gram + 1
        key = mix((h[gram:] - h[:grams]) * powers(len(part))[1][:grams])
        least = (key & ~_LOW) | np.arange(grams, dtype=U64)
        size = 1
        while size * 2 <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < reach:
            least = np.minimum(least[:starts], least[reach - size:reach - size + starts])
        at = (least[:starts] & _LOW).astype(np.int64)
        same = np.zeros(starts, bool)
        same[1:] = (at[1:] == at[:-1]) & valid[:-1]
        first = np.flatnonzero(valid & ~same)
        more = np.zeros(starts, bool)
        more[:-1] = same[1:] & valid[1:]
        last = np.flatnonzero(valid & ~more)
        at = at[first]
        out.append((at + b, first + b, last + b, key[at]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchor_keys(key: np.ndarray, parts: int):
    """The distinct keys by part, with counts: (keys, counts, order, offsets by part)."""
    keys, counts = np.unique(key, return_counts=True)
    order, at = sort_by_part((keys % U64(parts)).astype(np.int64), parts)
    return keys, counts, order, at


def ask(table: pa.Table, tokenise: Callable, width: int, gram: int, parts: int) -> pa.Table:
    """Step 1 for one chunk."""
    if not table.num_rows:
        return messages([])
    chunk = table.column("chunk")[0].as_py()
    tokens, bounds = tokenise(in_order(table))[:2]
    keys, counts, order, at = _anchor_keys(find_anchors(tokens, bounds, width, gram)[3], parts)
    return messages((p, chunk, pack(keys[order[at[p]:at[p + 1]]], counts[order[at[p]:at[p + 1]]].astype(np.uint32)))
                    for p in np.flatnonzero(np.diff(at)).tolist())


def answer(table: pa.Table, hot: int) -> pa.Table:
    """Step 2 for one part: 0 for an anchor that occurs once, 1 for a repeated one, 2 for a hot one."""
    got = list(incoming(table))
    if not got:
        return messages([])
    part = table.column("dst")[0].as_py()
    _, place = np.unique(np.concatenate([a[0] for _, a in got]), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([a[1] for _, a in got]))
    state = ((total > 1).astype(np.uint8) + (total > hot))[place]
    ends = np.cumsum([len(a[0]) for _, a in got])
    return messages((src, part, pack(state[e - len(a[0]):e])) for (src, a), e in zip(got, ends))


def _span_hash(tokens, first, last, at, key, width, gram) -> np.ndarray:
    """A hash of each span: its gram and the tokens around it."""
    out = np.empty(len(at), U64)
    for s in range(0, len(at), SLICE):
        e = min(s + SLICE, len(at))
        left, right = at[s:e] - first[s:e], last[s:e] + width - at[s:e] - gram
        item, place = ragged(left + right)
        pos = first[s:e][item] + place + np.where(place >= left[item], gram, 0)
        value = tokens[pos] * powers(int((left + right).max()))[0][place]
        total = np.add.reduceat(value, np.cumsum(left + right) - (left + right))
        out[s:e] = mix(total + mix(key[s:e], seed=1) + (left * 1024 + right).astype(U64), seed=2)
    return out


def _gather(values, first, last, at, width, gram) -> np.ndarray:
    """The values around the gram of each span, end to end."""
    out = []
    for s in range(0, len(at), SLICE):
        e = s + SLICE
        left, right = at[s:e] - first[s:e], last[s:e] + width - at[s:e] - gram
        item, place = ragged(left + right)
        out.append(values[first[s:e][item] + place + np.where(place >= left[item], gram, 0)])
    return np.concatenate(out) if out else values[:0]


def send_spans(table: pa.Table, replies: pa.Table, tokenise: Callable, width: int, gram: int, parts: int,
               earlier_only: bool) -> pa.Table:
    """Step 3 for one chunk."""
    if not table.num_rows or not replies.num_rows:
        return messages([])
    chunk = table.column("chunk")[0].as_py()
    table = in_order(table)
    tokens, bounds, values = tokenise(table)
    at, first, last, key = find_anchors(tokens, bounds, width, gram)
    keys, _, order, offsets = _anchor_keys(key, parts)
    state = np.zeros(len(keys), np.uint8)
    for p, (s,) in incoming(replies):
        state[order[offsets[p]:offsets[p + 1]]] = s
    state = state[np.searchsorted(keys, key)]
    del keys, order
    some = np.flatnonzero(state)
    at, first, last, key, state = at[some], first[some], last[some], key[some], state[some]
    echo: list[tuple[np.ndarray, np.ndarray]] = []
    out: dict[int, list[np.ndarray]] = {}

    ids = table.column("id")
    missing = np.asarray(ids.is_null()).astype(np.uint8)
    ids = ids.fill_null(0).to_numpy()

    def distinct(h, f, t):
        """The first of each group of equal spans and its size; the others are known repeats here."""
        _, one, place, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        again = np.ones(len(h), bool)
        if earlier_only:
            again[one] = False
        else:
            again = n[place] > 1
        if again.any():
            echo.append((f[again], t[again]))
        return one, n

    cool = state == 1
    a, f, t, k = at[cool], first[cool], last[cool], key[cool]
    one, n = distinct(_span_hash(tokens, f, t, a, k, width, gram), f, t)
    a, f, t, k = a[one], f[one], t[one], k[one]
    by, offsets = sort_by_part((k % U64(parts)).astype(np.int64), parts)
    for p in np.flatnonzero(np.diff(offsets)).tolist():
        i = by[offsets[p]:offsets[p + 1]]
        i = i[np.argsort(f[i])]  # ascending places pack well
        doc = np.searchsorted(bounds, f[i], side="right") - 1
        out[p] = [k[i], (a[i] - f[i]).astype(np.uint16), (t[i] + width - a[i] - gram).astype(np.uint16), n[i].astype(np.uint32),
                  ids[doc], missing[doc], f[i].astype(np.uint32), _gather(values, f[i], t[i], a[i], width, gram)]
    none = [np.zeros(0, U64), np.zeros(0, np.uint16), np.zeros(0, np.uint16), np.zeros(0, np.uint32), np.zeros(0, np.int64),
            np.zeros(0, np.uint8), np.zeros(0, np.uint32), values[:0]]

    # hot anchors: every window on its own, dealt by the whole window
    lone: dict[int, list[np.ndarray]] = {}
    if (~cool).any():
        f, t = first[~cool], last[~cool]
        item, place = ragged(t - f + 1)
        w = f[item] + place
        k1, k2 = np.empty(len(w), U64), np.empty(len(w), U64)
        edge = np.append(np.arange(0, len(w), SLICE), len(w))
        for s, e in zip(edge[:-1], edge[1:]):
            lo, hi = int(w[s]), int(w[e - 1]) + width
            for b in range(lo, hi, SEGMENT):  # windows ascend within a chunk
                i = np.flatnonzero((w[s:e] >= b) & (w[s:e] < b + SEGMENT)) + s
                if len(i):
                    local = tokens[b:min(b + SEGMENT + width, len(tokens))]
                    for got, base in ((k1, 0x9E3779B97F4A7C15), (k2, _BASE2)):
                        got[i] = mix(range_hash(prefix_hash(local, base), w[i] - b, w[i] - b + width, base), seed=3)
        one, n = distinct(k1 ^ mix(k2, seed=4), w, w)
        w, k1, k2 = w[one], k1[one], k2[one]
        by, offsets = sort_by_part((k1 % U64(parts)).astype(np.int64), parts)
        for p in np.flatnonzero(np.diff(offsets)).tolist():
            i = by[offsets[p]:offsets[p + 1]]
            i = i[np.argsort(w[i])]
            doc = np.searchsorted(bounds, w[i], side="right") - 1
            lone[p] = [k1[i], k2[i], n[i].astype(np.uint32), ids[doc], missing[doc], w[i].astype(np.uint32)]
    no_lone = [np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint32)]

    home = chunk % parts
    ef = np.concatenate([e[0] for e in echo]) if echo else np.zeros(0, np.int64)
    et = np.concatenate([e[1] for e in echo]) if echo else np.zeros(0, np.int64)
    by = np.argsort(ef, kind="stable")
    echoes = {home: [ef[by].astype(np.uint32), (et - ef)[by].astype(np.uint16)]} if len(ef) else {}
    no_echo = [np.zeros(0, np.uint32), np.zeros(0, np.uint16)]
    return messages((p, chunk, pack(*out.get(p, none), *lone.get(p, no_lone), *echoes.get(p, no_echo)))
                    for p in sorted({*out, *lone, *echoes}))


def _ranks(missing, ids, src, place) -> np.ndarray:
    """Document order of occurrences: id (nulls last), chunk, place."""
    order = np.lexsort((place, src, ids, missing))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def resolve(table: pa.Table, kernel: Callable, width: int, gram: int, earlier_only: bool) -> pa.Table:
    """Step 4 for one part: the window starts to remove, as runs, for each chunk."""
    got = list(incoming(table))
    if not got:
        return messages([])
    part = table.column("dst")[0].as_py()
    sizes = np.array([len(a[0]) for _, a in got])
    src = np.repeat(np.array([s for s, _ in got]), sizes)
    key, left, right, copies, ids, missing, first = (np.concatenate([a[i] for _, a in got]) for i in range(7))
    values = np.concatenate([a[7] for _, a in got])
    left, right, copies = left.astype(np.int64), right.astype(np.int64), copies.astype(np.int64)
    n_windows = left + right - (width - gram) + 1
    runs: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {s: [(a[14].astype(np.int64), a[14].astype(np.int64) + a[15])] for s, a in got}

    if len(key):
        rank = _ranks(missing, ids, src, first)
        length = left + right
        ends = np.cumsum(length)
        # equal spans of several chunks become one, with the first one's rank
        item, place = ragged(length)
        value = mix(values.astype(U64), seed=5) * powers(int(length.max()))[0][place]
        same = mix(np.add.reduceat(value, ends - length) + mix(key, seed=6) + (left * 1024 + right).astype(U64))
        _, rep, span = np.unique(same, return_index=True, return_inverse=True)
        total = np.bincount(span, weights=copies).astype(np.int64)
        earliest = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(earliest, span, rank)
        # only grams with several different surroundings need the kernel
        _, group, n = np.unique(key[rep], return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(n[group] > 1)
        flags_at = np.zeros(len(rep) + 1, np.int64)
        np.cumsum(n_windows[rep], out=flags_at[1:])
        flags = np.repeat((total > 1) & (not earlier_only), n_windows[rep])
        if len(mixed):
            mixed = mixed[np.argsort(group[mixed], kind="stable")]
            m = rep[mixed]
            it, pl = ragged(length[m])
            seen = kernel(group[mixed], left[m], right[m], n_windows[m], values[(ends - length)[m][it] + pl], total[mixed], earliest[mixed])
            it, pl = ragged(n_windows[m])
            flags[flags_at[mixed][it] + pl] = seen
        # to each occurrence its windows
        if earlier_only:
            whole = rank != earliest[span]
        else:
            whole = total[span] > 1
        it, pl = ragged(n_windows)
        gone = whole[it] | flags[flags_at[span][it] + pl]
        begin = gone.copy()
        begin[1:] &= ~gone[:-1] | (it[1:] != it[:-1])
        end = gone.copy()
        end[:-1] &= ~gone[1:] | (it[1:] != it[:-1])
        b, e = np.flatnonzero(begin), np.flatnonzero(end)
        who = src[it[b]]
        lo, hi = first[it[b]].astype(np.int64) + pl[b], first[it[e]].astype(np.int64) + pl[e]
        for s in np.unique(who).tolist():
            runs[s].append((lo[who == s], hi[who == s]))

    lone_sizes = np.array([len(a[8]) for _, a in got])
    if lone_sizes.sum():
        src = np.repeat(np.array([s for s, _ in got]), lone_sizes)
        k1, k2, copies, ids, missing, at = (np.concatenate([a[i] for _, a in got]) for i in range(8, 14))
        order = np.lexsort((k2, k1))
        new = np.ones(len(order), bool)
        new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        if earlier_only:
            rank = _ranks(missing, ids, src, at)
            least = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, group, rank)
            gone = rank != least[group]
        else:
            gone = np.bincount(group, weights=copies)[group] > 1
        for s in np.unique(src[gone]).tolist():
            w = at[gone & (src == s)].astype(np.int64)
            runs[s].append((w, w))

    out = []
    for s, pieces in runs.items():
        lo, hi = np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])
        if len(lo):
            by = np.argsort(lo, kind="stable")
            lo, hi = lo[by], hi[by]
            out.append((s, part, pack(np.diff(lo, prepend=0).astype(np.uint32), (hi - lo).astype(np.uint16))))
    return messages(out)


def covered(replies: pa.Table, n_tokens: int, width: int) -> np.ndarray:
    """Step 5 for one chunk: which tokens lie in a removed window."""
    change = np.zeros(n_tokens + 1, np.int64)
    for _, (step, more) in incoming(replies):
        lo = np.cumsum(step.astype(np.int64))
        np.add.at(change, lo, 1)
        np.add.at(change, lo + more + width, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, tokenise: Callable, kernel: Callable, finish: Callable,
                   schema: T.StructType, width: int, gram: int, earlier_only: bool, keep: bool = False, hot: int = HOT_ANCHOR,
                   chunks: int | None = None) -> DataFrame:
    """Run the five steps.  ``finish(table, removed, tokens...)`` makes the rows of one chunk."""
    chunks = chunks or n_chunks(docs.sparkSession, text_bytes(docs, text_col))
    parts = chunks
    texts = chunked(docs, id_col, text_col, chunks, keep)
    slim = texts.select("chunk", "id", "h", "text") if not keep else texts

    def step1(t: pa.Table) -> pa.Table:
        return ask(t, tokenise, width, gram, parts)

    def step2(t: pa.Table) -> pa.Table:
        return answer(t, hot)

    def step3(t: pa.Table, r: pa.Table) -> pa.Table:
        return send_spans(t, r, tokenise, width, gram, parts, earlier_only)

    def step4(t: pa.Table) -> pa.Table:
        return resolve(t, kernel, width, gram, earlier_only)

    def step5(t: pa.Table, r: pa.Table) -> pa.Table:
        return finish(in_order(t), r)

    asked = slim.groupBy("chunk").applyInArrow(step1, MESSAGE)
    replies = asked.groupBy("dst").applyInArrow(step2, MESSAGE)
    spans = slim.groupBy("chunk").cogroup(replies.groupBy("dst")).applyInArrow(step3, MESSAGE)
    runs = spans.groupBy("dst").applyInArrow(step4, MESSAGE)
    return slim.groupBy("chunk").cogroup(runs.groupBy("dst")).applyInArrow(step5, schema)
