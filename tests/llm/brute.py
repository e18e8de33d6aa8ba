"""Brute-force versions of the operators, in plain Python over small lists."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(text: str | None) -> bytes:
    raw = (text or "").encode()
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw)


def repeated_words(docs, width=35):
    """(id, n_words, n_removed, sha) of each (id, text)."""
    words = [SPACES.findall((t or "").encode()) for _, t in docs]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (ident, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone |= set(range(i, i + width))
        out.append((ident, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def earlier_bytes(docs, width=100):
    """(id, n_bytes, n_removed, n_spans, sha, kept bytes) of each (id, text), in document order."""
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    seen, out = set(), []
    for ident, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            piece = raw[i:i + width]
            if piece in seen:
                gone[i:i + width] = b"\1" * width
            seen.add(piece)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((ident, len(raw), sum(gone), spans, sha(kept), kept))
    return out


def leaks(docs, items, width=10):
    """(id, n_words, n_hit, n_items, sha, contaminated) of each (id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        size = min(len(w), width)
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for ident, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = windows.get(tuple(w[i:i + size]))
                if got:
                    hit |= set(range(i, i + size))
                    found |= got
        ids = ",".join(sorted(map(str, found)))
        out.append((ident, len(w), len(hit), len(found), sha(ids.encode()), bool(hit)))
    return out


def shingle_set(text, k):
    w = SPACES.findall(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def components(docs, k=3, percent=90):
    """(id, set size, smallest id of the component) of each (id, text)."""
    sets = [shingle_set(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = docs[i][0] is not None and docs[i][0] == docs[j][0]
            if same_id or both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(docs):
        if ident is not None:
            least[find(i)] = min(least.get(find(i), ident), ident)
    return [(ident, len(s), least.get(find(i))) for i, ((ident, _), s) in enumerate(zip(docs, sets))]


def lm(docs, folds=5, fold=1, discounts=None):
    """(id, held_out, n_tokens, n_known, train_tokens, base, score) of each (id, text)."""
    end, start = object(), object()
    rows = [(i, i is not None and zlib.crc32(str(i).encode()) % folds == fold, [*SPACES.findall(lower(t)), end]) for i, t in docs]
    count, context, pair = Counter(), Counter(), Counter()
    for _, out, tokens in rows:
        if not out:
            count.update(tokens)
            before = [start, *tokens[:-1]]
            context.update(before)
            pair.update(zip(before, tokens))
    n, v = sum(count.values()), len(count)
    tally = [sum(1 for c in pair.values() if c == r) for r in (1, 2, 3, 4)]
    d = discounts(tally)
    follow = defaultdict(lambda: [0, 0, 0])
    for (h, _), c in pair.items():
        follow[h][min(c, 3) - 1] += 1
    result = []
    for ident, out, tokens in rows:
        base = score = 0.0
        state = start
        for w in tokens:
            p0 = (count[w] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p0)
            p = p0
            if context[state]:
                weight = sum(x * y for x, y in zip(d, follow[state])) / context[state]
                c = pair[state, w]
                p = weight * p0 + ((c - d[min(c, 3) - 1]) / context[state] if c else 0)
            score += math.log10(p)
            state = w
        result.append((ident, out, len(tokens), sum(1 for w in tokens if count[w]), n, base, score))
    return result


def targets(sizes: dict, weights=(1, 2, 3), limit=3):
    """Each source's target, by sharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    full, left = {}, set(order)
    while True:
        rest = total - sum(full.values())
        share = sum(weight[s] for s in left)
        over = {s for s in left if rest * weight[s] / share > limit * sizes[s]}
        if not over:
            return full | {s: rest * weight[s] / share for s in left}
        full |= {s: limit * sizes[s] for s in over}
        left -= over
        if not left:
            return full
