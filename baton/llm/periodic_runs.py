"""Periodic run detection by multi-scale minimizers.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``max(min_length, exponent * q)`` words long, that no neighbouring word extends.  Short periods
are found by direct scans: one comparison of the words with those q places on.  Longer periods
are found scale by scale.  At scale s every place has a hash of its next ``2**s`` words, and the
*minimizers* are the places whose hash is least in some window of ``2**(s-1)`` places.  Inside a
run with ``2**(s-1) < q <= 2**s`` the windows repeat after q places, and so do their minima; no
nearer place has the same words, as the gram is at least a period long.  So two successive
minimizers of equal hash lie exactly q apart: such pairs are the seeds of that scale.  Seeds are
extended word by word, which also rules out hashes that only look equal.  (With an exponent of 4
a run holds at least two such window pairs, so none is missed.)

Texts are handled a few MB at a time, whole texts always; each is one row of one task, and
nothing is shuffled.  Work is in proportion to words times scales.

Defined results: a null or empty text has no words and no runs; ids may be null, repeated or of
any type, rows stay as they are.  The same stretch is given once, with its smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.llm.text import mix, slices

MIN_LENGTH, EXPONENT = 6, 4
#: Periods up to ``2**DIRECT`` are scanned directly.
DIRECT = 3
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _equal_ahead(words: np.ndarray, ends: np.ndarray, q: int) -> np.ndarray:
    """Whether each word equals that q places on in its own text; ``ends``: the end of each word's text."""
    same = np.zeros(len(words), bool)
    if q < len(words):
        same[:-q] = (words[:-q] == words[q:]) & (np.arange(len(words) - q) + q < ends[:-q])
    return same


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of the stretches that are true."""
    edge = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each ``width`` successive values, a power of two, by doubling."""
    step = 1
    while step < width:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places whose hash is the least of a window of ``width`` places; a 0 spoils its windows."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    pad = np.zeros(width - 1, hashes.dtype)
    return np.flatnonzero((_sliding(np.concatenate([pad, least, pad]), width, np.maximum) == hashes) & (hashes != 0))


def _extent(words: np.ndarray, low: int, high: int, a: int, b: int, q: int) -> tuple[int, int]:
    """[a, b) grown while the words equal those q places on, within the text [low, high)."""
    step = 64
    while b + q < high:
        n = min(step, high - q - b)
        differ = np.flatnonzero(words[b:b + n] != words[b + q:b + q + n])
        if len(differ):
            b += int(differ[0])
            break
        b, step = b + n, step * 2
    step = 64
    while a > low:
        n = min(step, a - low)
        differ = np.flatnonzero(words[a - n:a] != words[a - n + q:a + q])
        if len(differ):
            a += int(differ[-1]) + 1 - n
            break
        a, step = a - n, step * 2
    return a, b


def find_runs(words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the texts with the words ``words[bounds[t]:bounds[t + 1]]``.

    Words are numbers, equal for equal words; starts count from the first text's first word.
    """
    if exponent < 4:
        raise ValueError("seeds need an exponent of 4 or more")
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)
    for q in range(1, (1 << DIRECT) + 1):
        a, b = _stretches(_equal_ahead(words, ends, q))
        long = b - a + q >= max(min_length, exponent * q)
        found.append((a[long], (b - a + q)[long], np.full(int(long.sum()), q)))
    # the texts that a scale's periods fit are taken out of the arrays as scales go up
    place = np.arange(len(words))
    hashes, grown = mix(words.astype(np.uint64), seed=1) | np.uint64(1), 1
    scale = DIRECT + 1
    while True:
        room = sizes >= exponent * ((1 << (scale - 1)) + 1)
        if not room.any():
            break
        keep = room[np.searchsorted(bounds, place, side="right") - 1]
        place, hashes = place[keep], hashes[keep]
        gram, width = 1 << scale, 1 << (scale - 1)
        while grown < gram:  # hashes of twice as many words; 0 where the text ends before
            ahead = np.zeros_like(hashes)
            ahead[:-grown] = np.where(place[:-grown] + grown < ends[place[:-grown]], hashes[grown:], 0)
            hashes = np.where((ahead != 0) & (hashes != 0), mix(hashes * np.uint64(0x9E3779B97F4A7C15) + ahead, seed=grown.bit_length()) | np.uint64(1), np.uint64(0))
            grown *= 2
        at = minimizers(hashes, width)
        at = at[np.argsort(hashes[at], kind="stable")]
        pair = hashes[at[1:]] == hashes[at[:-1]]
        x, q = place[at[:-1][pair]], (place[at[1:]] - place[at[:-1]])[pair]
        near = (q > width) & (q <= gram)
        found.append(_extended(words, bounds, x[near], q[near], gram, min_length, exponent))
        scale += 1
    start, length, period = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in range(3))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[first], length[first], period[first]


def _extended(words: np.ndarray, bounds: np.ndarray, x: np.ndarray, q: np.ndarray, gram: int, min_length: int,
              exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs that hold the seeds: ``gram`` words from x and from x + q with equal hashes."""
    out: list[tuple[int, int, int]] = []
    order = np.lexsort((x, q))
    x, q = x[order], q[order]
    text = np.searchsorted(bounds, x, side="right") - 1
    # seeds of one period that overlap are one stretch already
    new = np.ones(len(x), bool)
    new[1:] = (q[1:] != q[:-1]) | (text[1:] != text[:-1]) | (x[1:] > x[:-1] + gram)
    heads = np.flatnonzero(new)
    done = (-1, -1, -1)  # text, period and end of the stretch before
    for k, i in enumerate(heads):
        stop = heads[k + 1] if k + 1 < len(heads) else len(x)
        t, period = int(text[i]), int(q[i])
        a, b = int(x[i]), int(x[stop - 1]) + gram
        if done[:2] == (t, period) and b <= done[2]:
            continue
        low, high = int(bounds[t]), int(bounds[t + 1])
        b = min(b, high - period)
        differ = np.flatnonzero(words[a:b] != words[a + period:b + period])
        for piece in zip([a, *(a + differ + 1).tolist()], [*(a + differ).tolist(), b]):  # one piece, but for equal hashes of different words
            if piece[1] > piece[0]:
                first, end = _extent(words, low, high, *piece, period)
                done = (t, period, end)
                if end - first + period >= max(min_length, exponent * period):
                    out.append((first, end - first + period, period))
    r = np.array(out, np.int64).reshape(-1, 3)
    return r[:, 0], r[:, 1], r[:, 2]


def split_words(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in UTF-8: what ``bytes.split`` gives."""
    return text.split() if text else []


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, equal for equal words, and the bounds of the texts."""
    bounds = np.cumsum([0] + [len(t) for t in texts])
    flat = pa.array([w for t in texts for w in t], pa.large_binary())
    return flat.dictionary_encode().indices.to_numpy().astype(np.int64), bounds


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run covers after its own first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  exponent: int = EXPONENT) -> DataFrame:
    """(id_col, n_words, runs, collapsed): of each text its runs by start and period, and the text
    without their repeats: the words that are left, joined by one space."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", RUNS), T.StructField("collapsed", T.BinaryType())])

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [split_words(t) for t in batch.column(1).to_pylist()]
                words, bounds = numbered(texts)
                start, length, period = find_runs(words, bounds, min_length, exponent)
                at = np.searchsorted(start, bounds)
                runs, left = [], []
                for t, own in enumerate(texts):
                    k = slice(at[t], at[t + 1])
                    mine = list(zip((start[k] - bounds[t]).tolist(), length[k].tolist(), period[k].tolist()))
                    mine.sort(key=lambda r: (r[0], r[2]))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                    left.append(b" ".join(collapsed(own, mine)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(runs, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
                    pa.array(left, pa.binary())], names=[id_col, "n_words", "runs", "collapsed"])

    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")).mapInArrow(detect, schema)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
