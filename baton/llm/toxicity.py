"""Toxicity: cumulative-link ordinal regression from sparse text features.

A document's severity grade y is modelled by ``P(y >= k) = sigmoid(w . x - theta_k)``: one
weight vector for all grades, one threshold for each, in order.  Features are the distinct
words of a document (lower-cased, hashed) and their beginnings of 4 to 6 bytes, so that forms
of a word that were never labelled are known by their stem; that a text holds one twice, or four
times, are features of their own.  Features that the sample's grades
do not depend on are left out beforehand; weights of the others come from proximal gradient
steps with an L1 penalty.  A fixed penalty would drop every word below a share of the sample,
so its weight is the one under which a fifth of the sample, held out, is graded best: most
recall less the share of clean documents rejected.

The classifier is fitted on at most ``max_labels`` labelled documents, those of least id
hash: a bounded sample, fitted in one task.  ``keep_toxic`` draws it by side.  The weights (at most ``MAX_FEATURES``) are
broadcast; every document is scored over its whole text.

Defined results: a null or empty text has no features; without labelled documents, or with
labels of one grade only, that grade (or 0) is predicted for all; label rows that repeat a
document count once, with the highest grade; null labels are left out; rows with equal ids
are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baton.llm.text import ALNUM, U64, flat, lower, mix, slices, word_hashes, word_spans
from baton.llm.wire import pack, unpack

#: Labelled documents used for the fit at most.
MAX_LABELS = 8_000
#: Features kept at most: those that the grades depend on most.
MAX_FEATURES = 1 << 14
#: Documents of the sample that must hold a feature.
MIN_DOCS = 3
#: Ranges of hashes that are looked through one after the other.
RANGES = 16
#: Squared z-score of a feature's residuals from which it is kept.
SCREEN = 15.0
#: Bytes of the beginnings of words.
STEMS = (4, 5, 6)
#: Occurrences in one document that make a feature each.
LEVELS = (1, 2, 4)
#: L1 weights tried, on the mean loss, strongest first.
PENALTIES = (5e-4, 2e-4, 1e-4, 5e-5, 2e-5)
#: One document of so many is held out to choose among them.
HELD_OUT = 5


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word, hash) of each word as a whole, and of the beginnings of longer ones."""
    every = np.arange(len(start))
    out = [(every, word_hashes(data, start, end))]
    for k in STEMS:
        long = every[end - start > k]
        out.append((long, mix(word_hashes(data, start[long], start[long] + k), seed=50 + k)))
    return out


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, occurrences) of each distinct feature of each document."""
    data, offsets = flat(column)
    data = lower(data)
    start, end, bounds = word_spans(data, offsets, ALNUM)
    of = np.searchsorted(bounds, np.arange(len(start)), side="right") - 1
    found = word_features(data, start, end)
    return _counts(np.concatenate([of[w] for w, _ in found]), np.concatenate([h for _, h in found]))


def _counts(doc: np.ndarray, value: np.ndarray):
    """Distinct (document, value) pairs, and how often each comes."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return doc[first], value[first], np.diff(np.append(first, len(doc)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, n_features: int, l1: float = PENALTIES[0], steps: int = 400, weight: np.ndarray | None = None):
    """(weights, thresholds) for grades 0..K by accelerated proximal gradient descent.

    ``doc`` ascends.  The loss is the mean negative log-likelihood of the cumulative-link model, documents counted
    by ``weight``; thresholds are kept in order by their increments.
    """
    n, top = len(grade), int(grade.max())
    share = np.full(n, 1 / n) if weight is None else weight / weight.sum()
    order = np.argsort(feature, kind="stable")
    by_feature, ptr = doc[order], np.searchsorted(feature[order], np.arange(n_features))
    held = np.append(np.diff(ptr), len(feature) - ptr[-1]) > 0 if n_features else np.zeros(0, bool)
    doc_ptr = np.searchsorted(doc, np.arange(n))
    doc_held = np.append(np.diff(doc_ptr), len(doc) - doc_ptr[-1]) > 0

    def scores(w):
        z = np.zeros(n)
        if len(feature):
            z[doc_held] = np.add.reduceat(w[feature], doc_ptr[doc_held])
        return z

    def gradient(w, theta):
        z = scores(w)
        cut = np.concatenate([[-np.inf], theta, [np.inf]])  # y = k between cut[k] and cut[k + 1]
        lo, hi = z - cut[grade], z - cut[grade + 1]  # P(y = k) = s(lo) - s(hi)
        s_lo, s_hi = _sigmoid(lo), _sigmoid(hi)
        p = np.maximum(s_lo - s_hi, 1e-12)
        d_lo, d_hi = s_lo * (1 - s_lo) / p, s_hi * (1 - s_hi) / p
        dz = -(d_lo - d_hi) * share
        gt = np.bincount(grade, weights=d_lo * share, minlength=top + 1)[1:] - np.bincount(grade + 1, weights=d_hi * share, minlength=top + 2)[1:top + 1]
        gw = np.zeros(n_features)
        if len(feature):
            gw[held] = np.add.reduceat(dz[by_feature], ptr[held])
        return gw, gt, -(np.log(p) * share).sum()

    # thresholds start at the logits of the grades' shares
    tail = np.array([share[grade >= k].sum() for k in range(1, top + 1)])
    theta = -np.log(tail / (1 - tail))
    w = np.zeros(n_features)
    v_w, v_t, t = w.copy(), theta.copy(), 1.0
    rate = 1.0
    for _ in range(steps):
        gw, gt, loss = gradient(v_w, v_t)
        while True:
            step = v_w - rate * gw
            new_w = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
            new_t = np.maximum.accumulate(v_t - rate * gt)
            new_t += 1e-6 * np.arange(top)
            dw, dt = new_w - v_w, new_t - v_t
            bound = loss + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * rate)
            if gradient(new_w, new_t)[2] <= bound + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v_w, v_t = new_w + (t - 1) / t_next * (new_w - w), new_t + (t - 1) / t_next * (new_t - theta)
        v_t = np.maximum.accumulate(v_t)
        moved = max(np.abs(new_w - w).max(initial=0), np.abs(new_t - theta).max(initial=0))
        w, theta, t = new_w, new_t, t_next
        rate *= 1.5
        if moved < 1e-5:
            break
    return w, theta


def null_residuals(grade: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """What the thresholds alone leave of each document's grade."""
    share = np.bincount(grade, weights=weight) / weight.sum()
    above = np.append(np.cumsum(share[::-1])[::-1], 0.0)  # P(y >= k)
    slope = above * (1 - above)
    return ((slope[:-1] - slope[1:]) / np.maximum(share, 1e-12))[grade]


def screened(doc: np.ndarray, base: np.ndarray, times: np.ndarray, grade: np.ndarray, weight: np.ndarray):
    """(document, feature, features): the features, numbered by base and level, on whose presence
    the grades depend most, and the documents that hold them, ascending."""
    residual = null_residuals(grade, weight)
    spread = (weight * residual ** 2).sum() / weight.sum()
    size = int(base.max(initial=-1)) + 1
    score = np.zeros((size, len(LEVELS)))
    for i, k in enumerate(LEVELS):
        hit = times >= k
        n = np.bincount(base[hit], minlength=size)
        mass = np.bincount(base[hit], weights=weight[doc[hit]], minlength=size)
        z = np.bincount(base[hit], weights=(weight * residual)[doc[hit]], minlength=size) ** 2 / np.maximum(mass * spread, 1e-12)
        score[:, i] = np.where(n >= MIN_DOCS, z, 0.0)
    score = score.reshape(-1)
    ok = np.flatnonzero(score >= SCREEN)
    ok = np.sort(ok[np.argsort(-score[ok], kind="stable")][:MAX_FEATURES])
    dense = np.full(len(score), -1, np.int32)
    dense[ok] = np.arange(len(ok))
    docs, found = [], []
    for i, k in enumerate(LEVELS):
        feature = dense[base.astype(np.int64) * len(LEVELS) + i]
        hit = (times >= k) & (feature >= 0)
        docs.append(doc[hit])
        found.append(feature[hit])
    doc, feature = np.concatenate(docs), np.concatenate(found)
    order = np.lexsort((feature, doc))
    return doc[order], feature[order], ok


def penalty(doc: np.ndarray, base: np.ndarray, times: np.ndarray, grade: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The L1 weight under which held-out documents are told apart best; the strongest of equals.

    ``toxic`` says which grades, by number, are; where the sample is too small to hold
    out toxic and clean documents, it is the weakest.
    """
    every = np.arange(len(grade), dtype=np.uint64)
    out = mix(every, seed=70) % U64(HELD_OUT) == 0
    rest = grade[~out]
    if len(np.unique(rest)) <= grade.max() or len(np.unique(toxic[grade[out]])) < 2:
        return PENALTIES[-1]
    at = np.cumsum(~out) - 1
    kept = ~out[doc]
    d, f, ok = screened(at[doc[kept]], base[kept], times[kept], rest, weight[~out])
    dense = np.full((int(base.max(initial=-1)) + 1) * len(LEVELS), -1)
    dense[ok] = np.arange(len(ok))
    bad = toxic[grade]
    best, chosen = -np.inf, PENALTIES[0]
    first = int(np.argmax(toxic))  # the least toxic grade
    for l1 in PENALTIES:
        w, theta = fit(d, f, rest, len(ok), l1, weight=weight[~out])
        z = np.zeros(len(grade))
        for i, k in enumerate(LEVELS):
            hit = (times >= k) & ~kept
            column = dense[base[hit].astype(np.int64) * len(LEVELS) + i]
            z += np.bincount(doc[hit], weights=np.where(column >= 0, np.append(w, 0.0)[column], 0.0), minlength=len(grade))
        said = z >= theta[first - 1]
        gain = said[out & bad].mean() - said[out & ~bad].mean()
        if gain > best:
            best, chosen = gain, l1
    return chosen


def frequent(doc: np.ndarray, value: np.ndarray, times: np.ndarray):
    """(features, document, number of the feature, occurrences): only features that ``MIN_DOCS``
    documents hold, which are all that can be kept; by ranges of hashes, so that no copy of all
    entries is made."""
    known, at, base = [], [], []
    n = 0
    for r in range(RANGES):
        some = np.flatnonzero(value // U64(2 ** 64 // RANGES) == r).astype(np.int32)
        values, place, held = np.unique(value[some], return_inverse=True, return_counts=True)
        keep = held >= MIN_DOCS
        number = np.cumsum(keep).astype(np.int32) - 1 + n
        hit = keep[place]
        known.append(values[keep])
        at.append(some[hit])
        base.append(number[place[hit]])
        n += int(keep.sum())
    at, base = np.concatenate(at), np.concatenate(base)
    order = np.argsort(at, kind="stable")  # by document again
    at = at[order]
    return np.concatenate(known), doc[at], base[order], times[at]


def _fit_table(table: pa.Table) -> pa.Table:
    """The model of one bounded sample: sorted feature hashes, weights, grades and thresholds."""
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    grades, grade = np.unique(table.column("grade").to_numpy(), return_inverse=True)
    known, w, theta = np.zeros(0, U64), np.zeros(0), np.zeros(0)
    if len(grades) > 1:
        docs, values, counts = [], [], []
        for a in range(0, len(table), 250):  # features of some texts at a time
            d, v, t = features(table.column("text").slice(a, 250))
            docs.append((d + a).astype(np.int32))
            values.append(v)
            counts.append(np.minimum(t, LEVELS[-1]).astype(np.uint8))
        value = np.concatenate(values)
        values.clear()
        doc, times = np.concatenate(docs), np.concatenate(counts)
        docs.clear()
        known, doc, base, times = frequent(doc, value, times)
        del value
        weight = table.column("weight").to_numpy()
        l1 = penalty(doc, base, times, grade, grades > 0, weight)
        doc, feature, ok = screened(doc, base, times, grade, weight)
        fitted, theta = fit(doc, feature, grade, len(ok), l1, weight=weight)
        every = np.zeros(len(known) * len(LEVELS))
        every[ok] = fitted
        every = every.reshape(-1, len(LEVELS))
        used = (every != 0).any(axis=1)
        known, w = known[used], every[used].reshape(-1)
    return pa.table({"blob": pa.array([pack(known, w, grades.astype(np.int64), theta)], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", max_labels: int = MAX_LABELS, keep_toxic: bool = False) -> bytes:
    """Fit on the labelled documents; ``grade`` is an integer expression over ``labels``.

    ``keep_toxic`` fills up to half of the sample with toxic labels before clean ones are
    taken, and weighs each side as in all labels.
    """
    sample = labels.select(F.col(f"`{label_id_col}`").cast("bigint").alias("id"), grade.cast("int").alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL")
    sample = sample.groupBy("id").agg(F.max("grade").alias("grade"))
    first = lambda rows, n: rows.orderBy(F.xxhash64("id"), "id").limit(n)
    if keep_toxic:
        toxic = F.col("grade") > 0
        n_toxic, n_clean = sample.agg(F.count_if(toxic), F.count_if(~toxic)).first()
        some_toxic = min(n_toxic, max(max_labels // 2, max_labels - n_clean))
        some_clean = min(n_clean, max_labels - some_toxic)
        sample = first(sample.where(toxic), some_toxic).withColumn("weight", F.lit(n_toxic / max(some_toxic, 1))).unionByName(
            first(sample.where(~toxic), some_clean).withColumn("weight", F.lit(n_clean / max(some_clean, 1))))
    else:
        sample = first(sample, max_labels).withColumn("weight", F.lit(1.0))  # at most 20 bytes a row are broadcast
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    held = texts.join(F.broadcast(sample), "id").groupBy("id").agg(F.max("grade").alias("grade"), F.max("weight").alias("weight"), F.min("text").alias("text"))
    got = held.groupBy(F.lit(0).alias("all")).applyInArrow(_fit_table, "blob binary").collect()
    return bytes(got[0]["blob"]) if got else pack(np.zeros(0, U64), np.zeros(0), np.zeros(1, np.int64), np.zeros(0))


def severity(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic): the expected grade, the probability of any
    grade above 0, the most probable grade, and whether it is more likely toxic than not.

    ``keep`` gives the input's columns and the documents that are not toxic instead.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    read = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       *([F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")] if keep else []))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight, grades, theta = unpack(sent.value)
        weight = weight.reshape(-1, len(LEVELS))
        bits = 18
        seen = np.zeros(1 << bits, bool)
        seen[(known >> U64(64 - bits)).astype(np.int64)] = True
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = flat(piece.column(0))
                data = lower(data)
                start, end, bounds = word_spans(data, offsets, ALNUM)
                n = piece.num_rows
                pairs = []
                for word, value in word_features(data, start, end):
                    some = np.flatnonzero(seen[(value >> U64(64 - bits)).astype(np.int64)])
                    if len(some):
                        at = np.minimum(np.searchsorted(known, value[some]), len(known) - 1)
                        hit = known[at] == value[some]
                        pairs.append(np.stack([np.searchsorted(bounds, word[some[hit]], side="right") - 1, at[hit]]))
                z = np.zeros(n)
                if pairs:
                    doc, base, times = _counts(*np.concatenate(pairs, axis=1))
                    for i, k in enumerate(LEVELS):
                        z += np.bincount(doc[times >= k], weights=weight[base[times >= k], i], minlength=n)
                above = _sigmoid(z[:, None] - theta[None, :])  # P(y >= each grade but the first)
                share = np.concatenate([np.ones((n, 1)), above], axis=1) - np.concatenate([above, np.zeros((n, 1))], axis=1)
                expected = share @ grades.astype(float)
                toxic = share @ (grades > 0)
                if keep:
                    yield pa.RecordBatch.from_arrays([piece.column(2).filter(pa.array(toxic < 0.5))], names=["row"])
                else:
                    yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(expected), pa.array(toxic), pa.array(grades[share.argmax(axis=1)].astype(np.int32)),
                                                      pa.array(toxic >= 0.5)], names=["doc_id", "severity", "p_toxic", "grade", "toxic"])

    if keep:
        return read.mapInArrow(score, T.StructType([read.schema["row"]])).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
    return read.mapInArrow(score, "doc_id bigint, severity double, p_toxic double, grade int, toxic boolean")


def severity_grade() -> Column:
    """0 for documents that are not toxic, 1 for toxic ones, 2 for toxic ones of low quality too."""
    return F.when(F.col("toxic") > 0, F.when(F.col("quality") > 0, 1).otherwise(2)).when(F.col("toxic") == 0, 0)
