"""Periodic run detection (12) against a scan of every period."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from baton.llm import periodic_runs as pr
from baton.llm import queries
from tests.llm.brute import SPACES, sha


def smallest_period(w):
    """By the failure function."""
    fail = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k]
        k += w[i] == w[k]
        fail[i + 1] = k
    return len(w) - fail[len(w)]


def all_runs(w, min_length=6, exponent=4):
    out = []
    n = len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - a + q
            if length >= max(min_length, exponent * q) and smallest_period(w[a:a + length]) == q:
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def ours(texts, **kw):
    words, bounds = pr.numbered(texts)
    start, length, period = pr.find_runs(words, bounds, **kw)
    t = np.searchsorted(bounds, start, side="right") - 1
    out = [[] for _ in texts]
    for i, s, n, q in zip(t, start, length, period):
        out[i].append((int(s - bounds[i]), int(n), int(q)))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def text_of(rng, kind):
    n = rng.randint(0, 400)
    if kind == "letters":
        return [rng.choice([b"a", b"b"]) for _ in range(n)]
    if kind == "planted":
        w = [str(rng.randint(0, 30)).encode() for _ in range(n)]
        for _ in range(rng.randint(1, 4)):
            root = [str(rng.randint(0, rng.choice([2, 50]))).encode() for _ in range(rng.randint(1, 90))]
            times = rng.choice([3.5, 3.99, 4, 4.01, 5.3, 9])
            at = rng.randint(0, len(w))
            w[at:at] = (root * 10)[:int(times * len(root))]
        return w
    if kind == "fibonacci":
        a, b = [b"a"], [b"a", b"b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == "thue-morse":
        return [b"ab"[bin(i).count("1") % 2:][:1] for i in range(n)] * rng.randint(1, 6)
    nested = [b"a", b"a", b"a", b"b"]
    for _ in range(rng.randint(1, 3)):
        nested = nested * 4 + [rng.choice([b"a", b"c"])]
    return nested


@pytest.mark.parametrize("kind", ["letters", "planted", "fibonacci", "thue-morse", "nested"])
def test_runs_equal_every_period(kind):
    rng = random.Random(kind)
    texts = [text_of(rng, kind) for _ in range(60)] + [[], [b"x"]] + [[b"x"] * n for n in range(8)]
    for text, got in zip(texts, ours(texts)):
        assert got == all_runs(text)


def test_other_bounds():
    rng = random.Random(2)
    texts = [text_of(rng, "planted") for _ in range(30)]
    for min_length, exponent in ((1, 4), (40, 5), (6, 7)):
        for text, got in zip(texts, ours(texts, min_length=min_length, exponent=exponent)):
            assert got == all_runs(text, min_length, exponent)
    with pytest.raises(ValueError):
        ours(texts, exponent=2)


def test_equal_hashes_of_other_words_are_no_runs(monkeypatch):
    # a hash of few values: seeds that only look equal must be cut to what is equal
    full = pr.mix
    monkeypatch.setattr(pr, "mix", lambda x, seed=0: full(x, seed) & np.uint64(0x1F))
    rng = random.Random(8)
    for _ in range(40):
        text = text_of(rng, "planted")
        assert set(ours([text])[0]) <= set(all_runs(text))


def test_very_long_texts():
    root = [str(i).encode() for i in range(40_000)]
    for text, run in (([b"w"] * 500_000, (0, 500_000, 1)), ([b"x"] + root * 5 + [b"y"], (1, 200_000, 40_000)), (root * 3, None)):
        assert ours([text])[0] == ([run] if run else [])


def expected(ident, text):
    """The contract's row of one document."""
    w = SPACES.findall((text or "").encode())
    n = len(w)
    h = None if ident is None else zlib.crc32(str(ident).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = all_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = None
    for s, k, q in runs:
        if best is None or k * best[2] > best[1] * q:
            best = (s, k, q)
    return (ident, len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2], sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, corpus, corpus_frame, tmp_dir):
    corpus_frame.write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op12_periodic_runs(spark, tmp_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(i, t) for i, t in corpus]
    assert rows_of(got) == sorted(want, key=repr) and sum(w[1] > 0 for w in want) >= 5


def test_query_on_the_test_table(spark):
    from tests.conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if r.text is None or len(r.text) < 6000}  # the slow side is quadratic
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, SF001).collect()]
    assert len(got) == len(docs)
    assert sorted(r for r in got if r[0] in short) == sorted(expected(i, t) for i, t in short.items())


def test_operator_gives_the_spans_and_the_text(spark, no_rows):
    rows = [("k", "a  b a b\na b a b c", 1), (None, None, 2), ("e", "", 3), ("n", " \t", 4)]
    df = spark.createDataFrame(rows, "text string, words string, id int")
    got = {r["text"]: r for r in pr.periodic_runs(df, "text", "words").collect()}
    assert [tuple(r) for r in got["k"].runs] == [(0, 8, 2)] and got["k"].collapsed == "a b c" and got["k"].n_words == 9
    assert all(got[k].runs == [] and got[k].collapsed == "" and got[k].n_words == 0 for k in (None, "e", "n"))
    assert pr.periodic_runs(no_rows).count() == 0
