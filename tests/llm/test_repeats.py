"""Substring dedup (1) and suffix-array dedup (4) against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from baton.llm.anchors import find_anchors
from baton.llm.substring_dedup import dedup_words, prefix_sets
from baton.llm.suffix_array_dedup import bucket_pointer_refinement, dedup_bytes
from baton.llm.text import BYTE_VALUE
from tests.llm.brute import earlier_bytes, repeated_words


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("width,chunks,hot", [(35, 5, 200_000), (35, 3, 1), (5, 4, 3), (2, 2, 200_000)])
def test_repeated_words(corpus, corpus_frame, width, chunks, hot):
    got = dedup_words(corpus_frame, width=width, chunks=chunks, hot=hot).collect()
    assert sorted(map(tuple, got), key=key) == sorted(repeated_words(corpus, width), key=key)
    assert any(r.n_removed for r in got)


def without_ties(corpus):
    """Rows whose order is set by their id: one row for each id, and one without an id."""
    seen, out = set(), []
    for i, t in corpus:
        if i not in seen:
            seen.add(i)
            out.append((i, t))
    return out


@pytest.mark.parametrize("width,chunks,hot", [(100, 5, 200_000), (100, 3, 1), (9, 4, 3), (3, 2, 200_000)])
def test_earlier_bytes(spark, corpus, width, chunks, hot):
    rows = without_ties(corpus)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = dedup_bytes(df, width=width, chunks=chunks, hot=hot).collect()
    assert sorted(map(tuple, got), key=key) == sorted((r[:5] for r in earlier_bytes(rows, width)), key=key)
    assert any(r.n_removed for r in got)


def test_equal_rows_keep_one(corpus_frame, corpus):
    got = dedup_bytes(corpus_frame, chunks=4, with_text=True)
    assert got.count() == len(corpus)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "rest"]
    twice = [r for r in got.collect() if r.doc_id == corpus[3][0]]
    assert len(twice) == 3 and len({r.kept_sha256 for r in twice if r.n_bytes >= 100}) <= 2
    assert sorted(r.rest.c0 for r in got.collect()) == sorted(f"c{i}" for i in range(len(corpus)))
    nulls = [r for r in got.collect() if r.text is None]
    assert len(nulls) == sum(t is None for _, t in corpus) and all(r.n_bytes == 0 for r in nulls)


def test_kept_text_has_whole_characters(spark):
    shared = "x" * 49 + "é" * 40
    df = spark.createDataFrame([(1, shared + "é tail"), (2, "head " + shared + "è more")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in dedup_bytes(df, with_text=True, chunks=2).collect()}
    assert got == {1: shared + "é tail", 2: "head  more"}


@pytest.mark.parametrize("operator", [dedup_words, dedup_bytes])
def test_no_rows(no_rows, operator):
    assert operator(no_rows).collect() == []


def test_text_column_of_words(spark):
    words = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, f"a\n{words}  b"), (2, words)], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in dedup_words(df, with_text=True, chunks=2).collect()} == {1: "a b", 2: ""}


@pytest.mark.parametrize("alphabet,n", [(2, 400), (4, 3000), (256, 5000), (1, 300)])
def test_bucket_pointer_refinement_sorts_suffixes(alphabet, n):
    rng = random.Random(n)
    text = [rng.randrange(alphabet) for _ in range(n)]
    text[50:120] = text[200:270]
    for depth in (1, 7, 50):
        sa = bucket_pointer_refinement(np.array(text, np.int32), depth)
        assert sorted(sa.tolist()) == list(range(n))
        cut = [tuple(text[i:i + depth]) for i in sa.tolist()]
        assert cut == sorted(cut)


def test_prefix_sets_bound_the_trees():
    rng = random.Random(1)
    sym = np.array([rng.choice([0, 0, 0, 1, 2]) for _ in range(3000)] + [0] * 20)
    pos = np.arange(3000)
    sets = list(prefix_sets(sym, pos, depth=10, limit=50))
    assert sorted(np.concatenate([s for s, _ in sets]).tolist()) == pos.tolist()
    for at, d in sets:
        assert len({tuple(sym[i:i + d]) for i in at.tolist()}) <= 1
        assert len(at) <= 50 or d == 10
    # no repeat of 10 symbols is split between sets
    where = {}
    for number, (at, _) in enumerate(sets):
        for i in at.tolist():
            assert where.setdefault(tuple(sym[i:i + 10]), number) == number


def test_anchors_are_chosen_by_content():
    rng = random.Random(3)
    text = np.array([rng.randrange(256) for _ in range(500)], np.uint8)
    text[300:420] = text[40:160]
    bounds = np.array([0, 200, 200, 500])
    at, first, last, _ = find_anchors(BYTE_VALUE[text], bounds, 100, 51)
    place = {}
    for a, f, t in zip(at.tolist(), first.tolist(), last.tolist()):
        for w in range(f, t + 1):
            assert w <= a <= w + 49 and (w + 100 <= 200 or w >= 200)
            place[w] = a - w
    assert sorted(place) == [*range(0, 101), *range(200, 401)]
    for w in range(40, 61):
        assert place[w] == place[w + 260]
