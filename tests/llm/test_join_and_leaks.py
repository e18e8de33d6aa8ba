"""Jaccard join (10) and decontamination (9) against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from baton.llm import decontaminate as D
from baton.llm import jaccard_join as J
from tests.llm.brute import components, leaks, shingle_set
from tests.llm.conftest import near, prose
from tests.llm.test_repeats import key


@pytest.mark.parametrize("k,percent,orders", [(3, 90, 2), (5, 80, 2), (3, 50, 3)])
def test_components(corpus, corpus_frame, k, percent, orders):
    got = J.jaccard_components(corpus_frame, shingle=k, percent=percent, orders=orders).collect()
    want = components(corpus, k, percent)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len({r[2] for r in want}) < len(corpus) - 8


def test_a_hot_group_of_near_copies_and_chains(spark):
    rng = random.Random(5)
    seed = prose(rng, 150)
    rows = [(i, near(rng, seed, 2)) for i in range(120)]
    text = prose(rng, 120)
    for i in range(12):  # a chain: neighbours link, ends do not
        rows.append((200 + i, text))
        text = near(rng, text, 2)
    rows += [(400 + i, prose(rng, 100) + seed[:200]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, J.jaccard_components(df).collect())) == sorted(components(rows))


def test_components_that_link_are_joined_before_all_their_pairs_are_listed(spark, monkeypatch):
    monkeypatch.setattr(J, "CLOSEST", 0)  # nothing is joined by step 1
    monkeypatch.setattr(J, "FEW", 0, raising=False)
    cross, made = J._Join.cross, []

    def counted(self, *args):
        pairs = J.stored(cross(self, *args))
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(J._Join, "cross", counted)
    rng = random.Random(13)
    seed, other = prose(rng, 150), prose(rng, 150)
    rows = [(i, near(rng, seed, 1)) for i in range(150)] + [(500 + i, near(rng, other, 3)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, J.jaccard_components(df).collect())) == sorted(components(rows))
    assert sum(made) < 5 * len(rows), made  # the first group alone has 11,175 pairs, all linked


def test_representatives(spark, corpus, corpus_frame):
    kept = J.keep_representatives(corpus_frame)
    assert kept.columns == corpus_frame.columns
    want = {i for i, _, least in components(corpus, 5, 80) if i == least and i is not None}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == want
    nulls = [r.text for r in kept.collect() if r.doc_id is None]
    assert sorted(nulls, key=str) == sorted([None, "a text without an id that nobody else has"], key=str)


@pytest.mark.parametrize("operator", [J.jaccard_components, J.keep_representatives])
def test_no_rows(no_rows, operator):
    assert operator(no_rows).collect() == []


def test_shared_prefixes_are_as_many_as_linked_sets_need():
    rng = random.Random(11)
    for percent in (50, 80, 90):
        for _ in range(60):
            base = set(rng.sample(range(4000), rng.randint(3, 300)))
            other = set(list(base)[rng.randint(0, len(base) // 12):]) | set(rng.sample(range(4000, 8000), rng.randint(0, len(base) // 12)))
            both = len(base & other)
            if 100 * both < percent * len(base | other):
                continue
            order = {x: rng.random() for x in base | other}
            n, m = np.array([len(base)]), np.array([len(other)])
            cut = [set(sorted(s, key=order.get)[:int(J.prefix_length(np.array([len(s)]), percent)[0])]) for s in (base, other)]
            assert len(cut[0] & cut[1]) >= J.shared_needed(n, m, percent)[0] >= 1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in J.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_sets_are_those_of_the_words():
    import pyarrow as pa
    texts = ["a b c d a b c", None, "", "A b", "x  y\nz"]
    known, place, at = J.shingle_sets(pa.array(texts), 3)
    assert np.diff(at).tolist() == [len(shingle_set(t, 3)) for t in texts]
    assert len(known) == len(set(known[place].tolist())) == len(set().union(*(shingle_set(t, 3) for t in texts))) == 6


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again today"), (2, "short item"), (3, None), (4, "  .,; "), (12, "short item"),
         (5, "quick brown fox jumps over the lazy dog again and"), (None, "one two"), (30, "é" * 3 + " ñ ü ö ä ß 1 2 3 4 5 6")]


def leak_docs():
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 60))) for i in range(20)]
    rows += [(50, "x THE QUICK brown-fox jumps, over the lazy dog! Again; and AGAIN today y"), (51, "a short item of the quick brown fox"), (52, None), (53, ""),
             (54, "quick brown fox jumps over the lazy dog again"), (55, "ééé ñ ü ö ä ß 1 2 3 4 5 6 " * 40), (None, "short item"), (50, "twice"),
             (56, "w " * 5000 + "short item " + "v " * 5000), (57, "short"), (58, "item short item")]
    return rows


@pytest.mark.parametrize("width,shingle,block", [(10, 3, 200_000), (10, 1, 200_000), (4, 4, 200_000), (10, 3, 14), (2, 3, 1)])
def test_leaks(spark, width, shingle, block):
    rows = leak_docs()
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, row int").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = D.decontaminate(docs, items, width=width, shingle=shingle, block_windows=block).collect()
    want = leaks(rows, [x for x in ITEMS if x[0] is not None], width)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    clean = D.decontaminate(docs, items, width=width, shingle=shingle, block_windows=block, keep=True)
    assert clean.columns == docs.columns
    assert sorted(r.row for r in clean.collect()) == [n for n, w in enumerate(want) if not w[5]]


def test_no_items_and_no_documents(spark, no_rows):
    docs = spark.createDataFrame(leak_docs(), "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    got = D.decontaminate(docs, items).collect()
    assert sorted(map(tuple, got), key=key) == sorted(leaks(leak_docs(), []), key=key)
    assert D.decontaminate(no_rows, spark.createDataFrame(ITEMS, "item_id bigint, text string")).collect() == []


def test_parity_bitmaps_differ_no_more_than_sets():
    rng = np.random.default_rng(3)
    for _ in range(50):
        base = rng.integers(0, 2 ** 63, rng.integers(1, 900)).astype(np.uint64)
        other = np.concatenate([base[rng.integers(0, 40):], rng.integers(0, 2 ** 63, rng.integers(0, 40)).astype(np.uint64)])
        bits = J.parity(np.concatenate([base, other]), np.array([0, len(base), len(base) + len(other)]))
        different = len(set(base.tolist()) ^ set(other.tolist()))
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= different
    assert J.parity(np.zeros(0, np.uint64), np.array([0, 0])).tolist() == [[0] * J.PARITY_WORDS]


def test_nearest_and_cross_pairs():
    rng = random.Random(8)
    n = np.array(sorted(rng.randint(50, 60) for _ in range(40)))
    group, node, comp = np.repeat([0, 1], 20), np.arange(40), np.array([rng.randrange(4) for _ in range(40)])
    order = np.lexsort((n, group))
    n = n[order]
    bits = np.zeros((40, J.PARITY_WORDS), np.uint64)
    bits[:, 0] = [rng.randrange(8) for _ in range(40)]
    want = {}
    for i in range(40):
        for j in range(i + 1, 40):
            both = -(-90 * (n[i] + n[j]) // 190)
            d = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            if group[i] == group[j] and comp[i] != comp[j] and n[j] * 90 <= n[i] * 100 and d <= n[i] + n[j] - 2 * both:
                want[i, j] = d
    a, b, *_ = J.cross_pairs(group, n, n, node, comp, bits, 90)
    assert set(zip(a.tolist(), b.tolist())) == set(want)
    a, b, *_ = J.nearest_pairs(group, n, n, node, comp, bits, 90)
    got = set(zip(a.tolist(), b.tolist()))
    assert got <= set(want)
    for i in {x for pair in want for x in pair}:
        least = min(d for pair, d in want.items() if i in pair)
        assert any(i in pair and want[pair] == least for pair in got)
