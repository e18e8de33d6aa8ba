"""Vector code compression (13) against plain Lloyd rounds."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from baton.llm import queries, vector_codes


def plain(rows, parts=16, entries=64, rounds=2, scale=256.0):
    """{(id, vector): (code, error)} and the codebooks of one vector length, by full scans."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(kept[0][1])
    cut = [0]
    for p in range(parts):
        cut.append(cut[-1] + n // parts + (p < n % parts))
    books = [[v[cut[p]:cut[p + 1]] for _, v in kept[:entries]] for p in range(parts)]

    def assign(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[cut[p]:cut[p + 1]], e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v in kept:
                groups.setdefault(assign(p, v)[1], []).append(v[cut[p]:cut[p + 1]])
            new.append([[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])])
        books = new
    out = {}
    for i, v in kept:
        best = [assign(p, v) for p in range(parts)]
        out[i, tuple(v)] = bytes(b[1] for b in best), sum(b[0] for b in best)
    return out, books


def frame(spark, rows):
    """Vectors under columns whose names the operator uses inside, too."""
    return spark.createDataFrame([(i, v, "l", 1, 2, b"") for i, v in rows],
                                 "vec_id bigint, embedding array<double>, label string, id int, dist int, code binary").repartition(3)


def check(spark, rows, **kw):
    got = vector_codes.compress(frame(spark, rows), **kw)
    fine = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    n = 0
    seen = got.codes.collect()
    for length in {len(v) for _, v in fine}:
        mine = [(i, v) for i, v in fine if len(v) == length]
        want, books = plain(mine, **kw)
        assert [p.tolist() for p in got.codebooks[length]] == books
        ours = sorted(((r.id is None, r.id or 0), bytes(r.code), r.error) for r in seen if r.length == length)
        scale = kw.get("scale", 256.0)
        assert ours == sorted(((i is None, i or 0), *want[i, tuple(math.floor(scale * x) for x in v)]) for i, v in mine)
        n += len(mine)
    assert n == len(seen)


@pytest.mark.parametrize("kw", [{}, {"parts": 3, "entries": 5, "rounds": 4}, {"parts": 1, "entries": 256, "rounds": 1}, {"rounds": 0}])
def test_codes_equal_plain_lloyd(spark, kw):
    rng = random.Random(5)
    rows = [(i * 3 % 307, [rng.choice([-0.01, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(16)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(80)]  # copies
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[10][1])]
    rows += [(2000, None), (2001, [None] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] + [0.0] * 15)]
    check(spark, rows, **kw)


def test_ties_go_to_the_lower_index(spark):
    # a codebook of equal entries, and vectors half-way between two
    rows = [(i, [float(i // 70)] * 16) for i in range(140)] + [(500 + i, [0.5] * 16) for i in range(9)]
    check(spark, rows)


def test_lengths_of_their_own(spark):
    rng = random.Random(6)
    rows = [(i, [rng.random() for _ in range(rng.choice([0, 1, 5, 16, 19]))]) for i in range(200)]
    check(spark, rows, entries=7)


def test_large_components_and_no_rows(spark):
    rows = [(i, [1e300 * (-1) ** i, 3e9, -1e17, 0.1] * 16) for i in range(70)]
    out = vector_codes.compress(frame(spark, rows))
    assert all(r.error >= 0 for r in out.codes.collect()) and int(np.abs(out.codebooks[64][0]).max()) == 1 << 27
    assert vector_codes.compress(frame(spark, []).limit(0)).codes.count() == 0
    # exact beyond doubles
    big = [(i, [float(2 ** 18 + i % 3), float(-2 ** 18 + 1 / 256)] * 2) for i in range(40)]
    check(spark, big, parts=2, entries=3)
    # the longest vectors at their bounds still have errors that are longs
    long = spark.createDataFrame([(i, [1e30 * (-1) ** i] * 4096) for i in range(3)], "vec_id bigint, embedding array<double>").selectExpr("*", "null as label")
    assert all(0 <= r.error < 1 << 63 for r in vector_codes.compress(long, entries=2, rounds=0).codes.collect())


def test_active_entries_equal_full_scans():
    rng = np.random.default_rng(3)
    for trial in range(50):
        v = rng.integers(-3, 4, (200, 2))
        old = rng.integers(-3, 4, (9, 2))
        new = np.where(rng.random(9)[:, None] < 0.4, rng.integers(-3, 4, (9, 2)), old)
        index, least = vector_codes.nearest(v, old)
        got = vector_codes.reassign(v, index, least, new, np.any(new != old, axis=1))
        assert all((a == b).all() for a, b in zip(got, vector_codes.nearest(v, new)))


def test_query_equals_sql(spark):
    from tests.conftest import SF001
    from tools.check_oracle import canon, duck

    got = queries.op13_vector_codes(spark, SF001)
    cur = duck(SF001).execute(queries.oracle_sql()["op13_vector_codes"])
    assert canon(got.columns, got.collect()) == canon([d[0] for d in cur.description], cur.fetchall())


def test_query_sums_by_label(spark, tmp_dir, monkeypatch):
    rows = [(i, [i / 7.0] * 16, [None, "a", "b"][i % 3]) for i in range(90)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string").write.parquet(f"{tmp_dir}/embeddings.parquet")
    for bound in (100_000, 0):  # broadcast and shuffled sums
        monkeypatch.setattr(queries, "BROADCAST_LABELS", bound)
        got = queries.op13_vector_codes(spark, tmp_dir).collect()
        want = {}
        for r in got:
            want[r.vec_id % 3] = want.get(r.vec_id % 3, 0) + r.error
        assert len(got) == 90 and all(r.label_error == want[r.vec_id % 3] for r in got)
