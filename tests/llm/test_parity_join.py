import random

import edge
import numpy as np
import pytest
from tideline.llm import parity_join as P


def sets_of(rows, k=4):
    out = []
    for _, t in rows:
        ws = (t or "").encode().lower().split()
        out.append({tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set())
    return out


def brute(rows, threshold=85):
    sets, root = sets_of(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return {(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)}


def corpus(seed, n=120, passage=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    shared = rng.choices(vocabulary, k=60)
    bases = [rng.choices(vocabulary, k=rng.choice([3, 4, 7, 12, 30, 80, 200, 400])) for _ in range(n // 4)]
    rows = []
    for i in range(n):
        ws = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        if rng.random() < passage:
            ws = ws[:40] + shared + ws[40:80]
        if rng.random() < 0.2:
            ws += rng.choices(vocabulary, k=rng.randint(1, 20))
        rows.append((1000 - 3 * i, (" " if i % 2 else "\n").join(ws).title()))
    return rows


def solve(spark, rows, parts=3):
    got = P.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    return {(r.doc_id, r.n_shingles, r.component_id) for r in got}


@pytest.mark.parametrize("seed,hot,passage", [(1, 50, 0.0), (2, 3, 0.7), (3, 1, 0.5)])
def test_same_as_brute_force(spark, monkeypatch, seed, hot, passage):
    monkeypatch.setattr(P, "HOT", hot)
    monkeypatch.setattr(P, "BLOCK", 5)
    rows = corpus(seed, passage=passage)
    assert solve(spark, rows) == brute(rows)


def test_five_words_as_brute_force(spark):
    ws = [f"x{i}" for i in range(234)]  # five words: 205 of 255; four words: 211 of 251, under 0.85
    rows = [*corpus(4), (2000, " ".join(ws)), (2001, " ".join("other" if i in (30, 70, 110, 150, 190) else w for i, w in enumerate(ws)))]
    sets = sets_of(rows, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in P.jaccard_components(docs, threshold=80, k=5).collect()}
    low = {d: d for d, _ in rows}
    for _ in rows:  # smallest id over links, until nothing changes
        before = dict(low)
        for i, (a, _) in enumerate(rows):
            for j, (b, _) in enumerate(rows[:i]):
                if (both := len(sets[i] & sets[j])) and 100 * both >= 80 * len(sets[i] | sets[j]):
                    low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    assert got == low and got != {r.doc_id: r.component_id for r in P.jaccard_components(docs).collect()}


def test_bounds_hold():
    bands, rng = P.Bands(), np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(7, 900))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut = int(rng.integers(0, max(1, n // 7)))
        b = np.unique(np.r_[a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64)])
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        differ = len(a) + len(b) - 2 * both
        linked = 100 * both >= 85 * (differ + both)
        assert not linked or differ <= bands.differ(len(a) + len(b))
        common = set(bands.listings(len(a))) & set(bands.listings(len(b)))
        if linked and differ:
            assert common
        for band, d, cells in common:
            x, y = P.sketch(a, band, cells), P.sketch(b, band, cells)
            assert np.bitwise_count(x[2] ^ y[2]).sum() <= differ
            agree = len(np.intersect1d(x[0], y[0])) + len(np.intersect1d(x[1], y[1]))
            assert cells - agree <= differ and (not linked or differ <= d)


def test_chain_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(140, 139), (7, 7)]
    got = {r.node: r.component for r in P.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 141)}}


def test_edges(spark):
    docs = edge.documents(spark)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in P.jaccard_components(docs).collect())
    n = {r[0] or 0: len(s) for r, s in zip(edge.ROWS, sets_of([r[:2] for r in edge.ROWS]))}
    want = [(i or 0, n[i or 0], 1 if i == 2 else i) for i, *_ in edge.ROWS]
    assert got == sorted(want, key=lambda x: x[:2])
    kept = P.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert P.jaccard_components(edge.empty(spark)).count() == 0 and P.keep_one_of_each(edge.empty(spark)).count() == 0
