import hashlib
import random

import edge
import numpy as np
import pytest
from tideline.llm import substring_dedup as S


def brute(rows, window):
    """By the definition: rows that repeat id and text are one; of rows of equal id none is earlier."""
    texts = {}
    for i, t in rows:
        texts.setdefault((i, t or ""), (t or "").encode().split())
    place = {}
    for (i, t), ws in texts.items():
        for s in range(len(ws) - window + 1):
            place.setdefault(tuple(ws[s:s + window]), []).append((i is None, i or 0, t, s))
    answer = {}
    for (i, t), ws in texts.items():
        gone = set()
        for s in range(len(ws) - window + 1):
            if any((a, b) < (i is None, i or 0) or (a, b, x) == (i is None, i or 0, t) and y < s for a, b, x, y in place[tuple(ws[s:s + window])]):
                gone.update(range(s, s + window))
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone)
        answer[i, t] = (i, len(ws), len(gone), hashlib.sha256(kept).hexdigest())
    return sorted((answer[i, t or ""] for i, t in rows), key=str)


def solve(docs, window, gram):
    got = S.without_repeats(docs, window=window, gram=gram).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted(map(tuple, got.collect()), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(50 if seed % 2 else 500)]
    passages = [rng.choices(vocabulary, k=rng.choice([3, 6, 7, 12, 40])) for _ in range(12)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(rng.randint(0, 5)):
            ws += rng.choice(passages) if rng.random() < 0.6 else rng.choices(vocabulary, k=rng.randint(1, 30))
        if rng.random() < 0.2:
            ws = ["la"] * rng.randint(1, 30) + ws  # repeats inside a document
        rows.append((rng.choice([i, 7 * i, None if i % 40 == 0 else i, 5]), (" " if i % 2 else "\t\n").join(ws)))
    return rows + rng.choices(rows, k=20)


@pytest.mark.parametrize("seed,window,gram,hot,shard", [(1, 6, 2, 2000, 400_000), (2, 6, 3, 2, 100), (3, 5, 5, 0, 50), (4, 20, 6, 1, 300)])
def test_as_brute_force(spark, monkeypatch, seed, window, gram, hot, shard):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SHARD_WORDS", shard)
    rows = corpus(seed)
    got = solve(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window, gram)
    assert got == brute(rows, window) and sum(r[2] for r in got) > 100


def test_index_against_plain_search():
    rng = np.random.default_rng(3)
    text = np.r_[rng.integers(1, 5, 400), 0, rng.integers(1, 5, 300), 0]
    index = S.FMIndex(text, 5, 12)
    end = np.r_[np.arange(12, 401), np.arange(413, 702)]
    length, _ = index.matching_statistics(text, end, 12)

    def often(pattern):
        return sum((text[i:i + len(pattern)] == pattern).all() for i in range(len(text) - len(pattern) + 1))

    for e, n in zip(end.tolist(), length.tolist()):
        assert (n == 0 or often(text[e - n:e]) > 1) and (n == 12 or often(text[e - n - 1:e]) == 1)


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    for symbols in (1, 2, 3, 64, 1000):
        values = rng.integers(0, symbols, 700)
        matrix = S.WaveletMatrix(values, symbols)
        c, i = rng.integers(0, symbols, 300), rng.integers(0, 701, 300)
        assert matrix.rank(c, i).tolist() == [int((values[:b] == a).sum()) for a, b in zip(c, i)]


def test_planted_passages(spark):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(5000)]
    passage = rng.choices(words, k=55)
    rows = [(i, " ".join(rng.choices(words, k=80) + (passage if i % 3 == 0 else []) + rng.choices(words, k=60))) for i in range(60)]
    got = {r[0]: r[2] for r in solve(spark.createDataFrame(rows, "doc_id long, text string"), 20, 6)}
    assert {i for i, n in got.items() if n} == {i for i in range(60) if i % 3 == 0 and i} and all(n in (0, 55, 56, 57) for n in got.values())


def test_edges(spark):
    rows = [r[:2] for r in edge.ROWS]
    assert solve(edge.documents(spark), 5, 2) == brute(rows, 5)
    assert solve(edge.documents(spark), 20, 6) == brute(rows, 20)
    assert S.without_repeats(edge.empty(spark)).count() == 0
