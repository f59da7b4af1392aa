import hashlib
import math
import random
import re
import zlib

import edge
import numpy as np
from tideline.llm import importance_resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return ws, [" ".join(ws[i:i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def brute(rows, target, percent=5, least=20):
    def bucket(g):
        return zlib.crc32(g.encode()) % 10_000

    s, t = [0] * 10_000, [0] * 10_000
    for texts, to in (([r[1] for r in rows], s), (target, t)):
        for x in texts:
            for g in runs(x)[1]:
                to[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    out = []
    for i, text in rows:
        ws, gs = runs(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in gs)
        out.append([i, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ws)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k in range(len(fit) * percent // 100):
        fit[k][4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def solve(docs, target, **kw):
    out = R.resample(docs, target, **kw).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted(map(tuple, out.collect()), key=str)


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 40_000).astype(np.uint8)
    length = rng.choice([1, 2, 5, 63, 64, 65, 127, 128, 129, 192, 1000, 9_999], 500)
    start = np.array([int(rng.integers(0, len(buf) - n + 1)) for n in length])
    assert R.span_crcs(buf, start, length).tolist() == [zlib.crc32(buf[a:a + n].tobytes()) for a, n in zip(start, length)]


def test_small_chunks(monkeypatch):
    monkeypatch.setattr(R, "CHUNK_BYTES", 7)
    test_crc_of_spans()


def test_as_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [rng.choice(["Wort", "Ünder", "x9", "naïve", "TOKEN", "z" * 70]) + str(i) for i in range(300)]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n\n", " -- ", "_"]) for _ in range(rng.choice([0, 1, 2, 19, 20, 21, 60, 300])))) for i in range(400)]
    target = [" ".join(rng.choices(vocabulary[:40], k=30)) for _ in range(10)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = solve(docs, spark.createDataFrame([(x,) for x in target], "text string"))
    assert got == brute(rows, target) and sum(r[4] is not None for r in got) > 5


def test_edges(spark):
    rows = [r[:2] for r in edge.ROWS]
    target = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    want = brute(rows, ["the cat sat on the mat"], 100, 5)
    assert solve(edge.documents(spark), target, percent=100, min_words=5) == want
    assert [r for r in want if r[4] is not None]
    assert solve(edge.documents(spark), target.limit(0)) == brute(rows, [])
    assert solve(edge.empty(spark), target) == []
