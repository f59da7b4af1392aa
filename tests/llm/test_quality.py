import random
import zlib

import edge
import numpy as np
from tideline.llm import quality_classifier as Q


def corpus(n=1500):
    rng, docs, labels = random.Random(3), [], []
    for i in range(n):
        good = rng.random() < 0.8
        ws = [rng.choice("the river and many trees stand where our children play today".split()) + rng.choice(["", "s", "ing", str(i % 7)]) for _ in range(rng.randint(3, 60))]
        if not good:
            ws = rng.choice([[w.upper() + "!!" for w in ws], [w + rng.choice(["###", "$$$"]) for w in ws], [ws[0]] * len(ws)])
        docs.append((i, " ".join(ws), "en", "s", 0))
        if i % 3:
            labels.append((i, int(good)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    out = Q.score_documents(edge.documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    truth, held = dict(labels), [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    pos, neg = ([r.score for r in held if truth.get(r.doc_id) == x] for x in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.97 and len(neg) > 20


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(600)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (sorted(Q.score_documents(edge.documents(spark, docs), spark.createDataFrame(x, "doc_id long, quality int")).collect()) for x in (labels, flipped))
    assert a == b


def test_isotonic():
    rng = np.random.default_rng(0)
    x = np.sort(rng.uniform(size=200))
    y = (rng.uniform(size=200) < x).astype(float)
    xs, ys = Q.isotonic(x, np.ones(200), y)
    assert (np.diff(ys) > 0).all() and (np.diff(xs) > 0).all()
    best = sum((v - m) ** 2 for v, m in zip(y, ys[np.searchsorted(xs, x).clip(0, len(xs) - 1)]))
    assert best <= ((y - y.mean()) ** 2).sum()


def test_edges(spark):
    docs = edge.documents(spark)
    for labels, want in (([], 0.5), ([(1, 1), (2, 1), (6, 1), (7, None)], 1.0)):
        out = Q.score_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(out) == len(edge.ROWS) and all(abs(r.score - want) < 2e-3 for r in out)
        assert [r.held_out for r in out if r.doc_id is None] == [False]
    assert Q.score_documents(edge.empty(spark), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
