import random

import edge
import numpy as np
import pytest
from tideline.llm import decontaminate as D

ITEMS = [(0, "What does a river carry to the sea each spring? It carries the melted snow of the high mountains and their dust."),
         (1, "Name the oldest tower of the small town near the lake. The oldest tower is the round one by the northern gate."),
         (2, "Short one."), (3, None), (None, "An item without a number asks nothing at all of you today. It is still found by its words alone.")]


def words_of(n, seed):
    rng = random.Random(seed)
    return [rng.choice("alpha beta gamma delta the of a on it river tower sea lake gate".split()) + rng.choice(["", "s", "ed"]) for _ in range(n)]


def brute(rows, items, overlap=0.8):
    out = set()
    for i, text in rows:
        ws = D.words(text or "")
        for item, q in items:
            if not q or len(D.words(q)) < D.MIN_ITEM_WORDS:
                if q and D.words(q) and f" {' '.join(D.words(q))} " in f" {' '.join(ws)} ":
                    out.add((i, item))
                continue
            ok = True
            for part in D.split_item(q):
                g = D.shingles(D.words(part))
                if g:
                    k = len(next(iter(g)))
                    ok &= len(g & D.shingles(ws, k)) / len(g) >= overlap
            if ok:
                out.add((i, item))
    return out


def corpus():
    rows = []
    for i in range(60):
        ws = words_of(40 + 17 * i, i)
        item = ITEMS[(0, 1, 4)[i % 3]][1]
        if i % 4 == 0:
            ws[i:i] = item.split()
        elif i % 4 == 1:  # question only
            ws[i:i] = D.split_item(item)[0].split()
        elif i % 4 == 2:  # one word changed in a long copy
            copy = item.upper().split()
            copy[3] = "other"
            ws[i:i] = copy
        rows.append((i, " ".join(ws)))
    return rows


def test_same_as_brute_force(spark):
    rows = corpus()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find_leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute(rows, ITEMS) and len(found) >= 15
    kept = D.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {r.doc_id for r in found}


def test_search_loses_nothing():
    rng = random.Random(3)
    items = [(i, " ".join(words_of(rng.randint(8, 120), 100 + i)), "") for i in range(40)]
    index = D.SegmentIndex(items)
    impact = np.zeros((len(index.vocab), len(index.item_of)))
    for t in range(len(index.vocab)):
        for e in range(index.blk_ptr[t], index.blk_ptr[t + 1]):
            for k in range(index.post_ptr[e], index.post_ptr[e + 1]):
                impact[t, index.seg[k]] = index.imp[k]
    assert np.allclose(impact.sum(axis=0), 1)
    for theta in (0.3, 0.5, 0.8):
        for seed in range(30):
            term = np.unique([index.vocab[w] for w in words_of(60, seed) if w in index.vocab])
            want = {s for s in range(impact.shape[1]) if impact[term, s].sum() >= theta}
            assert {s for _, s, _ in index.search(np.zeros(len(term), np.int64), term, theta)} == want


def test_shards_and_columns(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 200)
    rows = corpus()[:12]
    items = spark.createDataFrame([(i, *D.split_item(t)) for i, t in ITEMS if t], "item_id long, question string, answer string")
    found = D.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items, question="question", answer="answer").collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute(rows, [x for x in ITEMS if x[1]])


@pytest.mark.parametrize("which", ["documents", "empty"])
def test_edges(spark, which):
    docs = getattr(edge, which)(spark)
    items = spark.createDataFrame([(7, edge.ROWS[0][1])], "item_id long, text string")
    hits = [r.doc_id for r in D.find_leaks(docs, items).collect()]
    assert sorted(hits) == ([1, 1, 2] if which == "documents" else [])
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(hits)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs, none).count() == docs.count() and D.find_leaks(docs, none).count() == 0


def test_whole_item_where_the_split_is_a_guess(spark):
    item = "The tall keeper of the old light counted every ship that passed the long grey wall by night and by day in the year of the great storm. N with tilde."
    changed, cut = item.replace("tilde", "hat"), item.removesuffix(" N with tilde.")
    rows = [(0, "It says: " + changed), (1, "It says: " + cut + " Nothing else is said."), (2, "N with tilde."), (3, " ".join(item.split()[:12]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in D.find_leaks(docs, items).collect()) == [0, 1]
    assert sorted(r.doc_id for r in D.decontaminate(docs, items).collect()) == [2, 3]
    parts = spark.createDataFrame([(7, *D.split_item(item))], "item_id long, question string, answer string")
    assert D.find_leaks(docs, parts, question="question", answer="answer").count() == 0  # real parts are both wanted


def test_items_of_few_words(spark):
    items = [(1, "What is the capital of Peru? Lima"), (2, "the capital, OF Peru"), (3, "Lima"), (3, "Lima"), (6, "Lima"), (4, "..."), (5, "Quito")]
    docs = [(1, "They ask: what is the capital of Peru?  LIMA!"), (2, "What is the capital of the old Peru? Lima"), (3, "limas grow"),
            (4, "x " * 5000 + "capital of Peru, the capital of Peru"), (5, ""), (6, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = sorted((r["doc_id"], r["item_id"], r["passage_start"], r["score"], r["question_overlap"]) for r in D.find_leaks(d, b).collect())
    assert got == [(1, 1, 2, 1.0, 1.0), (1, 2, 4, 1.0, 1.0), (1, 3, 8, 1.0, 1.0), (1, 6, 8, 1.0, 1.0), (2, 3, 8, 1.0, 1.0), (2, 6, 8, 1.0, 1.0), (4, 2, 5003, 1.0, 1.0)]
    assert sorted(r["doc_id"] for r in D.decontaminate(d, b).collect()) == [3, 5, 6]
    assert {r[:2] for r in got} == brute(docs, items)
