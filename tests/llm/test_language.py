import random

import edge
from tideline.llm import language_id as L

WORDS = {"en": "the house and river with many trees stands where our children play today".split(),
         "de": "das haus und der fluss mit vielen bäumen steht wo unsere kinder heute spielen".split(),
         "fr": "la maison et la rivière avec beaucoup d'arbres où nos enfants jouent aujourd'hui".split()}


def corpus(n=300, seed=5):
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 40))), lang if rng.random() < 0.8 else None, f"{lang}-host" if i % 3 else "mixed", 0))
    return rows, [r[1] for r in rows]


def test_held_out_accuracy(spark):
    rows, _ = corpus()
    truth = {i: next(x for x in WORDS if set(t.split()) <= set(WORDS[x])) for i, t, *_ in rows}
    out = L.identify(edge.documents(spark, rows), host="source").collect()
    undeclared = [r for r in out if r.lang is None]
    assert sum(r.language == truth[r.doc_id] for r in undeclared) >= 0.97 * len(undeclared) > 30
    assert all(r.kept == (r.confidence >= L.MIN_CONFIDENCE) for r in out)


def test_evidence_is_fused(spark):
    rows, _ = corpus()
    rows += [(1000, "qzx", None, "de-host", 0), (1001, "qzx", None, "fr-host", 0), (1002, "qzx", "en", None, 0), (1003, " ".join(WORDS["fr"]), "en", "de-host", 0)]
    got = {r.doc_id: r.language for r in L.identify(edge.documents(spark, rows), host="source").filter("doc_id >= 1000").collect()}
    assert got == {1000: "de", 1001: "fr", 1002: "en", 1003: "fr"}  # prior, prior, declaration, text over both


def test_pages(spark):
    rng = random.Random(1)
    rows = [(i, f"https://{lang}.example.org/{lang}/{i}", f"<html lang='{lang}'><script>var x='</p>'</script><p>{' '.join(rng.choices(WORDS[lang], k=30))}</p></html>")
            for i, lang in enumerate(rng.choices(list(WORDS), k=60))]
    pages = L.page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert "script" not in pages.first().text and pages.first().suffix == "example.org"
    out = L.identify(pages, "text", "declared", "host", "suffix", carry=["page_id", "url"]).collect()
    assert all(r.language == r.url.split("/")[3] and r.kept for r in out)


def test_edges(spark):
    docs = edge.documents(spark, edge.ROWS * 6)
    out = L.identify(docs, host="source")
    assert [c for c in out.columns if c not in ("language", "confidence", "text_language", "kept")] == [c for c in docs.columns if c != "kept"]
    rows = out.collect()
    assert len(rows) == 6 * len(edge.ROWS)
    assert not any(r.kept for r in rows if not any(c.isalpha() for c in r.text or ""))
    assert {r.language for r in rows if r.doc_id in (1, 2)} == {"en"}
    assert L.identify(edge.empty(spark), host="source").count() == 0
    nothing = edge.documents(spark, [(1, "text", None, None, 4)])
    assert [(r.language, r.kept) for r in L.identify(nothing).collect()] == [(None, False)]


def test_rare_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "LANGUAGE_ROWS", 10, raising=False)
    rare = {"eu": "etxea eta ibaia zuhaitz askorekin gure haurrek gaur jolasten duten lekuan".split(),
            "fi": "talo ja joki jossa lapsemme leikkivät tänään monien puiden keskellä".split()}
    rng, rows = random.Random(3), []
    for lang, n in [("en", 900), ("de", 700), ("fr", 500), ("eu", 6), ("fi", 6)]:
        words = (WORDS | rare)[lang]
        rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(20)), lang, "s", 0) for i in range(n)]
    docs = edge.documents(spark, rows, clashes=False)
    langs, table = L.fit_text_model(docs, "text", "lang", train_rows=60)
    assert langs == ["de", "en", "eu", "fi", "fr"] and (table.max(axis=0) > table.min(axis=0)).all()  # no column is uniform
    out = L.identify(docs, train_rows=60).collect()
    assert all(r.kept and r.language == r.text_language == r.lang for r in out if r.lang in rare)
    assert sum(r.language == r.lang for r in out) >= 0.99 * len(out)


def test_rows_of_each_language(spark):
    assert L.rows_of_each([100_000, 30, 90_000, 8_000], 20_000) == (20_000 - 30 - 6_656) // 2
    assert L.rows_of_each([3_000, 9_000], 20_000) == 9_000 and L.rows_of_each([10 ** 7] * 200, 20_000) == L.LANGUAGE_ROWS
    # repeated texts: rows are drawn, not texts
    docs = spark.createDataFrame([("one text" if i % 2 else "ein satz", "en" if i % 2 else "de") for i in range(8_000)], "text string, lang string").repartition(3)
    _, table = L.fit_text_model(docs, "text", "lang", train_rows=4_000)
    assert (table.max(axis=0) - table.min(axis=0) > 7).all()  # about 2,000 rows of each
