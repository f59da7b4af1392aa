import math
import random
import re
from collections import Counter

import edge
from tideline.llm import divergence_rules as R


def brute_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if many[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def classes(text):
    rest = [c for c in text if c not in " \t\n\x0b\x0c\r"]
    n = [sum("A" <= c <= "Z" for c in rest), sum("0" <= c <= "9" for c in rest), len(text) - len(rest), sum(c in "#*$%&|<>" for c in rest), sum(c in ".,;:!?'\"()-" for c in rest)]
    return n + [len(rest) - sum(n[:2]) - n[3] - n[4]]


def distance(counts, ref):
    n = sum(counts)
    if not n:
        return 0.0
    q = [c / n for c in counts]

    def kl(a, b):
        return sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)

    return math.sqrt(max(0.0, min(1.0, (kl(ref, q) + kl(q, ref)) / 2)))


def corpus():
    rng = random.Random(8)
    vocabulary = {"en": [f"w{i}" for i in range(60)], "de": [f"ü{i}" for i in range(60)]}
    rows = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        ws = [vocabulary[lang][min(59, int(rng.expovariate(0.1)))].capitalize() if rng.random() < 0.1 else vocabulary[lang][min(59, int(rng.expovariate(0.1)))]
              for _ in range(rng.choice([5, 49, 50, 120, 300]))]
        text = "".join(w + rng.choice([" ", " ", "\n", ". ", "\t \r"]) for w in ws)
        if i % 10 == 0:
            text = text.upper().replace(" ", "### ")
        if i % 7 == 0:
            text += "\n".join(["same line here"] * 9)
        rows.append((i, text, lang if i % 11 else "xx", "s", 0))
    return rows


def test_same_as_brute_force(spark):
    rows = corpus()
    docs = edge.documents(spark, rows)
    refs = R.references(docs, "text", "lang")
    assert set(refs) == {"en", "de", ""}
    for lang in ("en", "de", ""):
        texts = [t for _, t, g, *_ in rows if lang in ("", g)]
        count = Counter(w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t))
        top = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:R.TOP_WORDS]
        assert refs[lang][1] == [w for w, _ in top]
        total = [sum(x) for x in zip(*(classes(t) for t in texts))]
        assert all(abs(a - b / sum(total)) < 1e-12 for a, b in zip(refs[lang][0], total))
    for r in R.judge(docs).select("row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance",
                                  R.F.col("kept").alias("verdict")).drop("words").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(r.text)
        share, top, words = refs[r.lang if r.lang in refs else ""]
        ws = Counter(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        found = [ws[w] for w in top]
        assert abs(r.char_distance - distance(classes(r.text), share)) < 1e-6
        assert abs(r.word_distance - distance([*found, r.n_words - sum(found)], words)) < 1e-6
        far = len(r.text) >= R.MIN_CHARS and r.char_distance > R.MAX_CHARS_DISTANCE or r.n_words >= R.MIN_WORDS and r.word_distance > R.MAX_WORDS_DISTANCE
        assert r.verdict == (not r.base_failed and not far)


def test_edges(spark):
    docs = edge.documents(spark)
    out = R.judge(docs)
    rows = out.select("row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted((r.text or "", *r[1:7]) for r in rows) == sorted((t or "", *brute_base(t)) for _, t, *_ in edge.ROWS)
    kept = R.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert R.judge(edge.empty(spark)).count() == 0
