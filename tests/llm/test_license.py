import random

import edge
from tideline.llm import license_scan as S


def shingles(text):
    ws = S.WORD.findall(text.lower())
    return [tuple(ws[i:i + S.SHINGLE]) for i in range(len(ws) - S.SHINGLE + 1)]


def corpus():
    rng, rows = random.Random(2), []
    for i in range(150):
        ws = [rng.choice("the a license under terms of software free use copy version river tower".split()) for _ in range(rng.randint(0, 300))]
        name, template = S.TEMPLATES[i % len(S.TEMPLATES)]
        part = template.split()
        if i % 3 == 1 and len(part) > 20:  # the first nine tenths
            part = part[:len(part) * 9 // 10]
        if i % 5 != 4:
            at = rng.randint(0, len(ws))
            ws[at:at] = part if i % 2 else [w.upper() for w in part]
        rows.append((i, " ".join(ws), "en", "s", 0))
    return rows


def test_same_as_brute_force(spark):
    rows, want = corpus(), set()
    for i, text, *_ in rows:
        have = set(shingles(text))
        for t, (_, template) in enumerate(S.TEMPLATES):
            s = set(shingles(template))
            if len(s & have) >= S.CONTAINMENT * len(s):
                want.add((i, t))
    got = S.scan_licenses(edge.documents(spark, rows)).collect()
    assert {(r.doc_id, r.template) for r in got} == want and len(want) > 80
    for r in got:
        assert r.license == S.TEMPLATES[r.template][0] and 0.8 <= r.containment <= 1
        assert shingles(rows[r.doc_id][1])[r.start_word] in shingles(S.TEMPLATES[r.template][1])


def test_bands_retrieve():
    scanner, rng = S.Scanner(S.TEMPLATES), random.Random(1)
    missed = 0
    for k in range(300):
        t = k % len(S.TEMPLATES)
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 200))]
        text = " ".join(words + S.WORD.findall(S.TEMPLATES[t][1].lower()) + words[::-1])
        missed += not any(x[1] == t for x in scanner.scan([text]))
    assert missed == 0


def test_edges(spark):
    docs = edge.documents(spark, [*edge.ROWS, (20, edge.LONG + " Released under the MIT License. " + edge.LONG, "en", "s", 0), (20, "released UNDER the mit-license", "en", "s", 0)])
    assert sorted((r.doc_id, r.license) for r in S.scan_licenses(docs).collect()) == [(20, "MIT"), (20, "MIT")]
    assert S.scan_licenses(edge.empty(spark)).count() == 0 and S.scan_licenses(docs, []).count() == 0


def test_short_notices_and_full_texts(spark):
    full = dict(S.full_texts())
    rows = [(1, "Some prose. All rights reserved. More prose."), (2, "all RIGHTS reserved"), (3, "all rights"), (4, "reserved words, all rights"),
            (5, "# SPDX-License-Identifier: MIT"), (6, "// SPDX-License-Identifier: GPL-2.0-or-later"), (7, "SPDX-License-Identifier: Other"),
            (8, "Copyright (c) 2019 Someone"), (9, "prose copyright 2021 Someone"), (10, "the copyright of a text")]
    rows += [(100 + i, "Before it. " + t + " After it.") for i, t in enumerate(full.values())]
    found = {}
    for r in S.scan_licenses(edge.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])).collect():
        found.setdefault(r.doc_id, {})[r.license] = r.start_word
    assert found[1] == {"All-rights-reserved": 2} and found[2] == {"All-rights-reserved": 0}
    assert found[5] == {"SPDX": 0, "MIT": 0} and found[6] == {"SPDX": 0, "GPL-2.0": 0} and found[7] == {"SPDX": 0}
    assert found[8] == {"Copyright": 0} and found[9] == {"Copyright": 1} and not {3, 4, 10} & set(found)
    assert len(full) >= 10 and all(name in found[100 + i] for i, name in enumerate(full))
    assert S.Scanner([("x", "all rights reserved")]).scan(["all rights", "reserved", ""]) == []  # not over two documents
