import hashlib
import math
import random
import re

import edge
from pyspark.sql import functions as F
from tideline.llm import pii_sanitise as P

# The patterns as the contract states them.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def odd_texts():
    rng = random.Random(4)
    parts = ["a@b.c", "a@b.c_x@y.zz", "@", "x.y+z@host-1.example.com.", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.01.1.000", "4539 1488 0343 6467", "4539148803436467", "+49 (030) 555-1234",
             "+1", "++12 34567890", "1 2-3 4", "é𝔘", "0" * 16, "-", " ", ".", "9" * 25, "a.b@c@d.e", "text", "\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["a" * 60_000, "7 " * 9_000, "1.2.3.4 " * 1_500]


def test_spans_as_plain_patterns(spark):
    rows = [(i, t, "en", None, 0) for i, t in enumerate(odd_texts())]
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.base] for r in P.sanitise(edge.documents(spark, rows, clashes=False)).select("row.doc_id", "base").collect()}
    for i, t, *_ in rows:
        assert got[i] == brute(t), t[:80]


def corpus():
    filler = "the quick brown fox jumps over a lazy dog and some other plain words".split()
    rng, rows = random.Random(9), []
    for i in range(30):
        ws = [rng.choice(filler) for _ in range(30)]
        if i < 6:  # a rare nickname beside one address
            ws[10:10] = ["Zorblax", "writes", "from", "zed@mail.example.com"]
        if i in (6, 7):  # a term that is elsewhere too
            ws[5:5] = ["Quimby", "of", "qui@mail.example.com"]
        if i == 8:
            ws[5:5] = ["Quimby"]
        rows.append((i, " ".join(ws), "en", None, 0))
    return rows


def test_disclosing_terms(spark):
    rows = corpus()
    out = P.sanitise(edge.documents(spark, rows), min_support=2, generalise_at=0.5, remove_at=0.9, min_bits=2.0).select("row.doc_id", "row.text", "spans", "redacted")
    for r in out.collect():
        terms = {r.text[s.start:s.end]: P.KINDS[s.kind] for s in r.spans if s.kind > 3}
        if r.doc_id < 6:
            assert terms == {"Zorblax": "removed", "writes": "removed", "from": "removed"}
            assert "Zorblax" not in r.redacted and "<EMAIL>" in r.redacted and "zed@" not in r.redacted
        elif r.doc_id < 8:
            assert terms["Quimby"] == "term" and "<TERM>" in r.redacted
        elif r.doc_id == 8:  # a term that discloses an address does so without it, too
            assert terms == {"Quimby": "term"} and len(r.spans) == 1 and r.redacted == r.text.replace("Quimby", "<TERM>")
        else:
            assert not r.spans and r.redacted == r.text  # without an entity or such a term nothing changes


def names_of(kind, value):
    """[(level, name)] of a span, by the docstring."""
    v, digits = value.lower(), re.sub("[^0-9]", "", value)
    pools = {"email": ["local part " + v.split("@")[0], "domain " + v.split("@")[1]] if "@" in v else [], "ip": ["network " + ".".join(v.split(".")[:3])],
             "card": ["issuer " + digits[:6]], "phone": ["area " + digits[:4]], "secret": []}[kind]
    return [(P.VALUE, f"{kind} {v}")] + [(P.POOL, x) for x in pools] + [(P.KIND, kind)]


def spans_of(text):
    out = [(a, list(PLAIN)[k], e) for a, k, e in brute(text)]
    for m in re.finditer(r"[A-Za-z0-9]{20,}", text or ""):
        d = len(re.sub("[^0-9]", "", m.group()))
        if d >= 3 and len(m.group()) - d >= 3 and len(set(m.group())) >= 8:
            out.append((m.start(), "secret", m.end()))
    return out


def brute_disclosures(texts, min_support=3, generalise_at=0.5, remove_at=0.9, min_bits=4.0):
    """{(name, term): (kind, p, bits)} by loops over all texts."""
    n_t, near, has, at = {}, {}, {}, {}
    for i, t in enumerate(texts):
        for w in set(re.findall(r"[^\W\d_]+", (t or "").lower())):
            n_t[w] = n_t.get(w, 0) + 1
        spans = spans_of(t)
        ws = [m for m in re.finditer(r"[^\W\d_]{3,}", t or "") if not any(a < m.end() and m.start() < e for a, _, e in spans)]
        for a, kind, e in spans:
            for x in names_of(kind, t[a:e]):
                has.setdefault(x, set()).add(i)
                for m in ws:
                    if m.end() > a - P.NEAR and m.start() < e + P.NEAR:
                        near.setdefault((x, m.group().lower()), set()).add(i)
                        if x[0] == P.VALUE:
                            at.setdefault(m.group().lower(), set()).add((t, x))
    out = {}
    for ((level, name), w), rows in near.items():
        support = len({texts[i] for i in rows})
        p, p_e = len(rows) / n_t[w], len(has[level, name]) / len(texts)
        bits = math.log2(p / p_e)
        one_text, one_value = len({t for t, _ in at[w]}) == 1, len({x for _, x in at[w]}) == 1
        rare = support < min_support and level == P.VALUE and (one_text or one_value) and p >= remove_at
        if bits >= min_bits and (rare or support >= min_support and p >= generalise_at):
            out[name, w] = ("removed" if not rare and p >= remove_at else "term", round(p, 9), round(bits, 9), one_text)
    return out


def private_corpus():
    rng = random.Random(12)
    common = ["the", "and", "other", "plain", "words", "over", "lazy", "some", "quick", "there"]
    texts = []
    for i in range(220):
        ws = [rng.choice(common) for _ in range(rng.randint(0, 60))]
        if i % 20 == 0:
            ws[5:5] = ["token", "=", f"{rng.getrandbits(160):040x}"]  # a word that tells of a secret
        if i % 44 == 1:
            ws[3:3] = ["Acme", "desk", f"u{i}@acme.example.com"]  # a name that tells of a domain
        if i % 55 == 2:
            ws[3:3] = [f"Person{'abcdefgh'[i // 55]}", "on", f"+1 (020) 555-{1000 + i}", "or", f"10.1.2.{i % 250}"]  # a name that stands once
        if i % 73 == 5:
            ws[3:3] = ["Acme"]
        texts.append(" ".join(ws))
    return texts + texts[:45] + ["", None]


def test_p_and_bits_by_brute_force(spark):
    texts = private_corpus()
    docs = edge.documents(spark, [(i, t, "en", None, 0) for i, t in enumerate(texts)])
    want = brute_disclosures(texts)
    got = {(r.name, r.term): (P.KINDS[r.kind], round(r.p, 9), round(r.bits, 9)) for r in P.disclosures(docs).collect()}
    # a term of one text is reported for two of the text's values at most
    assert {k: v for k, v in got.items() if not want[k][3]} == {k: v[:3] for k, v in want.items() if not v[3]}
    assert all(got[k] == want[k][:3] for k in got) and {w for _, w in got} == {w for _, w in want}
    assert {"token", "acme", "persona"} <= {w for _, w in got} and got["secret", "token"][0] == "removed"
    # spans: every disclosing term, wherever it stands if it discloses a value, else in texts with one of the pool
    for r in P.sanitise(docs).select("row.text", "spans", "base").collect():
        spans = spans_of(r.text)
        mine = {n for a, kind, e in spans for n in names_of(kind, r.text[a:e])}
        terms = {}
        for (name, w), (kind, *_) in got.items():
            if any(n == name for _, n in mine) or name.split()[0] in PLAIN and " " in name or name.startswith("secret "):
                terms[w] = max(terms.get(w, 0), P.KINDS.index(kind))
        hits = [(m.start(), terms[m.group().lower()], m.end()) for m in re.finditer(r"[^\W\d_]{3,}", r.text or "")
                if m.group().lower() in terms and not any(a < m.end() and m.start() < e for a, _, e in spans)]
        assert [(s.start, s.kind, s.end) for s in r.spans] == sorted([(a, P.KINDS.index(k), e) for a, k, e in spans] + hits)
        assert [(s.start, s.kind, s.end) for s in r.base] == brute(r.text)


def test_written_form(spark):
    docs = edge.documents(spark, [(1, "mail a@b.c or 1.2.3.4", "en", None, 0)], clashes=False)
    want = "email:5:10,ip:14:21"
    r = P.sanitise(docs).select(P._written(F.col("spans")).alias("s"), F.sha2(P._written(F.col("base")), 256).alias("h"), "redacted").first()
    assert (r.s, r.h, r.redacted) == (want, hashlib.sha256(want.encode()).hexdigest(), "mail <EMAIL> or <IP>")


def test_overlaps_and_edges(spark):
    docs = edge.documents(spark, [(1, "call +4539148803436467 now", "en", None, 0)], clashes=False)
    assert P.redact(docs).first().text in ("call <PHONE> now", "call +<CARD> now", "call <CARD> now")
    docs = edge.documents(spark)
    out = P.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[9].endswith("mail: <EMAIL> <PHONE>.") or "<EMAIL>" in text[9] and "jo@" not in text[9]
    assert text[3] is None or text[3] == ""
    assert P.redact(edge.empty(spark)).count() == 0
