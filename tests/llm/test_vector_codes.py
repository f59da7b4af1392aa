import hashlib
import math
import random

import numpy as np
import pytest
from tideline.llm import vector_codes as V


def brute(rows, parts, entries, rounds):
    """(id, label, codes, error) of kept rows and the digest, by plain loops."""
    kept = [(i, lab, [math.floor(256 * c) for c in x]) for i, x, lab in rows
            if x is not None and x and all(c is not None and math.isfinite(c) for c in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2]) and len(r[2]) % parts == 0]
    size = len(kept[0][2]) // parts
    cut = [[x[p * size:(p + 1) * size] for p in range(parts)] for _, _, x in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for v in cut:
                own.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for k, members in own.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for (i, lab, _), v in zip(kept, cut):
        got = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, lab, bytes(k for _, k in got).hex(), sum(d for d, _ in got)))
    flat = ",".join(str(c) for b in books for e in b for c in e)
    return sorted(out, key=str), hashlib.sha256(flat.encode()).hexdigest()


def solve(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    got = V.train_and_encode(df.repartition(3), "vec_id", "embedding", "label", **kw)
    return sorted(((r.id, r.label, r.code.hex(), r.error) for r in got.rows.collect()), key=str), got.books.digest()


@pytest.mark.parametrize("rounds,groups,entries", [(2, 4, 64), (5, 3, 10), (4, 1, 6), (3, 7, 7)])
def test_as_brute_force(spark, rounds, groups, entries):
    rng = random.Random(rounds)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(9)]
    rows = [(3 * i - 50, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(300)]
    rows += [(1000 + i, [round(c) / 8 for c in rng.choice(centres)], 5) for i in range(60)]  # many equal parts: ties
    assert solve(spark, rows, parts=4, entries=entries, rounds=rounds, groups=groups) == brute(rows, 4, entries, rounds)


def test_bounds_spare_scans_and_net_is_tighter():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (40, 1, 4))
    x = (centres[rng.integers(0, 40, 4000)] + rng.integers(-60, 60, (4000, 1, 4))).astype(np.int64)
    books, state, scanned = V.Codebooks(np.ascontiguousarray(x[:40].transpose(1, 0, 2))[None]), (), []
    for _ in range(6):
        code, low, stamp, error, n = V.assign(x, books, *state)
        full = V._squares(x[:, 0], books.history[-1][0])
        assert (code[:, 0] == full.argmin(axis=1)).all() and (error == full.min(axis=1)).all()
        state, scanned = (code, low, stamp), [*scanned, n]
        new = books.history[-1].copy()
        for e in range(40):
            if (own := x[code[:, 0] == e, 0]).size:
                new[0, e] = own.sum(axis=0) // len(own)
        books = books.then(new)
    assert scanned[0] == 4000 and scanned[-1] < 1000
    group = V._groups(40, 4)
    net = V.net_displacements(books.history, group, 4)[0]
    drift = sum(V.net_displacements(books.history[k:k + 2], group, 4)[0] for k in range(6))
    assert (net <= drift + 1e-6).all() and (net < drift).any()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 16, 1), (1, [0.5] * 16, 1), (2, [-0.25] * 16, None), (None, [0.1] * 16, None), (4, None, 1), (5, [], 1),
            (6, [nan] + [0.0] * 15, 1), (7, [None] + [0.0] * 15, 1), (8, [inf] + [0.0] * 15, 1), (9, [0.5] * 32, 2), (10, [0.5] * 15, 2)]
    got = solve(spark, rows)
    assert got == brute(rows, 16, 64, 2) and len(got[0]) == 4
    huge = solve(spark, [(1, [1e300] * 16, 1), (2, [-1e300] * 16, 1)])
    assert [r[3] for r in huge[0]] == [0, 0]
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert V.train_and_encode(df, "vec_id", "embedding", "label") is None
