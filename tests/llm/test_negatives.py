import random

import numpy as np

from carelake.llm import negatives

KIND = "vec_id long, embedding array<double>, label int, row long, id long, place int"
ORDER = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows):
    data = []
    for i, (key, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            w = [int(np.floor(256 * x)) for x in v]
            if sum(x * x for x in w) < 2**62:
                data.append((i, key, w, label))
    out = []
    for i, key, v, label in data:
        if key is None or key % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), k is None, k or 0, j, other) for j, k, w, other in data if j != i]
        near = sorted(s for s in scored if s[4] == label)[:5]
        for p in near:
            fits = sorted(s for s in scored if s[4] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0])[:3]
            out += [(key, None if p[1] else p[2], n + 1, None if s[1] else s[2], -p[0], -s[0]) for n, s in enumerate(fits)]
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], KIND).repartition(3)
    return sorted((tuple(r[c] for c in ORDER) for r in negatives.mine_negatives(frame).collect()), key=str)


def test_strassen_is_exact(spark, monkeypatch):
    r = np.random.default_rng(0)
    for leaf in (1, 4, 32):
        monkeypatch.setattr(negatives, "LEAF", leaf)
        for n, d, m in ((1, 1, 1), (7, 5, 9), (64, 64, 64), (70, 33, 101), (3, 200, 40)):
            a, b = r.integers(-(2**28), 2**28, (n, d)), r.integers(-(2**28), 2**28, (d, m))
            want = np.array(a.astype(object) @ b.astype(object), dtype=object)
            assert (negatives.strassen(a, b).astype(object) == want).all()


def test_sums_that_wrap_on_the_way_are_exact(monkeypatch):
    """Inner sums overflow, the products themselves fit 64 bits."""
    monkeypatch.setattr(negatives, "LEAF", 1)
    a = np.array([[2**31, -(2**31)], [2**31, 2**31]]) * 2**30
    b = np.array([[1, 1], [1, -1]])
    assert (negatives.strassen(a, b) == a @ b).all()


def test_equals_brute_force(spark, monkeypatch):
    r = random.Random(3)
    rows = [(i, [r.choice([-1.0, -0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(6)], r.randint(0, 3)) for i in range(260)]
    rows += [(i, list(rows[50][1]), 1) for i in range(300, 340)] + [(50, list(rows[50][1]), rows[50][2])] * 2
    rows += [(None, list(rows[50][1]), 0), (None, [0.1] * 6, 2), (400, None, 1), (450, [0.1] * 6, None), (451, [float("nan")] * 6, 1), (452, [None] * 6, 1)]
    rows += [(500, [float("inf")] * 6, 1), (550, [0.0] * 6, 1), (600, [], 2), (650, [1.0, 2.0], 1), (700, [1.0] * 9, 0), (-50, [0.5] * 6, 3), (750, [1e12] * 6, 1)]
    want = brute(rows)
    assert found(spark, rows) == want and len(want) > 50
    monkeypatch.setattr(negatives, "TILE_ROWS", 32)
    monkeypatch.setattr(negatives, "TILE_SCORES", 64)
    monkeypatch.setattr(negatives, "ANCHOR_NUMBERS", 100)
    monkeypatch.setattr(negatives, "LEAF", 2)
    assert found(spark, rows) == want


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0], 1)]) == []
    assert found(spark, [(50, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == brute([(50, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)])
