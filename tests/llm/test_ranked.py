import math
import random
import re

import numpy as np

from carelake.llm import ranked

from .data import awkward, empty

ITEMS = "item_id long, text string, rank int, score long"


def brute(rows, items, k):
    def terms(text):
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)

    docs = [(key, terms(text)) for key, text in rows]
    docs = [d for d in docs if d[1]]
    big_n, big_l = len(docs), sum(len(w) for _, w in docs)
    df = {}
    for _, w in docs:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for key, w in docs:
            m = 10 + 90 * len(w) * big_n // big_l
            score = 0
            for t in set(terms(text)):
                if tf := w.count(t):
                    score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if none else key, -s) for i, (s, none, key) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    frame = spark.createDataFrame([(*i, 1, 1) for i in items], ITEMS)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked.ranked_search(docs, frame, k).collect()), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{int(r.paretovariate(0.6))}" for _ in range(300)] + ["Ünï", "日本"]
    text = lambda n: r.choice([" ", ", "]).join(r.choice(vocab) for _ in range(n))
    rows = [(r.randint(0, 400), text(r.randint(0, 80))) for _ in range(400)]
    rows += [(900 - i, rows[3][1]) for i in range(40)]  # equal scores, descending ids
    rows += [(None, rows[3][1]), (None, None), (7, ""), (8, "!!"), (9, rows[5][1] * 300)]
    items = [(i, text(r.randint(1, 30)).upper()) for i in range(20)] + [(50, rows[3][1]), (50, "zzz"), (51, None), (52, ""), (None, "w1 w2"), (53, "w3 w3 w3")]
    return rows, items


def test_equals_brute_force(spark, monkeypatch):
    rows, items = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, items, 10)
    for postings, batch, turn in ((1_000_000, 128, 8 << 20), (700, 3, 8 << 20), (1, 1, 400)):
        monkeypatch.setattr(ranked, "BLOCK_POSTINGS", postings)
        monkeypatch.setattr(ranked, "BATCH", batch)
        monkeypatch.setattr(ranked, "QUERY_BYTES", turn)
        assert found(spark, docs, items) == want
    assert found(spark, docs, items, k=1) == brute(rows, items, 1)


def test_awkward_rows(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    items = [(1, "short text"), (2, "word"), (3, "two 日本語 END x")]
    assert found(spark, awkward(spark), items, 3) == brute(rows, items, 3)
    assert found(spark, empty(spark), items) == [] and found(spark, awkward(spark), []) == []


def test_sparse_tables_give_every_range(spark):
    r = np.random.default_rng(2)
    doc, term = np.divmod(np.flatnonzero(r.random(300 * 4) < 0.4), 4)
    block = ranked.Block(doc, term, r.integers(1, 50, len(doc)), 300, 4)
    for t in range(4):
        a, b = block.start[t], block.start[t + 1]
        for lo in range(a, b, 7):
            for hi in range(lo, b + 1, 5):
                place, value = block.maxima(np.array([lo]), np.array([hi]))
                assert value[0] == (block.impact[lo:hi].max() if hi > lo else 0)
                assert hi == lo or lo <= place[0] < hi


def test_floors_end_a_search_early():
    """With a floor, ties at the floor count only below the named document."""
    doc, term, impact = np.arange(8), np.zeros(8, np.int64), np.array([5, 9, 9, 7, 9, 9, 3, 9])
    block = ranked.Block(doc, term, impact, 8, 1)
    docs, scores = block.search(np.array([0]), 3)
    assert docs.tolist() == [1, 2, 4] and scores.tolist() == [9, 9, 9]
    docs, scores = block.search(np.array([0]), 3, least=9, tied=2)
    assert docs.tolist() == [1]
