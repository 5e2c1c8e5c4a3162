import random
import re

from carelake.llm import contamination

from .data import awkward, empty


def brute(rows, items, window):
    """Every window of every item against every place of every text."""

    def words(text):
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)

    cut = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            n = min(window, len(w))
            for p in range(len(w) - n + 1):
                cut.setdefault(tuple(w[p : p + n]), set()).add(str(item))
    out = []
    for key, text in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(c) for c in cut}:
            for p in range(len(w) - n + 1):
                if (held := cut.get(tuple(w[p : p + n]))) is not None:
                    hit |= set(range(p, p + n))
                    names |= held
        spans = sorted(p for p in hit if p - 1 not in hit), sorted(p + 1 for p in hit if p + 1 not in hit)
        out.append((key, len(w), len(hit), sorted(names), list(zip(*spans)) or None))
    return sorted(out, key=str)


def found(spark, docs, items, window=10):
    rows = contamination.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string, row long, h long"), window).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), [tuple(s) for s in r.spans] if r.spans else None) for r in rows), key=str)


def planted(seed=4):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "x9"]
    sentence = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    common = sentence(14)
    items = [(i, sentence(r.choice([1, 3, 4, 5, 9, 10, 11, 25, 40])) if i % 5 else f"{sentence(6)} {common} {sentence(3)}", 1, 1) for i in range(25)]
    items += [(3, sentence(20), 1, 1), (7, items[7][1], 1, 1), (100, items[7][1], 1, 1), (None, sentence(12), 1, 1), (101, None, 1, 1), (102, " .,!", 1, 1)]
    rows = []
    for i in range(150):
        text = sentence(r.randint(0, 60))
        for _ in range(r.randint(0, 3)):
            own = r.choice(items)[1] or ""
            w = own.split(" ")
            start = r.randrange(len(w))
            text += r.choice([" ", ", ", ".\n", "--"]) + r.choice([own, own.upper(), " ".join(w[start : start + 12]), ";".join(w)]) + " " + sentence(r.randint(0, 9))
        rows.append((i // 2 if i % 3 else i, text))
    rows.append((500, (items[0][1] + " ") * 400))  # many occurrences that overlap and touch
    return rows, items


def test_equals_brute_force(spark):
    rows, items = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (10, 4):
        want = brute(rows, [i[:2] for i in items], window)
        assert found(spark, docs, items, window) == want
        assert any(w[2] for w in want) and any(not w[2] for w in want)


def test_turns_and_large_tables_give_the_same(spark, monkeypatch):
    rows, items = planted(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(contamination, "TURN_SHINGLES", 150)
    monkeypatch.setattr(contamination, "BROADCAST_WINDOWS", 0)
    assert found(spark, docs, items) == brute(rows, [i[:2] for i in items], 10)


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = [(1, "one two three four five six seven eight", 1, 1), (2, "word word word word word word word word word word word", 1, 1), (3, "short TEXT", 1, 1), (4, "x" * 300_000, 1, 1)]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(spark, docs, items) == brute(rows, [i[:2] for i in items], 10)
    assert found(spark, docs, []) == brute(rows, [], 10)
    assert found(spark, empty(spark), items) == []


def test_only_the_rarest_shingle_is_joined(spark):
    """The prefix of a window is one shingle: of those that occur, the one with the fewest places."""
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e"), (3, "f g h i j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, hits, _ = contamination.contamination(docs, spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string"))
    assert [(r.start, r.stop) for r in hits.collect()] == [(0, 10)]
