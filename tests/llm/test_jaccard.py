import itertools
import re

from carelake.llm import jaccard
from carelake.llm.graph import connected_components

from .data import awkward, empty, near_copies


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_components_equal_all_pairs(spark, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 4, 85)
    assert len({c for _, c in want.values()}) < len(rows) - 40
    assert result(jaccard.jaccard_components(docs, 4, 85)) == want
    # every column long: the order of shingles changes, the result does not
    monkeypatch.setattr(jaccard, "LONG_COLUMN", 2)
    monkeypatch.setattr(jaccard, "LONG_COLUMNS", 50)
    assert result(jaccard.jaccard_components(docs, 4, 85)) == want
    assert result(jaccard.jaccard_components(docs, 5, 60)) == brute(rows, 5, 60)


def test_awkward_rows(spark):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(awkward(spark), 4, 85).collect()]
    want = [(1, 5, 1), (2, 5, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 1, 6), (10, 1, 10), (11, 1, 11)]
    assert sorted(x for x in got if x[0] is not None and x[0] != 9) == want
    assert [x[2] for x in got if x[0] == 9] == [9, 9]
    assert sorted(x[1:] for x in got if x[0] is None) == [(0, None), (5, None)]
    assert jaccard.jaccard_components(empty(spark), 4, 85).count() == 0


def test_large_keys_beside_null_ones(spark):
    big = (1 << 60) + 1
    docs = spark.createDataFrame([(big, "a b c d"), (None, "a b c d"), (big + 1, "A b c d")], "doc_id long, text string")
    got = result(jaccard.jaccard_components(docs.coalesce(1), 4, 85))
    assert got == {big: (1, big), big + 1: (1, big), None: (1, None)}


def test_connected_components(spark):
    path = [(i, i + 1) for i in range(100, 140)] + [(3, 7), (7, 9), (9, 3), (5, 5), (None, 4)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {3: 3, 7: 3, 9: 3}


def test_shingle_sets_of_any_step(monkeypatch):
    """Equal shingles have equal hashes wherever the texts are cut, and different ones do not."""
    texts = ["a b c d e f", "B  c\tD e", None, "", " \n", "x" * 200 + " y", "x" * 199 + "z y", "word " * 300, "é É ñ b c d e"] * 3
    want = [s.tolist() for s in jaccard.shingle_sets(texts, 4)]
    assert [len(w) for w in want[:9]] == [3, 1, 0, 0, 0, 1, 1, 1, 4]
    assert set(want[1]) < set(want[0]) and want[5] != want[6] and want[8][0] != want[8][1] and set(want[1]) < set(want[8])
    for step in (1, 7, 50):
        monkeypatch.setattr(jaccard, "STEP_BYTES", step)
        assert [s.tolist() for s in jaccard.shingle_sets(texts, 4)] == want


def test_product_counts_overlaps_within_prefixes(spark):
    """Counts are those of the common columns that could still begin a link; pairs that link are never discarded."""
    rows = [(i, t) for i, t in near_copies() if t]
    sets = dict(zip([i for i, _ in rows], (s.tolist() for s in jaccard.shingle_sets([t for _, t in rows], 4)), strict=True))
    sets = {i: s for i, s in sets.items() if s}
    prefix = {i: s[: jaccard.prefix_length(len(s), 60)] for i, s in sets.items()}
    cells = [(i, len(sets[i]), k, s, i, -1, -1) for i, p in prefix.items() for k, s in enumerate(p)]
    rest = spark.createDataFrame(cells, "id long, n long, pos int, s long, comp long, main long, first long")
    got = {(r.idx, r.idy): r.overlap for r in jaccard._product(rest, 60).collect()}
    met = 0
    for a, b in itertools.combinations(sorted(prefix), 2):
        n, m = len(sets[a]), len(sets[b])
        needed = -(-(n + m) * 60 // 160)
        rooms = [min(n - prefix[a].index(s), m - prefix[b].index(s)) for s in sorted(set(prefix[a]) & set(prefix[b]))]
        counted = [r for r in rooms if r >= needed]
        met += bool(rooms)
        could = bool(counted) and len(counted) + counted[-1] - 1 >= needed
        assert got.get((a, b)) == (len(counted) if could else None)
        x, y = set(sets[a]), set(sets[b])
        assert (a, b) in got or 100 * len(x & y) < 60 * len(x | y)
    assert 0 < len(got) < met
