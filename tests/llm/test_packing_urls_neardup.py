import itertools
import random
import re

import numpy as np

from carelake.llm import neardup, packing, urls


def check_packing(sizes, bins, offsets, capacity):
    for b in set(bins):
        own = sorted((offsets[i], sizes[i]) for i in range(len(sizes)) if bins[i] == b)
        at = 0
        for o, s in own:
            assert o == at
            at += s
        assert at <= capacity
    return len(set(bins))


def test_pack_sizes():
    r = random.Random(1)
    for n, top in ((400, 1023), (300, 400), (50, 1023), (1, 5)):
        sizes = np.array([r.randint(1, top) for _ in range(n)])
        bins, offsets = packing.pack_sizes(sizes, 1024)
        used = check_packing(sizes.tolist(), bins.tolist(), offsets.tolist(), 1024)
        big = sum(s > 512 for s in sizes)
        assert used <= max(big, -(-sizes.sum() // 1024)) * 1.06 + 1
        assert sorted(set(bins)) == list(range(used))


def test_exchanges_empty_bins():
    """Against best fit alone: never more bins, never less squared fill, and some bins emptied."""
    r, saved = random.Random(5), 0
    for _ in range(200):
        sizes = [r.randint(100, 600) for _ in range(80)]
        bins, free = packing._best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, 1024)
        before, squares = len(bins), sum((1024 - f) ** 2 for f in free)
        search = packing._Search(bins, free, sizes, 1024)
        search.run()
        after = sum(1 for b in search.bins if b)
        assert after <= before and sum((1024 - f) ** 2 for f in search.free) >= squares
        assert sorted(i for b in search.bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) == 1024 - f for b, f in zip(search.bins, search.free))
        saved += before - after
    assert saved > 0


def test_few_distinct_lengths():
    """No exchange fills a bin exactly here: 400+400 and 300+300+300 become 400+300+300."""
    n = 300
    sizes = np.array([400] * n + [300] * 2 * n)
    bins, offsets = packing.pack_sizes(sizes, 1024)
    assert check_packing(sizes.tolist(), bins.tolist(), offsets.tolist(), 1024) == n


def test_search_ends_where_no_exchange_is_left():
    """By brute force, many tiny items and underfull bins beyond the first ones included."""
    r = random.Random(7)
    for sizes in ([r.choice([400, 300, 210, 77]) for _ in range(60)], [r.randint(250, 300) for _ in range(60)], [r.randint(1, 60) for _ in range(120)] + [700] * 9):
        bins, free = packing._best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, 1024)
        search = packing._Search(bins, free, sizes, 1024)
        search.run()
        left = [[sizes[i] for i in b] for b in search.bins if b]
        some = lambda b, n: {sum(c) for c in itertools.combinations(b, n)}
        for s in left:
            for t in left:
                if s is not t:
                    flows = {a - b for m, n in ((1, 0), (1, 1), (1, 2), (2, 1)) for a in some(s, m) for b in some(t, n)}
                    assert not any(0 < d <= 1024 - sum(t) and sum(t) + d > sum(s) for d in flows)


def test_pack_frame(spark):
    rows = [(i, 0, (i * 37) % 1024 + 1) for i in range(3000)] + [(None, 0, 1024), (7, 1, 1024), (7, 1, 1024)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, length long"), 1024).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 1024
    assert len(by) <= sum(r[2] for r in rows) / 1024 * 1.01 + 2
    assert packing.pack(spark.createDataFrame([], "doc_id long, piece int, length long"), 1024).count() == 0


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("com", "/de/x", "allow")]


def judged(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = min(fits, key=lambda f: (-len(f[0]), f[0])) if fits else (None, "allow")
    return host, path, rule, verdict


def test_urls_equal_brute_force(spark, monkeypatch):
    r = random.Random(2)
    hosts = ["net", "a.net", "Example.NET", "m.example.net", "example.com", "xexample.com", "b.example.com", "org", "x.org", "com", "a.com", "", "net:80"]
    paths = ["", "/", "/en/", "/en", "/en/1?x=/de/", "/de/", "/de/x/y", "/fr/a#b", "/fr", "?q=/en/", "#/en/"]
    rows = [(i, r.choice(["http://", "https://", "", "x://y://"]) + r.choice(hosts) + r.choice(paths)) for i in range(600)]
    rows += [(None, None), (1, ""), (1, "://"), (None, "http://a.net/" + "p" * 20000), (5, "http://" + "a." * 5000 + "net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    want = sorted((str(i), *map(str, judged(u))) for i, u in rows)
    for bits in (16, 0):  # a full filter lets everything through, the join decides
        if not bits:
            monkeypatch.setattr(urls, "_maybe", lambda key, table: True)
        got = urls.judge_urls(pages, rules).collect()
        assert sorted((str(x.page_id), x.host, x.path, str(x.rule), x.verdict) for x in got) == want
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = []
    for g in range(40):
        centre = r.standard_normal(16)
        for _ in range(12):
            rows.append((centre + r.standard_normal(16) * r.choice([0.02, 0.08, 0.15])).tolist())
    rows += rows[:30] + [(np.array(rows[0]) * 3).tolist()]
    data = [(i, [float(np.float32(x)) for x in v], i % 2 if i % 7 else 0) for i, v in enumerate(rows)]
    n = len(data)
    odd = [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [None] * 16, 0), (n + 4, data[0][1], None),
           (n + 5, [1.0, 2.0], 0), (n + 6, [2.0, 4.0], 0), (n + 7, [], 0), (n + 8, [float("inf")] * 16, 1)]
    frame = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, label int")
    v = np.array([d[1] for d in data])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    labels = np.array([d[2] for d in data])
    linked = (v @ v.T >= 0.98) & (labels[:, None] == labels[None, :]) & ~np.eye(n, dtype=bool)
    root = np.arange(n)
    while True:
        new = np.array([min([root[i], *root[linked[i]]]) for i in range(n)])
        if (new == root).all():
            break
        root = new
    want = {i: (int(linked[i].sum()), int(root[i])) for i in range(n)} | {n + k: (0, n + k) for k in range(9)}
    want[n + 5], want[n + 6] = (1, n + 5), (1, n + 5)
    for cell, block in ((2000, 2000), (40, 2000), (20, 16)):
        monkeypatch.setattr(neardup, "CELL_VECTORS", cell)
        monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
        got = {x.vec_id: (x.n_links, x.component_id) for x in neardup.near_duplicates(frame, 0.98).collect()}
        assert got == want
    assert neardup.near_duplicates(frame.limit(0), 0.98).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.01], 1)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), 0.98).collect()
    assert sorted((str(x.vec_id), x.n_links, str(x.component_id), x.kept) for x in got) == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 2, "1", False), ("None", 0, "None", True)]
