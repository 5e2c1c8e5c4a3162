import hashlib
import random
import re

from carelake.llm import pii

from .data import awkward, empty

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(digits)))]
    return sum(doubled) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = kind == "email"
            ok |= kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
            ok |= kind == "card" and 16 <= len(d) <= 19 and luhn(d)
            ok |= kind == "phone" and 8 <= len(d) <= 15
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def contexts():
    """A context with many seeds, and one token that no pattern knows."""
    rows = [(1000 + i, f"so my user id u{i}@x.org goes on") for i in range(12)]
    return [*rows, (1100, "so my user id u77(at)x.org, goes on"), (1101, "an other id u78(at)x.org")]


def test_base_spans_equal_python(spark):
    r = random.Random(3)
    bits = ["a", "b.", "@", "c-", "1", "23", "4111111111111111", "4111 1111 1111 1111", "+", "+1 (330) 555-8590", " ", "\n", "é😀",
            ".", "..", "-", "(", ")", "192.168.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "x@y.z", "x@y.z_q@r.s", "%", "0000000000000000"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 14)))) for i in range(800)]
    rows += [(900, None), (901, "a" * 3000), (902, "1" * 5000), (903, "1 " * 20000 + "a@b.c " * 3000), (904, "." * 3000 + "@" + ".a" * 1000)]
    rows += contexts()
    got = {x.doc_id: x for x in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = base(text)
        assert got[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), (i, text[:200], got[i].spans[:200])
        for kind in PATTERNS:
            assert got[i][f"n_{kind}"] == sum(k == kind for k, _, _ in want)
        assert set(joined(want).split(",")) <= set(got[i].spans.split(",")) or not want


def test_context_finds_unseen_identifiers(spark):
    got = {x.doc_id: x for x in pii.personal_data(spark.createDataFrame(contexts(), "doc_id long, text string")).collect()}
    text = contexts()[12][1]
    start = text.index("u77")
    assert got[1100].spans == f"email:{start}:{start + len('u77(at)x.org')}" and got[1100].n_email == 0
    assert got[1101].spans == ""


def test_awkward_rows_and_redaction(spark):
    got = pii.personal_data(awkward(spark)).collect()
    assert len(got) == awkward(spark).count() and {g.spans for g in got} == {""}
    assert pii.personal_data(empty(spark)).count() == 0 and pii.redact(empty(spark)).count() == 0
    rows = [(1, "é a@b.c, 1.2.3.4 or +1 (330) 555-8590", "en", None, 1, "x", 1), (2, None, None, None, None, None, None),
            (2, "none 😀", "en", "s", 1, "x", 1), (None, "4111 1111 1111 1111", "en", "s", 1, "x", 1)]
    out = pii.redact(awkward(spark, rows))
    assert out.columns == awkward(spark).columns
    assert sorted(str(r.text) for r in out.collect()) == ["None", "[CARD]", "none 😀", "é [EMAIL], [IP] or [PHONE]"]


def spans_of(spark, rows):
    return {x.doc_id: x.spans for x in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def marked(text, what, kind="email"):
    return f"{kind}:{text.index(what)}:{text.index(what) + len(what)}"


def test_seeds_and_tokens_have_the_same_context(spark):
    """Digit words before, leading marks, a seed right after one of its kind, doubled spaces."""
    rows = [(i, f"so Ticket {42} contact u{i}@x.org goes") for i in range(12)]
    rows += [(20 + i, f"the mail:  <v{i}@x.org> goes") for i in range(12)]
    rows += [(40 + i, f"either aa{i}@x.org bb{i}@x.org") for i in range(12)]
    texts = {60: "my Ticket 42 contact u77(at)x.org goes", 61: "the mail: <v77(at)x.org> goes", 62: "so 42 call v78(at)x.org"}
    got = spans_of(spark, rows + list(texts.items()))
    assert got[60] == marked(texts[60], "u77(at)x.org")
    assert got[61] == marked(texts[61], "v77(at)x.org")
    assert got[62] == ""


def test_accepted_instances_are_marked_and_induce_patterns(spark):
    rows = [(i, f"so my user id u{i}@x.org goes on") for i in range(80)]
    rows += [(100 + i, f"so my user id jane{'abcdefgh'[i]}(at)example.com goes on") for i in range(8)]
    rows += [(200 + i, f"please write to jane{'abcdefgh'[i]}(at)example.com") for i in range(8)]
    texts = {300: "please write to joe(at)example.com now", 301: "and ring janea(at)example.com", 302: "and ring joy(at)example.com"}
    got = spans_of(spark, rows + list(texts.items()))
    assert got[100] == marked(rows[80][1], "janea(at)example.com")
    assert got[200] == marked(rows[88][1], "janea(at)example.com")  # marked in another context
    assert got[300] == marked(texts[300], "joe(at)example.com")  # by a pattern that accepted instances induced
    assert got[301] == marked(texts[301], "janea(at)example.com") and got[302] == ""


def test_runs_of_digit_words(spark):
    rows = [(i, f"so call me at +1 330 555 85{i:02d} please") for i in range(12)]
    text = "do call me at 330 555 8577, please"
    got = spans_of(spark, [*rows, (50, text)])
    assert got[50] == marked(text, "330 555 8577", "phone")


def test_runs_of_any_length(spark):
    rows = [(i, f"so call me at +1 330 555 85{i:02d} please") for i in range(12)]
    run = " ".join(str(10 + i) for i in range(40))
    text = f"do call me at {run} please"
    assert spans_of(spark, [*rows, (50, text)])[50] == marked(text, run, "phone")


def brute_scores(seeds, tokens):
    """Trusted patterns and accepted instances of the pattern-instance graph, with kinds."""
    known = {(m, k) for _, m, k in seeds}
    kinds = {k for _, _, k in seeds}
    edges = {(b, m) for b, m, _ in seeds if b} | {(b, m) for b, m in tokens if b}
    sizes = {b: sum(x == b for x, _ in edges) for b, _ in edges}
    long = {m: sum(c.isalnum() for c in m) >= pii.MIN_IDENTIFIER for _, m in edges}
    trusted, accepted = {}, set()
    while True:
        new = {}
        for b, k in {(b, k) for b in sizes for k in kinds}:
            total, n_seeds = 0.0, 0
            for m in (m for x, m in edges if x == b):
                if (m, k) in known:
                    score = 1.0
                else:
                    rest = 1.0
                    for x, m2 in edges:
                        if m2 == m and x != b and (x, k) in trusted:
                            rest *= 1 - trusted[x, k]
                    score = min(round(1 - rest, 9), 1 - pii.DOUBT)
                total += score
                n_seeds += score == 1.0 or (score >= pii.MIN_SCORE and long[m])
            if n_seeds >= pii.MIN_SEEDS and total / sizes[b] >= pii.MIN_CONFIDENCE:
                new[b, k] = total / sizes[b]
        found = set()
        for m, k in {(m, k) for _, m in edges for k in kinds} - known:
            rest = 1.0
            for x, m2 in edges:
                if m2 == m and (x, k) in new and new[x, k] < 1:
                    rest *= 1 - new[x, k]
            if 1 - rest >= pii.MIN_SCORE - 1e-9 and long[m]:
                found.add((m, k))
        if len(found) <= len(accepted) and len(new) <= len(trusted):
            return {b: max(((c, k) for (x, k), c in new.items() if x == b))[1] for b, _ in new}, found
        trusted, accepted = new, found


def test_scores_equal_brute_force(spark):
    """A chain in which each round trusts the next pattern, for more rounds than any fixed number of ten."""
    r = random.Random(4)
    seeds = [("pattern 0", f"seed{i}@x.org", "email") for i in range(30)]
    tokens = []
    for step in range(14):
        seeds += [(f"pattern {step + 1}", f"seed{step}.{i}@x.org", "email") for i in range(18)]
        for i in range(4):
            tokens += [(f"pattern {step}", f"inst{step}(at)x{i}"), (f"pattern {step + 1}", f"inst{step}(at)x{i}")]
    tokens += [("pattern 14", f"last(at)x{i}") for i in range(4)]
    for i in range(200):
        tokens.append((f"other {r.randrange(12)}", f"token{r.randrange(60)}"))
        if r.random() < 0.3:
            seeds.append((f"other {r.randrange(12)}", f"token{r.randrange(60)}", r.choice(["phone", "email"])))
    patterns, found = pii.score_patterns(
        spark.createDataFrame(seeds, "before string, m string, kind string"), spark.createDataFrame(tokens, "before string, m string")
    )
    want_patterns, want = brute_scores(seeds, tokens)
    assert {x.before: x.kind for x in patterns.collect()} == want_patterns and len(want_patterns) > 12
    assert {(x.m, x.kind) for x in found.collect()} == want and len(want) >= 60
