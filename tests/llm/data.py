"""Small frames with the awkward rows every operator must survive."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _sha string, shard int"

AWKWARD = [
    (1, "one two three four five six seven eight", "en", "a", 1, "x", 9),
    (2, "One  TWO three\tfour five six seven eight", "en", "a", 1, "x", 9),
    (3, None, None, None, None, None, None),
    (4, "", "", "", 0, "", 0),
    (5, " \t\n", "en", "a", 1, "x", 9),
    (6, "short text", "en", "a", 1, "x", 9),
    (7, "SHORT text", "en", "a", 1, "x", 9),
    (8, "short  text", "en", "a", 1, "x", 9),
    (9, "Ünïcode ß 日本語 😀 <|endoftext|> end ", "de", "b", 1, "x", 9),
    (9, "Ünïcode ß 日本語 😀 <|endoftext|> end ", "de", "b", 1, "x", 9),
    (10, "word " * 60_000, "en", "b", 1, "x", 9),
    (11, "x" * 300_000, "en", "b", 1, "x", 9),
    (None, "one two three four five six seven eight", "en", "a", 1, "x", 9),
    (None, None, None, None, None, None, None),
]


def awkward(spark, rows=None):
    return spark.createDataFrame(AWKWARD if rows is None else rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def near_copies(seed=5, groups=12, size=12, words=120):
    """(doc_id, text): groups of near copies round the link threshold, a shared passage and singles."""
    import random

    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    passage = " ".join(r.choice(vocab) for _ in range(40))
    rows, k = [], 0
    for g in range(groups):
        base = [r.choice(vocab) for _ in range(r.randint(8, words))]
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(vocab)
            if r.random() < 0.3:
                w = w + [r.choice(vocab) for _ in range(r.randint(1, 8))]
            rows.append((k, " ".join(w)))
            k += 1
    for _ in range(150):
        own = " ".join(r.choice(vocab) for _ in range(r.randint(1, 60)))
        rows.append((k, f"{own} {passage}" if r.random() < 0.8 else own))
        k += 1
    r.shuffle(rows)
    return rows
