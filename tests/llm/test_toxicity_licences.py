import random
import textwrap
import zlib

import pytest

from carelake.llm import licences, toxicity

from .data import awkward, empty


def corpus(n=1500, seed=2):
    r = random.Random(seed)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(1500)]
    bad = ["vile", "scumbagish", "dreckig"]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.randint(5, 120))]
        toxic = r.random() < 0.3
        if toxic:
            words[r.randrange(len(words))] = r.choice(bad).upper() + "!"
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus()
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    return toxicity.train(docs, labels)


def test_held_out_accuracy(spark, model):
    rows = corpus()
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs.withColumn("held", toxicity.held_out()), model).collect()}
    assert all(got[i].held == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_whole_texts_count(model):
    clean = " ".join(x[1] for x in corpus(40, 9) if not x[2])
    chunked = clean * 150
    assert len(toxicity.featurize(chunked)[0]) > toxicity.CHUNK
    assert model.score(chunked) < 0.5 and model.score(chunked) < model.score(chunked + " vile")


def test_training_words_are_bounded(spark, monkeypatch):
    keys, words = list(range(100)), [i % 7 * 10 for i in range(100)]
    taken = toxicity.within_budget(keys, words, 500)
    assert sum(words[i] for i in taken) <= 500 and set(taken) >= {i for i in keys if not words[i]}
    assert all(words[i] > 500 - sum(words[j] for j in taken) for i in set(keys) - set(taken))
    rows = corpus()
    docs = spark.createDataFrame([x[:2] for x in rows] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity.Model, "fit", lambda self, texts, y: seen.append((len(texts), sum(map(len, texts)))))
    monkeypatch.setattr(toxicity.Model, "calibrate", lambda self, texts, languages, y: seen.append((len(texts), sum(map(len, texts)))))
    toxicity.train(docs, labels)
    every = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in rows)
    assert seen[0][0] + seen[1][0] == every
    monkeypatch.setattr(toxicity, "MAX_TRAINING_WORDS", 20_000)
    toxicity.train(docs, labels)
    assert 19_000 < seen[2][1] + seen[3][1] <= 20_000


def test_awkward_rows(spark, model):
    got = toxicity.score_toxicity(awkward(spark), model)
    assert got.columns == [*awkward(spark).columns, "score", "predicted"] and got.count() == awkward(spark).count()
    scores = {r.doc_id: r.score for r in got.collect()}
    assert scores[3] == scores[4] == scores[5]
    assert toxicity.score_toxicity(empty(spark), model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(awkward(spark), nothing).score("vile") < 0.5


def brute_dice(a, b):
    words = ["".join(c if c.isalnum() else " " for c in t.lower()).split() for t in (a, b)]
    left, right = ([" ".join(p) for p in zip(w, w[1:])] for w in words)
    rest, shared = list(right), 0
    for x in left:
        if x in rest:
            rest.remove(x)
            shared += 1
    return 2 * shared / (len(left) + len(right)) if left or right else 0.0


def test_licence_lines_equal_brute_force(spark):
    r = random.Random(4)
    rows = []
    for i in range(60):
        line = r.choice(licences.TEMPLATES)[1].split()
        for _ in range(r.randint(0, 2)):
            line[r.randrange(len(line))] = r.choice(["the", "an", "Licence", "of of"])
        rows.append((i, "Prose goes first.\n" + " ".join(line) + "\nand last"))
    got = {(x.doc_id, x.licence): x.dice for x in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.scope == "line" and x.unit == 1}
    want = {}
    for i, text in rows:
        for name, template in licences.TEMPLATES:
            d = brute_dice(text.split("\n")[1], template)
            if d >= 0.8:
                want[i, name] = max(want.get((i, name), 0), round(d, 6))
    assert got == pytest.approx(want)


def test_licence_over_several_lines(spark):
    mit = licences.TEMPLATES[2][1].replace("copies of", "copies\nof").replace("and/or", "and/or\n")
    docs = spark.createDataFrame([(1, f"Title here\n\n{mit}\n\nProse."), (2, mit)], "doc_id long, text string")
    assert {(x.doc_id, x.scope, x.licence) for x in licences.scan_licences(docs).collect()} == {
        (1, "paragraph", "MIT"), (1, "document", "MIT"), (2, "paragraph", "MIT")
    }  # the few words round it leave the whole first document above 0.8 too
    assert licences.scan_licences(awkward(spark)).count() == 0
    assert licences.scan_licences(empty(spark)).count() == 0


def test_licence_windows_inside_units(spark):
    grant = licences.TEMPLATES[2][1]
    wrapped = "\n".join(textwrap.wrap(grant, 80))
    prose = " ".join(f"word{i}" for i in range(300))
    rows = [
        (1, "Copyright 2020 Foo. Released under the MIT License. All rights reserved."),
        (2, f"{prose} {grant.replace('publish,', '')} {prose}"),
        (3, f"{prose}\n{wrapped}\n{prose}"),
        (4, f"{prose} Released under the MIT License. Released under the MIT License. {prose} released under the mit"),
        (5, "Released under the MIT License."),
    ]
    got = {(x.doc_id, x.scope, x.unit, x.licence): x.dice for x in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    edited = got.pop((2, "window", 299, "MIT"))  # a word shorter: two starts share as much
    assert 0.9 < edited < 1
    assert got == {(1, "window", 3, "MIT"): 1, (3, "window", 300, "MIT"): 1, (4, "window", 300, "MIT"): 1, (4, "window", 305, "MIT"): 1, (5, "line", 0, "MIT"): 1}


def test_licence_windows_equal_brute_force(spark):
    r = random.Random(6)
    templates = [("X", "a b c a b d e f a b"), ("Y", "g h g h g h i j")]
    texts = [" ".join(r.choice([t.split(), [r.choice("abcdefghij")]])[0] if r.random() < 0.3 else t for t in r.choices([x[1] for x in templates] + list("abcdefghij"), k=8)) for _ in range(80)]
    got, want = {}, {}
    for name, t in templates:
        for x in licences.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [(name, t)]).collect():
            if x.scope == "window":
                got[x.doc_id, name] = max(got.get((x.doc_id, name), 0), x.dice)
        for i, text in enumerate(texts):
            words = text.split()
            scores = [brute_dice(" ".join(words[s : s + len(t.split())]), t) for s in range(len(words) - len(t.split()) + 1)]
            if brute_dice(text, t) < 0.8 <= max(scores, default=0):
                want[i, name] = round(max(scores), 6)
    assert len(want) > 20 and {i: d for i, d in got.items() if i in want} == pytest.approx(want)


def test_siblings_and_whole_texts(spark):
    known = licences.known_templates()
    texts = {n: t for n, t in known if len(t) > 500 and n not in ("GPL-1.0", "LGPL-2.0")}
    rows = [(1, "This work is licensed under the GNU General Public License, version 2."),
            (2, "This work is licensed under the GNU Lesser General Public License, version 3."),
            (3, "Copyright 2020 Foo\n\n" + texts["BSD-2-Clause"].replace("HOLDERS", "OWNERS")), (4, "a line\n" + texts["ISC"]),
            (5, texts["GPL-2.0"]), (6, "Prose first. " * 9 + texts["Unlicense"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licences.scan_licences(docs, known, best_only=True).collect()
    found = {(x.doc_id, x.licence) for x in got if x.scope in ("document", "window") or x.doc_id < 3}
    assert {(1, "GPL-2.0"), (2, "LGPL-3.0"), (3, "BSD-2-Clause"), (4, "ISC"), (5, "GPL-2.0"), (6, "Unlicense")} <= found
    assert len({(x.doc_id, x.scope, x.unit) for x in got}) == len(got)
    assert not {"GPL-3.0", "BSD-3-Clause"} & {x.licence for x in got}
