"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are hashed to embedding rows; filters of several widths slide over the text, the
strongest response of each counts, and a logistic layer weighs them.  A threshold
for each language, guessed from the text itself, is calibrated on rows kept from training
and subtracted, so that 0.5 is the limit everywhere.  Only the text is read for a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import TEXT_BATCH_BYTES, materialize, released_after

#: About so many labelled rows at most are fitted on, chosen by a hash of the key.
MAX_TRAINING_ROWS = 16_000
#: So many words of them at most (four bytes each on the driver), in whole texts.
MAX_TRAINING_WORDS = 16_000_000
#: One in so many of them is kept for the thresholds.
CALIBRATION = 4
BUCKETS = 1 << 20
DIM = 4
WIDTHS = (1, 2, 3)
FILTERS = 4
EPOCHS = 3
#: Words a worker remembers the row of (about 0.15 KB each).
CACHE_WORDS = 150_000
#: Words of a text convolved at a time.
CHUNK = 100_000

_WORD = re.compile(r"[^\W\d_]+")
#: Frequent words by which a text's language is guessed.
LANGUAGE_WORDS = {
    "de": "der die und das ist nicht mit von den im zu ein eine auf",
    "en": "the and of to is that for with was are this from be",
    "es": "el los que y una por con las se lo para su",
    "fr": "le les et des est une pour dans qui sur un du ai",
}
_LANGUAGES = sorted(LANGUAGE_WORDS)
_VOTES: dict[str, int] = {}
for _n, _l in enumerate(_LANGUAGES):
    for _w in LANGUAGE_WORDS[_l].split():
        _VOTES[_w] = _n


class _Buckets(dict):
    """Word -> 8 * bucket + language vote (7: none), emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        code = 8 * (zlib.crc32(word.encode()) % BUCKETS) + _VOTES.get(word, 7)
        if len(word) <= 64:
            self[word] = code
        return code


_CODES = _Buckets()


def featurize(text: str | None) -> tuple[np.ndarray, int]:
    """Embedding rows of the words of the whole text, and its guessed language (len: none)."""
    words = _WORD.findall(text.lower()) if text else []
    codes = np.fromiter(map(_CODES.__getitem__, words), dtype=np.int64, count=len(words))
    votes = np.bincount(codes & 7, minlength=8)[: len(_LANGUAGES)]
    return (codes >> 3).astype(np.int32), int(votes.argmax()) if votes.any() else len(_LANGUAGES)


class Model:
    """Embeddings, filters by width (width * DIM x FILTERS), output weights and thresholds."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        self.table = (r.standard_normal((BUCKETS, DIM)) * 0.05).astype(np.float32)
        self.filters = [(r.standard_normal((w * DIM, FILTERS)) * 0.2).astype(np.float32) for w in WIDTHS]
        self.out = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        self.bias = 0.0
        self.thresholds = np.zeros(len(_LANGUAGES) + 1)

    def pool(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Strongest response of each filter over the text, and where it begins (-1: text too short)."""
        best = np.full((len(WIDTHS), FILTERS), -1.0, dtype=np.float32)
        where = np.full((len(WIDTHS), FILTERS), -1)
        for start in range(0, len(rows), CHUNK):
            e = self.table[rows[start : start + CHUNK + max(WIDTHS) - 1]]
            for k, (w, f) in enumerate(zip(WIDTHS, self.filters)):
                n = len(e) - w + 1
                if n < 1:
                    continue
                z = sum(e[i : i + n] @ f[i * DIM : (i + 1) * DIM] for i in range(w))
                top = z.argmax(axis=0)
                value = np.tanh(z[top, np.arange(FILTERS)])
                better = value > best[k]
                best[k][better], where[k][better] = value[better], top[better] + start
        return best.ravel(), where.ravel()

    def logit(self, rows: np.ndarray) -> float:
        return float(self.pool(rows)[0] @ self.out + self.bias)

    def score(self, text: str | None) -> float:
        rows, language = featurize(text)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(rows) - self.thresholds[language], -60, 60))))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> None:
        """Start from each word's log-odds in the training texts, then follow the gradient (Adagrad)."""
        base = np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
        present = [np.unique(t) for t in texts]
        ones = np.bincount(np.concatenate([p for p, y in zip(present, labels) if y] or [[]]).astype(int), minlength=BUCKETS)
        zeros = np.bincount(np.concatenate([p for p, y in zip(present, labels) if not y] or [[]]).astype(int), minlength=BUCKETS)
        odds = np.log((ones + 0.5) / (zeros + 0.5)) - base
        self.table[:, 0] += (np.clip(odds, -4, 4) * (ones + zeros) / (ones + zeros + 20.0)).astype(np.float32) * 0.5
        for w, f in zip(WIDTHS, self.filters):
            f[np.arange(w) * DIM, 0] = 1.0 / w
        self.out[::FILTERS] = 1.0
        self.bias = float(base)

        r = np.random.default_rng(seed)
        seen = [np.zeros_like(f) for f in self.filters]
        seen_out, seen_bias, seen_table = np.zeros_like(self.out), 0.0, np.zeros(BUCKETS, np.float32)
        for _ in range(EPOCHS):
            for d in r.permutation(len(texts)):
                rows = texts[d]
                pooled, where = self.pool(rows)
                p = 1.0 / (1.0 + np.exp(-np.clip(pooled @ self.out + self.bias, -30, 30)))
                g = float(p - labels[d])
                back = g * self.out * (1 - pooled * pooled)
                grad = g * pooled
                seen_out += grad * grad
                self.out -= 0.1 * grad / (1e-6 + np.sqrt(seen_out))
                seen_bias += g * g
                self.bias -= 0.1 * g / (1e-6 + seen_bias**0.5)
                for k, w in enumerate(WIDTHS):
                    f = self.filters[k]
                    for c in range(FILTERS):
                        at = where[k * FILTERS + c]
                        if at < 0:
                            continue
                        words = rows[at : at + w]
                        b = back[k * FILTERS + c]
                        gf = b * self.table[words].ravel()
                        ge = (b * f[:, c]).reshape(w, DIM)
                        seen[k][:, c] += gf * gf
                        f[:, c] -= 0.02 * gf / (1e-3 + np.sqrt(seen[k][:, c]))
                        np.add.at(seen_table, words, (ge * ge).sum(axis=1))
                        np.add.at(self.table, words, -0.02 * ge / (1e-2 + np.sqrt(seen_table[words]))[:, None])

    def calibrate(self, texts: list[np.ndarray], languages: np.ndarray, labels: np.ndarray) -> None:
        """For each language the threshold with most right answers; few rows: that of all languages."""
        logits = np.array([self.logit(t) for t in texts])
        overall = _best_threshold(logits, labels)
        for n in range(len(self.thresholds)):
            own = languages == n
            self.thresholds[n] = _best_threshold(logits[own], labels[own]) if own.sum() >= 20 else overall


def _best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the best gap between sorted logits; where nothing is gained, one above all of them."""
    if not len(logits):
        return 0.0
    order = np.argsort(-logits, kind="stable")
    z, y = logits[order], labels[order]
    gain = np.concatenate([[0], np.cumsum(np.where(y == 1, 1, -1))])  # right answers won by k positives
    open_cut = np.concatenate([[True], z[:-1] > z[1:], [True]])
    k = int(np.where(open_cut, gain, -len(z) - 1).argmax())
    if k == 0:
        return float(z[0] + 3.0)
    return float((z[k - 1] + z[k]) / 2 if k < len(z) else z[-1] - 1.0)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def within_budget(keys: np.ndarray, words: np.ndarray, budget: int) -> np.ndarray:
    """Those of the keys, in the order of a hash, whose texts fit ``budget`` words together; one that does not fit is passed over."""
    left, taken = budget, []
    for i in sorted(range(len(keys)), key=lambda i: (zlib.crc32(f"training {keys[i]}".encode()), keys[i])):
        if words[i] <= left:
            left -= words[i]
            taken.append(keys[i])
    return np.array(taken, dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled rows that are not held out: about MAX_TRAINING_ROWS with MAX_TRAINING_WORDS at most, as word codes, on the driver.

    The rows are chosen by a hash of their key over the whole table and read by a
    broadcast of their bounded list of keys; of texts that share a key one is used, the same in every run.
    Without a row of either class the model gives every text the same score below 0.5.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    usable = usable.groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("y"))
    every = max(1, -(-usable.count() // MAX_TRAINING_ROWS))
    chosen = usable.filter(F.pmod(F.xxhash64("k", F.lit(17)), F.lit(every)) == 0)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            coded = [featurize(t) for t in b["text"]]
            yield pd.DataFrame({
                "k": b["k"], "y": b["y"], "n": [len(c[0]) for c in coded], "rows": [c[0].tobytes() for c in coded], "language": [c[1] for c in coded],
            })
        _CODES.clear()  # a worker outlives its stage

    # four bytes a word: as arrays of numbers the rows would take the driver ten times that
    coded = rows.mapInPandas(lambda batches: released_after(run(batches)), "k long, y int, n long, rows binary, language int")
    coded = coded.groupBy("k", "y").agg(F.min(F.struct("n", "rows", "language")).alias("t")).select("k", "y", "t.*")
    coded = materialize(coded, "training-rows", TEXT_BATCH_BYTES)
    sizes = coded.select("k", "n").toArrow().to_pandas()
    if sizes["n"].sum() > MAX_TRAINING_WORDS:
        fitting = within_budget(sizes["k"].to_numpy(), sizes["n"].to_numpy(), MAX_TRAINING_WORDS)
        wanted = docs.sparkSession.createDataFrame(pd.DataFrame({"k": fitting}), "k long")
        coded = coded.join(F.broadcast(wanted), "k", "left_semi")
    pdf = coded.drop("n").toArrow().to_pandas().sort_values("k", kind="stable")
    model = Model()
    y = pdf["y"].to_numpy() if len(pdf) else np.zeros(0, int)
    if not len(y) or y.min() == y.max():
        model.bias = -3.0
        return model
    texts = [np.frombuffer(r, dtype=np.int32) for r in pdf["rows"]]
    languages = pdf["language"].to_numpy()
    kept = np.array([zlib.crc32(f"calibration {k}".encode()) % CALIBRATION == 0 for k in pdf["k"]])
    fit = [t for t, c in zip(texts, kept) if not c]
    if fit and y[~kept].min() < y[~kept].max():
        model.fit(fit, y[~kept])
        model.calibrate([t for t, c in zip(texts, kept) if c], languages[kept], y[kept])
    return model


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 if score >= 0.5) of every whole text.

    Null and empty texts have the score of a text without words.  Columns of those names
    are replaced.  No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for s in texts:
            yield pd.Series([m.score(t) for t in s], dtype="float64")
        _CODES.clear()  # a worker outlives its stage

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return released_after(scored(texts))

    kept = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])
    return kept.withColumn("score", score(F.col(text))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
