"""Ranked lexical search: best-first over document intervals with range-maximum tables.

The collection is cut into blocks of documents.  Inside a block every query term has a
posting list with its impacts and a sparse table over them, which gives the largest
impact of any range of documents in one step.  The sum of these maxima over a query's terms
bounds the score of every document of an interval.  The interval with the largest bound is
split at the document of its largest impact, that document is scored, and both halves come
back with their own bounds; what cannot reach the k-th best score is dropped.

Document statistics come from one pass over all texts, which also writes the postings of the
query terms (a few bytes each).  A first short search of every block gives each query a score that its
k-th result is sure to reach; the second search starts from it, so that most blocks end at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Postings of a block of documents; the tables over them take about 20 x 4 bytes each.
BLOCK_POSTINGS = 1_000_000
#: Intervals split in one step of numpy, and steps of the first, short search.
BATCH = 128
SEED_STEPS = 2
#: Queries are searched together up to so many bytes of query text; more are searched in turns.
QUERY_BYTES = 8 << 20

#: Bytes that end a term become spaces, A-Z become small; bytes of other alphabets stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_FOLD).split() if text else []


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of every row with a term: n counts all terms, terms only those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for b in batches:
            ids, sizes, terms, tfs, ends = [], [], [], [], [0]
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms_of(t.as_py())
                if not words:
                    continue
                own, counts = np.unique([x for x in map(get, words) if x is not None], return_counts=True)
                ids.append(i)
                sizes.append(len(words))
                terms.append(own.astype(np.int32))
                tfs.append(counts.astype(np.int32))
                ends.append(ends[-1] + len(own))
            none, ends = np.empty(0, np.int32), pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([none, *x]))) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], schema=schema)

    given = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return given.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


class Block:
    """Posting lists of some documents, numbered from 0, and sparse tables of the places of their maxima."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, term))
        self.doc, self.impact, self.n_docs = doc[order], impact[order], n_docs
        term = term[order].astype(np.int64)
        self.key = term * n_docs + self.doc  # grows over all lists: one search finds a document in any of them
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        levels, width, longest = [np.arange(len(order), dtype=np.int32)], 1, int(np.diff(self.start).max(initial=0))
        while 2 * width <= longest:
            a, b = levels[-1][:-width], levels[-1][width:]
            levels.append(np.where(self.impact[a] >= self.impact[b], a, b))
            width *= 2
        self.level_at = np.cumsum([0, *map(len, levels)])[:-1]
        self.table = np.concatenate(levels)

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of the largest impact in each range [lo, hi) of postings; an empty range has 0."""
        some = hi > lo
        level = np.frexp(np.maximum(hi - lo, 1).astype(np.float64))[1] - 1
        at = self.level_at[level]
        a = self.table[np.where(some, at + lo, 0)]
        b = self.table[np.where(some, at + hi - (1 << level), 0)]
        best = np.where(self.impact[a] >= self.impact[b], a, b)
        return best, np.where(some, self.impact[best], 0)

    def search(self, terms: np.ndarray, k: int, least: int = 1, tied: int | None = None, steps: int | None = None):
        """The k best documents by (score descending, number ascending) as (documents, scores).

        Only scores of at least ``least`` count, and of those equal to it only documents below ``tied``.
        ``steps`` ends the search early with true scores that need not be the best.
        """
        terms = terms[self.start[terms + 1] > self.start[terms]]
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(terms):
            return docs, scores
        limit, tied = max(1, least), self.n_docs if tied is None else tied
        base = terms * self.n_docs
        lo, hi = self.start[terms][None, :], self.start[terms + 1][None, :]
        first = np.zeros(1, np.int64)  # first document of each interval
        place, value = self.maxima(lo, hi)
        bound = value.sum(axis=1)
        while len(bound):
            live = (bound > limit) | ((bound == limit) & (first < tied))
            if steps is not None:
                live &= steps > 0
                steps -= 1
            if not live.all():
                lo, hi, first, place, value, bound = (x[live] for x in (lo, hi, first, place, value, bound))
                if not len(bound):
                    break
            order = np.argpartition(-bound, BATCH) if len(bound) > BATCH else np.arange(len(bound))
            pick, rest = order[:BATCH], order[BATCH:]
            left, right = lo[pick], hi[pick]
            split = self.doc[place[pick, value[pick].argmax(axis=1)]]
            wanted = base[None, :] + split[:, None]
            at = np.searchsorted(self.key, wanted)
            held = self.key[np.minimum(at, len(self.key) - 1)] == wanted
            score = np.where(held, self.impact[np.minimum(at, len(self.key) - 1)], 0).sum(axis=1)
            fits = (score > limit) | ((score == limit) & (split < tied))
            docs, scores = np.concatenate([docs, split[fits]]), np.concatenate([scores, score[fits]])
            if len(docs) >= k:
                best = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[best], scores[best]
                limit, tied = int(scores[-1]), int(docs[-1])
            new_lo, new_hi = np.concatenate([left, at + held]), np.concatenate([at, right])
            new_first = np.concatenate([first[pick], split + 1])
            new_place, new_value = self.maxima(new_lo, new_hi)
            new_bound = new_value.sum(axis=1)
            keep = (new_bound > limit) | ((new_bound == limit) & (new_first < tied))
            lo, hi, first, place, value, bound = (
                np.concatenate([old[rest], new[keep]])
                for old, new in ((lo, new_lo), (hi, new_hi), (first, new_first), (place, new_place), (value, new_value), (bound, new_bound))
            )
        order = np.lexsort((docs, -scores))[:k]
        return docs[order], scores[order]


def impacts(term: np.ndarray, tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """weight * ((10^9 tf) div (1000 tf + 8 m)) with m = 10 + (90 n N) div L, in 64-bit integers."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        n = n.astype(object)
    m = (10 + (90 * n * n_docs) // max(1, n_words)).astype(np.int64)
    return weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


_FOUND = pa.schema([("q", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _searched(stored: DataFrame, facts, queries: list[tuple[int, np.ndarray]], k: int, least: dict | None) -> DataFrame:
    """(q, id, score): up to k rows of each query and block; without ``least`` those of a short search."""
    shared = stored.sparkSession.sparkContext.broadcast((facts, queries, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weight, n_docs, n_words), wanted, floors = shared.value
        last = np.iinfo(np.int64).max

        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            nulls = np.asarray(t["id"].is_null())
            ids = t["id"].fill_null(0).to_numpy()
            order = np.lexsort((ids, nulls))  # by id, null ones last: of equal scores the first wins
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            lengths = t["terms"].combine_chunks().value_lengths().to_numpy()
            term, tf = (t[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
            impact = impacts(term, tf, np.repeat(t["n"].to_numpy(), lengths), weight, n_docs, n_words)
            some = impact > 0
            block = Block(np.repeat(number, lengths)[some], term[some], impact[some], len(ids), len(weight))
            sorted_ids = ids[order][: len(ids) - int(nulls.sum())]
            out = [[], [], []]
            for q, terms in wanted:
                if floors is None:
                    docs, scores = block.search(terms, k, steps=SEED_STEPS)
                else:
                    least, until, null_too = floors.get(q, (1, last, True))
                    tied = len(ids) if null_too else int(np.searchsorted(sorted_ids, until, "right"))
                    docs, scores = block.search(terms, k, least, tied)
                out[0].append(np.full(len(docs), q))
                out[1].append(order[docs])
                out[2].append(scores)
            rows = np.concatenate(out[1]).astype(np.int64) if out[1] else np.empty(0, np.int64)
            cols = [np.concatenate(out[0]) if out[0] else rows, None, np.concatenate(out[2]) if out[2] else rows]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(ids[rows], pa.int64(), mask=nulls[rows]), pa.array(cols[2], pa.int64())], schema=_FOUND)

        held, size = [], 0
        for b in batches:
            ends, start = np.cumsum(b.column(2).value_lengths().to_numpy()), 0
            while start < b.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(int(np.searchsorted(ends, before + BLOCK_POSTINGS - size, "right")), start + (not held))
                if stop > start:
                    held.append(b.slice(start, stop - start))
                    size += int(ends[stop - 1]) - before
                    start = stop
                if start < b.num_rows:
                    yield found(held)
                    held, size = [], 0
        if held:
            yield found(held)

    return stored.mapInArrow(run, "q long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The k best rows of ``docs`` for each row of ``items``: item key, rank (from 1), key, score.

    A row's score sums, over the item's distinct terms, weight times saturated term frequency in
    64-bit integers; the weight of a term falls with the number of documents that hold it.  Equal scores
    rank by ascending key, null keys last; rows that share a key are documents of their own, and so are
    rows of ``items`` that share theirs.  Null and empty texts have no terms: such items give
    no rows, such documents do not count.  Only scores above 0 are returned.  Empty tables
    give no rows; other columns do not matter.

    Items are searched together up to QUERY_BYTES of text; beyond that in turns, each with a
    pass over the documents.  A turn's vocabulary, weights and floors are all that reaches the
    driver, and of each block's results at most k rows an item are shuffled.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType.simpleString()
    given = items.select(F.monotonically_increasing_id().alias("q"), F.col(item_key).alias("item"), F.col(item_text).alias("text"))
    given = materialize(given.filter("text is not null"), "queries")
    total = given.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    turns = -(-total // QUERY_BYTES)
    results = []
    for turn in range(turns):
        rows = given.filter(F.pmod(F.xxhash64("q"), F.lit(turns)) == turn).select("q", "text").toArrow().to_pylist()
        texts = {r["q"]: set(terms_of(r["text"])) for r in rows}
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*texts.values())))}
        queries = [(q, np.array(sorted(vocabulary[t] for t in own), np.int64)) for q, own in texts.items() if own]
        if not queries:
            continue
        stored = materialize(postings(docs, vocabulary, key, text), "postings")
        n_docs, n_words = stored.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = stored.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
        weight = np.zeros(len(vocabulary), np.int64)
        for t, df in zip(counted["t"].to_pylist(), counted["df"].to_pylist()):
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        facts = (weight, n_docs, n_words)
        seeds = _best(_searched(stored, facts, queries, k, None), k).filter(F.col("rank") == k).collect()
        floors = {r.q: (r.score, r.id or 0, r.id is None) for r in seeds}
        results.append(_best(_searched(stored, facts, queries, k, floors), k))
    if not results:
        return spark.createDataFrame([], f"`{item_key}` {item_kind}, rank int, `{key}` {kind}, score long")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found.join(given.select("q", "item"), "q").select(
        F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("id").cast(kind).alias(key), "score"
    )
