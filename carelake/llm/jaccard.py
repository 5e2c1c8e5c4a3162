"""N-gram Jaccard join: a blocked sparse product of the document by shingle incidence matrix.

Only the part of the incidence matrix that a link needs is multiplied: for each distinct
shingle set the first shingles in one global order, as many as the similarity demands.
Shingles in many sets come last in the order, so their long columns drop out of nearly
all rows.  Pairs are discarded by bounds on their sizes and overlap counts; the rest are
checked on their full sets.

Components need not see every pair.  First each column ties its members to its most common
one (fewest rare shingles: in a large group of near copies the least edited).  While columns
that still join several components would give many pairs, rounds follow in which each
row outside a column's largest component meets a few others of its column, other ones each
time.  At last the rows outside meet the whole column, so that no link between two
components is lost: blocks of columns give partial overlap counts, which are summed by pair, and
pairs whose sum and sizes cannot make a link are discarded before the full check.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import TEXT_BATCH_BYTES, materialize, released_after
from carelake.llm.graph import connected_components

#: Shingles whose column is longer than this go to the end of the global order ...
LONG_COLUMN = 64
#: ... as far as they fit a broadcast of this many 8-byte numbers; else the limit doubles until they do.
LONG_COLUMNS = 2_000_000
#: Shingles of a block of documents, counted together in a worker (16 MB).
BLOCK_SHINGLES = 2_000_000
#: Bytes of text hashed in one step (about 40 bytes each are needed on the way), and words hashed by table.
STEP_BYTES = 1 << 20
TABLE_BYTES = 64
#: Rounds end when all that is left to multiply is so many pairs for each shared row, or a round links too little.
PAIRS_PER_ROW = 4
PARTNERS = 12
#: Id tables up to this many rows (8 bytes each) may be broadcast.
BROADCAST_IDS = 2_000_000
#: Copies (about 0.1 KB each with their set's signature) that may be broadcast.
BROADCAST_COPIES = 200_000

_MASK = np.uint64((1 << 62) - 1)
_LAST = np.int64(1 << 62)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SOLID = np.array([c not in b" \t\n\v\f\r" for c in range(256)])
#: A random number for each place in a word and byte there; a word's hash is their sum, its length mixed in.
_TABLE = np.random.Generator(np.random.PCG64(4)).integers(0, 1 << 64, TABLE_BYTES << 8, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of the words of lower-cased bytes, cut at ASCII white space.  Words beyond the table are hashed by SHA-1."""
    starts, hashes, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while at < len(text):
        end = len(text)
        if at + STEP_BYTES < end and (space := _SPACE.search(text, at + STEP_BYTES)):
            end = space.start()
        part = np.frombuffer(text, np.uint8, end - at, at)
        solid = _SOLID[part]
        edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
        first, length = edges[::2], edges[1::2] - edges[::2]
        if len(first):
            place = np.flatnonzero(solid)
            inside = place - np.repeat(first, length)
            codes = _TABLE[((inside & (TABLE_BYTES - 1)) << 8) | part[place]]
            h = _mixed(np.add.reduceat(codes, np.cumsum(length) - length) + length.astype(np.uint64))
            for i in np.flatnonzero(length > TABLE_BYTES):
                word = text[at + first[i] : at + first[i] + length[i]]
                h[i] = int.from_bytes(hashlib.sha1(word).digest()[:8], "little")
            starts.append(first + at)
            hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct 62-bit hashes of its word shingles (ASCII white space, A-Z lower-cased).

    A text with fewer words than ``width`` is one shingle; one without words has none.
    """

    def made(held: list[bytes]) -> Iterator[np.ndarray]:
        starts, h = _word_hashes(b"\n".join(held).lower())
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in held]))
        acc = np.full(len(h), width, dtype=np.uint64)
        for k in range(width):
            acc = _mixed(acc[: len(h) - k] + h[k:])
        first = 0
        for end in ends.tolist():
            n = end - first
            if n >= width:
                own = acc[first : end - width + 1]
            else:
                own = np.full(min(n, 1), n, dtype=np.uint64)
                for k in range(n):
                    own = _mixed(own + h[first + k])
            own = np.sort((own & _MASK).astype(np.int64))
            yield own[np.append(True, own[1:] != own[:-1])] if n > 1 else own
            first = end

    held, size = [], 0
    for t in texts:
        held.append(t.encode() if t else b"")
        size += len(held[-1])
        if size > STEP_BYTES:
            yield from made(held)
            held, size = [], 0
    if held:
        yield from made(held)


def prefix_length(n: int, percent: int) -> int:
    """Of any set that links to one of size n, one shingle at least is among this many first ones."""
    return n - (percent * n + 99) // 100 + 1


def _column_counts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(s, k): each document's first shingles in plain hash order, and of its other shingles those
    that come again in the same block of documents; to be summed by s."""

    def summed(first: list, others: list) -> pd.DataFrame:
        s, k = np.unique(np.concatenate(first), return_counts=True)
        t, m = np.unique(np.concatenate(others), return_counts=True)
        return pd.DataFrame({"s": np.concatenate([s, t[m > 1]]), "k": np.concatenate([k, m[m > 1]])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, others, held = [], [], 0
        for b in batches:
            for s in shingle_sets(b["text"], width):
                if n := len(s):
                    cut = prefix_length(n, percent)
                    first.append(s[:cut])
                    others.append(s[cut:])
                    held += n
                if held > BLOCK_SHINGLES:
                    yield summed(first, others)
                    first, others, held = [], [], 0
        if held:
            yield summed(first, others)

    return docs.select("text").mapInPandas(lambda batches: released_after(run(batches)), "s long, k long")


def long_columns(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """Sorted shingles in more than LONG_COLUMN documents.

    Exact for shingles that come first in some document by plain hash order; the others are
    found if they repeat inside blocks of neighbouring documents.  Whichever are found, any
    set gives a valid order; it only decides how much is multiplied.
    """
    counts = _column_counts(docs, width, percent).groupBy("s").agg(F.sum("k").alias("count"))
    counts = materialize(counts.filter(F.col("count") > LONG_COLUMN), "columns", TEXT_BATCH_BYTES)
    limit, n = LONG_COLUMN, counts.count()
    while n > LONG_COLUMNS:
        limit *= 2
        n = counts.filter(F.col("count") > limit).count()
    found = counts.filter(F.col("count") > limit).select("s").toArrow()["s"].to_numpy()
    return np.sort(found)


def incidence(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per document: id, n (set size), sig (of the whole set), prefix (its first shingles in
    order), rare (how many of all its shingles are in no long column)."""
    late = docs.sparkSession.sparkContext.broadcast(long_columns(docs, width, percent))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = late.value
        for b in batches:
            sizes, sigs, prefixes, rare = [], [], [], []
            for s in shingle_sets(b["text"], width):
                sizes.append(len(s))
                sigs.append(hashlib.sha256(s.tobytes()).digest())
                late_ones = 0
                if len(s) and len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    is_late = hot[at] == s
                    late_ones = int(is_late.sum())
                    s = np.sort(np.where(is_late, s | _LAST, s))
                rare.append(len(s) - late_ones)
                prefixes.append(s[: prefix_length(len(s), percent)] if len(s) else s)
            yield pd.DataFrame({"id": b["id"], "n": sizes, "sig": sigs, "prefix": prefixes, "rare": rare})

    # as a string: pandas would make floats of the keys beside a null one
    found = docs.withColumn("id", F.col("id").cast("string")).mapInPandas(
        lambda batches: released_after(run(batches)), "id string, n long, sig binary, prefix array<long>, rare long"
    )
    return found.withColumn("id", F.col("id").cast("long"))


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, set) of the documents in ``ids`` (one column, id)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1000):  # a set is larger than its text
                part = b.iloc[at : at + 1000]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "set": list(shingle_sets(part["text"], width))})

    return _among(docs, ids).mapInPandas(lambda batches: released_after(run(batches)), "id long, set array<long>")


def _among(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Semi or anti join on id; the ids are broadcast if a count shows that they are few."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def _needed(percent: int, n: Column, m: Column) -> Column:
    """The least overlap at which sets of n and m link: overlap * (100 + percent) >= percent * (n + m)."""
    return F.ceil((n + m) * percent / (100 + percent) - F.lit(1e-9))


def _checked(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the (a, b) pairs whose full sets link."""
    ids = materialize(pairs.select("a").union(pairs.select("b")).toDF("id").distinct(), "jaccard-ids")
    sets = materialize(full_sets(docs, ids, width), "jaccard-sets", TEXT_BATCH_BYTES)
    left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = pairs.join(left, "a").join(right, "b").withColumn("o", F.size(F.array_intersect("set_a", "set_b")))
    return both.filter(100 * F.col("o") >= percent * (F.size("set_a") + F.size("set_b") - F.col("o"))).select("a", "b")


def _met(rest: DataFrame, percent: int, round_no: int) -> DataFrame:
    """Distinct pairs (idx, idy) of different components that share a column and could link.

    A row outside its column's largest component meets about PARTNERS rows of one
    column of its document, chosen by hash.
    """
    one = rest.filter("comp <> main").select("s", "first", *(F.col(c).alias(f"{c}1") for c in ("id", "n", "pos", "comp")), "all")
    two = rest.select("s", *(F.col(c).alias(f"{c}2") for c in ("id", "n", "pos", "comp")), "all")
    salt, slots = F.lit(round_no), F.greatest(F.lit(1), (F.col("all") / PARTNERS).cast("long"))
    choice = one.groupBy("id1").agg(F.min_by("s", F.xxhash64("s", "id1", salt)).alias("s"))
    one = one.join(choice, ["id1", "s"]).withColumn("slot", F.pmod(F.xxhash64("id1", salt, F.lit("one")), slots))
    two = two.withColumn("slot", F.pmod(F.xxhash64("id2", salt), slots))
    room = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    kept = F.expr("comp1 <> comp2 and id2 <> first and id1 <> first") & (room >= _needed(percent, F.col("n1"), F.col("n2")))
    met = one.drop("all").join(two.drop("all"), ["s", "slot"]).filter(kept)
    return met.select(F.least("id1", "id2").alias("idx"), F.greatest("id1", "id2").alias("idy")).distinct()


def _product(rest: DataFrame, percent: int) -> DataFrame:
    """(idx, idy, overlap) of the pairs of different components that could link, by the overlap counted within their prefixes.

    The product of the prefix matrix with itself, over the open columns: each block of columns (a
    partition of the shuffle by shingle) counts the overlaps of its pairs, and the counts are summed by pair.
    A column counts while what the smaller remainder from it on holds could still reach the overlap that the
    sizes demand; remainders shrink along the prefix, so that of a pair which links its first common columns count.  What
    comes after the last counted one is the most that can be added; pairs that stay below the demand are
    discarded.  Columns whose first row is one of the pair are left out: such a pair is checked already.
    """
    sides = ("id", "n", "pos", "comp")
    one = rest.filter("comp <> main").select("s", "first", *(F.col(c).alias(f"{c}1") for c in sides))
    two = rest.select("s", *(F.col(c).alias(f"{c}2") for c in sides), (F.col("comp") == F.col("main")).alias("main2"))
    needed = _needed(percent, F.col("n1"), F.col("n2"))
    room = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    kept = F.expr("comp1 <> comp2 and (main2 or id1 < id2) and id1 <> first and id2 <> first") & (room >= needed)
    met = one.join(two, "s").filter(kept).select(
        F.least("id1", "id2").alias("idx"), F.greatest("id1", "id2").alias("idy"), needed.alias("needed"), (room - 1).alias("after")
    )
    counted = met.groupBy("idx", "idy", "needed").agg(F.count("*").alias("overlap"), F.min("after").alias("after"))
    return counted.filter("overlap + after >= needed").select("idx", "idy", "overlap")


def jaccard_components(
    docs: DataFrame, width: int, percent: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles (size of its set), component_id.

    Two documents link when their distinct word shingles overlap by ``percent`` of their union;
    component_id is the smallest key that links reach, the own one included.  A text
    with fewer than ``width`` words is one shingle; null and empty texts have none and link
    with nothing.  Rows with a null key link with nothing and have a null component_id;
    rows that share a key are one document in the links.  An empty table gives no rows.

    Works in blocks of the shuffle by shingle; each text is read three times, and no text
    is shuffled as long as the ids of the candidates fit a checked broadcast.
    """
    given = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = materialize(incidence(given, width, percent), "incidence", TEXT_BATCH_BYTES)
    usable = rows.filter("id is not null and n > 0")
    classes = usable.groupBy("sig").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).filter("copies > 1")
    # written first: its size is known then, so the join is a broadcast, or one whose large classes may be split
    members = usable.select("id", "sig").join(materialize(classes, "jaccard-classes"), "sig").filter("id <> rep")
    members = materialize(members.select("id", "sig", "rep").distinct(), "jaccard-copies")
    gone = members.select("id", "sig")
    single = usable.join(F.broadcast(gone) if gone.count() <= BROADCAST_COPIES else gone, ["id", "sig"], "left_anti")
    # equal rows that share their key too: hardly any, so that the other rows need not meet for them
    twice = materialize(usable.groupBy("id", "sig").agg(F.count("*").alias("k")).filter("k > 1").select("id", "sig"), "jaccard-rows")
    if not twice.isEmpty():
        once = single.join(twice, ["id", "sig"], "left_semi").dropDuplicates(["id", "sig"])
        single = single.join(twice, ["id", "sig"], "left_anti").unionByName(once)

    matrix = single.select(
        "id", "n", "rare", F.size("prefix").alias("p"), F.element_at("prefix", -1).alias("last"), F.posexplode("prefix").alias("pos", "s")
    )
    # min_by keeps to two numbers, which a hash aggregate can hold; written, so that ties fall once
    columns = matrix.groupBy("s").agg(F.count("*").alias("c"), F.min_by("id", "rare").alias("first")).filter("c > 1")
    shared = materialize(matrix.drop("rare").join(materialize(columns, "jaccard-shingles"), "s"), "jaccard-shared")

    # What a document can share within its prefix is at most its number of shared columns.
    facts = materialize(shared.groupBy("id", "n", "p", "last").agg(F.count("*").alias("m")), "jaccard-facts")
    x, y = (facts.select([F.col(c).alias(f"{c}{k}") for c in facts.columns]) for k in "xy")

    def links_of(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (idx, idy), those that link; sizes and shared columns discard most at once."""
        rest = F.when(F.col("lastx") <= F.col("lasty"), F.col("nx") - F.col("px")).otherwise(F.col("ny") - F.col("py"))
        bound = F.least(F.least("mx", "my") + rest, "nx", "ny")
        left = pairs.join(x, "idx").join(y, "idy").filter(bound >= _needed(percent, F.col("nx"), F.col("ny")))
        left = materialize(left.selectExpr("idx as a", "idy as b"), "jaccard-pairs")
        return materialize(_checked(left, given, width, percent), "jaccard-links") if not left.isEmpty() else left

    links = links_of(shared.filter("id <> first").select(F.col("first").alias("idx"), F.col("id").alias("idy")).distinct())
    found = connected_components(links)
    n_shared, round_no, before = shared.count(), 0, None
    while True:
        # Columns that still join several components.
        rows_now = shared.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("root", "id"))
        rows_now = rows_now.filter("id <> first or c > 2").drop("root", "p", "last")
        parts = rows_now.groupBy("s", "comp").agg(F.count("*").alias("k"))
        largest = parts.groupBy("s").agg(F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("comps"), F.sum("k").alias("all"))
        open_columns = largest.filter("comps > 1").select("s", F.col("top.comp").alias("main"), "all")
        rest = materialize(rows_now.join(open_columns, "s"), "jaccard-open")
        cost = rest.filter("comp <> main").agg(F.sum("all")).first()[0] or 0
        last = cost <= PAIRS_PER_ROW * n_shared or (before is not None and cost > 0.8 * before)
        links = links_of(_product(rest, percent)) if last else links_of(_met(rest, percent, round_no))
        found = connected_components(found.toDF("a", "b").union(links))
        if last:
            break
        round_no, before = round_no + 1, cost
    edges = found.toDF("a", "b").union(members.select("id", "rep"))
    whole = connected_components(edges).withColumnRenamed("node", "id")
    out = rows.select("id", "n").join(whole, "id", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))
