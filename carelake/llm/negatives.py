"""Hard-negative mining: exact integer products of anchor and candidate tiles by Strassen's recursion.

Vectors become integers.  Anchors come in blocks of bounded size; each block meets all rows, tile
by tile.  A tile's products are made in int64 by seven recursive products of half the size, odd sizes
padded with zeros; sums and products wrap alike, so the result is exact wherever it fits 64 bits.
From a tile's scores each anchor keeps its first positives, and in a second pass
the first negatives inside the window that each of its positives opens.  Both are short sorted lists
that merge in any order, so nothing else leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Numbers of an anchor block (64 MB on the driver and in each worker), of a tile of scores (16 MB) and of a tile's rows.
ANCHOR_NUMBERS = 8 << 20
TILE_SCORES = 2 << 20
TILE_ROWS = 4_096
#: Sides at which the recursion ends in a plain product.
LEAF = 32

_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two int64 matrices (modulo 2^64) by seven products of halves, padded with zeros to even sides."""
    n, d = a.shape
    m = b.shape[1]
    if min(n, d, m) <= LEAF:
        return a @ b
    if n % 2 or d % 2 or m % 2:
        a = np.pad(a, ((0, n % 2), (0, d % 2)))
        b = np.pad(b, ((0, d % 2), (0, m % 2)))
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k] = p1 + p4 - p5 + p7
    out[:i, k:] = p3 + p5
    out[i:, :k] = p2 + p4
    out[i:, k:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def integer_vectors(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(row, id, label, v) of the rows that take part, v as little-endian int64 (see ``mine_negatives``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column("x"):
                v = None if x.values is None else x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if v is None or not np.isfinite(v).all():
                    out.append(None)
                    continue
                v = np.floor(256.0 * v)
                out.append(v.astype("<i8").tobytes() if float(v @ v) < 2.0**62 else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(out, pa.binary())], names=["id", "label", "v"])

    given = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    made = given.filter("label is not null and x is not null").mapInArrow(run, "id long, label long, v binary")
    return made.filter("v is not null").select(F.monotonically_increasing_id().alias("row"), "*")


def _matrix(cells: list[bytes], width: int) -> np.ndarray:
    """Rows of ``width`` numbers; shorter vectors end in zeros, longer ones are cut (zeros meet what is cut)."""
    if all(len(c) == 8 * width for c in cells):
        return np.frombuffer(b"".join(cells), "<i8").reshape(len(cells), width)
    return np.frombuffer(b"".join(c[: 8 * width].ljust(8 * width, b"\0") for c in cells), "<i8").reshape(len(cells), width)


def _tiles(batches: Iterator[pa.RecordBatch], anchors: dict) -> Iterator[tuple]:
    """(first anchor, scores, rows, ids, labels) of every tile; a tile's rows ascend by id (null ones last)."""
    height = max(1, TILE_SCORES // TILE_ROWS)
    for b in batches:
        for start in range(0, b.num_rows, TILE_ROWS):
            part = b.slice(start, TILE_ROWS)
            nulls = np.asarray(part.column("id").is_null())
            ids = part.column("id").fill_null(0).to_numpy()
            rows, labels = part.column("row").to_numpy(), part.column("label").to_numpy()
            order = np.lexsort((rows, ids, nulls))
            rest = np.ascontiguousarray(_matrix(part.column("v").to_pylist(), anchors["v"].shape[1])[order].T)
            for a in range(0, len(anchors["row"]), height):
                scores = strassen(anchors["v"][a : a + height], rest)
                yield a, scores, rows[order], np.where(nulls, 0, ids)[order], nulls[order], labels[order]


def _first(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lines, columns) of each line's k highest allowed scores, best first; of equal ones the first column."""
    left = np.where(allowed, scores, _NONE)
    lines = np.arange(len(left))
    for _ in range(min(k, left.shape[1])):
        best = left.argmax(axis=1)
        some = left[lines, best] != _NONE
        if not some.any():
            return
        yield lines[some], best[some]
        left[lines, best] = _NONE


_PAIR = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_PAIR_DDL = "anchor long, window long, row long, id long, score long"


def _pairs(anchor, window, row, ids, nulls, score) -> pa.RecordBatch:
    joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (anchor, window, row, ids, score)]
    null = np.concatenate(nulls) if nulls else np.empty(0, bool)
    arrays = [pa.array(x, pa.int64(), mask=null if i == 3 else None) for i, x in enumerate(joined)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PAIR)


def _heaps(stored: DataFrame, block, k: int, windows: bool) -> DataFrame:
    """Of every run of tiles the first k positives of each anchor, or negatives of each of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        out = tuple([] for _ in range(6))
        size = 0
        for a, scores, rows, ids, nulls, labels in _tiles(batches, anchors):
            part = slice(a, a + len(scores))
            same = anchors["label"][part][:, None] == labels[None, :]
            if windows:
                tasks = []
                for w in range(anchors["low"].shape[1]):
                    low, high = anchors["low"][part, w], anchors["high"][part, w]
                    tasks.append((anchors["open"][part, w], ~same & (scores >= low[:, None]) & (scores <= high[:, None])))
            else:
                tasks = [(np.zeros(len(scores), np.int64), same & (anchors["row"][part][:, None] != rows[None, :]))]
            for names, allowed in tasks:
                for lines, columns in _first(scores, allowed, k):
                    for to, values in zip(out, (anchors["row"][part][lines], names[lines], rows[columns], ids[columns], nulls[columns], scores[lines, columns])):
                        to.append(values)
                    size += len(lines)
            if size > 1_000_000:
                yield _pairs(*out)
                out, size = tuple([] for _ in range(6)), 0
        yield _pairs(*out)

    return stored.mapInArrow(run, _PAIR_DDL)


def _merged(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose key is divisible by ``every``.  A score is the inner product of the vectors'
    integers floor(256 x).  An anchor's positives are its first ``positives`` other rows of the same
    label, by score descending, then key; its negatives for a positive the first ``negatives`` rows
    of other labels with ``low`` * positive <= 100 * negative <= ``high`` * positive.  Rows with a null label or vector,
    a null or non-finite component, or integers whose squares sum to 2^62 or more (their scores
    need not fit 64 bits) take no part.  Vectors of unequal length are compared as if zeros
    followed the shorter one.  Rows that share a key are rows of their own, and anchors of their own;
    null keys are no anchors and come last of equal scores.  Empty tables give no rows.

    Anchors are read in blocks of ANCHOR_NUMBERS numbers, each block with two passes over all rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    stored = materialize(integer_vectors(vectors, key, vector, label), "vectors")
    anchors = stored.filter(F.col("id") % every == 0)
    n, numbers = anchors.agg(F.count("*"), F.coalesce(F.max(F.octet_length("v")), F.lit(0)) / 8 + 2 * positives + 4).first()
    blocks = -(-n * int(numbers) // ANCHOR_NUMBERS)
    results = []
    for turn in range(blocks):
        own = anchors.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == turn).toArrow().sort_by("row")
        if not own.num_rows:
            continue
        cells = own["v"].to_pylist()
        held = {"row": own["row"].to_numpy(), "label": own["label"].to_numpy(), "v": _matrix(cells, max(1, max(map(len, cells)) // 8))}
        near = materialize(_merged(_heaps(stored, spark.sparkContext.broadcast(held), positives, False), positives), "positives")
        got = near.select("anchor", "score").distinct().toArrow()
        at = np.searchsorted(held["row"], got["anchor"].to_numpy())
        score = got["score"].to_numpy()
        # windows of each anchor side by side, one for each distinct positive score; the rest stay empty
        order = np.argsort(at, kind="stable")
        at, score = at[order], score[order]
        slot = np.arange(len(at)) - np.searchsorted(at, at)
        shape = (len(held["row"]), int(slot.max(initial=0)) + 1)
        floor, ceiling, opened = np.ones(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        floor[at, slot] = [-(-low * int(s) // 100) for s in score]
        ceiling[at, slot] = [high * int(s) // 100 for s in score]
        opened[at, slot] = score
        held |= {"low": floor, "high": ceiling, "open": opened}
        far = _merged(_heaps(stored, spark.sparkContext.broadcast(held), negatives, True), negatives)
        far = far.select("anchor", F.col("window").alias("score"), "place", F.col("id").alias("far"), F.col("score").alias("far_score"))
        results.append(near.select("anchor", "id", "score").join(far, ["anchor", "score"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("own")), "anchor"))
    names = {"anchor_id": "own", "positive_id": "id", "rank": "place", "negative_id": "far", "positive_score": "score", "negative_score": "far_score"}
    ids = ("anchor_id", "positive_id", "negative_id")
    if not results:
        return spark.createDataFrame([], ", ".join(f"{c} {kind if c in ids else 'int' if c == 'rank' else 'long'}" for c in names))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found.select(*[F.col(f).cast(kind if c in ids else "int" if c == "rank" else "long").alias(c) for c, f in names.items()])
