"""Random forests over binned rows: the learner and the scorer behind ``operators.ml``.

Same method as Spark ML's forest (thresholds, bootstrap weights, features per node, Gini gain, stopping rules, merged
leaves, votes), same parameters, and the result is a ``RandomForestClassificationModel``.  What differs is the inner
loop: a row is a few bytes of bin numbers, and a task takes the rows of a block through a tree as arrays, a level a pass.
Each pass counts the weight of every (node, feature, bin, label) in every task, adds the counts up by tree and sends the
best split of each node to the driver; no task holds more than its blocks and the counts of one piece of one tree.

Learned here: labels 0 and 1, numeric and two-valued features, ``TAKEN`` parameters; ``ml`` leaves all else to Spark.
"""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tasks get this module's functions by value: executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Parameters that the learner takes as Spark does; with any other one set, Spark's own learner fits.
TAKEN = {
    "featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol", "seed", "maxDepth", "numTrees", "maxBins",
    "featureSubsetStrategy", "bootstrap", "subsamplingRate", "minInstancesPerNode", "minInfoGain",
}
_OF_THE_FOREST = {"numTrees", "featureSubsetStrategy", "bootstrap", "subsamplingRate"}
N_CLASSES = 2
MOST_BINS, MOST_FEATURES = 256, 1024
# Rows and bytes of a block, bytes of a task's blocks, cells of a piece (nodes of one tree that are counted together).
MOST_BLOCK_ROWS, MOST_BLOCK_BYTES = 65_536, 4 << 20
MOST_TASK_BYTES, MOST_CELLS = 32 << 20, 4 << 20
_BATCH_BYTES = 8 << 20
_NO_SPLIT = 255
_EPSILON = float(np.finfo(float).eps)


def features_per_node(strategy: str, n_features: int, n_trees: int) -> int | None:
    """Features drawn for a node by the named strategies; None for one that is not named."""
    strategy = strategy.lower()
    if strategy == "auto":
        strategy = "all" if n_trees == 1 else "sqrt"
    named = {
        "all": n_features,
        "sqrt": math.ceil(math.sqrt(n_features)),
        "log2": max(1, math.ceil(math.log2(n_features))),
        "onethird": math.ceil(n_features / 3),
    }
    return named.get(strategy)


def two_valued_features(df: DataFrame, feature_col: str) -> set[int] | None:
    """Slots that the vector's metadata declares as 0/1; None if it declares categories of more values."""
    attrs = df.schema[feature_col].metadata.get("ml_attr", {}).get("attrs", {})
    return None if attrs.get("nominal") else {a["idx"] for a in attrs.get("binary", [])}


def number_of_features(df: DataFrame, feature_col: str) -> int:
    """Slots of the vector column by its metadata, else those of a row (0 if there is none)."""
    declared = df.schema[feature_col].metadata.get("ml_attr", {}).get("num_attrs")
    if declared is None:
        row = df.select(feature_col).first()
        declared = row[0].size if row is not None and row[0] is not None else 0
    return declared


def can_learn(clf, n_features: int, two_valued: set[int] | None) -> bool:
    return (
        {p.name for p in clf._paramMap} <= TAKEN
        and clf.getImpurity() == "gini"
        and two_valued is not None
        and 1 <= n_features <= MOST_FEATURES
        and 2 <= clf.getMaxBins() <= MOST_BINS
        and features_per_node(clf.getFeatureSubsetStrategy(), n_features, clf.getNumTrees()) is not None
        and (clf.getBootstrap() or clf.getSubsamplingRate() == 1.0)
    )


# --------------------------------------------------------------------------
# Thresholds and blocks
# --------------------------------------------------------------------------


def thresholds_of(values: np.ndarray, expected: float, n_splits: int) -> np.ndarray:
    """Thresholds of a numeric feature as Spark ML sets them: all midpoints if they are few, else about equal strides.

    ``expected`` is the number of sampled rows that was to be expected; those missing from ``values`` count as zeros.
    """
    found, counts = np.unique(values[values != 0.0], return_counts=True)
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > _EPSILON * len(values) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, zeros)
    between = (found[:-1] + found[1:]) / 2.0
    if len(between) <= n_splits:
        return between
    stride, chosen, before, target = expected / (n_splits + 1), [], counts[0], expected / (n_splits + 1)
    for i in range(1, len(found)):
        now = before + counts[i]
        if abs(before - target) < abs(now - target):
            chosen.append(i - 1)
            target += stride
        before = now
    return between[chosen]


def _matrix(column: pa.Array, n_features: int) -> np.ndarray:
    flat = column.flatten()
    if column.null_count or flat.null_count or len(flat) != len(column) * n_features:
        raise ValueError(f"a feature vector is null or has not {n_features} slots")
    return flat.to_numpy().reshape(-1, n_features)


def _block_maker(thresholds: list[np.ndarray | None], block_rows: int) -> Callable:
    """Arrow function: rows (features, label) to blocks (id, bins, labels); a feature without thresholds is 0/1."""

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column(0), len(thresholds))
        out = np.empty((len(x), len(thresholds) + 1), np.uint8)
        for j, cuts in enumerate(thresholds):
            if cuts is None and not np.isin(x[:, j], (0.0, 1.0)).all():
                raise ValueError(f"feature {j} is declared as two-valued and has other values than 0 and 1")
            out[:, j] = x[:, j] if cuts is None else np.searchsorted(cuts, x[:, j], side="left")
        out[:, -1] = batch.column(1).to_numpy()
        return out

    def block(number: int, rows: np.ndarray) -> pa.RecordBatch:
        parts = [rows[:, :-1].tobytes()], [rows[:, -1].tobytes()]
        number += TaskContext.get().partitionId() << 32
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array(p, pa.binary()) for p in parts]], ["id", "bins", "labels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = 0, np.empty((0, len(thresholds) + 1), np.uint8)
        for batch in batches:
            held = np.concatenate([held, binned(batch)])
            while len(held) >= block_rows:
                yield block(made, held[:block_rows])
                made, held = made + 1, held[block_rows:]
        if len(held):
            yield block(made, held)

    return run


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of jobs run inside are closed at ``_BATCH_BYTES``: records here are blocks and arrays of counts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(_BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


# --------------------------------------------------------------------------
# Growing
# --------------------------------------------------------------------------


class _Tree:
    """A growing tree as arrays over its nodes.  ``low`` is the child of bins up to ``bin``, the other follows it; a leaf is
    its own child.  ``flipped``: the low child is the right one."""

    def __init__(self):
        self.feature, self.bin, self.low = np.zeros(1, np.int32), np.full(1, _NO_SPLIT, np.uint8), np.zeros(1, np.int32)
        self.flipped, self.gain, self.stats = np.zeros(1, bool), np.full(1, -1.0), np.zeros((1, N_CLASSES))
        self.active = np.zeros(1, np.int32)

    def grow(self, found: np.ndarray, last: bool) -> None:
        """Split the active nodes as ``found`` (a record each); their children are active unless pure or at the last depth."""
        self.stats[self.active] = found["total"]
        split = found["gain"] > 0
        parents, found = self.active[split], found[split]
        n, k = len(self.feature), len(parents)
        self.feature[parents], self.bin[parents], self.flipped[parents] = found["feature"], found["bin"], found["flipped"]
        self.low[parents], self.gain[parents] = n + 2 * np.arange(k), found["gain"]
        stats = np.stack([found["low"], found["total"] - found["low"]], axis=1).reshape(-1, N_CLASSES)
        self.feature = np.append(self.feature, np.zeros(2 * k, np.int32))
        self.bin = np.append(self.bin, np.full(2 * k, _NO_SPLIT, np.uint8))
        self.low = np.append(self.low, np.arange(n, n + 2 * k, dtype=np.int32))
        self.flipped = np.append(self.flipped, np.zeros(2 * k, bool))
        self.gain = np.append(self.gain, np.full(2 * k, -1.0))
        self.stats = np.append(self.stats, stats, axis=0)
        mixed = gini(stats) >= _EPSILON
        self.active = np.empty(0, np.int32) if last else (n + np.flatnonzero(mixed)).astype(np.int32)


class _Piece:
    """Active nodes of one tree that are counted together: features drawn for each, and where their cells begin."""

    def __init__(self, tree: int, number: int, grown: _Tree, nodes: np.ndarray, subsets: np.ndarray, n_bins: np.ndarray):
        self.tree, self.number = tree, number
        self.feature, self.bin, self.low = grown.feature, grown.bin, grown.low
        self.slots = np.full(len(grown.feature), -1, np.int32)
        self.slots[nodes] = np.arange(len(nodes))
        self.subsets = np.ascontiguousarray(subsets.T.astype(np.int32))  # drawn feature x node
        widths = n_bins[subsets] * N_CLASSES
        ends = widths.ravel().cumsum()
        self.n_cells = int(ends[-1])
        self.starts = np.ascontiguousarray((ends - widths.ravel()).reshape(subsets.shape).T.astype(np.int32))


def gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1)
    out = np.ones(total.shape)
    for k in range(counts.shape[-1]):
        share = np.divide(counts[..., k], total, out=np.zeros(total.shape), where=total > 0)
        out -= share * share
    return np.where(total > 0, out, 0.0)


def poisson_cuts(rate: float) -> np.ndarray:
    """Cumulated Poisson probabilities on the scale of 32-bit numbers."""
    out, term, total, k = [], math.exp(-rate), 0.0, 0
    while (total := total + term) < 1 - 2**-33 and k < 255:
        out.append(min(int(total * 2**32), 2**32 - 1))
        k += 1
        term *= rate / k
    return np.array(out, np.uint32)


def bootstrap_weights(seed: int, tree: int, block: int, n: int, cuts: np.ndarray | None) -> np.ndarray:
    """How often each row of a block is in a tree's sample: the same in every pass, independent of where the block is."""
    weights = np.zeros(n, np.uint8)
    if cuts is None:
        return weights + np.uint8(1)
    drawn = np.random.Generator(np.random.SFC64([seed, tree, block])).integers(0, 2**32, n, dtype=np.uint32)
    for cut in cuts:
        weights += drawn >= cut
    return weights


def _cell_counter(pieces: list[_Piece], depth: int, n_features: int, seed: int, cuts: np.ndarray | None) -> Callable:
    """Arrow function: blocks to the weights of each piece's cells (node, drawn feature, bin, label)."""

    def add(cells: np.ndarray, piece: _Piece, block: int, bins: np.ndarray, labels: np.ndarray) -> None:
        weights = bootstrap_weights(seed, piece.tree, block, len(labels), cuts)
        rows = np.flatnonzero(weights).astype(np.int32)
        at, node = rows * np.int32(n_features), np.zeros(len(rows), np.int32)
        for _ in range(depth):
            node = piece.low.take(node) + (bins.take(at + piece.feature.take(node)) > piece.bin.take(node))
        slot = piece.slots.take(node)
        if (slot < 0).any():
            kept = np.flatnonzero(slot >= 0)
            rows, at, slot = rows.take(kept), at.take(kept), slot.take(kept)
        label, weight = labels.take(rows), weights.take(rows).astype(np.uint32)
        for features, starts in zip(piece.subsets, piece.starts, strict=True):
            b = bins.take(at + features.take(slot)).astype(np.int32)
            np.add.at(cells, starts.take(slot) + b * np.int32(N_CLASSES) + label, weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for number, bins, labels in zip(*batch.columns, strict=True):
                blocks.append((number.as_py(), *[np.frombuffer(x.as_buffer(), np.uint8) for x in (bins, labels)]))
        for piece in pieces if blocks else []:
            cells = np.zeros(piece.n_cells, np.uint32)
            for block in blocks:
                add(cells, piece, *block)
            if cells.max(initial=0) < 2**16:
                cells = cells.astype(np.uint16)
            columns = pa.array([piece.tree], pa.int32()), pa.array([piece.number], pa.int32()), pa.array([cells.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns], ["tree", "piece", "cells"])

    return run


_FOUND = np.dtype([
    ("feature", "i4"), ("bin", "u1"), ("flipped", "?"), ("gain", "f8"), ("low", "f8", (N_CLASSES,)), ("total", "f8", (N_CLASSES,)),
])


def best_splits(cells: np.ndarray, piece: _Piece, n_bins: np.ndarray, two_valued: np.ndarray, least_rows: int, least_gain: float) -> np.ndarray:
    """The best split of each node of a piece, a ``_FOUND`` record each; ``gain`` is -inf where none is allowed.

    The category with fewer rows of label 1 is the left one, of equal gains the first counts (as in Spark).
    """
    cells, width = cells.reshape(-1, N_CLASSES), int(n_bins.max())
    n_drawn, n_nodes = piece.subsets.shape
    found, step = np.zeros(n_nodes, _FOUND), max(1, MOST_CELLS // 4 // (n_drawn * width * N_CLASSES))
    for i in range(0, n_nodes, step):
        some = slice(i, min(i + step, n_nodes))
        drawn, starts = piece.subsets[:, some].T, piece.starts[:, some].T // N_CLASSES
        there = np.arange(width) < n_bins[drawn][..., None]
        counts = np.where(there[..., None], cells[np.where(there, starts[..., None] + np.arange(width), 0)], 0).astype(float)
        low = counts.cumsum(axis=2)
        total = low[:, :1, -1:, :]
        high = total - low
        n_low, n_high = low.sum(axis=-1), high.sum(axis=-1)
        flipped = two_valued[drawn][..., None] & (low[..., 1] > high[..., 1])
        weighted = [n / np.maximum(total.sum(axis=-1), 1) * gini(x) for x, n in ((low, n_low), (high, n_high))]
        left, right = np.where(flipped, weighted[1], weighted[0]), np.where(flipped, weighted[0], weighted[1])
        gain = gini(total) - left - right
        allowed = (np.arange(width) < n_bins[drawn][..., None] - 1) & (n_low >= least_rows) & (n_high >= least_rows) & (gain >= least_gain)
        gain = np.where(allowed, gain, -np.inf).reshape(len(gain), -1)
        best, nodes = gain.argmax(axis=1), np.arange(len(gain))
        j, b = np.divmod(best, width)
        out = found[some]
        out["feature"], out["bin"], out["flipped"] = drawn[nodes, j], b, flipped[nodes, j, b]
        out["gain"], out["low"], out["total"] = gain[nodes, best], low[nodes, j, b], total[:, 0, 0]
    return found


def _split_finder(pieces: list[_Piece], *rules) -> Callable:
    """Arrow function: the tasks' cells, all those of a piece in one partition, to the best splits of its nodes."""
    by_key = {(p.tree, p.number): p for p in pieces}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, number, part in zip(*batch.columns, strict=True):
                key, raw = (tree.as_py(), number.as_py()), part.as_buffer()
                size = by_key[key].n_cells
                cells = np.frombuffer(raw, np.uint16 if raw.size == 2 * size else np.uint32)
                sums[key] = sums[key] + cells if key in sums else cells.astype(np.int64)
        for key, cells in sums.items():
            found = best_splits(cells, by_key[key], *rules).tobytes()
            columns = pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([found], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns], ["tree", "piece", "found"])

    return run


def learn(clf, df: DataFrame, rows: int, n_features: int, two_valued: set[int], cores: int, least_task_rows: int):
    """The forest that ``clf`` describes, fitted on all ``rows`` of ``df`` (features and a label of 0 or 1)."""
    from pyspark.ml.functions import vector_to_array

    from carelake.session import scratch_path

    spark, seed = df.sparkSession, clf.getSeed() % 2**64
    n_trees, max_depth = clf.getNumTrees(), clf.getMaxDepth()
    data = df.select(vector_to_array(clf.getFeaturesCol()).alias("features"), clf.getLabelCol())
    n_bins = min(clf.getMaxBins(), rows)
    # Spark's learner sets its thresholds on a sample of this size
    share = min(1.0, max(clf.getMaxBins() ** 2, 10_000) / rows)
    seen = (data if share == 1.0 else data.sample(share, seed % 2**31)).select("features").toArrow()
    x = _matrix(seen.column(0).combine_chunks(), n_features) if seen.num_rows else np.empty((0, n_features))
    thresholds = [None if j in two_valued else thresholds_of(x[:, j], share * rows, n_bins - 1) for j in range(n_features)]
    bins = np.array([2 if t is None else len(t) + 1 for t in thresholds])

    n_tasks = -(-rows // least_task_rows) if rows < least_task_rows * cores else cores * -(-rows * (n_features + 1) // (MOST_TASK_BYTES * cores))
    block_rows = max(1, min(MOST_BLOCK_ROWS, MOST_BLOCK_BYTES // n_features, -(-rows // (8 * n_tasks))))
    path = scratch_path(spark, "forest-rows")
    data.mapInArrow(_block_maker(thresholds, block_rows), "id bigint, bins binary, labels binary").write.parquet(path)

    drawn = features_per_node(clf.getFeatureSubsetStrategy(), n_features, n_trees)
    cuts = poisson_cuts(clf.getSubsamplingRate()) if clf.getBootstrap() else None
    rules = bins, np.array([t is None for t in thresholds]), clf.getMinInstancesPerNode(), clf.getMinInfoGain()
    most_nodes = max(1, MOST_CELLS // (drawn * int(bins.max()) * N_CLASSES))
    trees = [_Tree() for _ in range(n_trees)]
    # the blocks in the files stay as they are, whatever becomes of the cached ones
    blocks = spark.read.parquet(path).repartition(n_tasks).persist()
    try:
        with _small_batches(spark):
            for depth in range(max(1, max_depth)):
                pieces = [p for t, tree in enumerate(trees) for p in _pieces(t, tree, depth, most_nodes, n_features, drawn, bins, seed)]
                if not pieces:
                    break
                counted = blocks.mapInArrow(_cell_counter(pieces, depth, n_features, seed, cuts), "tree int, piece int, cells binary")
                added = counted.repartition(min(len(pieces), 2 * cores), "tree", "piece")
                found = added.mapInArrow(_split_finder(pieces, *rules), "tree int, piece int, found binary").collect()
                by_tree: dict[int, list] = {}
                for r in sorted(found, key=lambda r: (r.tree, r.piece)):
                    by_tree.setdefault(r.tree, []).append(np.frombuffer(r.found, _FOUND))
                for t, tree in enumerate(trees):
                    nothing = np.zeros(0, _FOUND)
                    records = np.concatenate([nothing, *by_tree.get(t, [])])
                    if max_depth == 0:
                        records["gain"] = -np.inf
                    tree.grow(records, depth + 1 >= max_depth)
    finally:
        blocks.unpersist()
    return _as_model(clf, trees, thresholds, spark)


def _pieces(t: int, tree: _Tree, depth: int, most_nodes: int, n_features: int, drawn: int, bins: np.ndarray, seed: int) -> Iterator[_Piece]:
    for number, i in enumerate(range(0, len(tree.active), most_nodes)):
        nodes = tree.active[i : i + most_nodes]
        subsets = np.tile(np.arange(n_features), (len(nodes), 1))
        if drawn < n_features:
            subsets = np.random.default_rng([seed, t, depth, number]).permuted(subsets, axis=1)[:, :drawn]
        yield _Piece(t, number, tree, nodes, subsets, bins)


# --------------------------------------------------------------------------
# The Spark ML model
# --------------------------------------------------------------------------


def _nodes_of(tree: _Tree, thresholds: list[np.ndarray | None]) -> list[tuple]:
    """Node records in Spark ML's saved form, numbered from the root, left before right; leaves of one inner node that
    predict the same are merged."""
    low, flipped, inner = tree.low.tolist(), tree.flipped.tolist(), (tree.bin != _NO_SPLIT).tolist()
    predicted, size = tree.stats.argmax(axis=1).tolist(), [1] * len(low)
    for i in reversed(range(len(low))):
        if inner[i]:
            a, b = low[i], low[i] + 1
            if not inner[a] and not inner[b] and predicted[a] == predicted[b]:
                inner[i], predicted[i] = False, predicted[a]
            else:
                size[i] = 1 + size[a] + size[b]
    impurity, stats, gain = gini(tree.stats).tolist(), tree.stats.tolist(), tree.gain.tolist()
    out, waiting = [], [(0, 0)]
    while waiting:
        i, number = waiting.pop()
        left = right = -1
        split = -1, [], -1
        if inner[i]:
            left_node, right_node = (low[i] + 1, low[i]) if flipped[i] else (low[i], low[i] + 1)
            left, right = number + 1, number + 1 + size[left_node]
            waiting += [(right_node, right), (left_node, left)]
            f = int(tree.feature[i])
            split = (f, [1.0 if flipped[i] else 0.0], 2) if thresholds[f] is None else (f, [float(thresholds[f][tree.bin[i]])], -1)
        out.append((number, float(predicted[i]), impurity[i], stats[i], int(sum(stats[i])), gain[i] if inner[i] else -1.0, left, right, split))
    return out


_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT),
])


def _as_model(clf, trees: list[_Tree], thresholds: list[np.ndarray | None], spark: SparkSession):
    """The grown trees as Spark's own model, by way of its saved form."""
    from pyspark.ml.classification import RandomForestClassificationModel

    from carelake.session import scratch_path

    path = scratch_path(spark, "forest")

    def described(of: str, uid: str, without: set[str], **more) -> str:
        params = [{p.name: v for p, v in m.items() if p.name not in without} for m in (clf._paramMap, clf._defaultParamMap)]
        head = {"class": f"org.apache.spark.ml.classification.{of}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        return json.dumps({**head, "uid": uid, "paramMap": params[0], "defaultParamMap": params[1], **more})

    whole = described("RandomForestClassificationModel", clf.uid, set(), numFeatures=len(thresholds), numClasses=N_CLASSES, numTrees=len(trees))
    each = [
        (t, described("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", _OF_THE_FOREST, numFeatures=len(thresholds), numClasses=N_CLASSES), 1.0)
        for t in range(len(trees))
    ]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [pa.array(_nodes_of(tree, thresholds), _NODE) for tree in trees]
    tree_ids = np.repeat(np.arange(len(trees), dtype=np.int32), [len(n) for n in nodes])
    spark.createDataFrame(pa.table({"treeID": tree_ids, "nodeData": pa.chunked_array(nodes)})).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


# --------------------------------------------------------------------------
# Scoring
# --------------------------------------------------------------------------


class _Scorer:
    """A fitted forest as arrays over the nodes of all trees, read from its saved form."""

    def __init__(self, saved: pa.Table, n_features: int):
        column = lambda name: saved.column(name).combine_chunks()
        tree, node, left = (column(c).to_numpy() for c in ("tree", "id", "leftChild"))
        order = np.lexsort((node, tree))
        first = np.flatnonzero(np.diff(tree[order], prepend=-1))
        sizes = np.diff(np.append(first, len(order)))
        base = np.repeat(first, sizes)
        self.n_features, self.roots = n_features, first.astype(np.int32)
        inner = left[order] >= 0
        self.feature = np.where(inner, column("feature").to_numpy()[order], n_features).astype(np.int32)
        categories = column("categories").to_numpy()[order]
        value = column("value").to_numpy(zero_copy_only=False)[order]
        # a two-valued split sends its left category left: as a threshold of 0.5, with the children swapped if that is 1
        swapped = inner & (categories == 2) & (value == 1.0)
        self.at_most = np.where(categories == 2, 0.5, value)
        self.at_most[~inner] = 0.0
        children = [np.where(inner, base + column(c).to_numpy()[order], np.arange(len(order))) for c in ("leftChild", "rightChild")]
        self.low = np.where(swapped, children[1], children[0]).astype(np.int32)
        self.high = np.where(swapped, children[0], children[1]).astype(np.int32)
        stats = column("stats").flatten().to_numpy().reshape(len(order), -1)[order]
        total = stats.sum(axis=1, keepdims=True)
        self.shares = np.divide(stats, total, out=np.zeros(stats.shape), where=total != 0).T.copy()
        self.steps = [self._depth(i, i + n) for i, n in zip(first, sizes, strict=True)]

    def _depth(self, begin: int, end: int) -> int:
        nodes, depth = np.array([begin]), 0
        while len(nodes := nodes[self.feature[nodes] < self.n_features]):
            nodes, depth = np.concatenate([self.low[nodes], self.high[nodes]]), depth + 1
        return depth

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Votes by class and row, added up in the order of the trees as Spark does."""
        x = np.concatenate([x, np.zeros((len(x), 1))], axis=1).ravel()  # a leaf looks at the last slot
        rows = np.arange(0, len(x), self.n_features + 1, dtype=np.int32)
        votes = np.zeros((len(self.shares), len(rows)))
        for root, steps in zip(self.roots, self.steps, strict=True):
            node = np.full(len(rows), root, np.int32)
            for _ in range(steps):
                goes_low = x.take(rows + self.feature.take(node)) <= self.at_most.take(node)
                node = np.where(goes_low, self.low.take(node), self.high.take(node))
            for of_class, shares in zip(votes, self.shares, strict=True):
                of_class += shares.take(node)
        return votes


def scorer_of(model, spark: SparkSession) -> _Scorer | None:
    """Arrays of a fitted Spark forest; None if Spark has to score with it itself (other splits, outputs or thresholds)."""
    from pyspark.ml.classification import RandomForestClassificationModel

    from carelake.session import scratch_path

    if not isinstance(model, RandomForestClassificationModel) or model.numFeatures > MOST_FEATURES:
        return None
    if model.isSet("thresholds") or model.getLeafCol() or not all((model.getRawPredictionCol(), model.getProbabilityCol(), model.getPredictionCol())):
        return None
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    saved = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n.id.alias("id"), n.leftChild.alias("leftChild"), n.rightChild.alias("rightChild"),
        n.split.featureIndex.alias("feature"), n.split.numCategories.alias("categories"), n.impurityStats.alias("stats"),
        F.coalesce(F.get(n.split.leftCategoriesOrThreshold, F.lit(0)), F.lit(0.0)).alias("value"),
    ).toArrow()
    if not np.isin(saved.column("categories").to_numpy(), (-1, 2)).all():
        return None
    return _Scorer(saved, model.numFeatures)


def score(model, df: DataFrame, scorer: _Scorer) -> DataFrame:
    """``model.transform(df)`` of a forest, same columns and values, batch by batch instead of row by row."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    @F.arrow_udf("struct<raw: array<double>, probability: array<double>, prediction: double>")
    def scored(features: pa.Array) -> pa.Array:
        votes = scorer.votes(_matrix(features, scorer.n_features))
        total = votes.sum(axis=0)
        shares = np.divide(votes, total, out=votes.copy(), where=total != 0)
        ends = pa.array(np.arange(0, votes.size + 1, len(votes)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(v.T.ravel())) for v in (votes, shares)]
        return pa.StructArray.from_arrays([*lists, pa.array(votes.argmax(axis=0).astype(float))], ["raw", "probability", "prediction"])

    as_spark = model.transform(df).schema
    out = df.withColumn("_scored", scored(vector_to_array(model.getFeaturesCol())))
    made = {
        model.getRawPredictionCol(): array_to_vector(F.col("_scored.raw")),
        model.getProbabilityCol(): array_to_vector(F.col("_scored.probability")),
        model.getPredictionCol(): F.col("_scored.prediction"),
    }
    return out.select(*[f"`{c}`" for c in df.columns if c not in made], *[v.alias(c, metadata=as_spark[c].metadata) for c, v in made.items()])
