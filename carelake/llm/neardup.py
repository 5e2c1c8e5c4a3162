"""Embedding near-duplicates: an exact metric range join over cells round pivot vectors.

Unit vectors with cosine >= c are at most eps = sqrt(2 - 2c) apart.  Every distinct vector
belongs to the cell of its nearest pivot; a vector within eps of the border of another cell
(by the triangle inequality on the pivots' distances) is copied there.  A link therefore
has both ends in the cell of each end, and the cells are joined independently, in blocks of
bounded size.  Counts of links leave a block summed, and links only as a forest over it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize
from carelake.llm.graph import connected_components

#: One vector in so many is a pivot, so many pivots at most (broadcast, and copied to the driver).
CELL_VECTORS = 2_000
MAX_PIVOTS = 4_096
#: Rows of one side of a block: a block's matrix is at most this squared.
BLOCK_ROWS = 2_000
_SLACK = 1e-6


def _unit(vectors) -> np.ndarray:
    v = np.stack([np.asarray(x, dtype=np.float64) for x in vectors])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _cells(classes: DataFrame, eps: float, n: int) -> DataFrame:
    """A row (cell, own, cid, vec) for every cell a vector belongs or is copied to."""
    every = max(CELL_VECTORS, -(-n // MAX_PIVOTS))
    chosen = classes.filter(F.pmod(F.xxhash64("vec_key"), F.lit(every)) == 0).select("part", "vec").limit(4 * MAX_PIVOTS).toArrow().to_pandas()
    pivots = {p: _unit(g["vec"]) for p, g in chosen.groupby("part")}
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def place(vectors: np.ndarray, at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row, and which cells each row belongs to (boolean)."""
        if at is None:
            return np.zeros(len(vectors), int), np.ones((len(vectors), 1), bool)
        square = np.maximum(0.0, 2.0 - 2.0 * vectors @ at.T)
        near = square.argmin(axis=1)
        best = square[np.arange(len(vectors)), near]
        apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * at @ at.T))[near]
        # distance to the plane between two pivots, and the plain triangle inequality for equal pivots
        inside = square - best[:, None] <= 2.0 * apart * eps + _SLACK
        inside &= np.sqrt(square) - np.sqrt(best)[:, None] <= 2.0 * eps + _SLACK
        inside[np.arange(len(vectors)), near] = True
        return near, inside

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, g in b.groupby("part"):
                near, inside = place(_unit(g["vec"]), shared.value.get(part))
                row, cell = np.nonzero(inside)
                yield pd.DataFrame({
                    "cell": [f"{part}:{c}" for c in cell], "own": near[row] == cell,
                    "cid": g["cid"].to_numpy()[row], "vec": g["vec"].to_numpy()[row], "copies": g["copies"].to_numpy()[row],
                })

    return classes.select("part", "cid", "vec", "copies").mapInPandas(
        run, "cell string, own boolean, cid long, vec array<float>, copies long"
    )


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links i-j."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _block(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Rows (cid, links, root): links of the block's own rows, and a forest over all its links."""
    own = pdf[pdf["left"]]
    other = pdf[~pdf["left"]]
    a, b = _unit(own["vec"]) if len(own) else np.empty((0, 1)), _unit(other["vec"]) if len(other) else np.empty((0, 1))
    if not len(own) or not len(other):
        return pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
    ids_a, ids_b = own["cid"].to_numpy(), other["cid"].to_numpy()
    linked = (a @ b.T >= cosine) & (ids_a[:, None] != ids_b[None, :])
    ids, at = np.unique(np.concatenate([ids_a, ids_b]), return_inverse=True)
    i, j = np.nonzero(linked)
    root = ids[_forest(at[: len(ids_a)][i], at[len(ids_a) :][j], len(ids))]
    counts = linked @ other["copies"].to_numpy()
    moved = root != ids
    return pd.concat([
        pd.DataFrame({"cid": ids_a, "links": counts, "root": ids_a})[counts > 0],
        pd.DataFrame({"cid": ids[moved], "links": 0, "root": root[moved]}),
    ])


def near_duplicates(rows: DataFrame, cosine: float, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of ``rows``: key, n_links, component_id, kept.

    Two rows link when their labels are equal and not null, their vectors have the same
    length and their cosine in double precision is at least ``cosine``.  n_links counts
    the other rows; component_id is the smallest key that links reach, the own one included;
    kept tells whether that is the own key.  Rows with a null key or label and vectors
    that are null, empty, zero or hold a null or non-finite component link with nothing; a
    null key has a null component_id and is kept.  Rows that share a key count as other rows.

    Equal vectors are joined once, with their number.  A cell larger than a block is cut:
    each block of its own rows meets each block of all its rows.  In a cell where nearly
    all vectors link, the work grows with the square of the distinct vectors, the rows that leave do not.
    """
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = F.col(key).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & finite
    vec_key = F.sha2(F.concat_ws(",", F.col(label).cast("string"), F.concat_ws(" ", v.cast("array<string>"))), 256)
    given = rows.select(F.col(key).alias("id"), F.when(usable, vec_key).alias("vec_key"), F.col(label).cast("string").alias("l"), v.alias("vec"))
    classes = given.filter("vec_key is not null").groupBy("vec_key").agg(
        F.concat_ws("/", F.first("l"), F.size(F.first("vec"))).alias("part"),
        F.first("vec").cast("array<float>").alias("vec"), F.count("*").alias("copies"), F.min("id").alias("low"),
    )
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    eps = float(np.sqrt(max(0.0, 2.0 - 2.0 * cosine)))
    cells = materialize(_cells(classes, eps, classes.count()), "cells")

    sizes = cells.groupBy("cell").agg(F.count("*").alias("n_all"), F.sum(F.col("own").cast("long")).alias("n_own"))
    cut = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK_ROWS)).cast("int")
    sized = cells.join(sizes.filter("n_own > 0 and n_all > 1"), "cell").withColumn("na", cut("n_own")).withColumn("nb", cut("n_all"))
    mine = F.pmod(F.xxhash64("cid"), F.col("na")).cast("int")
    theirs = F.pmod(F.xxhash64("cid", F.lit(1)), F.col("nb")).cast("int")
    columns = ["cell", "cid", "vec", "copies"]
    left = sized.filter("own").select(*columns, mine.alias("a"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("b"), F.lit(True).alias("left"))
    right = sized.select(*columns, F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("a"), theirs.alias("b"), F.lit(False).alias("left"))
    found = left.unionByName(right).groupBy("cell", "a", "b").applyInPandas(
        lambda pdf: _block(pdf, cosine), "cid long, links long, root long"
    )
    found = materialize(found, "vector-links")

    links = found.filter("links > 0").groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    known = classes.select("vec_key", "cid", "copies", "low").join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.withColumn("root", F.coalesce("root", "cid"))
    lows = known.groupBy("root").agg(F.min("low").alias("component"))
    known = known.join(lows, "root").select("vec_key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component")
    out = given.select("id", "vec_key").join(known, "vec_key", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
