"""Running (prefix) sums that never put one whole group into a single task.

A plain ``sum(...) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)``
sends every row of a group to one task.  Here the rows are range-partitioned
on ``(g, o...)`` into balanced, ordered chunks (Spark samples the keys, so a
hot group is cut into several chunks), the sums run inside each
``(chunk, group)`` piece, and the per-piece totals give every piece the sum of
the earlier pieces of its group.  There are PIECES_PER_TASK times as many chunks as tasks:
neighbouring chunks share a task, which evens out what the sampled bounds leave uneven.

Bound: a group spans consecutive chunks and each chunk boundary cuts at most
one group, so there are at most ``#groups + n_chunks`` pieces; Spark chooses
how to join them by their size.

The chunk ids come from a range shuffle whose bounds Spark samples; the local
sums are therefore materialised once (reliable ``checkpoint()`` into the shared
checkpoint folder) and the piece totals are computed from that same copy, so
the two can never disagree about which chunk a row is in — also when a stage
is re-run after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Ranges for each task of the sums.
PIECES_PER_TASK = 4


def running_sums(
    df: DataFrame,
    partition_by: list[str],
    order_by: list,
    values: dict[str, Column],
    n_chunks: int,
    inclusive: bool = False,
) -> DataFrame:
    """Adds one column per ``values`` entry: the sum of that expression over the
    earlier rows (``inclusive=True``: earlier rows and the row itself) of the
    same ``partition_by`` group in ``order_by`` order.  Sums of no rows are 0.

    ``order_by`` must make the order total within a group (add a unique
    tie-break column) for the result to be deterministic.
    """
    from carelake.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    end = 0 if inclusive else -1
    tasks = max(1, n_chunks)
    ranged = df.repartitionByRange(PIECES_PER_TASK * tasks, *partition_by, *order_by).withColumn("_chunk", F.spark_partition_id())
    ranged = ranged.repartitionByRange(tasks, "_chunk")  # all of a chunk in one task: the window below needs no shuffle of its own
    w_local = Window.partitionBy("_chunk", *partition_by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, end)
    local = ranged.withColumns({f"_v_{n}": v for n, v in values.items()})
    local = local.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(w_local) for n in values}).checkpoint()
    pieces = local.groupBy(*partition_by, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_p_{n}") for n in values])
    w_chunk = (
        Window.partitionBy(*partition_by) if partition_by else Window.partitionBy(F.lit(0))
    ).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *partition_by, "_chunk", *[F.sum(f"_p_{n}").over(w_chunk).alias(f"_o_{n}") for n in values]
    )
    # NULL group keys are one group, as in a window: join them null-safely.
    o = offsets.select(*[F.col(c).alias(f"_g_{c}") for c in partition_by], *offsets.columns[len(partition_by):])
    cond = [local["_chunk"] == o["_chunk"]] + [local[c].eqNullSafe(o[f"_g_{c}"]) for c in partition_by]
    out = local.join(o, cond, "left").drop(o["_chunk"])
    out = out.withColumns(
        {n: F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_o_{n}"), F.lit(0)) for n in values}
    )
    return out.select(*df.columns, *values.keys())
