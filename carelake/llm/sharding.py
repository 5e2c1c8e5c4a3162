"""Contiguous shards of equal bytes: global prefix sums from per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize, shuffle_parts


def shard_by_bytes(sized: DataFrame, n_shards: int, order: list[str], size: str = "size") -> DataFrame:
    """``sized`` plus shard (0 to n_shards - 1) and slot (place in the shard, gapless from 0).

    Rows are dealt into range partitions of the sort order (``order``, nulls first; equal
    rows are cut apart by a seeded random number) and written once.  One small row per
    partition carries its bytes and rows; their running sums turn each partition's own
    running sums into global ones.  A row belongs to the shard in which the middle of its
    bytes falls, so shards differ from the target by less than one row on either side.
    A null size counts as 0.  An empty table gives no rows; shards may be empty if
    there are fewer rows than shards.  Columns named like an output or a helper column
    (shard, slot, or a leading underscore) are replaced.
    """
    spark = sized.sparkSession
    sized = sized.select([c for c in sized.columns if c.lower() not in ("shard", "slot") and c[0] != "_"])
    by = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tie")]
    dealt = (
        sized.withColumn("_tie", F.rand(7))
        .repartitionByRange(shuffle_parts(spark), *by)
        .withColumn("_part", F.spark_partition_id())
    )
    dealt = materialize(dealt.withColumn("_b", F.coalesce(F.col(size), F.lit(0)).cast("long")), "shards")

    totals = dealt.groupBy("_part").agg(F.sum("_b").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    overall = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(overall).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*by)
    placed = (
        dealt.withColumn("_end", F.sum("_b").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_row", F.row_number().over(inside))
        .join(offsets, "_part")
        .withColumn("_twice_middle", 2 * (F.col("_bytes_before") + F.col("_end")) - F.col("_b"))
        .withColumn("_row", F.col("_rows_before") + F.col("_row") - 1)
    )
    cut = f"cast(least({n_shards} - 1, cast(_twice_middle as decimal(38,0)) * {n_shards} div greatest(2 * _total, 1)) as int)"
    placed = placed.withColumn("shard", F.expr(cut))
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *sized.columns, "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Parquet folders shard=0, shard=1, ...; rows keep their slot."""
    sharded.write.partitionBy("shard").mode("overwrite").parquet(path)
