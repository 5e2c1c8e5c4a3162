"""Shared helpers of the training-data operators: scratch tables, table sizes and the memory of Python workers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import scratch_path

#: Bytes of an Arrow batch of texts: the executor and the Python worker each hold one, the worker also as strings.
TEXT_BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: What a Python worker keeps from task to task, by the operator that it belongs to.
KEPT: dict[str, dict] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage; the files outlive any executor.  While it is written, the Arrow batches
    of its Python steps are closed at ``batch_bytes`` (a longer row is a batch of its own).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_BATCH_BYTES, None)
    try:
        if batch_bytes is not None:
            spark.conf.set(_BATCH_BYTES, str(batch_bytes))
        df.write.parquet(path)
    finally:
        if batch_bytes is not None:
            spark.conf.unset(_BATCH_BYTES) if before is None else spark.conf.set(_BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col="text"):
    return F.coalesce(F.col(col), F.lit(""))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """The memory that this Python worker freed goes back to the system.

    Workers are used again by later stages: what the allocators keep would add up over a pipeline.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def drop_others(owner: str | None) -> None:
    """Drop what this Python worker still keeps for operators other than ``owner``."""
    others = [kept for name, kept in KEPT.items() if name != owner and kept]
    for kept in others:
        kept.clear()
    if others:
        give_back()


def released_after(results: Iterable, owner: str | None = None) -> Iterator:
    """``results`` of one task of the operator ``owner``: what others kept is dropped before, freed memory given back at the end."""
    drop_others(owner)
    try:
        yield from results
    finally:
        give_back()
