"""Data-quality and summary operators.

Each is one distributed aggregate (partial aggregation before the shuffle,
so a hot key costs one row per map task); results are small and returned
as DataFrames, never collected inside the operator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def validate_dataframe(df: DataFrame, required_columns: list[str]) -> bool:
    """True when every required column is present (schema check, no job)."""
    return set(required_columns) <= set(df.columns)


def contract_check(df: DataFrame, required_columns: list[str], key_columns: list[str] | None = None) -> DataFrame:
    """One row per required column: presence, NULL rows, and duplicate keys.

    Columns: ``column_name, present, null_rows, duplicate_rows``.  ``null_rows``
    is NULL for a missing column.  The key columns are one key together:
    ``duplicate_rows`` (rows whose key has no NULL and repeats an earlier one) is
    filled for each of them, and NULL if one is missing.  With a key the rows are
    counted per key first (summed before the shuffle), then once over all.
    """
    keys = list(key_columns or [])
    present = [c for c in required_columns if c in df.columns]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(present)]
    checked = bool(keys) and set(keys) <= set(df.columns)
    if checked:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        per_key = df.groupBy(*[F.col(k).alias(f"k_{i}") for i, k in enumerate(keys)]).agg(
            *nulls, (F.count_if(whole) - F.max(whole.cast("int"))).alias("d")
        )
        stats = per_key.agg(
            *[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(present))],
            F.coalesce(F.sum("d"), F.lit(0)).alias("d"),
        )
    else:
        stats = df.agg(*(nulls or [F.count(F.lit(1)).alias("_rows")]))
    rows = []
    for c in required_columns:
        null_rows = F.col(f"n_{present.index(c)}") if c in present else F.lit(None)
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in present).alias("present"),
                null_rows.cast("bigint").alias("null_rows"),
                (F.col("d") if checked and c in keys else F.lit(None)).cast("bigint").alias("duplicate_rows"),
            )
        )
    return _long(stats, rows, "column_name string, present boolean, null_rows bigint, duplicate_rows bigint")


def _long(stats: DataFrame, rows: list, schema: str | None = None) -> DataFrame:
    """One output row per struct, all taken from the single aggregate row (no re-aggregation)."""
    if not rows:
        return stats.sparkSession.createDataFrame([], schema)
    return stats.select(F.inline(F.array(*rows)))


def dedup_latest(df: DataFrame, keys: list[str], order_col: str | None = "updated_at") -> DataFrame:
    """One row per key: the newest ``order_col`` (NULL last), ties by the other columns (descending).

    Expressed as ``max(struct(order_col, other columns...))`` per key: an
    aggregate with map-side combining, so a key holding a third of the rows
    is reduced inside each map task instead of being sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    head = [order_col] if order_col else []
    packed = F.struct(*[F.col(c) for c in head + rest])
    return df.groupBy(*keys).agg(F.max(packed).alias("_keep")).select(*keys, "_keep.*").select(*df.columns)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each named DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def profile_table(df: DataFrame, exact: bool = False, rsd: float = 0.05) -> DataFrame:
    """Long-format profile: ``column_name, data_type, row_count, null_count, distinct_count``.

    Default distinct counts are HyperLogLog++ sketches (one pass, no
    per-column expansion of the data); ``exact=True`` counts the rows of each
    value column by column: every column is scanned and shuffled alone, summed
    before the shuffle, so a task holds values of one column and not whole rows.
    """
    if exact and df.columns:
        return reduce(DataFrame.unionByName, [_exact_column(df, c, t) for c, t in df.dtypes])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        aggs.append(F.approx_count_distinct(F.col(c), rsd).alias(f"d{i}"))
    stats = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("data_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"n{i}").cast("bigint").alias("null_count"),
            F.col(f"d{i}").cast("bigint").alias("distinct_count"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return _long(stats, rows)


def _exact_column(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """The row of ``profile_table`` for one column, from the number of rows of each of its values."""
    per_value = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    empty = F.col("_value").isNull()
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(empty, F.col("_n"))), F.lit(0)).alias("null_count"),
        F.count_if(~empty).alias("distinct_count"),
    ).select(F.lit(column).alias("column_name"), F.lit(data_type).alias("data_type"), "row_count", "null_count", "distinct_count")


#: Types whose values a sketch takes as they are; all others go in as strings.
_SKETCHED = ("int", "bigint", "string", "binary")


def profile_sketches(df: DataFrame, partition_by: str, lg: int = 12) -> DataFrame:
    """``partition_by, column_name, data_type, row_count, null_count, sketch`` for each value of ``partition_by``
    and each other column: the part of a profile that later runs can merge.

    One scan and one aggregate; a sketch is at most 2^lg bytes or so.  The relative standard error of the merged
    distinct count is about 1.04 / sqrt(2^lg): 1.6 % by default.
    """
    columns = [(c, t) for c, t in df.dtypes if c != partition_by]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (c, t) in enumerate(columns):
        value = F.col(f"`{c}`")
        aggs += [
            F.count_if(value.isNull()).alias(f"n{i}"),
            F.hll_sketch_agg(value if t in _SKETCHED else value.cast("string"), lg).alias(f"s{i}"),
        ]
    parts = df.groupBy(F.col(f"`{partition_by}`").alias("_part")).agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col("_rows").alias("row_count"),
            F.col(f"n{i}").cast("bigint").alias("null_count"), F.col(f"s{i}").alias("sketch"),
        )
        for i, (c, t) in enumerate(columns)
    ]
    return parts.select(F.col("_part").alias(partition_by), F.inline(F.array(*rows)))


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """``column_name, data_type, row_count, null_count, distinct_count`` over all partitions of ``profile_sketches``."""
    return sketches.groupBy("column_name", "data_type").agg(
        F.sum("row_count").cast("bigint").alias("row_count"), F.sum("null_count").cast("bigint").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
    )


def update_profile(df: DataFrame, partition_by: str, path: str, lg: int = 12) -> DataFrame:
    """Profile of a table that grows by partitions: the sketches of the partitions in ``df`` replace those stored
    under ``path``, the others stay; returns the profile of all of them.  Only ``df`` is scanned."""
    sketches = profile_sketches(df, partition_by, lg)
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    return merge_profiles(df.sparkSession.read.parquet(path))


def describe_long(df: DataFrame, columns: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Typed ``describe()``: ``column_name, count, mean, stddev, min, max`` per numeric column.

    ``mean``/``stddev`` (sample) are rounded to ``digits`` decimals; min/max are
    cast to double.  One aggregate pass.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = columns or [c for c, t in fields.items() if isinstance(t, NumericType)]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"c{i}"),
            F.round(F.avg(x), digits).alias(f"m{i}"),
            F.round(F.stddev_samp(x), digits).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    stats = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"c{i}").alias("count"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("stddev"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(cols)
    ]
    return _long(stats, rows, "column_name string, count bigint, mean double, stddev double, min double, max double")


def describe(df: DataFrame, *cols: str) -> DataFrame:
    """Spark's ``describe()`` (count/mean/stddev/min/max as strings), numeric and string columns."""
    if not cols:
        cols = tuple(f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, StringType)))
    return df.describe(*cols)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by ``order_by`` (a top-k: no full sort, one small final merge)."""
    return df.orderBy(*order_by).limit(n)
