"""Declared-schema readers, catalog scans and the file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from carelake import schemas
from carelake.sources.records import RAW, REASON, line_facts, read_records


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    enforce_header: bool = True,
    mode: str = "PERMISSIVE",
    corrupt_record_column: str | None = None,
    escape: str = "\\",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with header and a declared schema; inference off.

    ``enforce_header=True`` checks the header names against the schema
    (``enforceSchema=false``), so a reordered file raises instead of binding
    values to the wrong columns.  Unparsable values become NULL
    (``PERMISSIVE``); with ``corrupt_record_column`` the raw line of such rows
    is kept in that extra column.  Spark's CSV column pruning parses only the
    projected columns, so corruption is detected in the columns a query reads.
    """
    if corrupt_record_column:
        schema = StructType(list(schema.fields) + [StructField(corrupt_record_column, StringType(), True)])
    reader = (
        spark.read.format("csv")
        .schema(schema)
        .option("header", "true")
        .option("inferSchema", "false")
        .option("enforceSchema", "false" if enforce_header else "true")
        .option("mode", mode)
        .option("escape", escape)
        .option("multiLine", str(multi_line).lower())
    )
    if corrupt_record_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_record_column)
    return reader.load(path)


def extract(
    spark: SparkSession, source_path: str, schema: StructType, multi_line: bool | None = None, escape: str = "\\", **kw
) -> DataFrame:
    """``read_csv`` of files whose quoted fields may hold line breaks.

    ``None`` looks at the files first (one scan): where no field runs over a line end Spark's reader takes them
    line by line; where one does, but every file is small enough for one task, Spark's reader takes
    whole files; otherwise ``records.read_records`` puts the lines of all splits together.  All give the same rows.
    ``True`` and ``False`` ask for the last and the first way.
    """
    split = True
    if multi_line is None:
        multi_line, split = line_facts(spark, source_path, escape)
    if not multi_line or not split:
        return read_csv(spark, source_path, schema, escape=escape, multi_line=multi_line, **kw)
    corrupt = kw.get("corrupt_record_column")
    rows = read_records(spark, source_path, schema, escape)
    names = [f.name for f in schema.fields]
    return rows.select(*names, F.when(F.col(REASON).isNotNull(), F.col(RAW)).alias(corrupt)) if corrupt else rows.select(*names)


def extract_patients(spark: SparkSession, source_path: str, **kw) -> DataFrame:
    return extract(spark, source_path, schemas.PATIENTS, **kw)


def extract_physicians(spark: SparkSession, source_path: str, **kw) -> DataFrame:
    return extract(spark, source_path, schemas.PHYSICIANS, **kw)


def extract_appointments(spark: SparkSession, source_path: str, **kw) -> DataFrame:
    return extract(spark, source_path, schemas.APPOINTMENTS, **kw)


def read_table(spark: SparkSession, name: str | None) -> DataFrame | None:
    """Catalog scan; ``None`` passes through (optional enrichment tables)."""
    return None if not name else spark.table(name)


def file_inventory(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of the files under ``path``.

    A distributed listing through the ``binaryFile`` source; the file
    contents are pruned away, so only metadata is read.  Directories and files
    without a byte are not listed as rows (Spark's file index leaves both out).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(bool(recursive)).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def inventory_with_rows(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None, header: bool = True) -> DataFrame:
    """``file_inventory`` plus ``n_rows``: the lines of each file, less the header line.  A large file is counted
    in splits, and summed before the shuffle."""
    options = {"recursiveFileLookup": str(bool(recursive)).lower(), **({"pathGlobFilter": glob} if glob else {})}
    key = F.col("_metadata.file_path").alias("_file")
    files = spark.read.format("binaryFile").options(**options).load(path).select(key, "path", "length", "modificationTime")
    lines = spark.read.format("text").options(**options).load(path).select(key).groupBy("_file").agg(F.count(F.lit(1)).alias("_lines"))
    rows = F.greatest(F.coalesce("_lines", F.lit(0)) - (1 if header else 0), F.lit(0))
    return files.join(lines, "_file", "left").select("path", "length", "modificationTime", rows.alias("n_rows"))


def inventory_changes(old: DataFrame, new: DataFrame, key: str = "path", compare: tuple[str, ...] = ("length", "modificationTime")) -> DataFrame:
    """Two inventories of the same place side by side: key, status (added, removed, changed or unchanged), and the
    ``compare`` columns as ``old_...`` and ``new_...``.  Write ``old`` somewhere before the place changes."""
    a = old.select(F.col(key).alias("_a"), *[F.col(c).alias(f"old_{c}") for c in compare])
    b = new.select(F.col(key).alias("_b"), *[F.col(c).alias(f"new_{c}") for c in compare])
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(same, "unchanged").otherwise("changed")
    both = a.join(b, F.col("_a") == F.col("_b"), "full")
    return both.select(F.coalesce("_a", "_b").alias(key), status.alias("status"), *[f"{w}_{c}" for c in compare for w in ("old", "new")])
