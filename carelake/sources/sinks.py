"""Sinks: path writes and registered (external) tables.

A table that is replaced gets a data folder of its own: the new files are written and registered
under a name of their own first, then one change in the catalog (``ALTER TABLE ... SET LOCATION``)
makes them the table's.  A reader sees the old rows or the new ones, never a part, and a failed
run leaves the table as it was.  Folders that were replaced longer ago than ``keep_hours`` are removed
by a later run.  Format defaults to parquet; ``delta`` (where its jar is on the classpath)
replaces tables in its own log instead.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from carelake.operators.transforms import add_audit_columns


def create_database(spark: SparkSession, db_name: str, if_not_exists: bool = True, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if if_not_exists else ''}{db_name}")
    if use:
        spark.catalog.setCurrentDatabase(db_name)


def write_path(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Path-only sink with optional Hive-style partitioning.

    With partitioning, rows are first rebalanced on the partition columns
    (AQE's rebalance: small partitions coalesced, a hot partition value split
    across several tasks), so each partition folder gets a few right-sized
    files instead of one small file per writing task.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


#: Names of the data folders of a table: when they were begun (milliseconds), and a number.
_VERSION = re.compile(r"v-(\d{13})-[0-9a-f]{8}")


def table_folder(spark: SparkSession, table_name: str, path: str | None = None) -> str:
    """The folder that holds a table's data folders: ``path``, else the warehouse's for its name."""
    if path:
        return path.rstrip("/")
    database, _, name = table_name.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}"


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data folders in ``folder``, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n for n in found if _VERSION.fullmatch(n))


def remove_old_versions(spark: SparkSession, table_name: str, path: str | None = None, keep_hours: float = 24.0) -> list[str]:
    """Remove data folders that a newer one replaced more than ``keep_hours`` ago; returns their names.

    Readers that began before the replacement may still need them, so the delay must exceed the
    longest query.  The folder that the catalog names stays whatever its age.
    """
    folder = table_folder(spark, table_name, path)
    current = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").filter("col_name = 'Location'").first()
    names = versions(spark, folder)
    limit = time.time() * 1000 - keep_hours * 3_600_000
    gone = [n for n, later in zip(names, names[1:]) if int(_VERSION.fullmatch(later)[1]) < limit and not current[1].rstrip("/").endswith(n)]
    for name in gone:
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return gone


def _layout(spark: SparkSession, table_name: str) -> str:
    """Columns, format, partitions and buckets of a table, as its CREATE statement says; not its name, place or properties."""
    made = spark.sql(f"SHOW CREATE TABLE {table_name}").first()[0]
    return re.sub(r"(?m)^(LOCATION .*|TBLPROPERTIES .*|\s+'[^']*' = '[^']*'[,)].*)\n?", "", made.partition("(")[2])


def _swap(spark: SparkSession, staged: str, table_name: str, location: str) -> None:
    """Make the staged table's files those of ``table_name``.

    One catalog change where both have the same layout.  Otherwise, and for partitioned tables, whose
    partitions have places of their own, the old entry is dropped and the staged one takes its name:
    two changes, between which the table is missing for a moment.
    """
    if spark.catalog.tableExists(table_name):
        layout = _layout(spark, table_name)
        if layout == _layout(spark, staged) and "PARTITIONED BY" not in layout:
            spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{location}'")
            spark.sql(f"DROP TABLE {staged}")
            return
        spark.sql(f"DROP TABLE {table_name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table_name}")


def publish_table(
    df: DataFrame,
    table_name: str,
    path: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    bucket_by: list[str] | None = None,
    buckets: int | None = None,
    rebalance: bool = True,
    keep_hours: float = 24.0,
) -> DataFrame:
    """Write ``df`` and register it as ``table_name``; returns the table scan.

    The table is external; its data folders lie under ``path``, or under the warehouse's
    folder for its name.  ``overwrite`` replaces it as the module says, also where ``df`` reads the
    table itself; other modes write to its present folder.  ``bucket_by`` +
    ``buckets`` hash-bucket (and sort) the files on those columns: later
    joins and windows on the same key between tables with the same bucket
    count read co-located data and skip the shuffle.  Rows are hash-partitioned
    into exactly ``buckets`` partitions on those columns first (the same hash
    as bucketing), so each bucket is one file instead of one file per writing
    task per bucket.  Partitioned tables are rebalanced on the partition
    columns first (see ``write_path``).
    """
    spark = df.sparkSession
    if bucket_by and buckets:
        df = df.repartition(buckets, *bucket_by)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if fmt == "delta":
        if mode == "overwrite":
            writer = writer.option("overwriteSchema", "true")
        (writer.option("path", path) if path else writer).saveAsTable(table_name)
        return spark.table(table_name)
    if mode != "overwrite" and spark.catalog.tableExists(table_name):
        writer.saveAsTable(table_name)
        return spark.table(table_name)
    number = uuid.uuid4().hex[:8]
    location = f"{table_folder(spark, table_name, path)}/v-{int(time.time() * 1000)}-{number}"
    staged = f"{table_name}__{number}"
    writer.option("path", location).saveAsTable(staged)
    _swap(spark, staged, table_name, location)
    remove_old_versions(spark, table_name, path, keep_hours)
    return spark.table(table_name)


def publish_audited(
    df: DataFrame,
    table_name: str,
    path: str | None = None,
    mode: str = "overwrite",
    as_of=None,
    batch_id: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Audited sink: adds the audit columns, then ``publish_table`` in any save mode (incl. append)."""
    return publish_table(add_audit_columns(df, as_of, batch_id), table_name, path, mode, fmt=fmt)
