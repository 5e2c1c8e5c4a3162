"""Composite ETL jobs: per-entity CSV -> transform -> registered table, and the daily run.

Order matters in ``daily_etl``: the appointment job reads the patient and
physician tables the first two jobs have just published.  Each job is one
Spark write action; transforms are lazy until then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake import schemas
from carelake.operators.transforms import (
    filter_expr,
    transform_appointments,
    transform_patients,
    transform_physicians,
)
from carelake.session import scratch_path
from carelake.sources.readers import extract, read_table
from carelake.sources.records import FILE, RAW, REASON, read_records
from carelake.sources.sinks import create_database, publish_table


def stage_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as headered CSV files (the landing format of the source systems); text is quoted where it needs it."""
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def landed(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    rejects_table: str | None = None,
    rejects_path: str | None = None,
    as_of=None,
    escape: str = "\\",
) -> DataFrame:
    """The declared columns of the CSV files under ``source_path``; records may run over lines.

    Without ``rejects_table`` values that cannot be read are null.  With it the files are read once into a scratch
    table, the records that the parser or the declared non-null columns reject are appended to
    ``rejects_table`` (file, raw_record, reason, rejected_at), and the others are returned: every record
    ends in one of the two.
    """
    if not rejects_table:
        return extract(spark, source_path, schema, escape=escape)
    where = scratch_path(spark, "landed")
    parsed = read_records(spark, source_path, schema, escape)
    parsed.write.parquet(where)
    parsed = spark.read.schema(parsed.schema).parquet(where)
    at = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    rejects = parsed.filter(F.col(REASON).isNotNull())
    rejects = rejects.select(F.col(FILE).alias("file"), F.col(RAW).alias("raw_record"), F.col(REASON).alias("reason"), at.alias("rejected_at"))
    publish_table(rejects, rejects_table, rejects_path, mode="append")
    return parsed.filter(F.col(REASON).isNull()).select([f.name for f in schema.fields])


def run_patients(
    spark: SparkSession,
    source_path: str,
    target_path: str | None,
    table_name: str = "patients",
    as_of=None,
    buckets: int | None = None,
    fmt: str = "parquet",
    **landing,
) -> DataFrame:
    """``landing``: ``rejects_table``, ``rejects_path`` and ``escape`` of ``landed``, in all three jobs."""
    df = transform_patients(landed(spark, source_path, schemas.PATIENTS, as_of=as_of, **landing), as_of)
    return publish_table(df, table_name, target_path, fmt=fmt, bucket_by=["patient_id"], buckets=buckets)


def run_physicians(
    spark: SparkSession,
    source_path: str,
    target_path: str | None,
    table_name: str = "physicians",
    as_of=None,
    fmt: str = "parquet",
    **landing,
) -> DataFrame:
    df = transform_physicians(landed(spark, source_path, schemas.PHYSICIANS, as_of=as_of, **landing), as_of)
    return publish_table(df, table_name, target_path, fmt=fmt)


def run_appointments(
    spark: SparkSession,
    source_path: str,
    target_path: str | None,
    patients_table: str | None = None,
    physicians_table: str | None = None,
    table_name: str = "appointments",
    as_of=None,
    buckets: int | None = None,
    fmt: str = "parquet",
    **landing,
) -> DataFrame:
    """Appointments enriched from the registered patient/physician tables (each optional)."""
    df = transform_appointments(
        landed(spark, source_path, schemas.APPOINTMENTS, as_of=as_of, **landing),
        read_table(spark, patients_table),
        read_table(spark, physicians_table),
        as_of,
    )
    return publish_table(df, table_name, target_path, fmt=fmt, bucket_by=["patient_id"], buckets=buckets)


def daily_etl(
    spark: SparkSession,
    sources: dict[str, str],
    base_path: str | None,
    database: str,
    as_of=None,
    buckets: int | None = None,
    fmt: str = "parquet",
    rejects: bool = False,
    escape: str = "\\",
) -> dict[str, DataFrame]:
    """Patients, then physicians, then enriched appointments into ``database``.

    ``sources`` maps ``patients``/``physicians``/``appointments`` to CSV paths;
    tables land under ``base_path/<entity>`` (warehouse default when ``None``).
    With ``rejects``, records that cannot be read whole go to ``<entity>_rejects`` instead
    (see ``landed``); they are kept over runs.  With ``buckets``, patients and appointments are
    bucketed on ``patient_id`` with that many buckets, so the feature build (patient join + history
    window) later runs without shuffling either table.  The layout is what the
    caller asked for, whatever the data: a bucket is written and read by one
    task, so ask for no buckets where one patient owns a large share of the visits.
    """
    create_database(spark, database)

    def target(entity):
        return f"{base_path.rstrip('/')}/{entity}" if base_path else None

    def common(entity):
        own = {"rejects_table": f"{database}.{entity}_rejects", "rejects_path": target(f"{entity}_rejects")} if rejects else {}
        return {"as_of": as_of, "fmt": fmt, "escape": escape, **own}

    patients, physicians, appointments = (f"{database}.{e}" for e in ("patients", "physicians", "appointments"))
    out = {
        "patients": run_patients(spark, sources["patients"], target("patients"), patients, buckets=buckets, **common("patients")),
        "physicians": run_physicians(spark, sources["physicians"], target("physicians"), physicians, **common("physicians")),
    }
    out["appointments"] = run_appointments(
        spark, sources["appointments"], target("appointments"), patients, physicians, appointments, buckets=buckets, **common("appointments")
    )
    return out


def view_filter_table(
    spark: SparkSession,
    source: DataFrame,
    table_name: str,
    path: str | None = None,
    view_name: str = "taxi_raw",
    condition: str = "fare_amount < 30",
    fmt: str = "parquet",
) -> DataFrame:
    """Named view over a scan, and a materialised table defined by a filter over the view.

    The view is inlined by the analyzer, so the predicate reaches the scan.
    """
    source.createOrReplaceTempView(view_name)
    return publish_table(filter_expr(spark.table(view_name), condition), table_name, path, fmt=fmt)
