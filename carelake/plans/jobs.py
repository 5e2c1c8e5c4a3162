"""Command-line jobs: the daily ETL, the ML training/scoring job and the incremental ingest.

    python -m carelake.plans.jobs daily-etl --patients P --physicians D --appointments A \\
        --base-path B --database clinic [--as-of 2024-06-01]
    python -m carelake.plans.jobs ml-training --database clinic --base-path B [--model-type gbt]
    python -m carelake.plans.jobs incremental-appointments --landing L --database clinic --base-path B

The session comes from the cluster (``SparkSession.builder.getOrCreate()``);
paths and names are arguments, there is no environment config layer.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession


def daily_etl_main(args, spark: SparkSession) -> dict:
    from carelake.plans.etl import daily_etl

    sources = {"patients": args.patients, "physicians": args.physicians, "appointments": args.appointments}
    tables = daily_etl(spark, sources, args.base_path, args.database, args.as_of, args.buckets, args.format, args.rejects, args.escape)
    out = {name: f"{args.database}.{name}" for name in tables}
    if args.rejects:
        out["rejects"] = {name: spark.table(f"{args.database}.{name}_rejects").count() for name in tables}
    return out


def ml_training_main(args, spark: SparkSession) -> dict:
    from carelake.plans.training import ml_training_job

    db = args.database
    out = ml_training_job(
        spark,
        spark.table(f"{db}.appointments"),
        spark.table(f"{db}.patients"),
        spark.table(f"{db}.physicians"),
        f"{args.base_path.rstrip('/')}/ml",
        db,
        as_of=args.as_of,
        model_type=args.model_type,
        model_version=args.model_version,
        fmt=args.format,
    )
    return {name: str(df.count()) for name, df in out.items()}


def incremental_main(args, spark: SparkSession) -> dict:
    from carelake.streaming import run_incremental_appointments

    base = args.base_path.rstrip("/")
    db = args.database
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    df = run_incremental_appointments(
        spark,
        args.landing,
        f"{db}.appointments_incremental",
        f"{base}/appointments_incremental",
        f"{base}/_checkpoints/appointments_incremental",
        f"{db}.patients",
        f"{db}.physicians",
        args.as_of,
    )
    return {"table": f"{db}.appointments_incremental", "rows": str(df.count())}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="carelake.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    e = sub.add_parser("daily-etl")
    for name in ("patients", "physicians", "appointments"):
        e.add_argument(f"--{name}", required=True, help=f"landing path of the {name} CSV files")
    e.add_argument("--buckets", type=int, default=None, help="bucket patients/appointments on patient_id")
    e.add_argument("--rejects", action="store_true", help="land unreadable records in <entity>_rejects instead of nulls")
    e.add_argument("--escape", default="\\", help="character that escapes a quote inside quotes (default: backslash)")
    m = sub.add_parser("ml-training")
    m.add_argument("--model-type", default="random_forest", choices=["random_forest", "gbt"])
    m.add_argument("--model-version", default=None)
    i = sub.add_parser("incremental-appointments")
    i.add_argument("--landing", required=True)
    for s in (e, m):
        s.add_argument("--format", default="parquet", help="table format (delta needs its jar)")
    for s in (e, m, i):
        s.add_argument("--database", required=True)
        s.add_argument("--base-path", required=True)
        s.add_argument("--as-of", default=None, help="reference date/time (default: now)")
    return p


MAINS = {"daily-etl": daily_etl_main, "ml-training": ml_training_main, "incremental-appointments": incremental_main}


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"carelake-{args.job}").getOrCreate()
    t0 = time.time()
    result = MAINS[args.job](args, spark)
    result["seconds"] = round(time.time() - t0, 1)
    print(json.dumps({"job": args.job, **result}))
    return result


if __name__ == "__main__":
    main()
