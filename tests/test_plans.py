"""Plan shape: filters reach the parquet scan, scans read only used columns."""

import re

from carelake.operators.transforms import filter_expr, upcoming_appointments
from carelake.sources import fixtures as fx

from .conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upcoming_date_filter_pushed(spark):
    plan = _plan(upcoming_appointments(fx.appointments(spark, SF001), "2001-01-01"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "o_orderdate" in pushed


def test_view_filter_pushed(spark):
    fx.trips(spark, SF001).createOrReplaceTempView("taxi_raw_plan")
    plan = _plan(filter_expr(spark.table("taxi_raw_plan"), "fare_amount < 30"))
    assert "LessThan(value,30.0)" in plan


def test_feature_scan_is_pruned(spark):
    from carelake.plans.queries import QUERIES

    plan = _plan(QUERIES["appointment_features"](spark, SF001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    orders = [s for s in schemas if "o_orderkey" in s][0]
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders
    customer = [s for s in schemas if "c_custkey" in s][0]
    assert "c_name" not in customer and "c_acctbal" not in customer


PURE = [
    "appointment_features", "patient_history", "datetime_features", "patient_age", "lead_days",
    "transform_patients", "transform_physicians", "transform_appointments", "enrich_patient", "enrich_both",
    "audit_columns", "upcoming", "partition_columns", "conform_schema", "contract_check", "dedup_latest",
    "profile_table", "describe_features", "row_counts", "preview", "split_by_key", "eval_auc", "eval_accuracy",
    "appointment_features_skewed", "patient_history_skewed",
]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def test_no_python_in_plans(spark):
    from carelake.plans.queries import QUERIES

    for name in PURE:
        plan = _plan(QUERIES[name](spark, SF001))
        assert not any(node in plan for node in PYTHON_NODES), name


def test_enrichment_preserves_rows_with_unique_keys(spark):
    from carelake.plans.queries import QUERIES

    n = fx.appointments(spark, SF001).count()
    for name in ("enrich_patient", "enrich_both", "appointment_features"):
        assert QUERIES[name](spark, SF001).count() == n, name


def test_bucketed_tables_make_feature_build_shuffle_free(spark):
    from carelake.operators.features import generate_features
    from carelake.plans.etl import daily_etl, stage_csv
    from carelake.session import scratch_path

    src = {
        n: stage_csv(v(spark, SF001), scratch_path(spark, f"b-{n}"))
        for n, v in (("patients", fx.patients), ("physicians", fx.physicians), ("appointments", fx.appointments))
    }
    daily_etl(spark, src, scratch_path(spark, "bucketed"), "bucketed_db", "2001-01-01", buckets=4)
    t = {n: spark.table(f"bucketed_db.{n}") for n in ("appointments", "patients", "physicians")}
    plan = _plan(generate_features(t["appointments"], t["patients"], t["physicians"], split=False))
    assert "Exchange" not in plan.replace("BroadcastExchange", ""), plan


def test_tables_are_bucketed_if_and_only_if_asked(spark):
    from carelake.plans.etl import daily_etl, stage_csv
    from carelake.session import scratch_path

    src = {
        n: stage_csv(v(spark, SF001), scratch_path(spark, f"h-{n}"))
        for n, v in (("patients", fx.patients), ("physicians", fx.physicians), ("appointments", fx.appointments))
    }

    def bucketed(db):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.appointments").collect()
        return any(r.col_name == "Num Buckets" for r in rows)

    daily_etl(spark, src, scratch_path(spark, "cool-db"), "cool_db", "2001-01-01", buckets=4)
    assert bucketed("cool_db")
    daily_etl(spark, src, scratch_path(spark, "plain-db"), "plain_db", "2001-01-01")
    assert not bucketed("plain_db")


def test_preview_is_a_top_k(spark):
    from carelake.operators.quality import preview

    plan = _plan(preview(fx.appointments(spark, SF001), ["appointment_date", "appointment_id"], 10))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan
