"""Transforms, joins, de-duplication and quality checks on small literal frames."""

import datetime as dt

import pytest

from carelake.operators.features import conform_to_schema
from carelake.operators.quality import contract_check, dedup_latest, profile_table, validate_dataframe
from carelake.operators.transforms import (
    add_audit_columns,
    add_partition_columns,
    transform_appointments,
    transform_patients,
    transform_physicians,
    upcoming_appointments,
)
from carelake.schemas import FEATURES

APPT = "appointment_id string, patient_id string, physician_id string, appointment_date date, status string"


def test_joins_unmatched_none_and_duplicates(spark):
    appts = spark.createDataFrame(
        [("a1", "p1", "d1", dt.date(2024, 1, 6), "Scheduled"), ("a2", "p2", "d9", dt.date(2024, 1, 8), "Completed")],
        APPT,
    )
    pats = spark.createDataFrame([("p1", "Ann Lee"), ("p1", "Ann B. Lee")], "patient_id string, full_name string")
    docs = spark.createDataFrame([("d1", "Dr X", "Cardio")], "physician_id string, full_name string, specialty string")
    # None dimensions: no join, same rows
    assert transform_appointments(appts).count() == 2
    out = transform_appointments(appts, pats, docs, as_of="2024-01-01").collect()
    # duplicate patient key fans out, unmatched keys give NULLs
    assert len(out) == 3
    a2 = [r for r in out if r.appointment_id == "a2"][0]
    assert (a2.patient_name, a2.physician_name, a2.specialty) == (None, None, None)
    a1 = [r for r in out if r.appointment_id == "a1"]
    assert {r.patient_name for r in a1} == {"Ann Lee", "Ann B. Lee"}
    assert all(r.day_of_week == "Saturday" and r.is_weekend for r in a1)


def test_transform_patients_age_and_timestamp(spark):
    df = spark.createDataFrame(
        [("p1", "Ann", None, dt.date(1990, 3, 2))], "patient_id string, first_name string, last_name string, date_of_birth date"
    )
    r = transform_patients(df, as_of="1991-03-02").first()
    assert (r.full_name, r.age) == (None, 0)
    assert r.processed_timestamp == dt.datetime(1991, 3, 2)


def test_dedup_latest_rules(spark):
    rows = [
        ("k1", dt.datetime(2024, 1, 1), "old"),
        ("k1", dt.datetime(2024, 2, 1), "new"),
        ("k2", None, "null-ts"),
        ("k2", dt.datetime(2023, 1, 1), "dated"),
        ("k3", None, "same"),
        ("k3", None, "same"),
    ]
    df = spark.createDataFrame(rows, "physician_id string, updated_at timestamp, v string")
    got = {r.physician_id: r.v for r in dedup_latest(df, ["physician_id"], "updated_at").collect()}
    assert got == {"k1": "new", "k2": "dated", "k3": "same"}


def test_transform_physicians_dedups(spark):
    rows = [("d1", "A", "B", dt.date(2000, 1, 1), dt.datetime(2024, 1, 1)),
            ("d1", "A", "C", dt.date(2000, 1, 1), dt.datetime(2024, 5, 1))]
    df = spark.createDataFrame(rows, "physician_id string, first_name string, last_name string, hire_date date, updated_at timestamp")
    out = transform_physicians(df, as_of="2010-01-01").collect()
    assert len(out) == 1 and out[0].full_name == "A C" and out[0].years_employed == 10
    assert transform_physicians(df, keep="any").count() == 1


def test_partition_columns_rules(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29), dt.date(2020, 1, 1))], "visit_date date, update_date date")
    r = add_partition_columns(df).first()
    assert (r.year, r.month, r.day) == (2024, 2, 29)  # first candidate wins
    with pytest.raises(ValueError):
        add_partition_columns(spark.createDataFrame([(1,)], "x int"))


def test_conform_schema_missing_and_wide(spark):
    df = spark.createDataFrame([("a1", 7)], "appointment_id string, patient_age bigint")
    out = conform_to_schema(df, FEATURES)
    assert [f.name for f in out.schema.fields] == [f.name for f in FEATURES.fields]
    assert dict(out.dtypes)["patient_age"] == "int"
    r = out.first()
    assert r.patient_age == 7 and r.season is None and r.no_show_rate is None


def test_upcoming_filter(spark):
    appts = spark.createDataFrame(
        [("a1", "p", "d", dt.date(2024, 1, 6), "Scheduled"), ("a2", "p", "d", dt.date(2023, 1, 6), "Scheduled"),
         ("a3", "p", "d", dt.date(2024, 1, 6), "Completed"), ("a4", "p", "d", None, "Scheduled")],
        APPT,
    )
    assert [r.appointment_id for r in upcoming_appointments(appts, "2024-01-01").collect()] == ["a1"]


def test_audit_columns_share_one_instant(spark):
    df = add_audit_columns(spark.range(1), "2024-05-06 07:08:09")
    r = df.first()
    assert r.etl_batch_id == "20240506070809" and r.etl_date == dt.date(2024, 5, 6)


def test_contract_check_and_validate(spark):
    df = spark.createDataFrame([("p1", None), ("p1", "x"), (None, "y")], "patient_id string, name string")
    rows = {r.column_name: r for r in contract_check(df, ["patient_id", "name", "zip"], ["patient_id"]).collect()}
    assert (rows["patient_id"].null_rows, rows["patient_id"].duplicate_rows) == (1, 1)
    assert (rows["name"].present, rows["name"].null_rows, rows["name"].duplicate_rows) == (True, 1, None)
    assert (rows["zip"].present, rows["zip"].null_rows) == (False, None)
    assert validate_dataframe(df, ["patient_id"]) and not validate_dataframe(df, ["zip"])


def test_profile_exact_and_approx(spark):
    df = spark.range(0, 500).selectExpr("CAST(id % 50 AS STRING) AS k", "IF(id % 10 = 0, NULL, id) AS v")
    exact = {r.column_name: r for r in profile_table(df, exact=True).collect()}
    assert (exact["k"].distinct_count, exact["v"].null_count, exact["v"].row_count) == (50, 50, 500)
    approx = {r.column_name: r for r in profile_table(df).collect()}
    assert abs(approx["v"].distinct_count - 450) <= 45


def test_exact_profile_takes_columns_one_by_one(spark):
    df = spark.range(0, 60).selectExpr("CAST(id AS STRING) AS k", "IF(id % 2 = 0, NULL, id % 5) AS v", "CAST(NULL AS DATE) AS d", "double(-0.0) AS z")
    out = profile_table(df.union(df), exact=True)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()  # whole rows, once for each column
    want = [("k", "string", 120, 0, 60), ("v", "bigint", 120, 60, 5), ("d", "date", 120, 120, 0), ("z", "double", 120, 0, 1)]
    assert [tuple(r) for r in out.collect()] == want
    assert {tuple(r)[2:] for r in profile_table(df.limit(0), exact=True).collect()} == {(0, 0, 0)}
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in profile_table(df).schema.fields]


def test_summaries_with_nothing_to_report(spark):
    from carelake.operators.quality import describe_long

    df = spark.createDataFrame([("a",)], "s string")
    assert contract_check(df, []).count() == 0
    assert describe_long(df).columns == ["column_name", "count", "mean", "stddev", "min", "max"]
    assert describe_long(df).count() == 0


def test_profile_by_partition_merges(spark, tmp_path):
    from carelake.operators.quality import profile_sketches, update_profile

    df = spark.range(0, 20000).selectExpr(
        "id % 5 as part", "id", "cast(id % 300 as double) as d", "date_add(date'2020-01-01', cast(id % 90 as int)) as day",
        "if(id % 4 = 0, null, concat('s', id % 7000)) as s", "cast(null as int) as nothing",
    )
    path = str(tmp_path / "profile")
    update_profile(df.filter("part < 3").filter("id % 2 = 0"), "part", path)
    got = {r.column_name: r for r in update_profile(df, "part", path).collect()}
    assert {c: (r.row_count, r.null_count) for c, r in got.items()} == {
        "id": (20000, 0), "d": (20000, 0), "day": (20000, 0), "s": (20000, 5000), "nothing": (20000, 20000)
    }
    want = {"id": 20000, "d": 300, "day": 90, "s": df.select("s").distinct().count() - 1, "nothing": 0}
    assert all(abs(got[c].distinct_count - n) <= 0.065 * n for c, n in want.items())
    plan = profile_sketches(df, "part")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert update_profile(df.limit(0), "part", path).count() == 5  # nothing new: the stored parts stay
