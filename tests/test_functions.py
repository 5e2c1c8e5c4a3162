"""Edge rows for the column functions (names, whole years, weekend, season, lead days)."""

import datetime as dt

from carelake.functions import full_name, is_weekend, lead_days, season, weekday_name, whole_years


def test_full_name_nulls(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), ("Ann", None)], "first_name string, last_name string")
    got = [r[0] for r in df.select(full_name()).collect()]
    assert got == ["Ann Lee", None, None]


def test_whole_years(spark):
    rows = [
        (dt.date(1990, 3, 2), dt.date(1991, 3, 2)),  # first birthday: 365/365.25 -> 0
        (dt.date(1990, 3, 2), dt.date(2024, 3, 2)),
        (None, dt.date(2024, 3, 2)),
        (dt.date(2000, 1, 1), dt.date(1999, 1, 1)),  # reference before birth
    ]
    df = spark.createDataFrame(rows, "d date, ref date")
    out = df.select(whole_years("d", "ref").alias("y"))
    assert out.schema["y"].dataType.simpleString() == "bigint"
    assert [r.y for r in out.collect()] == [0, 34, None, -1]


def test_weekend_and_weekday_name(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(weekday_name("d").alias("n"), is_weekend("d").alias("w")).collect()
    assert [r.n for r in got] == ["Friday", "Saturday", "Sunday", "Monday", None]
    assert [r.w for r in got] == [False, True, True, False, False]


def test_weekend_on_timestamp_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 23, 30),)], "t timestamp_ntz")
    assert df.select(is_weekend("t")).first()[0] is True


def test_season_every_month_and_null(spark):
    dates = [(dt.date(2023, m, 15),) for m in range(1, 13)] + [(None,)]
    got = [r[0] for r in spark.createDataFrame(dates, "d date").select(season("d")).collect()]
    assert got == (
        ["Winter", "Winter"] + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter", "Fall"]
    )


def test_lead_days_truncates_timestamp(spark):
    rows = [
        (dt.date(2024, 3, 2), dt.datetime(2024, 3, 1, 23, 0)),  # 23:00 the day before -> 1
        (dt.date(2024, 3, 2), dt.datetime(2024, 3, 5, 8, 0)),  # created after the visit -> negative
    ]
    df = spark.createDataFrame(rows, "d date, c timestamp")
    got = df.select(lead_days("d", "c").alias("x"))
    assert got.schema["x"].dataType.simpleString() == "int"
    assert [r.x for r in got.collect()] == [1, -3]


def test_no_python_udf_in_feature_plan(spark):
    from carelake.plans.queries import QUERIES

    from .conftest import SF001

    plan = QUERIES["appointment_features"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
