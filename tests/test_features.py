"""History window, hot-key split plan and the feature composite."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from carelake.operators import features
from carelake.operators.features import calculate_patient_history, generate_features
from carelake.operators.prefix import running_sums

HIST = "appointment_id string, patient_id string, appointment_date date, appointment_time timestamp, no_show boolean"


def _hist_rows(df):
    return sorted(
        (r.appointment_id, r.previous_appointments, r.previous_no_shows, r.no_show_rate)
        for r in df.select("appointment_id", "previous_appointments", "previous_no_shows", "no_show_rate").collect()
    )


def _visits(spark, flags_by_patient):
    rows = []
    for pid, flags in flags_by_patient.items():
        for i, f in enumerate(flags):
            d = dt.date(2020, 1, 1) + dt.timedelta(days=i)
            rows.append((f"{pid}-{i}", pid, d, dt.datetime.combine(d, dt.time(9)), f))
    return spark.createDataFrame(rows, HIST)


@pytest.mark.parametrize("split", [False, True])
def test_history_null_rules(spark, split):
    df = _visits(spark, {"a": [True, None, False], "b": [None, True]})
    got = {r[0]: r[1:] for r in _hist_rows(calculate_patient_history(df, split=split, hot_rows=1))}
    assert got["a-0"] == (0, None, 0.0)
    assert got["a-1"] == (1, 1, 1.0)
    assert got["a-2"] == (2, 1, 0.5)
    assert got["b-0"] == (0, None, 0.0)
    assert got["b-1"] == (1, None, None)


def test_history_types(spark):
    out = calculate_patient_history(_visits(spark, {"a": [True]}))
    types = dict(out.dtypes)
    assert types["previous_appointments"] == "bigint"
    assert types["previous_no_shows"] == "bigint"
    assert types["no_show_rate"] == "double"


def test_same_day_ties_are_ordered_by_time_then_id(spark):
    d = dt.date(2020, 1, 1)
    rows = [
        ("x2", "p", d, dt.datetime(2020, 1, 1, 9), True),
        ("x1", "p", d, dt.datetime(2020, 1, 1, 9), False),
        ("x0", "p", d, dt.datetime(2020, 1, 1, 8), None),
    ]
    got = {r[0]: r[1] for r in _hist_rows(calculate_patient_history(spark.createDataFrame(rows, HIST)))}
    assert got == {"x0": 0, "x1": 1, "x2": 2}


def test_hot_patient_split_matches_window(spark):
    """One patient owns a third of all rows; the split plan must give the window's answer."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        pid = "hot" if i % 3 == 0 else f"p{rnd.randrange(200)}"
        d = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(60))
        flag = rnd.choice([True, False, None])
        rows.append((f"id{i:05d}", pid, d, dt.datetime.combine(d, dt.time(rnd.randrange(24))), flag))
    df = spark.createDataFrame(rows, HIST).repartition(6)
    plain = _hist_rows(calculate_patient_history(df, split=False))
    split = calculate_patient_history(df, hot_rows=1)
    assert _hist_rows(split) == plain


def test_running_sums_without_groups(spark):
    df = spark.range(0, 1000).withColumn("v", (F.col("id") % 7).cast("bigint"))
    out = running_sums(df, [], ["id"], {"s": F.col("v")}, n_chunks=5).orderBy("id").collect()
    acc = 0
    for r in out:
        assert r.s == acc
        acc += r.v


def test_feature_plan_has_one_window(spark):
    from carelake.plans.queries import QUERIES

    from .conftest import SF001

    df = QUERIES["appointment_features"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bWindow \[", plan)) == 1, plan
    # one exchange of the appointments (the dimensions are broadcast at this size)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan


def test_generate_features_edges(spark):
    appts = spark.createDataFrame(
        [
            ("1", "p1", "d1", dt.date(2024, 1, 6), dt.datetime(2024, 1, 6, 10), dt.datetime(2024, 1, 1, 8), True),
            ("2", "p9", "d9", dt.date(2024, 1, 8), dt.datetime(2024, 1, 8, 11), dt.datetime(2024, 1, 8, 7), None),
        ],
        "appointment_id string, patient_id string, physician_id string, appointment_date date, "
        "appointment_time timestamp, created_at timestamp, no_show boolean",
    )
    pats = spark.createDataFrame(
        [("p1", dt.date(1990, 1, 6), "F", dt.datetime(2000, 1, 1))],
        "patient_id string, date_of_birth date, gender string, created_at timestamp",
    )
    docs = spark.createDataFrame([("d1", "Cardiology")], "physician_id string, specialty string")
    out = {r.appointment_id: r for r in generate_features(appts, pats, docs).collect()}
    a, b = out["1"], out["2"]
    # 12418 days / 365.25 = 33.998: the 365.25-day year gives 33 on the 34th birthday
    assert (a.patient_age, a.patient_gender, a.physician_specialty) == (33, "F", "Cardiology")
    assert (a.appointment_lead_days, a.day_of_week, a.is_weekend, a.appointment_hour, a.season) == (
        5, "Saturday", True, 10, "Winter")
    assert (b.patient_age, b.patient_gender, b.physician_specialty) == (None, None, None)
    assert (b.previous_appointments, b.previous_no_shows, b.no_show_rate) == (0, None, 0.0)


def test_feature_schema_is_declared(spark):
    from carelake.plans.queries import QUERIES
    from carelake.schemas import FEATURES

    from .conftest import SF001

    df = QUERIES["appointment_features"](spark, SF001)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in FEATURES.fields]


def test_hot_null_patient_key_is_split_and_correct(spark):
    """Many rows without a patient id form one (hot) window group; the split plan must agree."""
    rnd = random.Random(11)
    rows = []
    for i in range(1200):
        pid = None if i % 2 == 0 else f"p{rnd.randrange(40)}"
        d = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(30))
        rows.append((f"id{i:05d}", pid, d, dt.datetime.combine(d, dt.time(rnd.randrange(24))), rnd.choice([True, False, None])))
    df = spark.createDataFrame(rows, HIST).repartition(4)
    plain = _hist_rows(calculate_patient_history(df, split=False))
    split = calculate_patient_history(df, hot_rows=1)
    assert _hist_rows(split) == plain


def _many_visits(spark, pid, days):
    return spark.range(0, 60000, 1, 8).selectExpr(
        "LPAD(CAST(id * 7919 % 60000 AS STRING), 6, '0') AS appointment_id", f"{pid} AS patient_id",
        f"IF({days} = 0 OR id % 97 = 0, NULL, DATE_ADD(DATE'2020-01-01', CAST(id * 7 % {max(days, 1)} AS INT))) AS appointment_date",
        f"IF({days} = 0 OR id % 89 = 0, NULL, TIMESTAMP'2020-01-01 00:00:00' + MAKE_INTERVAL(0, 0, 0, 0, CAST(id * 5 % 24 AS INT))) AS appointment_time",
        "IF(id % 3 = 0, NULL, id % 2 = 0) AS no_show",
    )


@pytest.mark.parametrize("pid, days", [
    ("IF(id % 3 = 0, 'hot', CAST(id AS STRING))", 0),  # a third of the rows, none with a date
    ("IF(id % 10 < 4, 'a', IF(id % 10 < 8, NULL, CAST(id AS STRING)))", 400),  # a patient and the rows without one
    ("'a'", 1),  # one day of one patient
])
def test_hot_patients_are_spread_over_tasks(spark, pid, days):
    """The values of one window per patient, and no task of the sums holds twice the median."""
    df = _many_visits(spark, pid, days)
    assert _hist_rows(calculate_patient_history(df)) == _hist_rows(calculate_patient_history(df, split=False))
    hot = features.hot_keys(df, "patient_id")
    order = ["appointment_date", "appointment_time", "appointment_id"]
    ranges = features._history_ranges(df.filter(hot.has()), hot, order, "no_show")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [r["count"] for r in ranges.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) == hot.pieces and max(tasks) < 2 * sorted(tasks)[len(tasks) // 2]


def test_salted_join_spreads_a_hot_patient(spark):
    df = _many_visits(spark, "IF(id % 3 = 0, 'hot', CAST(id AS STRING))", 30)
    pats = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3), (None, 4)], "patient_id string, v int")
    hot = features.hot_keys(df, "patient_id")
    assert hot.values == ["hot"]
    rows = df.filter(hot.has())
    want = rows.join(pats, "patient_id", "left")
    got = features.salted_left_join(rows, pats, hot, ["appointment_id"])
    assert got.columns == want.columns and got.count() == 40000 and got.exceptAll(want).isEmpty()
    salts = rows.groupBy(F.pmod(F.xxhash64("appointment_id"), F.lit(hot.pieces))).count().collect()
    assert len(salts) == hot.pieces and max(r["count"] for r in salts) < 2 * min(r["count"] for r in salts)


def test_only_large_patients_leave_the_plain_plan(spark):
    df = _many_visits(spark, "CAST(id % 100 AS STRING)", 30)
    assert not features.hot_keys(df, "patient_id")
    plan = calculate_patient_history(df)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bWindow \[", plan)) == 1 and "Union" not in plan
    assert len(features.hot_keys(df, "patient_id", 1).values) <= 8


def test_running_sums_inclusive_with_groups(spark):
    df = spark.range(0, 600).selectExpr("CAST(id % 3 AS STRING) AS g", "id", "id % 5 AS v")
    out = running_sums(df, ["g"], ["id"], {"s": F.col("v")}, n_chunks=4, inclusive=True).collect()
    acc = {}
    for r in sorted(out, key=lambda r: r.id):
        acc[r.g] = acc.get(r.g, 0) + r.v
        assert r.s == acc[r.g]
