"""Registered queries: one per operator of the inventory, each with its oracle.

Every query reads the driver tables of ``sf_dir`` (through the clinic views
of ``carelake.sources.fixtures``) over their whole extent.  ``ORACLE`` holds
the equivalent DuckDB SQL for the keys whose result is expressible in SQL;
keys without an entry get the weaker rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.oracle import with_fixtures
from carelake.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed values shared by the checks: the reference date replacing
# current_date(), and the load instant replacing current_timestamp().
AS_OF = "2001-01-01"
AS_OF_TS = "2001-01-01 00:00:00"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn

    return deco


def _views(spark: SparkSession, sf_dir: str):
    return fx.appointments(spark, sf_dir), fx.patients(spark, sf_dir), fx.physicians(spark, sf_dir)


# --------------------------------------------------------------------------
# C1 flagship: appointment features
# --------------------------------------------------------------------------

FEATURES_SQL = """
SELECT a.appointment_id, a.patient_id, a.physician_id, a.appointment_date, a.appointment_time,
  CAST(floor(date_diff('day', p.date_of_birth, a.appointment_date) / CAST(365.25 AS DOUBLE)) AS INTEGER) AS patient_age,
  p.gender AS patient_gender,
  d.specialty AS physician_specialty,
  CAST(date_diff('day', CAST(a.created_at AS DATE), a.appointment_date) AS INTEGER) AS appointment_lead_days,
  CAST(sum(CAST(a.no_show AS INTEGER)) OVER w AS INTEGER) AS previous_no_shows,
  CAST(count(*) OVER w AS INTEGER) AS previous_appointments,
  CAST(CASE WHEN count(*) OVER w > 0
       THEN CAST(CAST(sum(CAST(a.no_show AS INTEGER)) OVER w AS DOUBLE) / count(*) OVER w AS FLOAT)
       ELSE 0.0 END AS FLOAT) AS no_show_rate,
  dayname(a.appointment_time) AS day_of_week,
  coalesce(isodow(a.appointment_time) IN (6, 7), FALSE) AS is_weekend,
  CAST(hour(a.appointment_time) AS INTEGER) AS appointment_hour,
  CASE WHEN month(a.appointment_time) IN (12, 1, 2) THEN 'Winter'
       WHEN month(a.appointment_time) IN (3, 4, 5) THEN 'Spring'
       WHEN month(a.appointment_time) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  a.no_show
FROM appointments a
LEFT JOIN patients p ON a.patient_id = p.patient_id
LEFT JOIN physicians d ON a.physician_id = d.physician_id
WINDOW w AS (PARTITION BY a.patient_id
             ORDER BY a.appointment_date NULLS FIRST, a.appointment_time NULLS FIRST, a.appointment_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


# A third of the visits belongs to one patient and has no date, the rest is as it is.
SKEWED_SQL = """(SELECT * REPLACE (
    CASE WHEN CAST(appointment_id AS BIGINT) % 3 = 0 THEN '1' ELSE patient_id END AS patient_id,
    CASE WHEN CAST(appointment_id AS BIGINT) % 3 = 0 THEN NULL ELSE appointment_date END AS appointment_date,
    CASE WHEN CAST(appointment_id AS BIGINT) % 3 = 0 THEN NULL ELSE appointment_time END AS appointment_time)
  FROM appointments)"""


@register("appointment_features", FEATURES_SQL)
def q_appointment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from carelake.operators.features import generate_features

    return generate_features(*_views(spark, sf_dir))


@register("appointment_features_skewed", FEATURES_SQL.replace("FROM appointments a", f"FROM {SKEWED_SQL} a"))
def q_appointment_features_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship where one patient owns a third of the visits, all without a date."""
    from carelake.operators.features import generate_features

    _, p, d = _views(spark, sf_dir)
    return generate_features(fx.skewed_appointments(spark, sf_dir), p, d)


# --------------------------------------------------------------------------
# Features: single operators
# --------------------------------------------------------------------------

HISTORY_SQL = """
SELECT appointment_id, patient_id,
  count(*) OVER w AS previous_appointments,
  CAST(sum(CAST(no_show AS INTEGER)) OVER w AS BIGINT) AS previous_no_shows,
  CASE WHEN count(*) OVER w > 0
       THEN CAST(CAST(CAST(sum(CAST(no_show AS INTEGER)) OVER w AS DOUBLE) / count(*) OVER w AS FLOAT) AS DOUBLE)
       ELSE 0.0 END AS no_show_rate
FROM appointments
WINDOW w AS (PARTITION BY patient_id ORDER BY appointment_date NULLS FIRST, appointment_time NULLS FIRST, appointment_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""

HISTORY_COLS = ["appointment_id", "patient_id", "previous_appointments", "previous_no_shows", "no_show_rate"]


@register("patient_history", HISTORY_SQL)
def q_patient_history(spark, sf_dir):
    from carelake.operators.features import calculate_patient_history

    return calculate_patient_history(fx.appointments(spark, sf_dir)).select(*HISTORY_COLS)


@register("patient_history_skewed", HISTORY_SQL.replace("FROM appointments", f"FROM {SKEWED_SQL}"))
def q_patient_history_skewed(spark, sf_dir):
    """Histories where one patient owns a third of the visits, all without a date."""
    from carelake.operators.features import calculate_patient_history

    return calculate_patient_history(fx.skewed_appointments(spark, sf_dir)).select(*HISTORY_COLS)


@register(
    "datetime_features",
    """
SELECT appointment_id,
  CAST(hour(appointment_time) AS INTEGER) AS hour_of_day,
  dayname(appointment_time) AS day_of_week,
  CAST(day(appointment_time) AS INTEGER) AS day_of_month,
  CAST(month(appointment_time) AS INTEGER) AS month,
  CAST(quarter(appointment_time) AS INTEGER) AS quarter,
  CAST(year(appointment_time) AS INTEGER) AS year,
  coalesce(isodow(appointment_time) IN (6, 7), FALSE) AS is_weekend,
  CASE WHEN month(appointment_time) IN (12, 1, 2) THEN 'Winter'
       WHEN month(appointment_time) IN (3, 4, 5) THEN 'Spring'
       WHEN month(appointment_time) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM appointments
""",
)
def q_datetime_features(spark, sf_dir):
    from carelake.operators.features import extract_datetime_features

    out = extract_datetime_features(fx.appointments(spark, sf_dir))
    return out.select(
        "appointment_id", "hour_of_day", "day_of_week", "day_of_month", "month", "quarter", "year", "is_weekend", "season"
    )


@register(
    "patient_age",
    """
SELECT a.appointment_id,
  CAST(floor(date_diff('day', p.date_of_birth, a.appointment_date) / 365.25) AS INTEGER) AS patient_age
FROM appointments a LEFT JOIN patients p ON a.patient_id = p.patient_id
""",
)
def q_patient_age(spark, sf_dir):
    from carelake.operators.features import calculate_patient_age

    a, p, _ = _views(spark, sf_dir)
    df = a.select("appointment_id", "patient_id", "appointment_date").join(
        p.select("patient_id", "date_of_birth"), "patient_id", "left"
    )
    return calculate_patient_age(df).select("appointment_id", "patient_age")


@register(
    "lead_days",
    """
SELECT appointment_id,
  CAST(date_diff('day', CAST(created_at AS DATE), appointment_date) AS INTEGER) AS appointment_lead_days
FROM appointments
""",
)
def q_lead_days(spark, sf_dir):
    from carelake.operators.features import calculate_appointment_lead_time

    return calculate_appointment_lead_time(fx.appointments(spark, sf_dir)).select(
        "appointment_id", "appointment_lead_days"
    )


# --------------------------------------------------------------------------
# Transforms and joins
# --------------------------------------------------------------------------

PATIENTS_T_SQL = """
SELECT *, first_name || ' ' || last_name AS full_name,
  CAST(floor(date_diff('day', date_of_birth, DATE '2001-01-01') / 365.25) AS BIGINT) AS age,
  TIMESTAMP '2001-01-01 00:00:00' AS processed_timestamp
FROM patients
"""

PHYSICIANS_T_SQL = """
SELECT * FROM (
  SELECT *, first_name || ' ' || last_name AS full_name,
    CAST(floor(date_diff('day', hire_date, DATE '2001-01-01') / 365.25) AS BIGINT) AS years_employed,
    TIMESTAMP '2001-01-01 00:00:00' AS processed_timestamp
  FROM physicians) t
QUALIFY row_number() OVER (PARTITION BY physician_id ORDER BY updated_at DESC NULLS LAST,
  first_name DESC NULLS LAST, last_name DESC NULLS LAST, specialty DESC NULLS LAST,
  license_number DESC NULLS LAST, email DESC NULLS LAST, contact_number DESC NULLS LAST,
  department DESC NULLS LAST, hire_date DESC NULLS LAST, status DESC NULLS LAST,
  created_at DESC NULLS LAST, full_name DESC NULLS LAST, years_employed DESC NULLS LAST,
  processed_timestamp DESC NULLS LAST) = 1
"""

APPT_T_COLS = """a.*, dayname(a.appointment_date) AS day_of_week,
  coalesce(isodow(a.appointment_date) IN (6, 7), FALSE) AS is_weekend,
  TIMESTAMP '2001-01-01 00:00:00' AS processed_timestamp"""

APPT_T_SQL = f"SELECT {APPT_T_COLS} FROM appointments a"

ENRICH_PATIENT_SQL = f"""
SELECT {APPT_T_COLS}, p.first_name || ' ' || p.last_name AS patient_name
FROM appointments a LEFT JOIN patients p ON a.patient_id = p.patient_id
"""

ENRICH_BOTH_SQL = f"""
SELECT {APPT_T_COLS}, p.first_name || ' ' || p.last_name AS patient_name,
  d.first_name || ' ' || d.last_name AS physician_name, d.specialty
FROM appointments a
LEFT JOIN patients p ON a.patient_id = p.patient_id
LEFT JOIN physicians d ON a.physician_id = d.physician_id
"""


@register("transform_patients", PATIENTS_T_SQL)
def q_transform_patients(spark, sf_dir):
    from carelake.operators.transforms import transform_patients

    return transform_patients(fx.patients(spark, sf_dir), AS_OF_TS)


@register("transform_physicians", PHYSICIANS_T_SQL)
def q_transform_physicians(spark, sf_dir):
    from carelake.operators.transforms import transform_physicians

    return transform_physicians(fx.physicians(spark, sf_dir), AS_OF_TS)


@register("transform_appointments", APPT_T_SQL)
def q_transform_appointments(spark, sf_dir):
    from carelake.operators.transforms import transform_appointments

    return transform_appointments(fx.appointments(spark, sf_dir), as_of=AS_OF_TS)


@register("enrich_patient", ENRICH_PATIENT_SQL)
def q_enrich_patient(spark, sf_dir):
    from carelake.operators.transforms import transform_appointments, transform_patients

    a, p, _ = _views(spark, sf_dir)
    return transform_appointments(a, transform_patients(p, AS_OF_TS), None, AS_OF_TS)


@register(
    "enrich_physician",
    f"""
SELECT {APPT_T_COLS}, d.first_name || ' ' || d.last_name AS physician_name, d.specialty
FROM appointments a LEFT JOIN physicians d ON a.physician_id = d.physician_id
""",
)
def q_enrich_physician(spark, sf_dir):
    """Physician enrichment alone (the patient table is not given)."""
    from carelake.operators.transforms import transform_appointments, transform_physicians

    a, _, d = _views(spark, sf_dir)
    return transform_appointments(a, None, transform_physicians(d, AS_OF_TS), AS_OF_TS)


@register("enrich_both", ENRICH_BOTH_SQL)
def q_enrich_both(spark, sf_dir):
    from carelake.operators.transforms import transform_appointments, transform_patients, transform_physicians

    a, p, d = _views(spark, sf_dir)
    return transform_appointments(a, transform_patients(p, AS_OF_TS), transform_physicians(d, AS_OF_TS), AS_OF_TS)


@register(
    "audit_columns",
    """
SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS etl_timestamp, DATE '2001-01-01' AS etl_date,
  '20010101000000' AS etl_batch_id
FROM physicians
""",
)
def q_audit_columns(spark, sf_dir):
    from carelake.operators.transforms import add_audit_columns

    return add_audit_columns(fx.physicians(spark, sf_dir), AS_OF_TS)


@register(
    "upcoming",
    "SELECT * FROM appointments WHERE appointment_date > DATE '2001-01-01' AND status = 'Scheduled'",
)
def q_upcoming(spark, sf_dir):
    from carelake.operators.transforms import upcoming_appointments

    return upcoming_appointments(fx.appointments(spark, sf_dir), AS_OF)


PARTITION_COLS_SQL = """
SELECT *, CAST(year(appointment_date) AS INTEGER) AS year, CAST(month(appointment_date) AS INTEGER) AS month,
  CAST(day(appointment_date) AS INTEGER) AS day
FROM appointments
"""


@register("partition_columns", PARTITION_COLS_SQL)
def q_partition_columns(spark, sf_dir):
    from carelake.operators.transforms import add_partition_columns

    return add_partition_columns(fx.appointments(spark, sf_dir))


@register(
    "surrogate_key",
    "SELECT count(*) AS row_count, count(*) AS distinct_keys FROM appointments",
)
def q_surrogate_key(spark, sf_dir):
    from pyspark.sql import functions as F

    from carelake.operators.transforms import add_surrogate_key

    keyed = add_surrogate_key(fx.appointments(spark, sf_dir))
    return keyed.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("surrogate_key").alias("distinct_keys"))


@register(
    "conform_schema",
    """
SELECT appointment_id, patient_id, physician_id, appointment_date,
  CAST(appointment_time AS TIMESTAMP) AS appointment_time,
  CAST(NULL AS INTEGER) AS patient_age, CAST(NULL AS VARCHAR) AS patient_gender,
  CAST(NULL AS VARCHAR) AS physician_specialty,
  CAST(date_diff('day', CAST(created_at AS DATE), appointment_date) AS INTEGER) AS appointment_lead_days,
  CAST(NULL AS INTEGER) AS previous_no_shows, CAST(NULL AS INTEGER) AS previous_appointments,
  CAST(NULL AS FLOAT) AS no_show_rate,
  dayname(appointment_time) AS day_of_week,
  coalesce(isodow(appointment_time) IN (6, 7), FALSE) AS is_weekend,
  CAST(hour(appointment_time) AS INTEGER) AS appointment_hour,
  CASE WHEN month(appointment_time) IN (12, 1, 2) THEN 'Winter'
       WHEN month(appointment_time) IN (3, 4, 5) THEN 'Spring'
       WHEN month(appointment_time) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  no_show
FROM appointments
""",
)
def q_conform_schema(spark, sf_dir):
    """Partial feature frame (no joins, no history) conformed to the declared feature schema."""
    from carelake.operators.features import (
        calculate_appointment_lead_time,
        conform_to_schema,
        extract_datetime_features,
    )
    from carelake.schemas import FEATURES

    df = calculate_appointment_lead_time(extract_datetime_features(fx.appointments(spark, sf_dir)))
    return conform_to_schema(df.withColumnRenamed("hour_of_day", "appointment_hour"), FEATURES)


# --------------------------------------------------------------------------
# Quality and summaries
# --------------------------------------------------------------------------


@register(
    "contract_check",
    """
SELECT 'patient_id' AS column_name, TRUE AS present, CAST(count_if(patient_id IS NULL) AS BIGINT) AS null_rows,
  CAST(count(patient_id) - count(DISTINCT patient_id) AS BIGINT) AS duplicate_rows FROM patients
UNION ALL SELECT 'first_name', TRUE, CAST(count_if(first_name IS NULL) AS BIGINT), NULL FROM patients
UNION ALL SELECT 'last_name', TRUE, CAST(count_if(last_name IS NULL) AS BIGINT), NULL FROM patients
UNION ALL SELECT 'gender', TRUE, CAST(count_if(gender IS NULL) AS BIGINT), NULL FROM patients
UNION ALL SELECT 'clinic_id', FALSE, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
""",
)
def q_contract_check(spark, sf_dir):
    from carelake.operators.quality import contract_check

    return contract_check(
        fx.patients(spark, sf_dir), ["patient_id", "first_name", "last_name", "gender", "clinic_id"], ["patient_id"]
    )


@register(
    "contract_check_composite",
    """
SELECT c AS column_name, c <> 'l_missing' AS present, CASE WHEN c <> 'l_missing' THEN CAST(0 AS BIGINT) END AS null_rows,
  CASE WHEN c IN ('l_orderkey', 'l_linenumber') THEN
    (SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem) END AS duplicate_rows
FROM (VALUES ('l_orderkey'), ('l_linenumber'), ('l_shipdate'), ('l_missing')) AS t(c)
""",
)
def q_contract_check_composite(spark, sf_dir):
    """A key of two columns, and a required column that is missing."""
    from carelake.operators.quality import contract_check

    required = ["l_orderkey", "l_linenumber", "l_shipdate", "l_missing"]
    return contract_check(fx.table(spark, sf_dir, "lineitem"), required, ["l_orderkey", "l_linenumber"])


@register(
    "contract_check_missing_key",
    "SELECT 'id' AS column_name, FALSE AS present, CAST(NULL AS BIGINT) AS null_rows, CAST(NULL AS BIGINT) AS duplicate_rows "
    "UNION ALL SELECT 'name', TRUE, CAST(count_if(name IS NULL) AS BIGINT), NULL FROM (SELECT n_name AS name FROM nation)",
)
def q_contract_check_missing_key(spark, sf_dir):
    from carelake.operators.quality import contract_check

    nation = fx.table(spark, sf_dir, "nation").withColumnRenamed("n_name", "name")
    return contract_check(nation, ["id", "name"], ["id"])


@register(
    "dedup_latest",
    """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
  l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
  l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1
""",
)
def q_dedup_latest(spark, sf_dir):
    from carelake.operators.quality import dedup_latest

    return dedup_latest(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@register(
    "dedup_any",
    "SELECT physician_id, count(*) AS kept, TRUE AS from_input FROM physicians GROUP BY physician_id HAVING count(*) >= 1",
)
def q_dedup_any(spark, sf_dir):
    """``transform_physicians(keep="any")`` on a doubled table: one row per physician, and it is one of the input's."""
    from pyspark.sql import functions as F

    from carelake.operators.transforms import transform_physicians

    rows = fx.physicians(spark, sf_dir)
    doubled = rows.union(rows.withColumn("last_name", F.concat("last_name", F.lit("-2"))))
    out = transform_physicians(doubled, AS_OF_TS, keep="any")
    given = doubled.select("physician_id", "last_name").distinct().withColumn("known", F.lit(True))
    out = out.join(given, ["physician_id", "last_name"], "left")
    return out.groupBy("physician_id").agg(
        F.count("*").alias("kept"), F.min(F.coalesce("known", F.lit(False))).alias("from_input")
    )


_DESCRIBED = [
    "appointment_id", "patient_id", "physician_id", "patient_age", "patient_gender", "physician_specialty", "appointment_lead_days",
    "previous_no_shows", "previous_appointments", "no_show_rate", "day_of_week", "appointment_hour", "season",
]


def _described(row: str, value: str) -> str:
    return f"SELECT '{row}' AS summary, " + ", ".join(f"{value.format(c=c)} AS {c}" for c in _DESCRIBED) + " FROM f"


@register(
    "describe_summary",
    f", f AS ({FEATURES_SQL})\n"
    + "\nUNION ALL ".join([
        _described("count", "CAST(count({c}) AS VARCHAR)"),
        _described("mean", "printf('%.4f', avg(TRY_CAST({c} AS DOUBLE)))"),
        _described("stddev", "printf('%.4f', stddev_samp(TRY_CAST({c} AS DOUBLE)))"),
        _described("min", "CAST(min({c}) AS VARCHAR)"),
        _described("max", "CAST(max({c}) AS VARCHAR)"),
    ]),
)
def q_describe_summary(spark, sf_dir):
    """The string summary of the feature table: all five rows of its numeric and string columns; means to four digits."""
    from pyspark.sql import functions as F

    from carelake.operators.features import generate_features
    from carelake.operators.quality import describe

    out = describe(generate_features(*_views(spark, sf_dir)))
    digits = [F.when(F.col("summary").isin("mean", "stddev"), F.format_string("%.4f", F.col(c).cast("double"))).otherwise(F.col(c)).alias(c) for c in _DESCRIBED]
    missing = [F.when(F.col(c) != "null", F.col(c)).alias(c) for c in _DESCRIBED]
    return out.select("summary", *digits).select("summary", *missing)


_PATIENT_TYPES = [
    ("patient_id", "string"), ("first_name", "string"), ("last_name", "string"), ("date_of_birth", "date"),
    ("gender", "string"), ("contact_number", "string"), ("email", "string"), ("address", "string"),
    ("city", "string"), ("state", "string"), ("zip_code", "string"), ("insurance_provider", "string"),
    ("insurance_id", "string"), ("created_at", "timestamp_ntz"), ("updated_at", "timestamp_ntz"),
]


@register(
    "profile_table",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, count(DISTINCT {c}) AS distinct_count FROM patients"
        for c, t in _PATIENT_TYPES
    ),
)
def q_profile_table(spark, sf_dir):
    from carelake.operators.quality import profile_table

    return profile_table(fx.patients(spark, sf_dir), exact=True)


_APPOINTMENT_COLS = ["appointment_id", "patient_id", "physician_id", "appointment_time", "status", "no_show", "created_at"]


@register(
    "profile_merged",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count, TRUE AS estimate_within_error FROM appointments"
        for c in _APPOINTMENT_COLS
    ),
)
def q_profile_merged(spark, sf_dir):
    """Sketches stored by year in two runs, the second of which replaces a year that was half there, and merged;
    the estimates against exact counts: four standard errors."""
    from pyspark.sql import functions as F

    from carelake.operators.quality import profile_table, update_profile
    from carelake.session import scratch_path

    rows = fx.appointments(spark, sf_dir).select(*_APPOINTMENT_COLS, F.year("appointment_date").alias("visit_year"))
    path = scratch_path(spark, "profile")
    late = F.coalesce(F.col("visit_year") >= 1995, F.lit(False))
    update_profile(rows.filter(~late | ((F.col("visit_year") == 1995) & (F.crc32("appointment_id") % 2 == 0))), "visit_year", path)
    merged = update_profile(rows.filter(late), "visit_year", path).withColumnRenamed("distinct_count", "estimate")
    exact = profile_table(rows.drop("visit_year"), exact=True).select("column_name", "distinct_count")
    within = F.abs(F.col("estimate") - F.col("distinct_count")) <= 4 * 1.04 / 64 * F.col("distinct_count")
    return merged.join(exact, "column_name").select("column_name", "row_count", "null_count", "distinct_count", within.alias("estimate_within_error"))


_NUMERIC_FEATURES = [
    "patient_age", "appointment_lead_days", "previous_no_shows", "previous_appointments", "no_show_rate",
    "appointment_hour",
]


@register(
    "describe_features",
    f", f AS ({FEATURES_SQL})\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
        f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM f"
        for c in _NUMERIC_FEATURES
    ),
)
def q_describe_features(spark, sf_dir):
    from carelake.operators.features import generate_features
    from carelake.operators.quality import describe_long

    a, p, d = _views(spark, sf_dir)
    return describe_long(generate_features(a, p, d), _NUMERIC_FEATURES)


@register(
    "row_counts",
    """
SELECT 'patients' AS table_name, count(*) AS row_count FROM patients
UNION ALL SELECT 'physicians', count(*) FROM physicians
UNION ALL SELECT 'appointments', count(*) FROM appointments
""",
)
def q_row_counts(spark, sf_dir):
    from carelake.operators.quality import row_counts

    a, p, d = _views(spark, sf_dir)
    return row_counts({"patients": p, "physicians": d, "appointments": a})


@register("preview", "SELECT * FROM appointments ORDER BY appointment_date, appointment_id LIMIT 10")
def q_preview(spark, sf_dir):
    from carelake.operators.quality import preview

    return preview(fx.appointments(spark, sf_dir), ["appointment_date", "appointment_id"], 10)


@register(
    "split_by_key",
    """
SELECT appointment_id,
  CASE WHEN substring(md5(appointment_id), 1, 4) < 'cccd' THEN 'train' ELSE 'test' END AS split
FROM appointments
""",
)
def q_split_by_key(spark, sf_dir):
    from carelake.operators.ml import split_label

    return split_label(fx.appointments(spark, sf_dir).select("appointment_id"), "appointment_id")


# --------------------------------------------------------------------------
# Sources and sinks (S1-S14) and the composite ETL jobs
# --------------------------------------------------------------------------


def _uid() -> str:
    import uuid

    return uuid.uuid4().hex[:10]


def _staged(spark, sf_dir, entity):
    from carelake.plans.etl import stage_csv
    from carelake.session import scratch_path

    view = {"patients": fx.patients, "physicians": fx.physicians, "appointments": fx.appointments}[entity]
    return stage_csv(view(spark, sf_dir), scratch_path(spark, f"landing-{entity}"))


# Spark's reader takes an empty field for a missing one.
LANDED_PATIENTS = "FROM (SELECT * REPLACE (nullif(address, '') AS address) FROM patients) patients"


@register("scan_csv_patients", f"SELECT * {LANDED_PATIENTS}")
def q_scan_csv_patients(spark, sf_dir):
    from carelake.sources.readers import extract_patients

    return extract_patients(spark, _staged(spark, sf_dir, "patients"))


@register("scan_csv_physicians", "SELECT * FROM physicians")
def q_scan_csv_physicians(spark, sf_dir):
    from carelake.sources.readers import extract_physicians

    return extract_physicians(spark, _staged(spark, sf_dir, "physicians"))


@register("scan_csv_appointments", "SELECT * FROM appointments")
def q_scan_csv_appointments(spark, sf_dir):
    from carelake.sources.readers import extract_appointments

    return extract_appointments(spark, _staged(spark, sf_dir, "appointments"))


@register("scan_catalog", "SELECT * FROM patients")
def q_scan_catalog(spark, sf_dir):
    from carelake.session import scratch_path
    from carelake.sources.readers import read_table
    from carelake.sources.sinks import publish_table

    name = f"patients_{_uid()}"
    publish_table(fx.patients(spark, sf_dir), name, scratch_path(spark, name))
    return read_table(spark, name)


@register("publish_table", "SELECT * FROM appointments")
def q_publish_table(spark, sf_dir):
    from carelake.session import scratch_path
    from carelake.sources.sinks import publish_table

    name = f"appointments_{_uid()}"
    return publish_table(fx.appointments(spark, sf_dir), name, scratch_path(spark, name))


@register("partitioned_roundtrip", PARTITION_COLS_SQL)
def q_partitioned_roundtrip(spark, sf_dir):
    from carelake.operators.transforms import add_partition_columns
    from carelake.session import scratch_path
    from carelake.sources.sinks import write_path

    path = scratch_path(spark, "appointments-by-month")
    write_path(add_partition_columns(fx.appointments(spark, sf_dir)), path, partition_by=["year", "month"])
    return spark.read.parquet(path)


@register(
    "audited_append",
    """
SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS etl_timestamp, DATE '2001-01-01' AS etl_date,
  '20010101000000' AS etl_batch_id FROM physicians
UNION ALL
SELECT *, TIMESTAMP '2001-01-02 06:30:00' AS etl_timestamp, DATE '2001-01-02' AS etl_date,
  '20010102063000' AS etl_batch_id FROM physicians
""",
)
def q_audited_append(spark, sf_dir):
    """Audited sink: an overwrite load followed by an append load of a second batch."""
    from carelake.session import scratch_path
    from carelake.sources.sinks import publish_audited

    name = f"physicians_audit_{_uid()}"
    path = scratch_path(spark, name)
    d = fx.physicians(spark, sf_dir)
    publish_audited(d, name, path, "overwrite", as_of=AS_OF_TS)
    return publish_audited(d, name, path, "append", as_of="2001-01-02 06:30:00")


# S8 under the inventory's own name: the audited sink in overwrite mode.
@register(
    "publish_audited",
    """
SELECT *, TIMESTAMP '2001-01-01 00:00:00' AS etl_timestamp, DATE '2001-01-01' AS etl_date,
  '20010101000000' AS etl_batch_id FROM physicians
""",
)
def q_publish_audited(spark, sf_dir):
    from carelake.session import scratch_path
    from carelake.sources.sinks import publish_audited

    name = f"physicians_audited_{_uid()}"
    return publish_audited(fx.physicians(spark, sf_dir), name, scratch_path(spark, name), "overwrite", as_of=AS_OF_TS)


@register("feature_table", FEATURES_SQL)
def q_feature_table(spark, sf_dir):
    from carelake.operators.features import generate_features
    from carelake.plans.training import create_feature_table
    from carelake.session import scratch_path

    a, p, d = _views(spark, sf_dir)
    name = f"appointment_features_{_uid()}"
    return create_feature_table(spark, generate_features(a, p, d, conform=False), name, scratch_path(spark, name))


@register("view_filter_table", "SELECT * FROM trips WHERE fare_amount < 30")
def q_view_filter_table(spark, sf_dir):
    from carelake.plans.etl import view_filter_table
    from carelake.session import scratch_path

    name = f"filtered_taxis_{_uid()}"
    return view_filter_table(spark, fx.trips(spark, sf_dir), name, scratch_path(spark, name), f"taxi_raw_{_uid()}")


@register("etl_patients", PATIENTS_T_SQL.replace("FROM patients", LANDED_PATIENTS))
def q_etl_patients(spark, sf_dir):
    from carelake.plans.etl import run_patients
    from carelake.session import scratch_path

    name = f"patients_{_uid()}"
    return run_patients(spark, _staged(spark, sf_dir, "patients"), scratch_path(spark, name), name, AS_OF_TS)


@register("etl_physicians", PHYSICIANS_T_SQL)
def q_etl_physicians(spark, sf_dir):
    from carelake.plans.etl import run_physicians
    from carelake.session import scratch_path

    name = f"physicians_{_uid()}"
    return run_physicians(spark, _staged(spark, sf_dir, "physicians"), scratch_path(spark, name), name, AS_OF_TS)


@register("etl_appointments", ENRICH_PATIENT_SQL)
def q_etl_appointments(spark, sf_dir):
    """Appointment job with only the patient table given (physician enrichment skipped)."""
    from carelake.plans.etl import run_appointments, run_patients
    from carelake.session import scratch_path

    pt = f"patients_{_uid()}"
    run_patients(spark, _staged(spark, sf_dir, "patients"), scratch_path(spark, pt), pt, AS_OF_TS)
    at = f"appointments_{_uid()}"
    return run_appointments(
        spark, _staged(spark, sf_dir, "appointments"), scratch_path(spark, at), pt, None, at, AS_OF_TS
    )


@register("daily_etl", ENRICH_BOTH_SQL)
def q_daily_etl(spark, sf_dir):
    from carelake.plans.etl import daily_etl
    from carelake.session import scratch_path

    sources = {e: _staged(spark, sf_dir, e) for e in ("patients", "physicians", "appointments")}
    db = f"clinic_{_uid()}"
    return daily_etl(spark, sources, scratch_path(spark, db), db, AS_OF_TS)["appointments"]


@register("daily_etl_bucketed", ENRICH_BOTH_SQL)
def q_daily_etl_bucketed(spark, sf_dir):
    """The daily run with patients and appointments bucketed on patient_id, as asked."""
    from carelake.plans.etl import daily_etl
    from carelake.session import scratch_path

    sources = {n: _staged(spark, sf_dir, n) for n in ("patients", "physicians", "appointments")}
    db = f"clinic_{_uid()}"
    return daily_etl(spark, sources, scratch_path(spark, db), db, AS_OF_TS, buckets=4)["appointments"]


@register(
    "daily_etl_rejects",
    """SELECT 'appointments' AS landed_in, appointment_id, NULL AS reason FROM appointments
WHERE CAST(appointment_id AS BIGINT) % 11 <> 0 AND CAST(appointment_id AS BIGINT) % 13 <> 0
UNION ALL SELECT 'rejects', CASE WHEN CAST(appointment_id AS BIGINT) % 13 <> 0 THEN appointment_id END,
  concat_ws('; ', CASE WHEN CAST(appointment_id AS BIGINT) % 11 = 0 THEN 'appointment_date: bad value; duration_minutes: bad value' END,
            CASE WHEN CAST(appointment_id AS BIGINT) % 11 <> 0 THEN 'appointment_id: missing' END)
FROM appointments WHERE CAST(appointment_id AS BIGINT) % 11 = 0 OR CAST(appointment_id AS BIGINT) % 13 = 0""",
)
def q_daily_etl_rejects(spark, sf_dir):
    """The daily run over files with bad dates and numbers and missing keys: what landed in which of the two tables."""
    from pyspark.sql import functions as F

    from carelake.plans.etl import daily_etl, stage_csv
    from carelake.session import scratch_path

    sources = {e: _staged(spark, sf_dir, e) for e in ("patients", "physicians")}
    bad, key = "CAST(appointment_id AS BIGINT) % 11 = 0", "CAST(appointment_id AS BIGINT) % 13 = 0"
    broken = {
        "appointment_id": f"IF({key}, NULL, appointment_id) AS appointment_id",
        "appointment_date": f"IF({bad}, '31.12.99', CAST(appointment_date AS STRING)) AS appointment_date",
        "duration_minutes": f"IF({bad}, 'an hour, about', CAST(duration_minutes AS STRING)) AS duration_minutes",
    }
    rows = fx.appointments(spark, sf_dir)
    sources["appointments"] = stage_csv(rows.selectExpr(*[broken.get(c, c) for c in rows.columns]), scratch_path(spark, "landing-broken"))
    db = f"clinic_{_uid()}"
    good = daily_etl(spark, sources, scratch_path(spark, db), db, AS_OF_TS, rejects=True)["appointments"]
    first = F.when(~F.col("raw_record").startswith(","), F.substring_index("raw_record", ",", 1))
    return good.select(F.lit("appointments").alias("landed_in"), "appointment_id", F.lit(None).cast("string").alias("reason")).unionByName(
        spark.table(f"{db}.appointments_rejects").select(F.lit("rejects").alias("landed_in"), first.alias("appointment_id"), "reason")
    )


@register("file_inventory", "SELECT TRUE AS all_csv, TRUE AS no_empty_file, count(*) AS n_rows FROM appointments")
def q_file_inventory(spark, sf_dir):
    """The CSV part files of a staged landing folder: their names, sizes, and the rows read back through them."""
    from pyspark.sql import functions as F

    from carelake.sources.readers import extract_appointments, file_inventory

    path = _staged(spark, sf_dir, "appointments")
    files = file_inventory(spark, path, recursive=True, glob="*.csv")
    facts = files.agg(F.min(F.col("path").endswith(".csv")).alias("all_csv"), F.min(F.col("length") > 0).alias("no_empty_file"))
    rows = extract_appointments(spark, path).agg(F.count("*").alias("n_rows"))
    return facts.withColumn("k", F.lit(1)).join(rows.withColumn("k", F.lit(1)), "k").drop("k")


_LINE = "appointment_id || ',' || coalesce(patient_id, '')"


@register(
    "inventory_changes",
    f""", l AS (
  SELECT 'visit_year=' || year(appointment_date) AS folder, year(appointment_date) AS y, octet_length(encode({_LINE})) + 1 AS b,
         appointment_id FROM appointments WHERE appointment_date IS NOT NULL
), a AS (
  SELECT folder, count(*) AS n, sum(b) AS b FROM l WHERE y <= 1996 AND (y <> 1995 OR CAST(appointment_id AS BIGINT) % 2 = 0) GROUP BY folder
), b AS (SELECT folder, count(*) AS n, sum(b) AS b FROM l WHERE y >= 1994 GROUP BY folder)
SELECT coalesce(a.folder, b.folder) AS folder,
       CASE WHEN a.folder IS NULL THEN 'added' WHEN b.folder IS NULL THEN 'removed'
            WHEN a.n = b.n AND a.b = b.b THEN 'unchanged' ELSE 'changed' END AS status,
       CAST(a.b AS BIGINT) AS old_length, CAST(b.b AS BIGINT) AS new_length, a.n AS old_n_rows, b.n AS new_n_rows
FROM a FULL JOIN b ON a.folder = b.folder""",
)
def q_inventory_changes(spark, sf_dir):
    """Two inventories of a landing folder, before and after a delivery that adds, drops, completes and repeats years."""
    from pyspark.sql import functions as F

    from carelake.session import scratch_path
    from carelake.sources.readers import inventory_changes, inventory_with_rows

    lines = fx.appointments(spark, sf_dir).filter("appointment_date IS NOT NULL").select(
        F.expr(_LINE).alias("value"), F.year("appointment_date").alias("visit_year"), "appointment_id"
    )
    path = scratch_path(spark, "deliveries")

    def delivered(rows):
        rows.select("value", "visit_year").write.mode("overwrite").partitionBy("visit_year").text(path)
        files = inventory_with_rows(spark, path, recursive=True, glob="*.txt", header=False)
        folder = F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder")
        totals = files.groupBy(folder).agg(F.sum("length").alias("length"), F.sum("n_rows").alias("n_rows"))
        kept = scratch_path(spark, "inventory")
        totals.write.parquet(kept)
        return spark.read.parquet(kept)

    half = (F.col("visit_year") != 1995) | (F.col("appointment_id").cast("bigint") % 2 == 0)
    before = delivered(lines.filter((F.col("visit_year") <= 1996) & half))
    after = delivered(lines.filter("visit_year >= 1994"))
    return inventory_changes(before, after, "folder", ("length", "n_rows"))


# --------------------------------------------------------------------------
# ML (M1-M9, A5-A6, P13-P15, S12-S13, C6)
# --------------------------------------------------------------------------


def _ml_features(spark, sf_dir):
    """Published feature table for the model keys (training iterates over it)."""
    from carelake.operators.features import generate_features
    from carelake.plans.training import create_feature_table
    from carelake.session import scratch_path

    a, p, d = _views(spark, sf_dir)
    name = f"ml_features_{_uid()}"
    return create_feature_table(spark, generate_features(a, p, d), name, scratch_path(spark, name))


def _forest(spark, sf_dir, **params):
    from carelake.operators.ml import train_and_evaluate

    features = _ml_features(spark, sf_dir)
    return features, *train_and_evaluate(features, run_id="run", **params)


_CATS = ["patient_gender", "physician_specialty", "day_of_week", "season"]


def _index_cte(c: str) -> str:
    return (
        f"ix_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i "
        f"FROM f WHERE {c} IS NOT NULL GROUP BY {c}),\n"
        f"n_{c} AS (SELECT count(*) AS n FROM ix_{c})"
    )


_INDEX_FROM = "FROM f " + " ".join(
    f"LEFT JOIN ix_{c} ON f.{c} = ix_{c}.v CROSS JOIN n_{c}" for c in _CATS
)

STRING_INDEX_SQL = (
    f", f AS ({FEATURES_SQL}),\n"
    + ",\n".join(_index_cte(c) for c in _CATS)
    + "\nSELECT f.appointment_id, "
    + ", ".join(f"CAST(coalesce(ix_{c}.i, n_{c}.n) AS DOUBLE) AS {c}_idx" for c in _CATS)
    + "\n"
    + _INDEX_FROM
)

ONE_HOT_SQL = (
    f", f AS ({FEATURES_SQL}),\n"
    + ",\n".join(_index_cte(c) for c in _CATS)
    + "\nSELECT f.appointment_id, "
    + ", ".join(
        f"list_transform(range(n_{c}.n), lambda j: CASE WHEN j = coalesce(ix_{c}.i, n_{c}.n) "
        f"THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
        f" AS {c}_vec"
        for c in _CATS
    )
    + "\n"
    + _INDEX_FROM
)


@register("string_index_dictionary", STRING_INDEX_SQL)
def q_string_index_dictionary(spark, sf_dir):
    """The same indices from dictionary tables joined to the rows."""
    from carelake.operators.ml import category_dictionary, index_by_dictionary

    features = _ml_features(spark, sf_dir)
    out = index_by_dictionary(features, {c: category_dictionary(features, c) for c in _CATS})
    return out.select("appointment_id", *[f"{c}_idx" for c in _CATS])


@register("string_index", STRING_INDEX_SQL)
def q_string_index(spark, sf_dir):
    from carelake.operators.ml import build_pipeline

    f = _ml_features(spark, sf_dir)
    pipeline, _ = build_pipeline()
    return pipeline.fit(f).transform(f).select("appointment_id", *[f"{c}_idx" for c in _CATS])


@register("one_hot", ONE_HOT_SQL)
def q_one_hot(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from carelake.operators.ml import build_pipeline

    f = _ml_features(spark, sf_dir)
    pipeline, _ = build_pipeline()
    out = pipeline.fit(f).transform(f)
    return out.select("appointment_id", *[vector_to_array(f"{c}_vec").alias(f"{c}_vec") for c in _CATS])


@register(
    "impute_zero",
    f", f AS ({FEATURES_SQL})\nSELECT appointment_id, "
    # Spark widens coalesce(float, 0) to double; DuckDB keeps float, hence the cast.
    + ", ".join(
        f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}_f" if c == "no_show_rate" else f"coalesce({c}, 0) AS {c}_f"
        for c in _NUMERIC_FEATURES
    )
    + ", CAST(no_show AS DOUBLE) AS label FROM f",
)
def q_impute_zero(spark, sf_dir):
    from carelake.operators.features import generate_features
    from carelake.operators.ml import _imputer, with_label

    a, p, d = _views(spark, sf_dir)
    out = with_label(_imputer(_NUMERIC_FEATURES).transform(generate_features(a, p, d)))
    return out.select("appointment_id", *[f"{c}_f" for c in _NUMERIC_FEATURES], "label")


@register(
    "eval_auc",
    f", f AS ({FEATURES_SQL}),\n"
    """s AS (SELECT CAST(no_show_rate AS DOUBLE) AS score, CAST(no_show AS INTEGER) AS y FROM f
         WHERE no_show IS NOT NULL AND no_show_rate IS NOT NULL),
r AS (SELECT y, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score)
                 + count(*) OVER (PARTITION BY score) - 1) / 2.0 AS avg_rank FROM s)
SELECT round((sum(CASE WHEN y = 1 THEN avg_rank ELSE 0 END)
              - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 9) AS auc,
       CAST(sum(y) AS BIGINT) AS positives, CAST(count(*) - sum(y) AS BIGINT) AS negatives
FROM r""",
)
def q_eval_auc(spark, sf_dir):
    """AUC of the prior no-show rate as a score for the no-show label (a data-derived score column).

    Rows without a label or without a score (no known prior flag) are left out."""
    from pyspark.sql import functions as F

    from carelake.operators.features import generate_features
    from carelake.operators.ml import auc_frame

    a, p, d = _views(spark, sf_dir)
    out = auc_frame(generate_features(a, p, d), "no_show_rate", "no_show")
    return out.select(F.round("auc", 9).alias("auc"), "positives", "negatives")


@register(
    "eval_accuracy",
    f", f AS ({FEATURES_SQL})\n"
    """SELECT round(avg(CASE WHEN (CASE WHEN no_show_rate >= 0.5 THEN 1.0 ELSE 0.0 END)
                              = CAST(no_show AS DOUBLE) THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
       count(*) AS n
FROM f WHERE no_show IS NOT NULL""",
)
def q_eval_accuracy(spark, sf_dir):
    """Accuracy of the rule ``prior no-show rate >= 0.5`` against the label."""
    from pyspark.sql import functions as F

    from carelake.operators.features import generate_features
    from carelake.operators.ml import accuracy_frame

    a, p, d = _views(spark, sf_dir)
    rule = F.when(F.col("no_show_rate") >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
    f = generate_features(a, p, d).withColumn("prediction", rule)
    return accuracy_frame(f, "prediction", "no_show").select(F.round("accuracy", 9).alias("accuracy"), "n")


_TEST_ROW = "substr(md5(appointment_id), 1, 4) >= 'cccd'"
_ONE_HOT_FEATURES = " || ".join(f"o.{c}_vec" for c in _CATS)
PREPARED_SQL = ONE_HOT_SQL.replace("\nSELECT f.appointment_id, ", ",\no AS (SELECT f.appointment_id, ", 1) + (
    f")\nSELECT f.appointment_id, {_ONE_HOT_FEATURES} || ["
    + ", ".join(f"CAST(coalesce(f.{c}, 0) AS DOUBLE)" for c in _NUMERIC_FEATURES)
    + "] AS features, CAST(f.no_show AS DOUBLE) AS label FROM f JOIN o ON f.appointment_id = o.appointment_id"
)


@register("prepared_features", PREPARED_SQL)
def q_prepared_features(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from carelake.operators.ml import prepare_training_data

    _, out, _ = prepare_training_data(_ml_features(spark, sf_dir), _CATS, _NUMERIC_FEATURES)
    return out.select("appointment_id", vector_to_array("features").alias("features"), "label")


_SCORED_SQL = (
    f", f AS ({FEATURES_SQL})\nSELECT appointment_id, CAST(no_show AS DOUBLE) AS label, TRUE AS in_range, "
    f"TRUE AS consistent FROM f WHERE no_show IS NOT NULL AND {_TEST_ROW}"
)


def _scored_test_rows(spark, sf_dir, train):
    """Fit on the prepared train split, score the test split; probabilities in range and in line with predictions."""
    from pyspark.sql import functions as F

    from carelake.operators.ml import apply_model, positive_score, prepare_training_data, split_by_key

    _, prepared, _ = prepare_training_data(_ml_features(spark, sf_dir))
    rows, test = split_by_key(prepared, "appointment_id")
    out = apply_model(train(rows), test.filter("label IS NOT NULL")).withColumn("p", positive_score())
    return out.select(
        "appointment_id", "label", F.col("p").between(0, 1).alias("in_range"),
        ((F.col("p") > 0.5).cast("double") == F.col("prediction")).alias("consistent"),
    )


@register("train_random_forest", _SCORED_SQL)
def q_train_random_forest(spark, sf_dir):
    from carelake.operators.ml import train_random_forest

    return _scored_test_rows(spark, sf_dir, train_random_forest)


@register("train_gbt", _SCORED_SQL)
def q_train_gbt(spark, sf_dir):
    from carelake.operators.ml import train_gbt

    return _scored_test_rows(spark, sf_dir, train_gbt)


# Trees of depth 1 in SQL: the best split over all midpoints of all values of these columns.
_STUMP_COLS = ["patient_age", "appointment_lead_days", "previous_no_shows", "previous_appointments", "appointment_hour"]
_STUMP = {"maxBins": 4096}
_STUMP_X = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS x{j}" for j, c in enumerate(_STUMP_COLS))
_STUMP_TRAIN = (
    f", f AS ({FEATURES_SQL}),\nr AS (SELECT appointment_id, {_TEST_ROW} AS test, {_STUMP_X}, CAST(no_show AS DOUBLE) AS label "
    "FROM f WHERE no_show IS NOT NULL)"
)


def _best_split(name: str, rows: str) -> str:
    """CTEs ``name``: one row (j, t, gain by variance, row counts, means) of the best split of y in ``rows``."""
    values = " UNION ALL ".join(f"SELECT {j} AS j, x{j} AS v, y FROM {rows}" for j in range(len(_STUMP_COLS)))
    return f"""{name}_v AS (
  SELECT j, v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q FROM ({values}) GROUP BY j, v
), {name}_c AS (
  SELECT j, (v + lead(v) OVER o) / 2 AS t, sum(n) OVER c AS nl, sum(s) OVER c AS sl, sum(q) OVER c AS ql,
         sum(n) OVER a AS n, sum(s) OVER a AS s, sum(q) OVER a AS q
  FROM {name}_v WINDOW o AS (PARTITION BY j ORDER BY v), c AS (PARTITION BY j ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY j)
), {name} AS (
  SELECT *, sl / nl AS lm, (s - sl) / (n - nl) AS rm,
         ((q - s * s / n) - (ql - sl * sl / nl) - ((q - ql) - (s - sl) * (s - sl) / (n - nl))) / n AS gain
  FROM {name}_c WHERE t IS NOT NULL ORDER BY gain DESC, j, t LIMIT 1
)"""


def _leaf(split: str) -> str:
    return f"CASE WHEN [{', '.join(f'x{j}' for j in range(len(_STUMP_COLS)))}][{split}.j + 1] <= {split}.t THEN {split}.lm ELSE {split}.rm END"


def _stump_rows(spark, sf_dir):
    """(train, test): labelled rows with the stump columns in ``features``."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    from carelake.operators.ml import split_by_key, with_label

    rows = with_label(_ml_features(spark, sf_dir).filter("no_show IS NOT NULL"))
    rows = rows.select("appointment_id", "label", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _STUMP_COLS])
    return split_by_key(VectorAssembler(inputCols=_STUMP_COLS, outputCol="features").transform(rows), "appointment_id")


@register(
    "forest_stump",
    _STUMP_TRAIN + ",\ntr AS (SELECT *, label AS y FROM r WHERE NOT test),\n" + _best_split("b", "tr")
    + f"""
SELECT {_STUMP_COLS}[j + 1] AS feature, t AS threshold, round(2 * gain, 9) AS gain, CAST(nl AS BIGINT) AS left_rows,
       CAST(n - nl AS BIGINT) AS right_rows, round(lm, 9) AS left_share, round(rm, 9) AS right_share, 1.0::DOUBLE AS importance FROM b""",
)
def q_forest_stump(spark, sf_dir):
    """One tree of depth 1 without sampling: its split, the gain in Gini impurity, both leaves and the importance."""
    from pyspark.sql import functions as F

    from carelake.operators.ml import importance_from_nodes, train_random_forest, tree_nodes

    train, _ = _stump_rows(spark, sf_dir)
    model = train_random_forest(train, max_depth=1, num_trees=1, featureSubsetStrategy="all", bootstrap=False, **_STUMP)
    nodes = tree_nodes(model, spark)
    root = nodes.filter("node = 0").select("feature", "threshold", "gain", "left", "right")
    side = lambda s: nodes.select(
        F.col("node").alias(s), F.col("weight").cast("bigint").alias(f"{s}_rows"), F.round(F.col("stats")[1] / F.col("weight"), 9).alias(f"{s}_share")
    )
    out = root.join(side("left"), "left").join(side("right"), "right").join(importance_from_nodes(nodes), "feature")
    name = F.element_at(F.array(*[F.lit(c) for c in _STUMP_COLS]), F.col("feature") + 1)
    return out.select(name.alias("feature"), "threshold", F.round("gain", 9).alias("gain"), "left_rows", "right_rows", "left_share", "right_share", "importance")


@register(
    "boosted_stumps",
    _STUMP_TRAIN + ",\nt1 AS (SELECT *, 2 * label - 1 AS y FROM r WHERE NOT test),\n" + _best_split("b1", "t1")
    + f""",
t2 AS (SELECT t1.* REPLACE (4 * y / (1 + exp(2 * y * ({_leaf("b1")}))) AS y) FROM t1, b1),\n""" + _best_split("b2", "t2")
    + f"""
SELECT appointment_id, label, round(1 / (1 + exp(-2 * (({_leaf("b1")}) + 0.1 * ({_leaf("b2")})))), 9) AS p FROM r, b1, b2 WHERE test""",
)
def q_boosted_stumps(spark, sf_dir):
    """Two boosting rounds of depth 1: the probabilities of the test rows."""
    from pyspark.sql import functions as F

    from carelake.operators.ml import positive_score, train_gbt

    train, test = _stump_rows(spark, sf_dir)
    model = train_gbt(train, max_depth=1, max_iter=2, **_STUMP)
    return model.transform(test).select("appointment_id", "label", F.round(positive_score(), 9).alias("p"))


_RUN_SQL = (
    f", f AS ({FEATURES_SQL})\n"
    f"""SELECT 'param' AS kind, 'model_type' AS name, CAST(NULL AS DOUBLE) AS value, 'random_forest' AS detail, TRUE AS in_range
UNION ALL SELECT 'param', 'max_depth', 10.0, NULL, TRUE UNION ALL SELECT 'param', 'num_trees', 100.0, NULL, TRUE
UNION ALL SELECT 'param', 'train_size', CAST(count_if(NOT {_TEST_ROW}) AS DOUBLE), NULL, TRUE FROM f WHERE no_show IS NOT NULL
UNION ALL SELECT 'param', 'test_size', CAST(count_if({_TEST_ROW}) AS DOUBLE), NULL, TRUE FROM f WHERE no_show IS NOT NULL
UNION ALL SELECT 'metric', 'auc', NULL, NULL, TRUE UNION ALL SELECT 'metric', 'accuracy', NULL, NULL, TRUE"""
)


def _run_rows(metrics):
    """Parameters as they are; of a metric only that it lies between 0 and 1."""
    from pyspark.sql import functions as F

    metric = F.col("kind") == "metric"
    return metrics.filter("kind <> 'importance'").select(
        "kind", "name", F.when(~metric, F.col("value")).alias("value"), "detail",
        F.when(metric, F.col("value").between(0, 1)).otherwise(True).alias("in_range"),
    )


@register("train_and_evaluate", _RUN_SQL)
def q_train_and_evaluate(spark, sf_dir):
    return _run_rows(_forest(spark, sf_dir)[2])


@register(
    "feature_importance",
    f", f AS ({FEATURES_SQL})\n"
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}_vec_' || {c} AS feature, '{c}_vec' AS source_column, TRUE AS in_range, TRUE AS sums_to_one "
        f"FROM f WHERE {c} IS NOT NULL AND no_show IS NOT NULL AND NOT {_TEST_ROW}" for c in _CATS
    )
    + "".join(f" UNION ALL SELECT '{c}_f', '{c}_f', TRUE, TRUE" for c in _NUMERIC_FEATURES),
)
def q_feature_importance(spark, sf_dir):
    from pyspark.sql import functions as F

    from carelake.operators.ml import feature_importance

    _, model, _, pred = _forest(spark, sf_dir)
    out = feature_importance(model, pred)
    total = out.agg(F.sum("importance")).scalar()
    return out.select("feature", "source_column", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


_PREDICTED_SQL = (
    f", f AS ({FEATURES_SQL})\nSELECT appointment_id, patient_id, appointment_date, "
    f"TIMESTAMP '{AS_OF_TS}' AS prediction_timestamp, TRUE AS in_range FROM f"
)


@register("predict_no_shows", _PREDICTED_SQL)
def q_predict_no_shows(spark, sf_dir):
    """Scoring rows that have no label column."""
    from pyspark.sql import functions as F

    from carelake.operators.ml import predict_no_shows

    features, model, _, _ = _forest(spark, sf_dir)
    out = predict_no_shows(model, features.drop("no_show"), AS_OF_TS)
    in_range = F.col("no_show_probability").between(0, 1) & F.col("prediction").isin(0.0, 1.0)
    return out.select("appointment_id", "patient_id", "appointment_date", "prediction_timestamp", in_range.alias("in_range"))


@register("score_reloaded", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM appointments")
def q_score_reloaded(spark, sf_dir):
    """Save the fitted pipeline, load it back: rows whose score differs from the unsaved model's."""
    from pyspark.sql import functions as F

    from carelake.operators.ml import load_model, predict_no_shows, save_model
    from carelake.session import scratch_path

    features, model, _, _ = _forest(spark, sf_dir)
    reloaded = load_model(save_model(model, scratch_path(spark, "model")))
    one, two = (
        predict_no_shows(m, features, AS_OF_TS).select("appointment_id", F.col("no_show_probability").alias(n))
        for m, n in ((model, "a"), (reloaded, "b"))
    )
    both = one.join(two, "appointment_id", "full")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"))


@register("run_metrics", _RUN_SQL)
def q_run_metrics(spark, sf_dir):
    """Metrics of the run appended to a metrics table and read back."""
    from carelake.session import scratch_path
    from carelake.sources.sinks import publish_table

    name = f"model_runs_{_uid()}"
    return _run_rows(publish_table(_forest(spark, sf_dir)[2], name, scratch_path(spark, name), mode="append"))


@register(
    "score_upcoming",
    f"SELECT appointment_id, patient_id, appointment_date, 'v1' AS model_version, TIMESTAMP '{AS_OF_TS}' AS prediction_timestamp, "
    "TRUE AS in_range FROM appointments WHERE appointment_date > DATE '2001-01-01' AND status = 'Scheduled'",
)
def q_score_upcoming(spark, sf_dir):
    """The whole ML job: feature table, training, model reload, scoring of upcoming visits."""
    from pyspark.sql import functions as F

    from carelake.plans.training import ml_training_job
    from carelake.session import scratch_path

    a, p, d = _views(spark, sf_dir)
    db = f"clinic_ml_{_uid()}"
    out = ml_training_job(spark, a, p, d, scratch_path(spark, db), db, as_of=AS_OF, model_version="v1")
    in_range = F.col("no_show_probability").between(0, 1) & F.col("prediction").isNotNull()
    return out["predictions"].select(
        "appointment_id", "patient_id", "appointment_date", "model_version", "prediction_timestamp", in_range.alias("in_range")
    )


# --------------------------------------------------------------------------
# Incremental (streaming) form of the appointment ETL
# --------------------------------------------------------------------------


@register("incremental_appointments", ENRICH_BOTH_SQL)
def q_incremental_appointments(spark, sf_dir):
    """Two landing drops (visits before / from 1998), two availableNow runs: every row lands once."""
    from pyspark.sql import functions as F

    from carelake.plans.etl import run_patients, run_physicians
    from carelake.session import scratch_path
    from carelake.streaming import run_incremental_appointments

    pt, dt_ = f"patients_{_uid()}", f"physicians_{_uid()}"
    run_patients(spark, _staged(spark, sf_dir, "patients"), scratch_path(spark, pt), pt, AS_OF_TS)
    run_physicians(spark, _staged(spark, sf_dir, "physicians"), scratch_path(spark, dt_), dt_, AS_OF_TS)
    landing = scratch_path(spark, "landing-appointments")
    at = f"appointments_{_uid()}"
    target, ckpt = scratch_path(spark, at), scratch_path(spark, f"{at}-checkpoint")
    early = F.coalesce(F.col("appointment_date") < F.lit("1998-01-01").cast("date"), F.lit(True))
    appts = fx.appointments(spark, sf_dir)
    out = None
    for drop in (appts.filter(early), appts.filter(~early)):
        drop.write.mode("append").option("header", "true").csv(landing)
        out = run_incremental_appointments(spark, landing, at, target, ckpt, pt, dt_, AS_OF_TS)
    return out
