"""Clinic views over the driver's TPC-H-like tables.

``patients`` come from ``customer``, ``physicians`` from ``supplier`` and
``appointments`` from ``orders``.  The views inject NULL names, NULL genders,
unmatched physician keys and NULL no-show flags so that every NULL rule of the
operators is exercised.  The same definitions exist as DuckDB SQL in
``carelake.oracle`` for the independent check.

Everything is a lazy projection of a parquet scan: Catalyst prunes the scan to
the referenced columns and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The views are SQL projections (one analysis, no per-expression round trips).
PATIENTS_SQL = [
    "CAST(c_custkey AS STRING) AS patient_id",
    "CASE WHEN c_custkey % 50 = 0 THEN CAST(NULL AS STRING) ELSE 'Customer' END AS first_name",
    "substring(c_name, 10) AS last_name",
    "date_add(DATE'1930-01-01', CAST(c_custkey * 37 % 29000 AS INT)) AS date_of_birth",
    "CASE WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'M' END AS gender",
    "CAST(NULL AS STRING) AS contact_number",
    "concat('patient', CAST(c_custkey AS STRING), '@example.org') AS email",
    # free text as it comes: commas, quotes, line breaks, empty and missing
    "CASE c_custkey % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN concat('Street ', CAST(c_custkey AS STRING), ', \"upper\" floor')"
    " WHEN 3 THEN concat('Street ', CAST(c_custkey AS STRING), char(10), 'Yard') ELSE 'Main Street' END AS address",
    "concat('City', CAST(c_nationkey AS STRING)) AS city",
    "CAST(NULL AS STRING) AS state",
    "CAST(NULL AS STRING) AS zip_code",
    "c_mktsegment AS insurance_provider",
    "CAST(NULL AS STRING) AS insurance_id",
    "timestampadd(MINUTE, c_custkey, TIMESTAMP_NTZ'1999-01-01 00:00:00') AS created_at",
    "timestampadd(DAY, CAST(c_custkey % 400 AS INT), TIMESTAMP_NTZ'2000-01-01 00:00:00') AS updated_at",
]

PHYSICIANS_SQL = [
    "CAST(s_suppkey AS STRING) AS physician_id",
    "'Supplier' AS first_name",
    "substring(s_name, 10) AS last_name",
    "concat('SPEC_', CAST(s_nationkey % 5 AS STRING)) AS specialty",
    "concat('LIC', CAST(s_suppkey AS STRING)) AS license_number",
    "CAST(NULL AS STRING) AS email",
    "CASE s_suppkey % 3 WHEN 0 THEN concat('desk', char(10), '\"', CAST(s_suppkey AS STRING), '\"') ELSE CAST(NULL AS STRING) END AS contact_number",
    "concat('DEPT_', CAST(s_nationkey % 3 AS STRING)) AS department",
    "date_add(DATE'1980-01-01', CAST(s_suppkey * 53 % 9000 AS INT)) AS hire_date",
    "CASE WHEN s_suppkey % 10 = 0 THEN 'Inactive' ELSE 'Active' END AS status",
    "CAST(date_add(DATE'1980-01-01', CAST(s_suppkey * 53 % 9000 AS INT)) AS TIMESTAMP_NTZ) AS created_at",
    "timestampadd(DAY, CAST(s_suppkey % 30 AS INT), TIMESTAMP_NTZ'2001-06-01 00:00:00') AS updated_at",
]

APPOINTMENTS_SQL = [
    "CAST(o_orderkey AS STRING) AS appointment_id",
    "CAST(o_custkey AS STRING) AS patient_id",
    "CAST(o_orderkey * 7 % 120 AS STRING) AS physician_id",
    "CAST(o_orderdate AS DATE) AS appointment_date",
    "timestampadd(HOUR, CAST(o_orderkey % 10 + 8 AS INT), o_orderdate) AS appointment_time",
    "CAST(15 * (o_orderkey % 4 + 1) AS INT) AS duration_minutes",
    "o_orderpriority AS reason",
    "CASE o_orderstatus WHEN 'P' THEN 'Scheduled' WHEN 'F' THEN 'Completed' ELSE 'No-Show' END AS status",
    "CASE o_orderstatus WHEN 'F' THEN FALSE WHEN 'O' THEN TRUE END AS no_show",
    "CASE o_orderkey % 7 WHEN 0 THEN 'said \"fine\", left early' WHEN 1 THEN concat('line one', char(10), char(10), 'line, three') WHEN 2 THEN 'on time' ELSE CAST(NULL AS STRING) END AS notes",
    "timestampadd(HOUR, CAST(o_orderkey % 24 - (o_orderkey % 60) * 24 AS INT), o_orderdate) AS created_at",
    "timestampadd(HOUR, CAST(o_orderkey % 10 + 9 AS INT), o_orderdate) AS updated_at",
]

TRIPS_SQL = ["event_id", "ts AS pickup_time", "event_type AS trip_kind", "value AS fare_amount"]


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*PATIENTS_SQL)


def physicians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*PHYSICIANS_SQL)


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*APPOINTMENTS_SQL)


def skewed_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appointments of which every third belongs to patient 1 and has neither date nor time."""
    hot = "CAST(appointment_id AS BIGINT) % 3 = 0"
    parts = {
        "patient_id": f"IF({hot}, '1', patient_id) AS patient_id",
        "appointment_date": f"IF({hot}, NULL, appointment_date) AS appointment_date",
        "appointment_time": f"IF({hot}, NULL, appointment_time) AS appointment_time",
    }
    df = appointments(spark, sf_dir)
    return df.selectExpr(*[parts.get(c, c) for c in df.columns])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the sample taxi table: ``events.value`` plays ``fare_amount``."""
    return table(spark, sf_dir, "events").selectExpr(*TRIPS_SQL)
