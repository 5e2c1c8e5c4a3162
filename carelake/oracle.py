"""Independent DuckDB SQL for the correctness gate.

``FIXTURE_CTES`` re-states the clinic views of ``carelake.sources.fixtures``
in DuckDB SQL; every oracle query is ``WITH <fixtures> <query>``.  The driver
tables (customer, supplier, orders, events, lineitem, ...) are views in the
DuckDB session.
"""

FIXTURE_CTES = """
WITH patients AS (
  SELECT CAST(c_custkey AS VARCHAR) AS patient_id,
         CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 'Customer' END AS first_name,
         substring(c_name, 10) AS last_name,
         CAST(DATE '1930-01-01' + CAST(c_custkey * 37 % 29000 AS INTEGER) AS DATE) AS date_of_birth,
         CASE WHEN c_custkey % 3 = 0 THEN 'F' WHEN c_custkey % 3 = 1 THEN 'M' END AS gender,
         CAST(NULL AS VARCHAR) AS contact_number,
         'patient' || CAST(c_custkey AS VARCHAR) || '@example.org' AS email,
         CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Street ' || CAST(c_custkey AS VARCHAR) || ', "upper" floor'
              WHEN 3 THEN 'Street ' || CAST(c_custkey AS VARCHAR) || chr(10) || 'Yard' ELSE 'Main Street' END AS address,
         'City' || CAST(c_nationkey AS VARCHAR) AS city,
         CAST(NULL AS VARCHAR) AS state,
         CAST(NULL AS VARCHAR) AS zip_code,
         c_mktsegment AS insurance_provider,
         CAST(NULL AS VARCHAR) AS insurance_id,
         TIMESTAMP '1999-01-01 00:00:00' + to_minutes(CAST(c_custkey AS BIGINT)) AS created_at,
         TIMESTAMP '2000-01-01 00:00:00' + to_days(CAST(c_custkey % 400 AS INTEGER)) AS updated_at
  FROM customer
),
physicians AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS physician_id,
         'Supplier' AS first_name,
         substring(s_name, 10) AS last_name,
         'SPEC_' || CAST(s_nationkey % 5 AS VARCHAR) AS specialty,
         'LIC' || CAST(s_suppkey AS VARCHAR) AS license_number,
         CAST(NULL AS VARCHAR) AS email,
         CASE s_suppkey % 3 WHEN 0 THEN 'desk' || chr(10) || '"' || CAST(s_suppkey AS VARCHAR) || '"' END AS contact_number,
         'DEPT_' || CAST(s_nationkey % 3 AS VARCHAR) AS department,
         CAST(DATE '1980-01-01' + CAST(s_suppkey * 53 % 9000 AS INTEGER) AS DATE) AS hire_date,
         CASE WHEN s_suppkey % 10 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
         CAST(CAST(DATE '1980-01-01' + CAST(s_suppkey * 53 % 9000 AS INTEGER) AS DATE) AS TIMESTAMP) AS created_at,
         TIMESTAMP '2001-06-01 00:00:00' + to_days(CAST(s_suppkey % 30 AS INTEGER)) AS updated_at
  FROM supplier
),
appointments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS appointment_id,
         CAST(o_custkey AS VARCHAR) AS patient_id,
         CAST(o_orderkey * 7 % 120 AS VARCHAR) AS physician_id,
         CAST(o_orderdate AS DATE) AS appointment_date,
         o_orderdate + to_hours(CAST(o_orderkey % 10 + 8 AS BIGINT)) AS appointment_time,
         CAST(15 * (o_orderkey % 4 + 1) AS INTEGER) AS duration_minutes,
         o_orderpriority AS reason,
         CASE o_orderstatus WHEN 'P' THEN 'Scheduled' WHEN 'F' THEN 'Completed' ELSE 'No-Show' END AS status,
         CASE o_orderstatus WHEN 'F' THEN FALSE WHEN 'O' THEN TRUE END AS no_show,
         CASE o_orderkey % 7 WHEN 0 THEN 'said "fine", left early' WHEN 1 THEN 'line one' || chr(10) || chr(10) || 'line, three' WHEN 2 THEN 'on time' END AS notes,
         o_orderdate + to_hours(CAST(o_orderkey % 24 - (o_orderkey % 60) * 24 AS BIGINT)) AS created_at,
         o_orderdate + to_hours(CAST(o_orderkey % 10 + 9 AS BIGINT)) AS updated_at
  FROM orders
),
trips AS (
  SELECT event_id, ts AS pickup_time, event_type AS trip_kind, value AS fare_amount FROM events
)
"""


def with_fixtures(sql: str) -> str:
    return FIXTURE_CTES + sql
