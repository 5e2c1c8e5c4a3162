"""Feature engineering for the no-show model.

Plan of ``generate_features`` (one shuffle of the appointments when nothing
is skewed, none when appointments and patients are bucketed on patient_id)::

    appointments ⟕ patients(patient_id, date_of_birth, gender)   -- sort-merge on patient_id (or broadcast)
    → history window partitioned by patient_id                    -- reuses the join's partitioning
    ⟕ physicians(physician_id, specialty)                         -- broadcast if Spark's size check allows
    → calendar / age / lead-time projections (one codegen stage)
    → conform to the declared feature schema

The physician join comes after the window; physician keys are unique in the
published physician table (the ETL de-duplicates it).  With duplicate
physician keys the fan-out copies are not counted as earlier visits.

Skew: one patient may own a large share of all appointments.  By default the rows of
each patient are counted first; patients that own more than a task's share (fewer than there
are shuffle partitions) leave the plan above.  Their rows meet the patient dimension by
(patient_id, salt) and are cut into ranges of the whole sort order, visit id included, so
that even visits without a date are spread; totals of the earlier ranges are added to the sums inside
each (see ``operators.prefix``).  ``split=False`` asks for one window per patient without the count.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.columns import datetime_feature_columns, lead_days, whole_years
from carelake.operators.prefix import running_sums

#: A patient with fewer rows is never treated apart.
HOT_ROWS = 2_000


def extract_datetime_features(df: DataFrame, datetime_col: str = "appointment_time") -> DataFrame:
    """Adds hour_of_day, day_of_week, day_of_month, month, quarter, year, is_weekend, season."""
    return df.withColumns(datetime_feature_columns(datetime_col))


def calculate_appointment_lead_time(
    df: DataFrame, appointment_date_col: str = "appointment_date", created_at_col: str = "created_at"
) -> DataFrame:
    """Adds ``appointment_lead_days`` = calendar days from creation to the visit (may be negative)."""
    return df.withColumn("appointment_lead_days", lead_days(appointment_date_col, created_at_col))


def calculate_patient_age(
    df: DataFrame, dob_col: str = "date_of_birth", as_of_date_col: str = "appointment_date"
) -> DataFrame:
    """Adds ``patient_age`` = whole years (365.25-day) at the reference date, as int."""
    return df.withColumn("patient_age", whole_years(dob_col, as_of_date_col).cast("int"))


def _rate(prev_ns: Column, prev_n: Column) -> Column:
    # float precision, then widened to double by the 0.0 default.
    return F.when(prev_n > 0, (prev_ns / prev_n).cast("float")).otherwise(F.lit(0.0))


def _order_columns(df: DataFrame, date_col: str, tie_breakers) -> list[str]:
    return [date_col] + [c for c in tie_breakers if c in df.columns and c != date_col]


def _session_key(df: DataFrame) -> str:
    """Cache scope for built Column objects: one entry set per Spark application."""
    try:
        return df.sparkSession.sparkContext.applicationId
    except Exception:  # Connect sessions: Columns are plain Python objects
        return "connect"


@functools.lru_cache(maxsize=64)
def _history_exprs(pid: str, order: tuple, no_show_col: str, scope: str = "") -> dict:
    # Column objects are immutable, unresolved expressions: build them once per signature.
    w = Window.partitionBy(pid).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    prev_n = F.count(F.lit(1)).over(w)
    prev_ns = F.sum(F.col(no_show_col).cast("int")).over(w)
    return {"previous_appointments": prev_n, "previous_no_shows": prev_ns, "no_show_rate": _rate(prev_ns, prev_n)}


def _history_window(df: DataFrame, pid: str, order: list[str], no_show_col: str) -> DataFrame:
    # one projection; the analyzer evaluates each distinct window expression once
    return df.withColumns(_history_exprs(pid, tuple(order), no_show_col, _session_key(df)))


class HotKeys:
    """Patients that own more than a task's share of the rows, and how many pieces their rows are cut into."""

    def __init__(self, key: str, values: list, pieces: int):
        self.key, self.values, self.pieces = key, values, pieces

    def __bool__(self) -> bool:
        return bool(self.values)

    def has(self) -> Column:
        """Whether a row belongs to one of them; rows without a key are one patient, as in a window."""
        known = [v for v in self.values if v is not None]
        return F.coalesce(F.col(self.key).isin(known), F.lit(None in self.values))


def hot_keys(df: DataFrame, key: str, least: int = HOT_ROWS) -> HotKeys:
    """Count the rows of each key (summed before the shuffle) and name those above a task's share.

    The share is the rows over the number of shuffle partitions, ``least`` at least; fewer
    keys than partitions can be above it, so their list is small whatever the data.
    """
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    total = df.count()
    share = max(least, total // tasks, 1)
    if total <= share:
        return HotKeys(key, [], 0)
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share).collect()
    return HotKeys(key, [r[0] for r in hot], -(-2 * sum(r.n for r in hot) // share))


def salted_left_join(left: DataFrame, right: DataFrame, hot: HotKeys, spread: list[str]) -> DataFrame:
    """Left join of rows with hot keys: each row of ``right`` is there once for every salt, each row of
    ``left`` has the salt of its ``spread`` columns, so that a key meets in as many places as there are salts."""
    salt = F.pmod(F.xxhash64(*spread), F.lit(hot.pieces)).cast("int")
    copies = right.filter(hot.has()).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(hot.pieces - 1))))
    return left.withColumn("_salt", salt).join(copies, [hot.key, "_salt"], "left").drop("_salt")


def _history_ranges(df: DataFrame, hot: HotKeys, order: list[str], no_show_col: str) -> DataFrame:
    """The same history for the rows of hot patients, from sums over ranges of the sort order."""
    flag = F.col(no_show_col).cast("int").cast("bigint")
    values = {"_n": F.lit(1).cast("bigint"), "_s": F.coalesce(flag, F.lit(0)), "_k": flag.isNotNull().cast("bigint")}
    out = running_sums(df, [hot.key], order, values, hot.pieces)
    prev_ns = F.when(F.col("_k") > 0, F.col("_s"))
    return out.select(
        *df.columns, F.col("_n").alias("previous_appointments"), prev_ns.alias("previous_no_shows"), _rate(prev_ns, F.col("_n")).alias("no_show_rate")
    )


def calculate_patient_history(
    df: DataFrame,
    patient_id_col: str = "patient_id",
    appointment_date_col: str = "appointment_date",
    no_show_col: str = "no_show",
    tie_breakers=("appointment_time", "appointment_id"),
    split: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``previous_appointments``, ``previous_no_shows``, ``no_show_rate``.

    Semantics over all earlier rows of the same patient (rows frame
    ``unbounded preceding .. 1 preceding``): the count is 0 on a first visit;
    the sum skips NULL flags and is NULL until a non-NULL flag was seen; the
    rate is ``sum / count`` at float precision when count > 0, else 0.0.
    Rows are ordered by date, then the tie-break columns present in ``df``
    (the reference orders by date only, which leaves same-day ties open).

    ``split`` counts the rows of each patient first; histories of more than a task's share of
    the rows (``hot_rows`` at least) are cut into ranges of that order, the others are one
    window per patient.  Without it all are.
    """
    order = _order_columns(df, appointment_date_col, tie_breakers)
    hot = hot_keys(df, patient_id_col, hot_rows) if split else None
    if not hot:
        return _history_window(df, patient_id_col, order, no_show_col)
    rest = _history_window(df.filter(~hot.has()), patient_id_col, order, no_show_col)
    return rest.unionByName(_history_ranges(df.filter(hot.has()), hot, order, no_show_col))


def conform_to_schema(df: DataFrame, schema) -> DataFrame:
    """Project ``df`` onto ``schema``: present columns are cast, missing ones become typed NULLs."""
    cols = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def generate_features(
    appointments_df: DataFrame,
    patients_df: DataFrame,
    physicians_df: DataFrame,
    conform: bool = True,
    split: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The 17-column feature table of the no-show model.

    Dimensions are pruned to the columns used before joining, so the
    appointment's own ``created_at`` drives lead time and ``specialty`` comes
    from the physician dimension.  With ``conform`` the result is cast to the
    declared feature schema (int counts, float rate), as it is published;
    without it the natural types (bigint counts, double rate) are kept and the
    column names follow the declared schema in both cases.  ``split`` and ``hot_rows`` as in
    ``calculate_patient_history``; the patient join of hot patients is salted.
    """
    pat = patients_df.select("patient_id", "date_of_birth", "gender")
    phy = physicians_df.select("physician_id", "specialty")
    appt = appointments_df.select(
        *[
            c
            for c in (
                "appointment_id",
                "patient_id",
                "physician_id",
                "appointment_date",
                "appointment_time",
                "created_at",
                "no_show",
            )
            if c in appointments_df.columns
        ]
    )
    order = _order_columns(appt, "appointment_date", ("appointment_time", "appointment_id"))
    hot = hot_keys(appt.select("patient_id"), "patient_id", hot_rows) if split else None
    rest = appt.filter(~hot.has()) if hot else appt
    df = _history_window(rest.join(pat, "patient_id", "left"), "patient_id", order, "no_show")
    if hot:
        spread = salted_left_join(appt.filter(hot.has()), pat, hot, ["appointment_id"])
        df = df.unionByName(_history_ranges(spread, hot, order, "no_show"))
    # Physicians last: the patient join and the window share the patient_id
    # partitioning (no exchange at all when both tables are bucketed on it).
    df = df.join(phy, "physician_id", "left")
    return df.select(*_feature_columns(frozenset(df.columns), conform, _session_key(df)))


@functools.lru_cache(maxsize=64)
def _feature_columns(present: frozenset, conform: bool, scope: str = "") -> list[Column]:
    """The 17 output columns as one projection (one analysis, one codegen stage).

    Built once per input column set: Column objects are immutable, unresolved
    expressions, and building them costs a JVM round trip per call.
    """
    from carelake.functions.columns import is_weekend, season, weekday_name
    from carelake.schemas import FEATURES

    def col(c):
        return F.col(c) if c in present else F.lit(None)

    t = col("appointment_time")
    exprs = {
        "appointment_id": col("appointment_id"),
        "patient_id": col("patient_id"),
        "physician_id": col("physician_id"),
        "appointment_date": col("appointment_date"),
        "appointment_time": t,
        "patient_age": whole_years(col("date_of_birth"), col("appointment_date")).cast("int"),
        "patient_gender": col("gender"),
        "physician_specialty": col("specialty"),
        "appointment_lead_days": lead_days(col("appointment_date"), col("created_at")),
        "previous_no_shows": col("previous_no_shows"),
        "previous_appointments": col("previous_appointments"),
        "no_show_rate": col("no_show_rate"),
        "day_of_week": weekday_name(t),
        "is_weekend": is_weekend(t),
        "appointment_hour": F.hour(t),
        "season": season(t),
        "no_show": col("no_show"),
    }
    types = {f.name: f.dataType for f in FEATURES.fields}
    return [(e.cast(types[n]) if conform else e).alias(n) for n, e in exprs.items()]
