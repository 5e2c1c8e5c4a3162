"""Column expressions used by the clinic operators.

All are built-in Spark expressions (JVM side, whole-stage codegen); none is a
Python UDF.  Each accepts a column name or a ``Column``.  Date and time
functions work on ``date``, ``timestamp`` and ``timestamp_ntz`` inputs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Days per year used for whole-year ages, and the month sets of
# each season (anything else, including NULL, is "Fall").
DAYS_PER_YEAR = 365.25
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_date(as_of=None) -> Column:
    """Reference date: ``current_date()`` by default, else a fixed date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.to_date(F.lit(str(as_of)))


def as_of_timestamp(as_of=None) -> Column:
    """Load/score time: ``current_timestamp()`` by default, else a fixed instant."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return F.to_timestamp(F.lit(str(as_of)))


def full_name(first: ColumnOrName = "first_name", last: ColumnOrName = "last_name") -> Column:
    """``first || ' ' || last``; NULL when either part is NULL (``concat``, not ``concat_ws``)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def whole_years(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``floor(datediff(end, start) / 365.25)`` as bigint (approximate age/tenure)."""
    return F.floor(F.datediff(_c(end), _c(start)) / F.lit(DAYS_PER_YEAR))


def lead_days(event_date: ColumnOrName, created: ColumnOrName) -> Column:
    """Calendar days from creation to the event; timestamps truncate to their date."""
    return F.datediff(_c(event_date), _c(created)).cast("int")


def weekday_name(x: ColumnOrName) -> Column:
    """English full weekday name, e.g. ``Saturday``."""
    return F.date_format(_c(x), "EEEE")


def is_weekend(x: ColumnOrName) -> Column:
    """Saturday or Sunday; a NULL date gives ``false``."""
    return F.coalesce(F.weekday(_c(x)) >= F.lit(5), F.lit(False))


def season(x: ColumnOrName) -> Column:
    """Meteorological season of the month; NULL falls through to ``Fall``."""
    m = F.month(_c(x))
    return (
        F.when(m.isin(*WINTER_MONTHS), F.lit("Winter"))
        .when(m.isin(*SPRING_MONTHS), F.lit("Spring"))
        .when(m.isin(*SUMMER_MONTHS), F.lit("Summer"))
        .otherwise(F.lit("Fall"))
    )


def datetime_feature_columns(x: ColumnOrName) -> dict[str, Column]:
    """The eight calendar features of a timestamp, keyed by output name."""
    c = _c(x)
    return {
        "hour_of_day": F.hour(c),
        "day_of_week": weekday_name(c),
        "day_of_month": F.dayofmonth(c),
        "month": F.month(c),
        "quarter": F.quarter(c),
        "year": F.year(c),
        "is_weekend": is_weekend(c),
        "season": season(c),
    }
