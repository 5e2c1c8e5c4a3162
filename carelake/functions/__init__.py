from carelake.functions.columns import (  # noqa: F401
    as_of_date,
    as_of_timestamp,
    datetime_feature_columns,
    full_name,
    is_weekend,
    lead_days,
    season,
    weekday_name,
    whole_years,
)
