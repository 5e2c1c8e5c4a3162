"""Composite jobs: per-entity ETL, the daily run, the ML job, registered queries."""

from carelake.plans.etl import (  # noqa: F401
    daily_etl,
    run_appointments,
    run_patients,
    run_physicians,
    stage_csv,
    view_filter_table,
)
from carelake.plans.training import create_feature_table, ml_training_job  # noqa: F401
