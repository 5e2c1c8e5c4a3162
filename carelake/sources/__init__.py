"""Readers, sinks and the clinic fixture views."""

from carelake.sources.readers import (  # noqa: F401
    extract_appointments,
    extract_patients,
    extract_physicians,
    file_inventory,
    read_csv,
    read_table,
)
from carelake.sources.sinks import create_database, publish_audited, publish_table, write_path  # noqa: F401
