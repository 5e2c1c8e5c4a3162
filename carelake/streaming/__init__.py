from carelake.streaming.incremental import appointment_stream, run_incremental_appointments  # noqa: F401
