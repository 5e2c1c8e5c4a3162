"""Incremental appointment ETL: new files only, exactly once."""

from carelake.session import scratch_path
from carelake.sources import fixtures as fx
from carelake.streaming import run_incremental_appointments

from .conftest import SF001


def test_incremental_runs_process_each_file_once(spark):
    appts = fx.appointments(spark, SF001)
    landing = scratch_path(spark, "landing")
    target, ckpt = scratch_path(spark, "inc"), scratch_path(spark, "inc-ckpt")
    first = appts.filter("appointment_date < DATE '1996-01-01'")
    first.write.option("header", "true").csv(landing)
    n1 = run_incremental_appointments(spark, landing, "inc_appts", target, ckpt, as_of="2001-01-01").count()
    assert n1 == first.count()
    # no new files: nothing appended
    assert run_incremental_appointments(spark, landing, "inc_appts", target, ckpt, as_of="2001-01-01").count() == n1
    appts.filter("appointment_date >= DATE '1996-01-01'").write.mode("append").option("header", "true").csv(landing)
    out = run_incremental_appointments(spark, landing, "inc_appts", target, ckpt, as_of="2001-01-01")
    assert out.count() == appts.count()
    assert out.select("appointment_id").distinct().count() == appts.count()
    assert {"day_of_week", "is_weekend", "processed_timestamp"} <= set(out.columns)
