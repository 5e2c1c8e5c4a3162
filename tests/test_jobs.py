"""The command-line jobs end to end on staged CSVs of the smallest tables."""

from carelake.plans.etl import stage_csv
from carelake.plans.jobs import main
from carelake.session import scratch_path
from carelake.sources import fixtures as fx

from .conftest import SF001


def test_daily_etl_then_ml_then_incremental(spark):
    paths = {
        name: stage_csv(view(spark, SF001), scratch_path(spark, f"job-{name}"))
        for name, view in (("patients", fx.patients), ("physicians", fx.physicians), ("appointments", fx.appointments))
    }
    base = scratch_path(spark, "jobs")
    common = ["--database", "clinic_jobs", "--base-path", base, "--as-of", "2001-01-01"]
    main(["daily-etl", "--patients", paths["patients"], "--physicians", paths["physicians"],
          "--appointments", paths["appointments"], *common], spark)
    assert spark.table("clinic_jobs.appointments").count() == fx.appointments(spark, SF001).count()
    out = main(["ml-training", "--model-type", "gbt", *common], spark)
    assert int(out["predictions"]) == fx.appointments(spark, SF001).filter(
        "appointment_date > DATE '2001-01-01' AND status = 'Scheduled'").count()
    inc = main(["incremental-appointments", "--landing", paths["appointments"], *common], spark)
    assert int(inc["rows"]) == fx.appointments(spark, SF001).count()


def test_cli_arguments():
    from carelake.plans.jobs import parser

    a = parser().parse_args(["daily-etl", "--patients", "p", "--physicians", "d", "--appointments", "a",
                             "--database", "db", "--base-path", "b", "--buckets", "8"])
    assert (a.job, a.buckets, a.as_of) == ("daily-etl", 8, None)
    m = parser().parse_args(["ml-training", "--database", "db", "--base-path", "b", "--model-type", "gbt"])
    assert (m.model_type, m.model_version) == ("gbt", None)
    i = parser().parse_args(["incremental-appointments", "--landing", "l", "--database", "db", "--base-path", "b"])
    assert i.landing == "l"
