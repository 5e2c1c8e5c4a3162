"""CSV reading rules, catalog publishing, partitioned sinks and the file inventory."""

import datetime as dt
import os

import pytest

from carelake.operators.transforms import add_partition_columns
from carelake.schemas import APPOINTMENTS
from carelake.session import scratch_path
from carelake.sources.readers import extract_appointments, file_inventory, read_csv
from carelake.sources.sinks import publish_table, write_path

HEADER = ",".join(f.name for f in APPOINTMENTS.fields)


def _write(spark, name, text):
    d = scratch_path(spark, name)
    os.makedirs(d)
    with open(os.path.join(d, "part-0.csv"), "w") as fh:
        fh.write(text)
    return d


def test_csv_bad_values_become_null(spark):
    text = HEADER + "\n" + "a1,p1,d1,not-a-date,2024-01-06T10:00:00,xx,r,Scheduled,maybe,,2024-01-01T00:00:00,\n" + ",,,,,,,,,,,\n"
    df = extract_appointments(spark, _write(spark, "bad", text))
    rows = df.collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.appointment_id, r.appointment_date, r.duration_minutes, r.no_show) == ("a1", None, None, None)
    assert r.appointment_time == dt.datetime(2024, 1, 6, 10)
    assert all(v is None for v in rows[1])


def test_csv_corrupt_record_column(spark):
    text = HEADER + "\n" + "a1,p1,d1,2024-01-06,,15,r,Scheduled,true,,,\n" + "a2,p1,d1,2024-01-06,,oops,r,x,true,,,\n"
    df = extract_appointments(spark, _write(spark, "corrupt", text), corrupt_record_column="_corrupt")
    # whole rows: with CSV column pruning only the projected columns are parsed
    bad = df.filter("_corrupt IS NOT NULL").collect()
    assert [r.appointment_id for r in bad] == ["a2"]


def test_csv_reordered_header_raises(spark):
    cols = [f.name for f in APPOINTMENTS.fields]
    cols[0], cols[1] = cols[1], cols[0]
    text = ",".join(cols) + "\n" + "p1,a1,d1,2024-01-06,,15,r,Scheduled,true,,,\n"
    path = _write(spark, "reordered", text)
    with pytest.raises(Exception):
        extract_appointments(spark, path).collect()
    # positional binding only when explicitly asked for
    assert read_csv(spark, path, APPOINTMENTS, enforce_header=False).first().appointment_id == "p1"


def test_publish_is_idempotent_and_schema_follows(spark):
    name = "t_publish"
    path = scratch_path(spark, name)
    df = spark.range(5).withColumnRenamed("id", "k")
    publish_table(df, name, path)
    publish_table(df, name, path)
    assert spark.table(name).count() == 5
    wider = df.withColumn("extra", df.k * 2)
    assert "extra" in publish_table(wider, name, path).columns


def test_partitioned_sink_prunes(spark):
    from .conftest import SF001
    from carelake.sources import fixtures as fx

    path = scratch_path(spark, "by-month")
    write_path(add_partition_columns(fx.appointments(spark, SF001)), path, partition_by=["year", "month"])
    back = spark.read.parquet(path).filter("year = 1998 AND month = 3")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()
    assert back.count() == fx.appointments(spark, SF001).filter("year(appointment_date) = 1998 AND month(appointment_date) = 3").count()


def test_file_inventory_recursion(spark):
    root = scratch_path(spark, "inv")
    os.makedirs(os.path.join(root, "sub"))
    for p in ("a.csv", "sub/b.csv"):
        with open(os.path.join(root, p), "w") as fh:
            fh.write("x\n")
    flat = file_inventory(spark, root).collect()
    deep = file_inventory(spark, root, recursive=True).collect()
    assert len(flat) == 1 and len(deep) == 2
    assert all(r.length == 2 for r in deep)


def test_pipeline_definitions_need_a_pipeline_run(spark):
    from pyspark.errors import PySparkRuntimeError

    from carelake.plans.pipeline_definitions import define

    spark.conf.set("carelake.trips.path", "/root/testdata/sf0.001/events.parquet")
    with pytest.raises(PySparkRuntimeError):
        define(spark)


def test_checkpoint_root_reads_the_session_setting(spark):
    from carelake.session import CHECKPOINT_CONF, checkpoint_root

    current = checkpoint_root(spark)
    assert spark.conf.get(CHECKPOINT_CONF) == current
    assert scratch_path(spark, "x").startswith(current + "/x-")


def test_a_local_session_without_settings_gets_a_folder(tmp_path):
    """In a process of its own, with no defaults file: publishing works, and the folder stays the same."""
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from carelake.session import checkpoint_root, scratch_path\n"
        "from carelake.sources.sinks import publish_table\n"
        f"s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.warehouse.dir', '{tmp_path}/wh').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert checkpoint_root(s) == checkpoint_root(s)\n"
        "assert publish_table(s.range(3), 't', scratch_path(s, 't')).count() == 3\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def test_create_database_and_use(spark):
    from carelake.sources.sinks import create_database

    create_database(spark, "carelake_db_test")
    create_database(spark, "carelake_db_test")  # IF NOT EXISTS
    create_database(spark, "carelake_db_test", use=True)
    assert spark.catalog.currentDatabase() == "carelake_db_test"
    spark.catalog.setCurrentDatabase("default")


def test_partitioned_write_rebalances_files(spark):
    import glob

    from .conftest import SF001
    from carelake.sources import fixtures as fx

    df = add_partition_columns(fx.appointments(spark, SF001)).repartition(6)
    path = scratch_path(spark, "rebalanced")
    write_path(df, path, partition_by=["year"])
    dirs = glob.glob(path + "/year=*")
    files = glob.glob(path + "/year=*/*.parquet")
    assert len(files) == len(dirs)  # one right-sized file per folder instead of one per task
    assert spark.read.parquet(path).count() == df.count()


def test_read_table_optional_and_audited_batches(spark):
    from carelake.sources.readers import read_table
    from carelake.sources.sinks import publish_audited

    assert read_table(spark, None) is None
    name, path = "audit_batches", scratch_path(spark, "audit")
    df = spark.range(3)
    publish_audited(df, name, path, "overwrite", as_of="2024-01-01 00:00:00")
    out = publish_audited(df, name, path, "append", as_of="2024-01-02 03:04:05")
    batches = sorted(r.etl_batch_id for r in out.select("etl_batch_id").distinct().collect())
    assert batches == ["20240101000000", "20240102030405"] and out.count() == 6


def test_bucketed_publish_writes_one_file_per_bucket(spark):
    import glob

    df = spark.range(0, 5000).selectExpr("CAST(id % 97 AS STRING) AS patient_id", "id").repartition(7)
    path = scratch_path(spark, "bucketed")
    out = publish_table(df, "bucketed_files", path, bucket_by=["patient_id"], buckets=4)
    assert len(glob.glob(path + "/v-*/*.parquet")) == 4
    assert out.count() == 5000


def test_readers_see_old_or_new_rows_only(spark):
    """A reader in a loop during publishes, one of them failing: every read is one whole version."""
    import threading

    from pyspark.sql import functions as F

    name, path = "t_swapped", scratch_path(spark, "swapped")

    def version(k):
        return spark.range(0, 4000, 1, 8).select("id", F.lit(k).alias("k"))

    publish_table(version(0), name, path)
    seen, stop, errors = [], threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.table(name).agg(F.count("*"), F.min("k"), F.max("k")).first()))
            except Exception as e:
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 6):
            publish_table(version(k), name, path)
        with pytest.raises(Exception):
            publish_table(version(6).withColumn("k", F.expr("IF(id = 3999, raise_error('lost'), k)").cast("int")), name, path)
        # a table may be replaced from its own rows
        publish_table(spark.table(name).withColumn("k", F.col("k") + 2), name, path)
    finally:
        stop.set()
        reader.join()
    assert not errors, errors[0]
    assert spark.table(name).agg(F.min("k"), F.max("k"), F.count("*")).first() == (7, 7, 4000)
    assert {s[0] for s in seen} == {4000} and all(a == b for _, a, b in seen)
    assert [s[1] for s in seen] == sorted(s[1] for s in seen) and len({s[1] for s in seen}) > 1


def test_old_versions_go_after_the_delay(spark):
    from carelake.sources.sinks import remove_old_versions, versions

    name, path = "t_versions", scratch_path(spark, "versions")
    for n in range(3):
        publish_table(spark.range(n + 1), name, path)
    assert len(versions(spark, path)) == 3  # all of them replaced just now
    assert len(remove_old_versions(spark, name, path, keep_hours=0)) == 2
    assert len(versions(spark, path)) == 1 and spark.table(name).count() == 3
    publish_table(spark.range(9), name, path, keep_hours=0)
    publish_table(spark.range(5), name, path, mode="append")
    assert spark.table(name).count() == 14 and remove_old_versions(spark, name, path, keep_hours=0) == []


def test_publish_keeps_layouts_apart(spark):
    name, path = "t_layouts", scratch_path(spark, "layouts")
    df = spark.range(20).selectExpr("id", "id % 2 AS p")
    publish_table(df, name, path)
    publish_table(df, name, path, partition_by=["p"])
    assert spark.table(name).filter("p = 1").count() == 10
    publish_table(df.filter("id > 9"), name, path, partition_by=["p"])
    assert spark.table(name).filter("p = 1").count() == 5
    out = publish_table(df, name, path, bucket_by=["id"], buckets=2)
    assert out.count() == 20 and "PARTITIONED" not in spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    publish_table(df.limit(0), name)  # the warehouse's folder
    assert spark.table(name).count() == 0


def test_inventory_counts_and_changes(spark, tmp_path):
    from pyspark.sql import functions as F

    from carelake.sources.readers import inventory_changes, inventory_with_rows

    place = tmp_path / "in coming"
    place.mkdir()
    for name, text in {"a.csv": "h\n1\n2\n", "b c.csv": "h\n1\n", "empty.csv": "", "gone.csv": "h\n"}.items():
        (place / name).write_text(text)

    def seen():
        files = inventory_with_rows(spark, str(place), glob="*.csv")
        return files.withColumn("name", F.regexp_extract("path", "[^/]+$", 0)).select("name", "length", "n_rows").collect()

    schema = "name string, length long, n_rows long"
    before = seen()
    assert {(r.name, r.length, r.n_rows) for r in before} == {("a.csv", 6, 2), ("b c.csv", 4, 1), ("gone.csv", 2, 0)}
    (place / "gone.csv").unlink()
    (place / "a.csv").write_text("h\n1\n2\n3\n")
    (place / "new.csv").write_text("h\n1")
    out = inventory_changes(spark.createDataFrame(before, schema), spark.createDataFrame(seen(), schema), "name", ("length", "n_rows"))
    assert {(r.name, r.status, r.old_n_rows, r.new_n_rows) for r in out.collect()} == {
        ("a.csv", "changed", 2, 3), ("b c.csv", "unchanged", 1, 1),
        ("gone.csv", "removed", 0, None), ("new.csv", "added", None, 1),
    }
