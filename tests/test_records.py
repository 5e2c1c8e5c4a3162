"""CSV records over several lines, their rejects and their counts."""

import csv
import io
import os
import random

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from carelake.session import scratch_path
from carelake.sources import records
from carelake.sources.readers import extract

SCHEMA = StructType([
    StructField("id", StringType(), False), StructField("note", StringType()), StructField("n", IntegerType()), StructField("day", DateType())
])
HEADER = "id,note,n,day\n"


def folder(spark, texts):
    d = scratch_path(spark, "records")
    os.makedirs(d)
    for i, t in enumerate(texts):
        with open(os.path.join(d, f"part-{i}.csv"), "w", newline="") as f:
            f.write(t)
    return d


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_file(r, n, doubled):
    out, rows = io.StringIO(), []
    w = csv.writer(out, lineterminator="\n", doublequote=doubled, escapechar=None if doubled else "\\")
    for i in range(n):
        note = "".join(r.choice(["a", "b c", ",", "\n", '"', "\n\n", "5' ", "\r\nx", "é"]) for _ in range(r.randint(0, 9)))
        w.writerow([f"k{i}", note, r.choice(["", 7]), r.choice(["", "2024-01-06"])])
        rows.append(note)
    return out.getvalue()


@pytest.mark.parametrize("doubled", [True, False])
def test_any_split_gives_the_same_records(spark, doubled):
    """Against a reader of whole files, with splits of a few bytes, so that records lie across them."""
    r = random.Random(8)
    texts = [HEADER + random_file(r, n, doubled) for n in (40, 1, 0, 200)]
    path, escape = folder(spark, texts), '"' if doubled else "\\"
    want = as_rows(spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", escape).csv(path))
    assert len(want) == 241
    for size in ("64", "1000", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = records.read_records(spark, path, SCHEMA, escape)
            assert as_rows(got.filter("_reason IS NULL").select("id", "note", "n", "day")) == want
            assert got.count() == len(want)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_pieces_of_a_split_give_the_same_records(spark, monkeypatch):
    """What one task sorts is bounded by the piece, not by the split."""
    monkeypatch.setattr(records, "PIECE_BITS", 3)
    path = folder(spark, [HEADER + random_file(random.Random(n), n, False) for n in (90, 30)])
    pieces = records._lines(spark, path, "\\").groupBy("file", "block").count()
    assert pieces.count() > 10 and max(r["count"] for r in pieces.collect()) <= 8
    want = as_rows(spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).csv(path))
    assert len(want) == 120 and as_rows(extract(spark, path, SCHEMA, multi_line=True)) == want
    size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path))
    monkeypatch.setattr(records, "PART_BYTES", size // 20)
    assert records.shuffle_parts(spark, path) in (20, 21)
    assert as_rows(extract(spark, path, SCHEMA, multi_line=True)) == want


def test_rejects_keep_file_text_and_reason(spark):
    path = folder(spark, [
        HEADER + 'a,"one\ntwo",1,2024-01-06\nb,x,oops,2024-01-06\nc,x,1\nd,x,1,2024-13-99\n,x,1,2024-01-06\n\ne,"ok ""q""",2,\n',
        HEADER + 'f,5" pipe,1,\ng,"never closed,1,\nh,x,1,\n',
    ])
    got = records.read_records(spark, path, SCHEMA, '"')
    reasons = {r._raw: (r._reason, r._file[-10:]) for r in got.filter("_reason IS NOT NULL").collect()}
    assert reasons == {
        "b,x,oops,2024-01-06": ("n: bad value", "part-0.csv"), "c,x,1": ("wrong number of fields", "part-0.csv"),
        "d,x,1,2024-13-99": ("day: bad value", "part-0.csv"), ",x,1,2024-01-06": ("id: missing", "part-0.csv"),
        'g,"never closed,1,': (records.NEVER_CLOSED, "part-1.csv"), "h,x,1,": (records.NEVER_CLOSED, "part-1.csv"),
    }
    kept = {r.id: r.note for r in got.filter("_reason IS NULL").collect()}
    assert kept == {"a": "one\ntwo", "e": 'ok "q"', "f": '5" pipe'}


def test_reader_is_chosen_by_the_files(spark):
    plain, multi = folder(spark, [HEADER + 'a,"x, y",1,\nb,"",,\n']), folder(spark, [HEADER + 'a,"x\ny",1,\nb,"",,\n'])
    assert records.line_facts(spark, plain) == (False, False) and records.line_facts(spark, multi) == (True, False)
    # an empty field is null, as by Spark's defaults
    assert as_rows(extract(spark, plain, SCHEMA)) == [("a", "x, y", 1, None), ("b", None, None, None)]
    want = [("a", "x\ny", 1, None), ("b", None, None, None)]
    assert as_rows(extract(spark, multi, SCHEMA)) == want == as_rows(extract(spark, multi, SCHEMA, multi_line=True))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert records.line_facts(spark, multi) == (True, True)
        assert as_rows(extract(spark, multi, SCHEMA)) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_records_and_other_headers(spark, monkeypatch):
    monkeypatch.setattr(records, "MAX_RECORD_LINES", 3)
    path = folder(spark, [HEADER + 'a,"1\n2\n3",1,\nb,"1\n2\n3\n4",1,\nc,x,1,\n'])
    got = records.read_records(spark, path, SCHEMA)
    assert sorted(r.id for r in got.filter("_reason IS NULL").collect()) == ["a", "c"]
    assert got.filter(f"_reason = '{records.NEVER_CLOSED}'").count() == 4
    with pytest.raises(Exception, match="header differs"):
        records.read_records(spark, folder(spark, ['note,id,n,day\nx,"a\nb",1,\n']), SCHEMA).collect()
    assert records.read_records(spark, folder(spark, [HEADER]), SCHEMA).count() == 0
