import hashlib
import re
import zlib

from pyspark.sql import functions as F

from carelake.llm import dedup, sharding

from .data import AWKWARD, awkward, empty


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(spark, monkeypatch):
    rows = [*AWKWARD, *[(100 + i, "same text" if i % 2 else f"own {i}", None, None, None, None, None) for i in range(300)]]
    big = 1 << 62
    for bits in (16, 1):  # the second filter is nearly full: every row is a possible repeat
        monkeypatch.setattr(dedup, "BITS_PER_ROW", bits)
        got = dedup.exact_dedup(awkward(spark, rows)).collect()
        assert len(got) == len(rows)
        groups = {}
        for r in rows:
            groups.setdefault(norm(r[1]), []).append(r[0])
        by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        for sha, ids in by_sha.items():
            own = [r for r in got if r.text_sha256 == sha]
            keep = min((i for i in ids if i is not None), default=None)
            assert len(own) == len(ids) and {r.group_size for r in own} == {len(ids)} and {r.keep_id for r in own} == {keep}
            assert [r.doc_id for r in own if r.kept] == [keep]
        kept = dedup.drop_duplicates(awkward(spark, rows))
        assert kept.columns == awkward(spark).columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert dedup.exact_dedup(empty(spark)).count() == 0
    assert dedup.drop_duplicates(empty(spark)).count() == 0


def test_bitmaps_larger_than_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", 0)
    assert dedup.exact_dedup(awkward(spark)).filter("kept").count() == len({norm(r[1]) for r in AWKWARD})


def exchanges(df):
    """Output columns of the shuffles in the plan of ``df``."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line and "rangepartitioning" not in line]


def test_large_filter_shuffles_only_stubs(spark, monkeypatch):
    """Beyond one broadcast: right results in several parts, and no row that is alone moves."""
    rows = [(i, f"own {i}" if i % 3 else f"same {i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", dedup.BITMAP_BITS // 8)
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in dedup.exact_dedup(docs).collect()}
    assert got == {i: (min(groups[t]), len(groups[t]), i == min(groups[t])) for i, t in rows}
    assert sorted(r.doc_id for r in dedup.drop_duplicates(docs).collect()) == sorted(min(g) for g in groups.values())
    alone, _ = dedup.mark_repeats(docs, "text", "doc_id", ["doc_id", "text"])
    assert not exchanges(alone) and alone.count() >= 0.9 * sum(len(g) == 1 for g in groups.values())


def sized(docs):
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "shard", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"))


def test_shards_are_contiguous_and_even(spark):
    docs = spark.range(0, 5000).selectExpr("id as doc_id", "repeat('ü', cast(id * 37 % 211 as int)) as text", "1 as shard")
    got = sorted(sharding.shard_by_bytes(sized(docs), 16, ["doc_id", "crc", "size"]).collect(), key=lambda r: r.doc_id)
    assert [r.shard for r in got] == sorted(r.shard for r in got)
    totals = [sum(r.size for r in got if r.shard == s) for s in range(16)]
    assert max(totals) - min(totals) <= 2 * max(r.size for r in got)
    for s in range(16):
        assert [r.slot for r in got if r.shard == s] == list(range(sum(r.shard == s for r in got)))
    for r in got[::400]:
        assert r.crc == zlib.crc32(("ü" * (r.doc_id * 37 % 211)).encode())


def test_awkward_shards(spark):
    got = sharding.shard_by_bytes(sized(awkward(spark)), 4, ["doc_id", "crc", "size"]).collect()
    assert len(got) == len(AWKWARD)
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_by_bytes(sized(empty(spark)), 4, ["doc_id"]).count() == 0


def test_a_third_of_the_rows_is_one_row(spark):
    docs = spark.range(0, 900).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "'same' as text", "1 as shard")
    got = sharding.shard_by_bytes(sized(docs), 9, ["doc_id", "crc", "size"]).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert [(r.n, r.m) for r in got] == [(100, 99)] * 9


def test_written_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard_by_bytes(sized(awkward(spark)), 2, ["doc_id"]), path)
    assert spark.read.parquet(path).count() == len(AWKWARD)
