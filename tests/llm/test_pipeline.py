import corpus_pipeline
from carelake.llm.common import materialize

from .data import AWKWARD, DOCS


def test_every_stage_survives_awkward_rows(spark, tmp_path):
    spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    extra = [(200 + i, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 3 + f"tail {i % 2}", "en", "a", 1, "x", 1) for i in range(4)]
    for rows in (AWKWARD + extra, []):
        docs = spark.createDataFrame(rows, DOCS)
        for name, stage in corpus_pipeline.STAGES:
            before = docs
            docs = materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
            if name != "packing":
                assert docs.columns == before.columns
        if rows:
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert {1, 200} <= ids and not ids & {2, 202, 203}


def test_near_copies_leave_by_row(spark, tmp_path):
    """Rows that share a doc_id with a near copy, or have none, are documents of their own."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen " * 2
    rows = [(1, base + "a"), (2, base + "b"), (2, "a clean text that is like no other"), (None, base + "c"), (None, "another clean text of its own"), (1, "and one more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()
    assert sorted(r.text for r in got) == sorted(t for _, t in (rows[0], rows[2], rows[4], rows[5]))
