import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from carelake.llm import bpe, jaccard, packing
from carelake.llm.common import TEXT_BATCH_BYTES, materialize, released_after

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_codec_leaves_the_worker_when_another_operator_runs_there():
    bpe.codec(PATH)
    assert list(released_after(iter([1, 2]), "bpe")) == [1, 2] and PATH in bpe._LOADED
    assert list(released_after(iter([3]))) == [3] and not bpe._LOADED


def test_batches_of_texts_are_bounded_and_the_setting_comes_back(spark):
    docs = spark.range(0, 400, 1, 1).select(F.lit("x" * 100_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]})

    before = spark.conf.get(LIMIT)
    rows = materialize(docs.mapInArrow(sizes, "n long, bytes long"), "test-batches", TEXT_BATCH_BYTES).collect()
    assert sum(r.n for r in rows) == 400 and max(r.bytes for r in rows) < TEXT_BATCH_BYTES + 200_000
    assert spark.conf.get(LIMIT) == before


def test_operators_on_texts_bound_their_batches(spark, monkeypatch):
    """Packing and the near-duplicate join write what Python makes of whole texts under the limit."""
    seen = {}

    def written(df, name, batch_bytes=None):
        seen[name] = batch_bytes
        return materialize(df, name, batch_bytes)

    for module in (packing, jaccard):
        monkeypatch.setattr(module, "materialize", written)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (None, None)], "doc_id long, text string")
    assert packing.pack(bpe.pieces(docs, PATH, 16, 2).drop("ids"), 16).count() > 3
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 4, 85).collect()} == {1: 1, 2: 1, None: None}
    assert {seen[n] for n in ("pieces", "columns", "incidence", "jaccard-sets")} == {TEXT_BATCH_BYTES}
