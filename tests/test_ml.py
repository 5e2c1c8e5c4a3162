"""Spark ML pieces: indexer rules, AUC against Spark's evaluator, save/reload, split."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from carelake.operators.ml import (
    accuracy_frame,
    auc_frame,
    category_dictionary,
    dealt_for_training,
    feature_importance,
    gbt,
    importance_from_nodes,
    index_by_dictionary,
    load_model,
    positive_score,
    predict_no_shows,
    random_forest,
    save_model,
    split_by_key,
    train_and_evaluate,
    training_parts,
    tree_nodes,
)
from carelake.session import scratch_path


def test_indexer_null_unseen_and_ties(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "g string")
    model = StringIndexer(inputCol="g", outputCol="i", handleInvalid="keep").fit(train)
    assert model.labels == ["c", "a", "b"]  # frequency first, then alphabetical
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "g string")
    assert [r.i for r in model.transform(test).collect()] == [1.0, 3.0, 3.0]


def test_auc_matches_spark_evaluator(spark):
    df = spark.range(0, 4000).select(
        (F.col("id") % 97 / 97.0).alias("score"),
        F.when((F.col("id") * 7919 % 13) < 6 + (F.col("id") % 97) / 20, 1.0).otherwise(0.0).alias("label"),
    )
    ours = auc_frame(df, "score", "label").first().auc
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(df)
    assert ours == pytest.approx(ref, abs=1e-9)


def test_accuracy_counts_null_prediction_wrong(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (None, 0.0), (1.0, None)], "prediction double, label double")
    r = accuracy_frame(df).first()
    assert (r.accuracy, r.n) == (pytest.approx(1 / 3), 3)


def test_split_is_a_partition(spark):
    df = spark.range(0, 5000).selectExpr("CAST(id AS STRING) AS appointment_id")
    train, test = split_by_key(df, "appointment_id")
    assert train.count() + test.count() == 5000
    assert train.join(test, "appointment_id").count() == 0
    # stable under repartitioning
    train2, _ = split_by_key(df.repartition(7), "appointment_id")
    assert sorted(r[0] for r in train.collect()) == sorted(r[0] for r in train2.collect())


@pytest.fixture(scope="module")
def small_run(spark):
    from carelake.operators.features import generate_features
    from carelake.sources import fixtures as fx

    from .conftest import SF001

    feats = generate_features(fx.appointments(spark, SF001), fx.patients(spark, SF001), fx.physicians(spark, SF001))
    feats = feats.checkpoint()
    model, metrics, pred = train_and_evaluate(feats, num_trees=5, max_depth=4)
    return feats, model, metrics, pred


def test_train_and_evaluate_metrics(small_run):
    _, _, metrics, pred = small_run
    m = {(r.kind, r.name): r for r in metrics.collect()}
    assert 0.0 <= m[("metric", "auc")].value <= 1.0
    assert 0.0 <= m[("metric", "accuracy")].value <= 1.0
    assert m[("param", "num_trees")].value == 5.0
    assert m[("param", "train_size")].value + m[("param", "test_size")].value > 0
    probs = pred.select(positive_score().alias("p")).collect()
    assert all(0.0 <= r.p <= 1.0 for r in probs)


def test_reload_scores_equal(spark, small_run):
    feats, model, _, _ = small_run
    reloaded = load_model(save_model(model, scratch_path(spark, "m")))
    a = sorted((r.appointment_id, r.no_show_probability) for r in predict_no_shows(model, feats).collect())
    b = sorted((r.appointment_id, r.no_show_probability) for r in predict_no_shows(reloaded, feats).collect())
    assert a == b


def test_importances_cover_every_slot(small_run):
    feats, model, _, pred = small_run
    imp = feature_importance(model, pred).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert {r.source_column for r in imp} >= {"patient_age_f", "no_show_rate_f"}


def test_predictions_conform_to_declared_schema(spark, small_run):
    from carelake.operators.ml import conform_predictions
    from carelake.schemas import PREDICTIONS

    feats, model, _, _ = small_run
    pred = conform_predictions(predict_no_shows(model, feats, as_of="2001-01-01"), "v1")
    assert [(f.name, f.dataType) for f in pred.schema.fields] == [(f.name, f.dataType) for f in PREDICTIONS.fields]
    r = pred.first()
    assert r.model_version == "v1" and isinstance(r.prediction, bool) and 0.0 <= r.no_show_probability <= 1.0


def test_split_label_values(spark):
    from carelake.operators.ml import split_label

    df = split_label(spark.range(0, 200).selectExpr("CAST(id AS STRING) AS k"), "k")
    assert {r.split for r in df.collect()} == {"train", "test"}


class _Called(Exception):
    pass


@pytest.mark.parametrize("name, where", [
    ("train_random_forest", "carelake.operators.ml.train_random_forest"),
    ("train_gbt", "carelake.operators.ml.train_gbt"),
    ("feature_importance", "carelake.operators.ml.train_and_evaluate"),
    ("predict_no_shows", "carelake.operators.ml.train_and_evaluate"),
    ("score_reloaded", "carelake.operators.ml.train_and_evaluate"),
    ("score_upcoming", "carelake.plans.training.ml_training_job"),
])
def test_queries_train_with_the_defaults(spark, monkeypatch, name, where):
    from carelake.plans.queries import QUERIES

    from .conftest import SF001

    def called(*_, **params):
        assert not set(params) & {"max_depth", "num_trees", "max_iter"}
        raise _Called

    monkeypatch.setattr(where, called)
    with pytest.raises(_Called):
        QUERIES[name](spark, SF001)


@pytest.mark.parametrize("rows, cores, parts", [
    (0, 8, 1), (5_000, 8, 1), (12_000, 8, 3), (40_000, 8, 8), (4_000_000, 8, 8), (4_000_001, 8, 16), (43_000_000, 12, 96)
])
def test_training_parts_fill_the_cores(rows, cores, parts):
    assert training_parts(rows, cores) == parts


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr("carelake.operators.ml.LEAST_TASK_ROWS", 10)
    data = _assembled(spark).repartition(3)
    rows = dealt_for_training(data)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) == cores and sum(sizes) == 2000 and max(sizes) - min(sizes) <= 2 * cores
    assert rows.schema["features"].metadata == data.schema["features"].metadata
    assert rows.exceptAll(data.select(rows.columns)).count() == 0


def _assembled(spark):
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(0, 2000).selectExpr(
        "cast(id % 17 as double) a", "cast(id * 7 % 23 as double) b", "cast(id * 13 % 5 as double) c",
        "cast((id % 17 > 8) <> (id * 7 % 23 > 15 or id % 29 = 0) as double) label",
    )
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)


@pytest.mark.parametrize("learner, per_tree", [(lambda: random_forest(4, 7), True), (lambda: gbt(3, 4), False)])
def test_importance_from_node_table(spark, learner, per_tree):
    model = learner().fit(_assembled(spark))
    nodes = tree_nodes(model, spark)
    got = {r.feature: r.importance for r in importance_from_nodes(nodes, per_tree).collect()}
    want = model.featureImportances.toArray()
    assert len(got) > 1
    assert [got.get(i, 0.0) for i in range(3)] == pytest.approx(list(want), abs=1e-9)
    # every inner node's rows are its children's
    kids = {(r.tree, r.node): r for r in nodes.collect()}
    inner = [r for r in kids.values() if r.feature is not None]
    assert inner and all(r.weight == kids[r.tree, r.left].weight + kids[r.tree, r.right].weight for r in inner)


def test_node_table_of_one_leaf(spark):
    data = _assembled(spark).withColumn("label", F.lit(1.0)).union(_assembled(spark).limit(0))
    nodes = tree_nodes(random_forest(3, 1).fit(data), spark)
    assert [(r.node, r.feature, r.left) for r in nodes.collect()] == [(0, None, None)]
    assert importance_from_nodes(nodes).count() == 0


def test_dictionary_index_equals_string_indexer(spark):
    words = [f"w{i % 700}" if i % 3 else "hot" for i in range(5000)] + [None] * 50 + ["", "ä"]
    train = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "g string, index int")
    test = train.union(spark.createDataFrame([("unseen", -1)], "g string, index int"))
    model = StringIndexer(inputCol="g", outputCol="want", handleInvalid="keep").fit(train)
    words = category_dictionary(train, "g")
    assert [r.value for r in words.orderBy("index").collect()] == list(model.labels)
    got = index_by_dictionary(model.transform(test), {"g": words})
    assert got.columns == ["g", "index", "want", "g_idx"] and got.count() == test.count()
    assert got.filter("want <> g_idx or g_idx is null").count() == 0
    none = category_dictionary(train.filter("g is null"), "g")
    assert none.count() == 0 and {r.g_idx for r in index_by_dictionary(train.limit(3), {"g": none}).collect()} == {0.0}
