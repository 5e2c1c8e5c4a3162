"""The forest learner and scorer of ``operators.forest`` against Spark ML's own."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from carelake.operators import forest
from carelake.operators.ml import apply_model, fit_forest, gbt, predict_no_shows, random_forest, save_model, train_and_evaluate, train_random_forest, tree_nodes
from carelake.session import scratch_path

WHOLE = {"num_trees": 1, "featureSubsetStrategy": "all", "bootstrap": False}


@pytest.fixture(scope="module")
def rows(spark):
    """Three numeric columns (zeros, few and many values), a one-hot column, labels that depend on them."""
    df = spark.range(0, 4000).selectExpr(
        "id", "cast(id * 37 % 1009 - 400 as double) / 7 a", "cast(if(id % 3 = 0, 0, id * 7 % 23) as double) b", "cast(id * 13 % 5 as double) c",
        "concat('k', cast(id * 11 % 31 % 4 as string)) g",
        "cast((id * 37 % 1009 > 600) <> (id * 7 % 23 > 15 or id * 11 % 31 % 4 = 2 or id % 29 < 4) as double) label",
    )
    df = StringIndexer(inputCol="g", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    df = OneHotEncoder(inputCols=["i"], outputCols=["v"]).fit(df).transform(df)
    return VectorAssembler(inputCols=["v", "a", "b", "c"], outputCol="features").transform(df).select("id", "features", "label").checkpoint()


def _nodes(model, spark):
    return tree_nodes(model, spark).orderBy("tree", "node").collect()


def _same(ours, sparks):
    assert [(r.tree, r.node, r.feature, r.left_categories, list(r.stats), r.prediction, r.left, r.right) for r in ours] == [
        (r.tree, r.node, r.feature, r.left_categories, list(r.stats), r.prediction, r.left, r.right) for r in sparks
    ]
    for name in ("threshold", "gain"):
        one, other = ([-9.0 if r[name] is None else r[name] for r in nodes] for nodes in (ours, sparks))
        assert one == pytest.approx(other, rel=1e-9)


@pytest.mark.parametrize("depth, more", [(10, {}), (6, {"minInstancesPerNode": 40, "minInfoGain": 0.001, "maxBins": 9}), (0, {}), (1, {"maxBins": 256})])
def test_a_tree_of_all_rows_is_sparks(spark, rows, depth, more):
    clf = random_forest(depth, **WHOLE, **more)
    ours, sparks = _nodes(fit_forest(clf, rows), spark), _nodes(clf.fit(rows), spark)
    assert len(sparks) > (50 if depth == 10 else 0)
    _same(ours, sparks)


def test_blocks_tasks_and_pieces_do_not_change_the_tree(spark, rows, monkeypatch):
    clf = random_forest(7, **WHOLE)
    want = _nodes(fit_forest(clf, rows), spark)
    monkeypatch.setattr(forest, "MOST_BLOCK_ROWS", 64)
    monkeypatch.setattr(forest, "MOST_TASK_BYTES", 1000)
    monkeypatch.setattr(forest, "MOST_CELLS", 2000)
    monkeypatch.setattr("carelake.operators.ml.LEAST_TASK_ROWS", 100)
    _same(_nodes(fit_forest(clf, rows.repartition(5)), spark), want)


def test_no_forest_is_fitted_or_applied_row_by_row(spark, rows, monkeypatch):
    """Spark's own fit and transform of a forest cost microseconds for each row, tree and level."""

    def never(*_):
        raise AssertionError("row by row")

    monkeypatch.setattr(RandomForestClassifier, "_fit", never)
    model = train_random_forest(rows, max_depth=3, num_trees=4)
    assert model.getNumTrees == 4 and model.numFeatures == 7 and model.numClasses == 2
    visits = rows.selectExpr(
        "cast(id as string) appointment_id", "'p' patient_id", "current_date() appointment_date", "label = 1 no_show",
        *[f"concat('x', id % {k}) {c}" for k, c in ((2, "patient_gender"), (3, "physician_specialty"), (7, "day_of_week"), (4, "season"))],
        *[f"cast(id % {k} as double) {c}" for k, c in ((90, "patient_age"), (60, "appointment_lead_days"), (3, "previous_no_shows"),
                                                       (5, "previous_appointments"), (11, "no_show_rate"), (10, "appointment_hour"))],
    )
    model, metrics, _ = train_and_evaluate(visits, num_trees=3, max_depth=3)
    assert {r.name: r.value for r in metrics.filter("name like '%_size'").collect()}["train_size"] > 3000
    plan = predict_no_shows(model, visits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("trees", [1, 9])
def test_scores_are_sparks(spark, rows, trees):
    model = fit_forest(random_forest(6, trees), rows)
    holes = rows.union(spark.createDataFrame([(-1, [0.0, 1.0, 0.0, 0.0, float("nan"), 3.0, float("nan")], 0.0)], "id long, features array<double>, label double")
                       .select("id", _vector("features"), "label"))
    ours, sparks = apply_model(model, holes), model.transform(holes)
    assert ours.columns == sparks.columns and [f.dataType for f in ours.schema] == [f.dataType for f in sparks.schema]
    assert [f.metadata for f in ours.schema] == [f.metadata for f in sparks.schema]
    assert sorted(ours.collect(), key=lambda r: r.id)[1:] == sorted(sparks.collect(), key=lambda r: r.id)[1:]
    one, other = (x.filter("id = -1").select("rawPrediction", "probability", "prediction").first() for x in (ours, sparks))
    assert one == other


def _vector(name):
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.col(name)).alias(name)


def test_every_row_is_drawn_in_every_tree_by_poisson(spark, rows):
    cuts = forest.poisson_cuts(1.0)
    drawn = forest.bootstrap_weights(42, 3, 7, 200_000, cuts)
    assert (drawn == forest.bootstrap_weights(42, 3, 7, 200_000, cuts)).all()
    assert (drawn != forest.bootstrap_weights(42, 4, 7, 200_000, cuts)).any()
    assert np.bincount(drawn, minlength=4)[:4] / 200_000 == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131], abs=0.005)
    assert drawn.mean() == pytest.approx(1.0, abs=0.01) and drawn.max() >= 6
    assert forest.bootstrap_weights(42, 0, 0, 5, None).tolist() == [1] * 5
    roots = [r.weight for r in _nodes(fit_forest(random_forest(1, 20), rows), spark) if r.node == 0]
    assert len(roots) == 20 and len(set(roots)) > 10 and np.mean(roots) == pytest.approx(4000, rel=0.02)


def test_forest_learns_as_well_as_sparks(spark, rows):
    train, test = rows.filter("id % 5 <> 0"), rows.filter("id % 5 = 0")
    clf = random_forest(6, 30)
    hits = [m.transform(test).filter("prediction = label").count() / 800 for m in (fit_forest(clf, train), clf.fit(train))]
    assert hits[0] > 0.75 and hits[0] == pytest.approx(hits[1], abs=0.05)
    assert _nodes(fit_forest(clf, train.coalesce(1)), spark) == _nodes(fit_forest(clf, train.coalesce(1)), spark)


def test_the_model_is_saved_and_loaded_as_sparks(spark, rows):
    clf = random_forest(4, 5).setSeed(-7)
    model = fit_forest(clf, rows)
    again = RandomForestClassificationModel.load(save_model(model, scratch_path(spark, "m")))
    assert model.uid == clf.uid == again.uid and again.getOrDefault("maxDepth") == 4 and again.getOrDefault("seed") == -7
    assert _nodes(again, spark) == _nodes(model, spark)
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0)


@pytest.mark.parametrize("change, params", [
    (lambda df: df.withColumn("label", F.col("id") % 3), {}),
    (lambda df: df, {"impurity": "entropy"}),
    (lambda df: df, {"minWeightFractionPerNode": 0.1}),
    (lambda df: df.withColumn("features", F.col("features").alias("features", metadata={
        "ml_attr": {"attrs": {"nominal": [{"idx": 6, "num_vals": 5}]}, "num_attrs": 7}})), {}),
])
def test_other_forests_are_sparks(spark, rows, monkeypatch, change, params):
    monkeypatch.setattr(forest, "learn", None)
    model = fit_forest(random_forest(3, 2, **params), change(rows))
    assert apply_model(model, rows).count() == 4000
    assert {r.prediction for r in apply_model(model, rows).collect()} <= {0.0, 1.0, 2.0}


def test_boosted_trees_score_as_before(spark, rows):
    model = gbt(2, 2).fit(rows)
    assert forest.scorer_of(model, spark) is None
    assert apply_model(model, rows).columns == model.transform(rows).columns


def test_null_features_and_empty_tables_are_errors(spark, rows):
    with pytest.raises(Exception):  # noqa: B017  # Spark's own
        fit_forest(random_forest(2, 2), rows.withColumn("features", F.when(F.col("id") != 3, F.col("features")).alias("features", metadata=rows.schema["features"].metadata)))
    with pytest.raises(Exception):  # noqa: B017  # Spark's own
        fit_forest(random_forest(2, 2), rows.limit(0))
