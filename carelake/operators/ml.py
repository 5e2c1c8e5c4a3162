"""No-show model: preparation, training, evaluation and scoring with Spark ML.

Everything runs distributed: StringIndexer/OneHotEncoder/VectorAssembler are
column transforms, random forests train and score with ``operators.forest``
(Spark ML's method and model, over binned rows as arrays), GBT with Spark ML's
tree learner, and the evaluation metrics are DataFrame aggregates.  One
``PipelineModel`` (imputation + indexing + encoding + assembly + classifier)
is fitted once on the training split and applied unchanged to test and
scoring rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default categorical and numeric inputs, the split cut-off on
# the md5 hex prefix of the key (about 80% train), and the model defaults.
CATEGORICAL_COLS = ["patient_gender", "physician_specialty", "day_of_week", "season"]
NUMERICAL_COLS = [
    "patient_age",
    "appointment_lead_days",
    "previous_no_shows",
    "previous_appointments",
    "no_show_rate",
    "appointment_hour",
]
TRAIN_PREFIX_CUTOFF = "cccd"
RF_MAX_DEPTH = 10
RF_NUM_TREES = 100
GBT_MAX_DEPTH = 5
GBT_MAX_ITER = 50
SEED = 42
# Rows of a training task: no fewer, so that a task is worth its tree statistics, and no more, so that its cached rows stay small.
LEAST_TASK_ROWS, MOST_TASK_ROWS = 5_000, 500_000


def is_train(key_col: str, cutoff: str = TRAIN_PREFIX_CUTOFF) -> Column:
    """Deterministic split membership from the key's md5 prefix (independent of partitioning)."""
    return F.substring(F.md5(F.col(key_col).cast("string")), 1, 4) < F.lit(cutoff)


def split_label(df: DataFrame, key_col: str, cutoff: str = TRAIN_PREFIX_CUTOFF) -> DataFrame:
    """Adds ``split`` = ``train`` / ``test``."""
    return df.withColumn("split", F.when(is_train(key_col, cutoff), F.lit("train")).otherwise(F.lit("test")))


def split_by_key(df: DataFrame, key_col: str, cutoff: str = TRAIN_PREFIX_CUTOFF) -> tuple[DataFrame, DataFrame]:
    """(train, test): a partition of ``df`` that is the same on every run and every cluster size."""
    cond = is_train(key_col, cutoff)
    return df.filter(cond), df.filter(~cond)


def _imputer(numerical_cols: list[str]):
    """SQL stage: ``coalesce(x, 0)`` into ``x_f`` for each numeric input.

    Being a pipeline stage, it is applied identically at fit, test and scoring time.
    """
    from pyspark.ml.feature import SQLTransformer

    parts = [f"coalesce(`{c}`, 0) AS `{c}_f`" for c in numerical_cols]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def with_label(df: DataFrame, target_col: str = "no_show") -> DataFrame:
    """Adds the double ``label``.  Not a pipeline stage: scoring needs no target column."""
    return df.withColumn("label", F.col(target_col).cast("double"))


def build_pipeline(
    categorical_cols: list[str] | None = None,
    numerical_cols: list[str] | None = None,
    classifier=None,
):
    """Imputer, one StringIndexer and OneHotEncoder per categorical column
    (unseen/NULL categories kept in an extra slot that encodes to all zeros),
    a VectorAssembler into ``features``, and optionally a classifier.

    Returns ``(Pipeline, assembler_input_names)``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    cats = list(categorical_cols or CATEGORICAL_COLS)
    nums = list(numerical_cols or NUMERICAL_COLS)
    # One multi-column indexer: all category counts come from a single pass.
    indexer = StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats], handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_vec" for c in cats])
    inputs = [f"{c}_vec" for c in cats] + [f"{c}_f" for c in nums]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    stages = [_imputer(nums), indexer, encoder, assembler]
    if classifier is not None:
        stages.append(classifier)
    return Pipeline(stages=stages), inputs


def prepare_training_data(
    df: DataFrame,
    categorical_cols: list[str] | None = None,
    numerical_cols: list[str] | None = None,
    target_col: str = "no_show",
):
    """Fit the preparation stages on ``df``; returns ``(PipelineModel, transformed df, input names)``."""
    pipeline, inputs = build_pipeline(categorical_cols, numerical_cols)
    model = pipeline.fit(df)
    return model, with_label(model.transform(df), target_col), inputs


def random_forest(max_depth: int = RF_MAX_DEPTH, num_trees: int = RF_NUM_TREES, seed: int = SEED, **kw):
    """Random forest on ``features``/``label``.

    ``cacheNodeIds=True`` gives the same model faster (each row's current node is kept between
    levels), at the price of one node id per row and tree; it is off by default, as in Spark.
    """
    from pyspark.ml.classification import RandomForestClassifier

    return RandomForestClassifier(
        featuresCol="features", labelCol="label", maxDepth=max_depth, numTrees=num_trees, seed=seed, **kw
    )


def gbt(max_depth: int = GBT_MAX_DEPTH, max_iter: int = GBT_MAX_ITER, seed: int = SEED, **kw):
    from pyspark.ml.classification import GBTClassifier

    return GBTClassifier(featuresCol="features", labelCol="label", maxDepth=max_depth, maxIter=max_iter, seed=seed, **kw)


def training_parts(rows: int, cores: int) -> int:
    """How many equal tasks ``rows`` are trained in: whole rounds of the cores, unless the rows are few."""
    if rows < LEAST_TASK_ROWS * cores:
        return max(1, -(-rows // LEAST_TASK_ROWS))
    return cores * -(-rows // (MOST_TASK_ROWS * cores))


def dealt_for_training(df: DataFrame, feature_col: str = "features") -> DataFrame:
    """``label`` and features of ``df`` in equal partitions.  Every level of every tree is a pass over them, as long as its
    last task; the files of a table rarely fill the cores evenly."""
    return df.select(feature_col, "label").repartition(training_parts(df.count(), df.sparkSession.sparkContext.defaultParallelism))


def fit_forest(clf, df: DataFrame):
    """``clf.fit(df)`` of a random forest (features and ``label``).  Labels other than 0 and 1, categories of more than two
    values and parameters that ``operators.forest`` does not take are Spark's own learner's.  A model from ``operators.forest``
    has no training ``summary``."""
    from carelake.operators import forest

    feature_col, cores = clf.getFeaturesCol(), df.sparkSession.sparkContext.defaultParallelism
    n_features, two_valued = forest.number_of_features(df, feature_col), forest.two_valued_features(df, feature_col)
    if forest.can_learn(clf, n_features, two_valued):
        y = F.col("label")
        is_binary = F.coalesce(y.isin(0.0, 1.0), F.lit(False))
        seen = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~is_binary).alias("other"), F.count_if(y == 1.0).alias("ones")).first()
        if seen.ones and not seen.other:
            return forest.learn(clf, df, seen.rows, n_features, two_valued, cores, LEAST_TASK_ROWS)
    return clf.fit(dealt_for_training(df, feature_col))


def apply_model(model, df: DataFrame) -> DataFrame:
    """``model.transform(df)``: a forest at the end scores in batches of rows (``operators.forest``), all else as Spark does."""
    from pyspark.ml import PipelineModel

    from carelake.operators import forest

    stages = list(model.stages) if hasattr(model, "stages") else [model]
    scorer = forest.scorer_of(stages[-1], df.sparkSession) if stages else None
    if scorer is None:
        return model.transform(df)
    return forest.score(stages[-1], PipelineModel(stages[:-1]).transform(df), scorer)


def train_random_forest(
    df: DataFrame, feature_col: str = "features", target_col: str = "label",
    max_depth: int = RF_MAX_DEPTH, num_trees: int = RF_NUM_TREES, **kw,
):
    """Random forest on an assembled frame; the label is cast to double and NULL labels are skipped."""
    data = df.filter(F.col(target_col).isNotNull()).withColumn("label", F.col(target_col).cast("double"))
    return fit_forest(random_forest(max_depth, num_trees, **kw).setFeaturesCol(feature_col), data)


def train_gbt(
    df: DataFrame, feature_col: str = "features", target_col: str = "label",
    max_depth: int = GBT_MAX_DEPTH, max_iter: int = GBT_MAX_ITER, **kw,
):
    """Gradient-boosted trees on an assembled frame (labels as in ``train_random_forest``)."""
    data = df.filter(F.col(target_col).isNotNull()).withColumn("label", F.col(target_col).cast("double"))
    return gbt(max_depth, max_iter, **kw).setFeaturesCol(feature_col).fit(dealt_for_training(data, feature_col))


def positive_score(prob_col: str = "probability") -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(prob_col))[1]


def auc_frame(df: DataFrame, score_col: str, label_col: str = "label", n_chunks: int | None = None) -> DataFrame:
    """Area under the ROC curve as a one-row DataFrame ``(auc, positives, negatives)``.

    Ties count one half (same as the trapezoid ROC area).  Rows are first
    grouped by distinct score (map-side combined), then each score needs the
    number of negatives ranked below it: a prefix sum over the sorted scores,
    computed in range-partitioned chunks so no task holds all scores.
    """
    from carelake.operators.prefix import running_sums

    y = F.col(label_col).cast("double")
    s = F.col(score_col).cast("double")
    grouped = (
        df.filter(y.isNotNull() & s.isNotNull())
        .groupBy(s.alias("_score"))
        .agg(F.sum(y).alias("_pos"), F.sum(F.lit(1.0) - y).alias("_neg"))
    )
    if n_chunks is None:
        n_chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = running_sums(grouped, [], ["_score"], {"_below": F.col("_neg")}, n_chunks)
    return ranked.agg(
        F.try_divide(
            F.sum(F.col("_pos") * (F.col("_below") + F.lit(0.5) * F.col("_neg"))),
            F.sum("_pos") * F.sum("_neg"),
        ).alias("auc"),
        F.sum("_pos").cast("bigint").alias("positives"),
        F.sum("_neg").cast("bigint").alias("negatives"),
    )


def accuracy_frame(df: DataFrame, prediction_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """One-row ``(accuracy, n)``: share of labelled rows whose prediction equals the label
    (a NULL prediction counts as wrong)."""
    y = F.col(label_col).cast("double")
    p = F.col(prediction_col).cast("double")
    hit = F.coalesce(p == y, F.lit(False)).cast("double")
    return df.filter(y.isNotNull()).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def feature_importance(model, transformed: DataFrame, features_col: str = "features") -> DataFrame:
    """``(feature, source_column, importance)`` per vector slot.

    Slot names come from the assembled column's ML attributes, so a one-hot
    column contributes one row per category (``patient_gender_vec_F`` ...);
    ``source_column`` maps each slot back to its input column.
    """
    tree_model = model.stages[-1] if hasattr(model, "stages") else model
    imp = tree_model.featureImportances.toArray()
    attrs = transformed.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    inputs = None
    for st in getattr(model, "stages", []):
        if hasattr(st, "getInputCols") and st.getOutputCol() == features_col:
            inputs = st.getInputCols()

    def source(name):
        for c in inputs or []:
            if name == c or name.startswith(c + "_"):
                return c
        return name

    rows = [(names.get(i, f"f{i}"), source(names.get(i, f"f{i}")), float(v)) for i, v in enumerate(imp)]
    spark = transformed.sparkSession
    return spark.createDataFrame(rows, "feature string, source_column string, importance double")


def tree_nodes(model, spark) -> DataFrame:
    """The nodes of a fitted tree ensemble (or of the last stage of a pipeline), one row each, from its saved form.

    ``tree, node, feature, threshold, left_categories, gain, weight, stats, prediction, left, right``.  Leaves have
    null ``feature``, ``gain`` and children; ``threshold`` is null where a category splits, ``left_categories`` where
    a number does.  ``weight`` is the weight of the training rows that reach the node; ``stats`` are their weights by
    label (classification trees), or weight, sum and sum of squares (regression trees, as in boosting).
    """
    from carelake.session import scratch_path

    tree_model = model.stages[-1] if hasattr(model, "stages") else model
    saved = spark.read.parquet(f"{save_model(tree_model, scratch_path(spark, 'trees'))}/data")
    boosted = "GBT" in type(tree_model).__name__
    inner, numeric = F.col("n.leftChild") >= 0, F.col("n.split.numCategories") == -1
    stats = F.col("n.impurityStats")
    weight = stats[0] if boosted else F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return saved.select("treeID", F.col("nodeData").alias("n")).select(
        F.col("treeID").alias("tree"), F.col("n.id").alias("node"),
        F.when(inner, F.col("n.split.featureIndex")).alias("feature"),
        F.when(inner & numeric, F.get(F.col("n.split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.when(inner & ~numeric, F.col("n.split.leftCategoriesOrThreshold")).alias("left_categories"),
        F.when(inner, F.col("n.gain")).alias("gain"), weight.alias("weight"), stats.alias("stats"),
        F.col("n.prediction").alias("prediction"),
        F.when(inner, F.col("n.leftChild")).alias("left"), F.when(inner, F.col("n.rightChild")).alias("right"),
    )


def importance_from_nodes(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """``(feature, importance)`` of the vector slots that split any node of ``tree_nodes``.

    A split counts its gain times the weight of its rows; ``per_tree`` gives every tree the same total (forests),
    else trees count as they are (boosting).  The importances sum to 1.
    """
    split = nodes.filter("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("part"))
    if per_tree:
        totals = split.groupBy("tree").agg(F.sum("part").alias("of_tree"))
        split = split.join(totals, "tree").select("feature", F.try_divide("part", "of_tree").alias("part"))
    by_feature = split.groupBy("feature").agg(F.sum("part").alias("part"))
    total = by_feature.agg(F.sum("part").alias("total"))
    return by_feature.join(F.broadcast(total)).select("feature", F.try_divide("part", "total").alias("importance"))


def category_dictionary(df: DataFrame, column: str) -> DataFrame:
    """``(value, index)`` of the non-null values of ``column``: 0 is the most frequent, equal counts in the order of
    the values.  A table like any other, for categories whose values no driver could hold as an array."""
    from carelake.operators.prefix import running_sums

    counts = df.filter(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("_n"))
    n_chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = running_sums(counts, [], [F.desc("_n"), F.col("value")], {"_before": F.lit(1)}, n_chunks)
    return ranked.select("value", F.col("_before").cast("double").alias("index"))


def index_by_dictionary(df: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """``df`` plus ``<column>_idx`` for each dictionary: the index of the column's value, and the size of the dictionary
    for values that it lacks and for NULL (as ``StringIndexer`` with ``handleInvalid="keep"`` does).

    Spark chooses each join by the dictionary's size; a hot value of a sort-merge join is AQE's to split.
    """
    out = df
    for column, words in dictionaries.items():
        words = words.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
        size = float(words.count())
        out = out.join(words, F.col(f"`{column}`").cast("string") == F.col("_value"), "left")
        out = out.withColumn(f"{column}_idx", F.coalesce("_index", F.lit(size))).drop("_value", "_index")
    return out


def predict_no_shows(model, df: DataFrame, as_of=None, model_version: str | None = None) -> DataFrame:
    """Score ``df``: ids, ``prediction``, ``prediction_timestamp``, ``no_show_probability`` = P(no-show)."""
    from carelake.functions.columns import as_of_timestamp

    pred = apply_model(model, df)
    out = pred.select(
        "appointment_id",
        "patient_id",
        "appointment_date",
        "prediction",
        as_of_timestamp(as_of).alias("prediction_timestamp"),
        positive_score("probability").alias("no_show_probability"),
    )
    if model_version is not None:
        out = out.withColumn("model_version", F.lit(model_version))
    return out


def conform_predictions(pred: DataFrame, model_version: str) -> DataFrame:
    """Cast scored rows to the declared prediction schema (float probability, boolean prediction)."""
    from carelake.operators.features import conform_to_schema
    from carelake.schemas import PREDICTIONS

    return conform_to_schema(
        pred.withColumns({"prediction": F.col("prediction") > 0.5, "model_version": F.lit(model_version)}),
        PREDICTIONS,
    )


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def train_and_evaluate(
    df: DataFrame,
    categorical_cols: list[str] | None = None,
    numerical_cols: list[str] | None = None,
    target_col: str = "no_show",
    key_col: str = "appointment_id",
    model_type: str = "random_forest",
    run_id: str | None = None,
    **params,
):
    """Split by key hash, fit one pipeline (preparation + classifier) on train, evaluate on test.

    The test split is scored once: label, score and prediction are written to the shared
    scratch folder and both metrics read them from there.  Returns ``(PipelineModel, metrics DataFrame, test predictions)``.  The
    metrics table has ``(run_id, kind, name, value, detail)`` rows for the
    parameters, split sizes, AUC, accuracy and per-slot importances.
    """
    import uuid

    from pyspark.ml import PipelineModel

    run_id = run_id or uuid.uuid4().hex
    labeled = with_label(df.filter(F.col(target_col).isNotNull()), target_col)
    train, test = split_by_key(labeled, key_col)
    if model_type == "random_forest":
        clf = random_forest(**params)
        settings = {"max_depth": clf.getMaxDepth(), "num_trees": clf.getNumTrees()}
    elif model_type == "gbt":
        clf = gbt(**params)
        settings = {"max_depth": clf.getMaxDepth(), "max_iter": clf.getMaxIter()}
    else:
        raise ValueError(f"unknown model_type {model_type!r}")
    prepared = build_pipeline(categorical_cols, numerical_cols)[0].fit(train)
    rows = prepared.transform(train)
    trees = fit_forest(clf, rows) if model_type == "random_forest" else clf.fit(dealt_for_training(rows))
    model = PipelineModel([*prepared.stages, trees])
    pred = apply_model(model, test)

    spark = df.sparkSession
    schema = "run_id string, kind string, name string, value double, detail string"
    param_rows = [(run_id, "param", "model_type", None, model_type)] + [
        (run_id, "param", k, float(v), None) for k, v in settings.items()
    ]
    parts = [spark.createDataFrame(param_rows, schema)]

    def metric(frame: DataFrame, kind: str, name: str, col: str) -> DataFrame:
        return frame.select(
            F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), F.lit(name).alias("name"),
            F.col(col).cast("double").alias("value"), F.lit(None).cast("string").alias("detail"),
        )

    from carelake.session import scratch_path

    path = scratch_path(spark, "scored-test")
    pred.select("label", positive_score().alias("_score"), "prediction").write.parquet(path)
    scored = spark.read.parquet(path)
    sizes = labeled.agg(
        F.count_if(is_train(key_col)).alias("train_size"), F.count_if(~is_train(key_col)).alias("test_size")
    )
    stacked = F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in ("train_size", "test_size")]))
    parts.append(
        sizes.select(stacked).select(
            F.lit(run_id).alias("run_id"), F.lit("param").alias("kind"), "name",
            F.col("n").cast("double").alias("value"), F.lit(None).cast("string").alias("detail"),
        )
    )
    parts.append(metric(auc_frame(scored, "_score"), "metric", "auc", "auc"))
    parts.append(metric(accuracy_frame(scored), "metric", "accuracy", "accuracy"))
    imp = feature_importance(model, pred)
    parts.append(
        imp.select(
            F.lit(run_id).alias("run_id"), F.lit("importance").alias("kind"), F.col("feature").alias("name"),
            F.col("importance").alias("value"), F.col("source_column").alias("detail"),
        )
    )
    from functools import reduce

    metrics = reduce(DataFrame.unionByName, parts)
    return model, metrics, pred
