"""ML job: features -> feature table -> train/evaluate -> save/reload -> score upcoming -> predictions table.

Deviation from a literal replay (recorded in the README): history features
are computed over all appointments and the upcoming filter is applied
afterwards, so completed visits count in the history of upcoming ones.

The feature table is written once and every later step reads it back, which
cuts the lineage (joins + window) before training iterates over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.operators.features import conform_to_schema, generate_features
from carelake.operators.ml import (
    conform_predictions,
    load_model,
    predict_no_shows,
    save_model,
    train_and_evaluate,
)
from carelake.operators.transforms import upcoming_appointments
from carelake.sources.sinks import publish_table


def create_feature_table(
    spark: SparkSession,
    features_df: DataFrame,
    target_table: str = "appointment_features",
    target_path: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Publish features cast to the declared feature schema; the warehouse picks the path when none is given."""
    from carelake.schemas import FEATURES

    return publish_table(conform_to_schema(features_df, FEATURES), target_table, target_path, fmt=fmt)


def ml_training_job(
    spark: SparkSession,
    appointments: DataFrame,
    patients: DataFrame,
    physicians: DataFrame,
    base_path: str,
    database: str | None = None,
    as_of=None,
    model_type: str = "random_forest",
    model_version: str | None = None,
    metrics_mode: str = "append",
    fmt: str = "parquet",
    **params,
) -> dict[str, DataFrame]:
    """Returns the published ``features``, ``metrics`` and ``predictions`` tables."""
    import uuid

    prefix = f"{database}." if database else ""
    base = base_path.rstrip("/")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    features = create_feature_table(
        spark, generate_features(appointments, patients, physicians), f"{prefix}appointment_features", f"{base}/features", fmt
    )
    run_id = uuid.uuid4().hex
    model, metrics, _ = train_and_evaluate(features, model_type=model_type, run_id=run_id, **params)
    metrics = publish_table(metrics, f"{prefix}model_runs", f"{base}/model_runs", mode=metrics_mode, fmt=fmt)
    model = load_model(save_model(model, f"{base}/models/{run_id}"))
    upcoming_ids = upcoming_appointments(appointments, as_of).select("appointment_id")
    to_score = features.join(upcoming_ids, "appointment_id", "left_semi")
    preds = conform_predictions(predict_no_shows(model, to_score, as_of), model_version or run_id)
    name = f"{prefix}appointment_predictions"
    if spark.catalog.tableExists(name) and to_score.isEmpty():
        predictions = spark.table(name)  # nothing upcoming: the last predictions stay
    else:
        predictions = publish_table(preds, name, f"{base}/predictions", fmt=fmt)
    return {"features": features, "metrics": metrics, "predictions": predictions}
