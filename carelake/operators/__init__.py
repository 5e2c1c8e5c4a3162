"""DataFrame -> DataFrame operators."""

from carelake.operators.features import (  # noqa: F401
    calculate_appointment_lead_time,
    calculate_patient_age,
    calculate_patient_history,
    conform_to_schema,
    extract_datetime_features,
    generate_features,
)
from carelake.operators.ml import (  # noqa: F401
    accuracy_frame,
    auc_frame,
    build_pipeline,
    category_dictionary,
    feature_importance,
    importance_from_nodes,
    index_by_dictionary,
    load_model,
    predict_no_shows,
    prepare_training_data,
    save_model,
    split_by_key,
    train_and_evaluate,
    train_gbt,
    train_random_forest,
    tree_nodes,
)
from carelake.operators.prefix import running_sums  # noqa: F401
from carelake.operators.quality import (  # noqa: F401
    contract_check,
    dedup_latest,
    describe,
    describe_long,
    merge_profiles,
    preview,
    profile_sketches,
    profile_table,
    row_counts,
    update_profile,
    validate_dataframe,
)
from carelake.operators.transforms import (  # noqa: F401
    add_audit_columns,
    add_partition_columns,
    add_surrogate_key,
    enrich_with_patients,
    enrich_with_physicians,
    filter_expr,
    transform_appointments,
    transform_patients,
    transform_physicians,
    upcoming_appointments,
)
