"""Column -> Column helpers; all built from JVM-side ``pyspark.sql.functions``."""

from tarmac.functions.columns import (  # noqa: F401
    artifact_id,
    clean_run_id,
    date_features,
    default_text,
    delay_class,
    display_id,
    kv_last_wins,
    ms_to_seconds,
    parse_model_ids,
    route,
    short_name,
    to_bool_text,
    to_epoch_ms,
)
