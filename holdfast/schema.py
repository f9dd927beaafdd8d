"""Table layouts used across the package."""

from __future__ import annotations

from pyspark.sql import types as T

# The published revision-history layout. The files carry no header, so
# columns bind by position and both order and count matter.
_RAW_LAYOUT = """
wiki_db string
event_entity string
event_type string
event_timestamp string
event_comment string
event_user_id string
event_user_text_historical string
event_user_text string
event_user_blocks_historical string
event_user_blocks string
event_user_groups_historical string
event_user_groups string
event_user_is_bot_by_historical string
event_user_is_bot_by string
event_user_is_created_by_self boolean
event_user_is_created_by_system boolean
event_user_is_created_by_peer boolean
event_user_is_anonymous boolean
event_user_registration_timestamp string
event_user_creation_timestamp string
event_user_first_edit_timestamp string
event_user_revision_count bigint
event_user_seconds_since_previous_revision bigint
page_id string
page_title_historical string
page_title string
page_namespace_historical int
page_namespace_is_content_historical boolean
page_namespace int
page_namespace_is_content boolean
page_is_redirect boolean
page_is_deleted boolean
page_creation_timestamp string
page_first_edit_timestamp string
page_revision_count bigint
page_seconds_since_previous_revision bigint
user_id string
user_text_historical string
user_text string
user_blocks_historical string
user_blocks string
user_groups_historical string
user_groups string
user_is_bot_by_historical string
user_is_bot_by string
user_is_created_by_self boolean
user_is_created_by_system boolean
user_is_created_by_peer boolean
user_is_anonymous boolean
user_registration_timestamp string
user_creation_timestamp string
user_first_edit_timestamp string
revision_id string
revision_parent_id string
revision_minor_edit boolean
revision_deleted_parts string
revision_deleted_parts_are_suppressed boolean
revision_text_bytes bigint
revision_text_bytes_diff bigint
revision_text_sha1 string
revision_content_model string
revision_content_format string
revision_is_deleted_by_page_deletion boolean
revision_deleted_by_page_deletion_timestamp string
revision_is_identity_reverted boolean
revision_first_identity_reverting_revision_id string
revision_seconds_to_identity_revert bigint
revision_is_identity_revert boolean
revision_is_from_before_page_creation boolean
revision_tags string
"""


def struct(ddl: str) -> T.StructType:
    """Parse ``name type`` pairs separated by newlines or commas; needs no session."""
    simple = {
        "string": T.StringType(),
        "boolean": T.BooleanType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "double": T.DoubleType(),
        "timestamp": T.TimestampType(),
    }
    pairs = (p.split() for p in ddl.replace(",", "\n").splitlines() if p.strip())
    return T.StructType([T.StructField(name, simple[kind]) for name, kind in pairs])


RAW = struct(_RAW_LAYOUT)

# The columns of clean edits that jobs exchange.
CLEAN = struct(
    """
    wiki_db string, ts timestamp, year int, month int,
    event_user_id string, event_user_text string,
    event_user_registration_timestamp string, event_user_first_edit_timestamp string,
    event_user_revision_count bigint,
    page_id string, page_namespace int,
    revision_id string, revision_minor_edit boolean,
    revision_text_bytes bigint, revision_text_bytes_diff bigint,
    revision_is_identity_revert boolean, revision_is_identity_reverted boolean,
    event_comment string
    """
)

# The order of the feature vector is part of the contract between fit and scoring.
FEATURE_COLS = [
    "velocity",
    "revert_rate",
    "namespace_diversity",
    "avg_bytes_added",
    "avg_bytes_removed",
    "talk_page_ratio",
    "peak_hour_sin",
    "peak_hour_cos",
    "weekend_ratio",
    "edit_summary_rate",
    "minor_edit_ratio",
    "session_count",
    "first_edit_size",
]

FEATURES = struct(
    "event_user_id string, dropout int, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
)

# The fields of the raw change feed that the envelope needs. They are read as
# text, because the feed does not keep to one JSON type for each.
CHANGE = struct(
    """
    wiki string, type string, bot string, user string, title string, namespace string,
    timestamp string, length string, comment string, minor string, tags string
    """
)

ENVELOPE = struct(
    """
    user string, title string, namespace int, ts bigint,
    bytes_diff bigint, comment string, minor int, is_revert int
    """
)

# The columns of the scored stream.
SCORED = struct("user string, title string, ts bigint, dropout_risk double")

_FEATURE_MAP = T.MapType(T.StringType(), T.DoubleType())

LOGREG_MODEL = T.StructType(
    [
        T.StructField("intercept", T.DoubleType()),
        T.StructField("weights", _FEATURE_MAP),
        T.StructField("means", _FEATURE_MAP),
        T.StructField("stds", _FEATURE_MAP),
    ]
)

KMEANS_MODEL = T.StructType(
    [
        T.StructField(
            "centers_standardized", T.ArrayType(T.ArrayType(T.DoubleType()))
        ),
        T.StructField("feature_order", T.ArrayType(T.StringType())),
        T.StructField(
            "scaler",
            T.StructType(
                [
                    T.StructField("means", T.ArrayType(T.DoubleType())),
                    T.StructField("stds", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
    ]
)

RESULTS = struct(
    """
    cluster_id int, cluster_size bigint,
    model_auc_logreg double, model_auc_dnn double, kmeans_silhouette double,
    logreg_train_seconds double, kmeans_train_seconds double,
    """
    + ", ".join(f"mean_{c} double" for c in FEATURE_COLS)
)
