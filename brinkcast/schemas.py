"""Row types of the data model, as Spark schemas (DDL strings)."""

from __future__ import annotations

SOURCES = "source_id string, name string, kind string, url string, metadata map<string,string>"

# One entry of a landed feed, before it is known to be new.
FEED_PAYLOAD = (
    "source string, external_id string, published_at timestamp, author string, "
    "raw_content string, media_urls array<string>, raw_metadata map<string,string>"
)

RAW_ITEMS = (
    "raw_item_id string, source_id string, external_id string, published_at timestamp, "
    "captured_at timestamp, author string, raw_content string, media_urls array<string>, "
    "raw_metadata map<string,string>"
)

ITEMS = "item_id string, raw_item_id string, language string, clean_text string, token_count int"

ANNOTATIONS = (
    "item_id string, annotator string, valence_level int, target_type string, target_name string, "
    "confidence double, rationale string, annotated_at timestamp, labeler_version string"
)

PREDICTIONS = (
    "made_at timestamp, window_start timestamp, window_end timestamp, model_version string, "
    "feature_set_version string, feature_hash string, c1_value double, c2_3_prob double, "
    "c2_4_prob double, c2_5_prob double, c2_6_prob double, c3_prob double, c4_prob double, "
    "payload string"
)

OUTCOMES = (
    "window_start timestamp, window_end timestamp, v_max int, n_posts long, "
    "targets_observed string, had_jump boolean, computed_at timestamp"
)

# A label as a labeler returns it, before validation.
LABEL_RESULT = (
    "level int, target_type string, target_name string, rationale string, confidence double"
)

# The ordinal scale, the allowed target types, the scored thresholds.
LEVELS = (0, 1, 2, 3, 4, 5, 6)
TARGET_TYPES = ("person", "institution", "group", "media", "self_referential", "none")
THRESHOLDS = (3, 4, 5, 6)
