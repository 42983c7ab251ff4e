"""Trip-record analytics on Spark: drifting monthly files to a star schema and its marts."""

from waybill.functions.dates import month_list, valid_window
from waybill.functions.names import (
    comments_for,
    detect_pickup_col,
    silver_comments_for,
    to_snake_case,
)
from waybill.operators.bronze import build_bronze, deduplicate, deduplicate_first
from waybill.operators.schema import promote_type, snake_case_columns, unify_schemas
from waybill.operators.silver import add_coded_labels, filter_valid_dates, standardize_silver
from waybill.operators.sinks import comment_statements, write_table
from waybill.operators.zones import enrich_with_zones
from waybill.session import apply_settings, local_session

__all__ = [
    "add_coded_labels",
    "apply_settings",
    "build_bronze",
    "comment_statements",
    "comments_for",
    "deduplicate",
    "deduplicate_first",
    "detect_pickup_col",
    "enrich_with_zones",
    "filter_valid_dates",
    "local_session",
    "month_list",
    "promote_type",
    "silver_comments_for",
    "snake_case_columns",
    "standardize_silver",
    "to_snake_case",
    "unify_schemas",
    "valid_window",
    "write_table",
]
