"""Column builders and fixed patterns."""
from logscope.functions import patterns
from logscope.functions.columns import (
    application_id, app_number, cluster_id, cluster_start, component, container_attempt,
    container_id, container_number, container_role, extract, is_entry_header, level,
    level_matches, log_time, minutes_between, path_ids, seconds_between, size_bytes, with_log_time,
)

__all__ = [
    "patterns", "application_id", "app_number", "cluster_id", "cluster_start", "component",
    "container_attempt", "container_id", "container_number", "container_role", "extract",
    "is_entry_header", "level", "level_matches", "log_time", "minutes_between", "path_ids",
    "seconds_between", "size_bytes", "with_log_time",
]
