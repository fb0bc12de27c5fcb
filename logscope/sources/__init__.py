"""Sources: text log trees, parquet tables and periods, fixture corpus, result re-reads."""
from logscope.sources.balance import spread
from logscope.sources.fixture import (log_events, log_lines, log_lines_from_events, log_lines_sql, log_tree, log_tree_gzip,
                                      orders_by_month)
from logscope.sources.logs import (by_parts, concat_frames, gzip_text_bytes, list_logs, read_accounting, read_logs, read_logs_numbered,
                                   unread_files)
from logscope.sources.results import read_cluster_summary, read_result_csv, read_timeline
from logscope.sources.tables import profile_source, read_files, read_period, read_table

__all__ = ["by_parts", "concat_frames", "gzip_text_bytes", "list_logs", "log_tree_gzip", "read_accounting", "log_events", "log_lines", "log_lines_from_events", "log_lines_sql", "log_tree",
           "orders_by_month", "unread_files", "read_logs",
           "read_logs_numbered", "spread", "read_cluster_summary", "read_result_csv", "read_timeline",
           "profile_source", "read_files", "read_period", "read_table"]
