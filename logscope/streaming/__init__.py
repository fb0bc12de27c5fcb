"""The level and timeline operators over a log folder that grows (Structured Streaming).

The reference jobs are batch only; these are the same operators (A1-A6 and
the per-file / per-application bounds of A7) run incrementally as new
container logs land, with state in the shared checkpoint folder.
"""
from logscope.streaming.logs import app_bounds_stream, level_totals_stream, read_logs_stream, start

__all__ = ["app_bounds_stream", "level_totals_stream", "read_logs_stream", "start"]
