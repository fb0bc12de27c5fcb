"""End-to-end jobs ``(spark, input, output) -> dict of written paths`` (H7).

Each job reads its input once: the level job runs one aggregate scan plus the
sample (a second, top-n-only pass); the usage job stores the application
timeline and derives every output from it; the events job stores the parsed
messages of one scan by kind and derives every table of that family; the
daily job stores the per-day frame.  Callers may remove the stored tables of
their application afterwards (``session.clear_materialized``).
"""
from logscope.jobs.events import run_events_job
from logscope.jobs.daily import run_daily_job
from logscope.jobs.levels import run_levels_job
from logscope.jobs.usage import run_usage_job

__all__ = ["run_daily_job", "run_events_job", "run_levels_job", "run_usage_job"]
