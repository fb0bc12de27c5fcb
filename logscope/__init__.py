"""logscope: Spark-native analytics over cluster container logs and daily metric tables.

Every operator is a function from DataFrames to a DataFrame built from built-in
Spark SQL expressions, so Catalyst plans, prunes, pushes down and code-generates it.

Layout:
    functions/  fixed regex patterns and Column builders (level, ids, time, units)
    sources/    text log trees, parquet tables and periods, the ``log_lines`` fixture
    operators/  the analyses: levels, timelines, daily summaries, log events, tasks
    sinks/      single-file CSV / text writers
    plans/      the query catalog, its DuckDB oracle SQL and plan checks
    streaming/  the level operators over a growing log directory
    jobs/       end-to-end jobs that write the report files
"""

from logscope.session import checkpoint_dir, ensure_checkpoint_dir, get_session, materialize

__all__ = ["checkpoint_dir", "ensure_checkpoint_dir", "get_session", "materialize"]
