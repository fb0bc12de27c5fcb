"""Temp views over the tables and derived frames, and SQL text over them.

Views are named ``<prefix><name>`` so a library session never shadows a
caller's own views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PREFIX = "logscope_"


def register(df: DataFrame, name: str, prefix: str = PREFIX) -> str:
    view = f"{prefix}{name}"
    df.createOrReplaceTempView(view)
    return view


def register_tables(spark: SparkSession, sf_dir: str, names: list[str], prefix: str = PREFIX) -> dict[str, str]:
    from logscope.sources import read_table
    return {n: register(read_table(spark, sf_dir, n), n, prefix) for n in names}


def row_count(spark: SparkSession, view: str) -> DataFrame:
    """``SELECT COUNT(*) AS total`` over a registered view."""
    return spark.sql(f"SELECT COUNT(*) AS total FROM {view}")


def even_doubled(spark: SparkSession, view: str, key: str) -> DataFrame:
    """The F6 operator itself: keep even ``key`` values, project ``key * 2``.

    The modulo predicate is the operator's own semantics (the install check's
    filter-and-project), applied to the whole table; it is not an input subset.
    """
    return spark.sql(f"SELECT {key} * 2 AS doubled FROM {view} WHERE {key} % 2 = 0")


def register_log_views(logs: DataFrame, prefix: str = PREFIX) -> dict[str, str]:
    """Register the log frames SQL users query: ``log_lines``, ``log_records``,
    ``app_timeline`` and ``cluster_summary`` (S10).  Views are lazy plans; SQL
    over them is optimized together with the operators behind them."""
    from logscope.operators import records as RC
    from logscope.operators import timeline as TL
    timeline = TL.app_timeline(logs, ordered=False)
    return {
        "log_lines": register(logs, "log_lines", prefix),
        "log_records": register(RC.parse_records(logs, level_mode="word", time_mode="lenient"),
                                "log_records", prefix),
        "app_timeline": register(timeline, "app_timeline", prefix),
        "cluster_summary": register(TL.cluster_summary(timeline, ordered=False), "cluster_summary", prefix),
    }


def register_daily_view(daily: DataFrame, prefix: str = PREFIX) -> str:
    return register(daily, "daily_summary", prefix)
