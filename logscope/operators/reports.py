"""Text reports as DataFrames ``(line_no, text)`` (K5): formatted by Spark, written by a sink.

Reports are built from the small result frames (one row of totals, a few
rows of counts), never from raw lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.functions.patterns import LEVELS


def _lines(df: DataFrame, texts: list) -> DataFrame:
    """One output row per text expression, numbered in order."""
    arr = F.array(*[F.struct(F.lit(i).alias("line_no"), t.alias("text")) for i, t in enumerate(texts)])
    return df.select(F.inline(arr))


def level_report(summary: DataFrame) -> DataFrame:
    """The level summary as report lines: totals, distinct levels, one line per level with share."""
    s = summary
    first = s.agg(F.first("total_lines").alias("t"), F.first("lines_with_level").alias("w"),
                  F.first("unique_levels").alias("u"),
                  *[F.max(F.when(F.col("log_level") == x, F.col("count"))).alias(f"c_{x}") for x in LEVELS],
                  *[F.max(F.when(F.col("log_level") == x, F.col("share_pct"))).alias(f"p_{x}") for x in LEVELS])
    texts = [F.concat(F.lit("Total log lines processed: "), F.format_number("t", 0)),
             F.concat(F.lit("Total lines with log levels: "), F.format_number("w", 0)),
             F.concat(F.lit("Unique log levels found: "), F.col("u").cast("string")),
             F.lit(""), F.lit("Log level distribution:")]
    for x in LEVELS:
        texts.append(F.format_string("  %-5s: %10s (%6.2f%%)", F.lit(x), F.format_number(f"c_{x}", 0),
                                     F.col(f"p_{x}")))
    return _lines(first, texts)


def usage_report(stats: DataFrame, top: DataFrame) -> DataFrame:
    """Cluster usage stats and the top clusters as report lines."""
    head = _lines(stats, [
        F.concat(F.lit("Total unique clusters: "), F.col("total_clusters").cast("string")),
        F.concat(F.lit("Total applications: "), F.col("total_applications").cast("string")),
        F.format_string("Average applications per cluster: %.2f", F.col("avg_apps_per_cluster")),
        F.lit(""), F.lit("Most heavily used clusters:")])
    body = (top.select(F.format_string("  Cluster %s: %d applications", "cluster_id", "num_applications")
                       .alias("text"),
                       F.row_number().over(_top_order()).alias("rk"))
            .select((F.col("rk") + F.lit(4)).alias("line_no"), "text"))
    return head.unionByName(body)


def _top_order():
    from pyspark.sql import Window
    # ``top`` is a limit-n frame (n rows), so a global window over it is bounded
    return Window.orderBy(F.col("num_applications").desc(), F.col("cluster_id"))


def period_report(totals: DataFrame, count_name: str = "num_rows") -> DataFrame:
    """Period totals over a daily summary as report lines."""
    return _lines(totals, [
        F.concat(F.lit("Days with data: "), F.col("num_days").cast("string")),
        F.concat(F.lit("Date range: "), F.date_format("first_date", "MM/dd/yyyy"), F.lit(" to "),
                 F.date_format("last_date", "MM/dd/yyyy")),
        F.concat(F.lit("Total rows: "), F.format_number(f"total_{count_name}", 0)),
        F.concat(F.lit("Average rows per day: "), F.format_number(f"mean_daily_{count_name}", 0))])
