"""Family A: log-level distribution.

The counts, totals and shares come from ONE scan and ONE global aggregate:
the level is extracted once per line, every counter is a ``count_if`` in the
same aggregate (partial per task, a single-row final), and ``stack`` turns the
row into the fixed, zero-filled level order.  No join, no second scan and no
repeated regex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.functions.patterns import LEVELS


def with_level(logs: DataFrame, mode: str = "word", name: str = "log_level") -> DataFrame:
    """The level as a derived column (F2); ``filter(level != '')`` keeps lines with one."""
    return logs.withColumn(name, C.level("line", mode))


def level_totals(logs: DataFrame, mode: str = "word") -> DataFrame:
    """One row: ``total_lines, lines_with_level`` and one count per level (A1, A2, A3)."""
    lv = C.level("line", mode)
    return (logs.select(lv.alias("lv"))
            .agg(F.count(F.lit(1)).alias("total_lines"),
                 F.count_if(F.col("lv") != "").alias("lines_with_level"),
                 *[F.count_if(F.col("lv") == x).alias(f"n_{x}") for x in LEVELS]))


def _stack_levels(totals: DataFrame, extra: list[str]) -> DataFrame:
    body = ", ".join(f"'{x}', n_{x}" for x in LEVELS)
    return totals.selectExpr(f"stack({len(LEVELS)}, {body}) AS (log_level, count)", *extra)


def level_counts(logs: DataFrame, mode: str = "word") -> DataFrame:
    """``(log_level, count)``: INFO, WARN, ERROR, DEBUG in that order, zero-filled."""
    return _stack_levels(level_totals(logs, mode), [])


def level_groups(logs: DataFrame, mode: str = "plain") -> DataFrame:
    """``(log_level, count)`` of every level that occurs, lines without one under ``''`` (A3, unfiltered)."""
    return logs.groupBy(C.level("line", mode).alias("log_level")).agg(F.count(F.lit(1)).alias("count"))


def level_summary(logs: DataFrame, mode: str = "word") -> DataFrame:
    """One row per level with its share of the lines that have a level (A4, A5).

    ``share_pct`` is 0 when no line has a level; ``unique_levels`` counts
    levels seen at least once; totals repeat on every row.
    """
    return summary_of(level_totals(logs, mode))


def summary_of(totals: DataFrame) -> DataFrame:
    """``level_summary`` from the row of ``level_totals`` or ``totals_with_sample``."""
    t = totals
    seen = sum((F.col(f"n_{x}") > 0).cast("int") for x in LEVELS)
    t = t.withColumn("unique_levels", seen)
    out = _stack_levels(t, ["total_lines", "lines_with_level", "unique_levels"])
    share = (F.when(F.col("lines_with_level") == 0, F.lit(0.0))
             .otherwise(F.lit(100.0) * F.col("count") / F.col("lines_with_level")))
    return out.select("log_level", "count", share.alias("share_pct"),
                      "total_lines", "lines_with_level", "unique_levels")


def level_occurrences(logs: DataFrame) -> DataFrame:
    """Every case-sensitive level occurrence, several per line.

    The four level words cannot overlap one another (no suffix of one is a
    prefix of another), so the leftmost-match count of the alternation equals
    the count of each literal, ``(length(line) - length(replace(line, w, ''))) / len(w)``:
    plain string work inside whole-stage codegen, no per-line arrays.  The
    per-line counts are summed in one global aggregate; levels never seen are
    left out, as a ``uniq -c`` would.
    """
    line = F.col("line")

    def occ(w):
        n = (F.length(line) - F.length(F.replace(line, F.lit(w), F.lit("")))) / F.lit(len(w))
        return F.sum(n.cast("bigint")).alias(f"n_{w}")

    t = logs.agg(*[occ(x) for x in LEVELS])
    body = ", ".join(f"'{x}', n_{x}" for x in LEVELS)
    return (t.selectExpr(f"stack({len(LEVELS)}, {body}) AS (log_level, occurrences)")
             .filter(F.col("occurrences") > 0))


def sample_lines(logs: DataFrame, n: int = 10, seed: int | None = None,
                 key: str | Column | None = None, mode: str = "word") -> DataFrame:
    """``n`` uniformly random lines that carry a level → ``(log_entry, log_level)``.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only ``n x tasks`` rows reach the final merge; the
    input is never sorted as a whole.  With ``key`` the draw is reproducible
    across engines: rows are ordered by ``md5(key || '|' || seed)``.
    """
    lv = C.level("line", mode)
    df = logs.select("*", lv.alias("log_level")).filter(F.col("log_level") != "")
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        order = [F.md5(F.concat(k.cast("string"), F.lit(f"|{seed if seed is not None else 0}"))), k]
    else:
        order = [F.rand(seed)]
    return df.orderBy(*order).limit(n).select(F.col("line").alias("log_entry"), "log_level")


def totals_with_sample(logs: DataFrame, n: int = 10, seed: int | None = None, key: str | Column | None = None,
                       mode: str = "word") -> DataFrame:
    """The row of ``level_totals`` and, in the same scan and aggregate, a sample of ``n`` lines with a level (A1-A6 with O7):
    ``levels`` (those seen) and ``sample``, an array of at most ``n`` (log_entry, log_level).

    Every line draws a random number, which falls into one of ``n`` equal ranges; the aggregate keeps the line with the least
    number of each range.  Such minima merge like any other aggregate (one buffer of ``n`` lines a task), and as the draws treat all lines
    alike, any set of lines of the size that results is as likely as any other.  A range stays empty only when there are few lines;
    ``sample_of`` then says so and ``sample_lines`` draws the missing ones.  ``n`` is a number of report lines (tens): each is an aggregate of
    its own.  With ``key`` the draw is reproducible across engines: the number is ``md5(key || '|' || seed)``."""
    lv = C.level("line", mode)
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        draw = F.md5(F.concat(k.cast("string"), F.lit(f"|{seed if seed is not None else 0}")))
        part = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("bigint") * F.lit(n) / F.lit(float(1 << 32)))
    else:
        draw, part = F.rand(seed), F.floor(F.col("draw") * F.lit(n))
    rows = logs.select(lv.alias("lv"), "line", draw.alias("draw")).withColumn("part", F.when(F.col("lv") != "", part))
    one = F.struct("draw", F.col("line").alias("log_entry"), F.col("lv").alias("log_level"))
    picks = [F.min(F.when(F.col("part") == i, one)).alias(f"p_{i}") for i in range(n)]
    t = rows.agg(F.count(F.lit(1)).alias("total_lines"), F.count_if(F.col("lv") != "").alias("lines_with_level"),
                 *[F.count_if(F.col("lv") == x).alias(f"n_{x}") for x in LEVELS],
                 F.collect_set(F.nullif(F.col("lv"), F.lit(""))).alias("levels"), *picks)
    sample = F.transform(F.array_compact(F.array(*[F.col(f"p_{i}") for i in range(n)])), lambda p: F.struct(p["log_entry"], p["log_level"]))
    return t.withColumn("sample", sample).drop(*[f"p_{i}" for i in range(n)])


def sample_of(totals: DataFrame) -> DataFrame:
    """``(log_entry, log_level)`` of the sample in the row of ``totals_with_sample``."""
    return totals.select(F.explode("sample").alias("s")).select("s.log_entry", "s.log_level")


def lines_containing(logs: DataFrame, text: str = "ERROR") -> DataFrame:
    """Lines that contain ``text`` (case-sensitive substring, K6/F8)."""
    return logs.filter(F.col("line").contains(text))
