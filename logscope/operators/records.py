"""Record parsing and line-structure analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.functions import patterns as P
from logscope.session import materialize


def parse_records(logs: DataFrame, level_mode: str = "plain", time_mode: str = "anchored") -> DataFrame:
    """``(path, line_no, ts, level, component, message)`` per line (L4).

    Defaults follow the documented parse: anchored ``yy/MM/dd`` time,
    case-sensitive level, component before the first ``:`` after the level,
    message = the whole line.  ``level_mode='word', time_mode='lenient'`` gives
    the job forms.
    """
    cols = ["path"] + (["line_no"] if "line_no" in logs.columns else [])
    return C.with_log_time(logs, "line", "ts", time_mode).select(*cols, "ts",
                       C.level("line", level_mode).alias("level"),
                       C.component("line").alias("component"), F.col("line").alias("message"))


def component_counts(logs: DataFrame) -> DataFrame:
    """Lines per component, most active first (A15); ``''`` collects lines without one."""
    return (logs.groupBy(C.component("line").alias("component"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "component"))


def _audit_files(logs: DataFrame) -> DataFrame:
    """Per file: lines and how many lack a time, a level or a component; one row per
    file and task reaches the shuffle."""
    return (C.with_log_time(logs, "line", "__ts").groupBy("path")
            .agg(F.count(F.lit(1)).alias("num_lines"),
                 F.count_if(F.col("__ts").isNull()).alias("no_timestamp"),
                 F.count_if(C.level("line") == "").alias("no_level"),
                 F.count_if(C.component("line") == "").alias("no_component")))


def _with_shares(audit: DataFrame, *keys: str) -> DataFrame:
    counts = ["no_timestamp", "no_level", "no_component"]
    pct = [(F.lit(100.0) * F.col(c) / F.col("num_lines")).alias(f"{c}_pct") for c in counts]
    return audit.select(*keys, "num_lines", *counts, *pct)


def parse_audit_by_file(logs: DataFrame) -> DataFrame:
    """Per file: lines and how many lack a time, a level or a component."""
    return _with_shares(_audit_files(logs), "path")


def parse_audit(logs: DataFrame) -> DataFrame:
    """Per application: the same, summed from the file rows."""
    a = (_audit_files(logs).groupBy(C.application_id("path").alias("application_id"))
         .agg(*[F.sum(c).alias(c) for c in ("num_lines", "no_timestamp", "no_level", "no_component")]))
    return _with_shares(a, "application_id")


def host_activity(logs: DataFrame) -> DataFrame:
    """Per host name or cluster address mentioned in lines: lines naming it,
    containers and applications (L15).

    Counted per (host, file) first, so a host named in most lines still ships
    at most one row per (task, file) to the final per-host aggregate.
    """
    line = F.col("line")
    hint = F.lit(False)
    for h in P.HOST_HINTS:
        hint = hint | line.contains(h)
    hosts = (logs.filter(hint)
             .select("path", F.explode(F.array_distinct(F.regexp_extract_all(line, F.lit(P.HOST), 1)))
                     .alias("host")))
    per_file = hosts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("lines"))
    return (per_file.groupBy("host")
            .agg(F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("containers"),
                 F.count_distinct(C.application_id("path")).alias("applications")))


BLOCK_LINES = 1 << 16


def stitched_entries(logs: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Multi-line entries: continuation lines attached to the header line before them.

    Needs ``(path, line_no, line)``.  A header is a line that starts with a
    time; every other line continues the latest header above it in its file.
    Lines before a file's first header have no entry to join and stay single
    rows (``has_header`` false).

    Output ``(path, entry_line_no, has_header, num_lines, entry_text)``, one row
    per entry; ``entry_line_no`` is the number of its first line.

    ``block_lines`` only decides how the work is spread, never the result: the
    lines are shuffled once, by (file, block of line numbers), so one huge file
    spreads over many tasks, and entries inside a block are put together there.
    These pieces are stored.  Only a block's leading lines and its last entry can
    be parts of an entry that crosses a block border: at most two pieces a block, which
    meet by file, take the latest header before them and are put together once more.
    """
    block = F.floor(F.col("line_no") / F.lit(block_lines))
    df = logs.select("path", "line_no", "line", block.alias("block"), C.is_entry_header("line").alias("is_header"))
    header_no = F.when(F.col("is_header"), F.col("line_no"))
    of_block = Window.partitionBy("path", "block")
    above = of_block.orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # same partitioning as the windows: no second shuffle
    pieces = materialize(
        df.withColumns({"entry": F.max(header_no).over(above), "last": F.max(header_no).over(of_block)})
        .groupBy("path", "block", "entry", "last")
        .agg(F.count(F.lit(1)).alias("num_lines"),
             F.array_sort(F.collect_list(F.struct("line_no", F.col("line").alias("text")))).alias("lines"))
        .withColumn("border", F.col("entry").isNull() | (F.col("entry") == F.col("last"))))

    before = Window.partitionBy("path").orderBy(F.col("block"), F.col("entry").asc_nulls_first())
    border = pieces.filter("border").withColumn("entry", F.last("entry", ignorenulls=True).over(before))
    # in the window's partitions; lines without a header stay apart by block
    merged = (border.groupBy("path", "entry", F.when(F.col("entry").isNull(), F.col("block")).alias("apart"))
              .agg(F.sum("num_lines").alias("num_lines"),
                   F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "lines"))), lambda x: x["lines"]))
                   .alias("lines")).drop("apart"))
    inner = pieces.filter("NOT border").select("path", "entry", "num_lines", "lines")
    text = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    # lines before a file's first header are single rows
    orphan = F.transform("lines", lambda x: F.struct(x["line_no"].alias("n"), F.lit(False).alias("h"), F.lit(1).cast("bigint").alias("k"), x["text"].alias("t")))
    whole = F.array(F.struct(F.col("entry").alias("n"), F.lit(True).alias("h"), F.col("num_lines").cast("bigint").alias("k"), text.alias("t")))
    rows = inner.union(merged).select("path", F.explode(F.when(F.col("entry").isNull(), orphan).otherwise(whole)).alias("e"))
    return rows.select("path", F.col("e.n").alias("entry_line_no"), F.col("e.h").alias("has_header"), F.col("e.k").alias("num_lines"),
                       F.col("e.t").alias("entry_text"))
