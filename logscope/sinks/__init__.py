"""Sinks (K1-K6): single-file CSV and text outputs written through the Hadoop file system.

Files are written by Spark into the output folder (HDFS, S3A or a shared
mount on a cluster) and, for the one-file contract, the single part file is
renamed with the Hadoop FileSystem API: no executor-local path and no driver
``shutil`` copy is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSS]"      # milliseconds are written and read back


def _fs(spark, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def _promote_single_part(spark, tmp_dir: str, target: str, ext: str) -> str:
    fs, tmp, jvm = _fs(spark, tmp_dir)
    parts = [s.getPath() for s in fs.listStatus(tmp) if s.getPath().getName().startswith("part-")
             and s.getPath().getName().endswith(ext)]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {tmp_dir}, found {len(parts)}")
    dst = jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(dst):
        fs.delete(dst, False)
    if not fs.rename(parts[0], dst):
        raise RuntimeError(f"could not move {parts[0]} to {target}")
    fs.delete(tmp, True)
    return target


def write_csv(df: DataFrame, path: str, single_file: bool = True, line_sep: str | None = None,
              quote_all: bool = False, order_by: list | None = None) -> str:
    """CSV with header, overwrite; an empty frame gives a header-only file (K1-K4).

    K2: ``line_sep="\\r\\n"`` for byte parity with CRLF files; K3: quotes inside
    values are doubled; K4: the result stays distributed (``toPandas`` is the caller's).

    Times are written as ``yyyy-MM-dd HH:mm:ss.SSS``; quotes inside values are
    doubled (RFC 4180).  ``single_file`` gathers the finished rows in one
    writer, meant for result frames that one file can hold; the exchange in
    front of it keeps the aggregate below parallel, and its ``order_by`` sorts
    inside that one partition, so no range-partitioning sample job precedes
    the write.  Frames that grow with the input are written with
    ``single_file=False``.
    """
    w = df.repartition(1) if single_file else df
    if order_by:
        w = w.sortWithinPartitions(*order_by) if single_file else w.orderBy(*order_by)
    writer = (w.write.mode("overwrite").option("header", True)
              .option("timestampNTZFormat", TIME_FORMAT).option("timestampFormat", TIME_FORMAT)
              .option("escape", '"'))
    if line_sep:
        writer = writer.option("lineSep", line_sep)
    if quote_all:
        writer = writer.option("quoteAll", True)
    if not single_file:
        writer.csv(path)
        return path
    tmp = path.rstrip("/") + "._tmp"
    writer.csv(tmp)
    return _promote_single_part(df.sparkSession, tmp, path, ".csv")


def write_text(df: DataFrame, path: str, column: str = "text", single_file: bool = True,
               order_by: str | None = None) -> str:
    """One string column as text lines (K5, K6); ``order_by`` sorts within the single file."""
    w = df.repartition(1) if single_file else df
    if order_by:
        w = w.sortWithinPartitions(order_by)
    w = w.select(F.col(column).cast("string").alias("value"))
    if not single_file:
        w.write.mode("overwrite").text(path)
        return path
    tmp = path.rstrip("/") + "._tmp"
    w.write.mode("overwrite").text(tmp)
    return _promote_single_part(df.sparkSession, tmp, path, ".txt")


def write_matching_lines(logs: DataFrame, text: str, path: str, single_file: bool = False) -> str:
    """Every line containing ``text`` (case-sensitive) as text output (K6).

    Written in parallel as part files by default: the number of matching
    lines grows with the input, so one writer would be a bottleneck at scale.
    """
    return write_text(logs.filter(F.col("line").contains(text)), path, column="line",
                      single_file=single_file)
