"""Parquet sources (S5-S7) and the source profile."""

from __future__ import annotations

import weakref
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# by session, so that a reader never outlives the session it belongs to
_READERS: weakref.WeakKeyDictionary[SparkSession, dict[tuple, DataFrame]] = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; the reader is reused per session while the
    file's size and modification time are unchanged (no repeated footer reads)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        st = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
        key = (st.getPath().toString(), st.getLen(), st.getModificationTime())
    except Exception:       # no JVM access: read afresh each time
        return spark.read.parquet(path)
    readers = _READERS.setdefault(spark, {})
    df = readers.get(key)
    if df is None:
        df = readers[key] = spark.read.parquet(path)
    return df


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Many parquet files (or globs) as one table (S5); the schema comes from parquet."""
    return spark.read.parquet(*paths)


def read_period(spark: SparkSession, root: str, years: Iterable[int], months: Iterable[int],
                file_glob: str = "*-{month:02d}.parquet", partition: str = "yyyy") -> DataFrame:
    """Monthly files below ``root/<partition>=<year>/`` for the given months.

    ``basePath`` keeps ``<partition>`` as a column, so a later filter on it
    prunes partitions; the month globs list only the wanted files.  Months
    without a file are passed over; a period without any file is an error.
    """
    root = root.rstrip("/")
    globs = [f"{root}/{partition}={y}/" + file_glob.format(month=m) for y in years for m in months]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda g: jvm.org.apache.hadoop.fs.Path(g)
    present = [g for g in globs if path(g).getFileSystem(conf).globStatus(path(g))]
    if not present:
        raise FileNotFoundError(f"no file for the period below {root}")
    return spark.read.option("basePath", root).parquet(*present)


def profile_source(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, num_rows, num_nulls)`` per column, in one scan.

    One global aggregate computes every count (partial per task, one final
    row), then ``stack`` turns the single row into one row per column.
    """
    fields = df.schema.fields
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(quoted(f.name).isNull()).alias(f"__n{i}") for i, f in enumerate(fields)]
    parts = [x for i, f in enumerate(fields) for x in (F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"__n{i}"))]
    return (df.agg(*aggs)
            .select(F.stack(F.lit(len(fields)), *parts).alias("column_name", "data_type", "num_nulls"),
                    F.col("__rows").alias("num_rows"))
            .select("column_name", "data_type", "num_rows", "num_nulls"))
