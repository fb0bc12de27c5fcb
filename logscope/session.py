"""Session profile (H4); credentials and cluster settings (H6) stay the caller's.

Times in logs carry no zone, so the session zone is pinned to UTC and parsed
times are exposed as TIMESTAMP_NTZ.  ANSI mode stays on: every parse that may
fail uses a ``try_`` function instead of switching ANSI off for the session.
"""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

PROFILE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # percentile aggregates keep this many groups per task in memory before they
    # fall back to sorting every row (default 128): a year of days, the stages of a file
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # a tree of many folders is listed by this many tasks, not by one for each folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "logscope",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the logscope profile.

    On a cluster, ``master`` is left to spark-submit and ``shuffle_partitions``
    to the caller (size it so one partition holds ~128-256 MB of shuffle data).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in PROFILE.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# checkpoint folders installed by ensure_checkpoint_dir for applications whose
# configuration names none (tests, local runs); the setting itself is fixed once
# a session runs, so the fallback is kept here, by application id
_FALLBACK: dict[str, str] = {}


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:       # sessions without a local SparkContext
        return "session"


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else the
    fallback that ``ensure_checkpoint_dir`` installed, else None."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:       # sessions without a local SparkContext
            d = None
    return d or _FALLBACK.get(_app_id(spark))


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) is ``fallback`` installed, for
    this application; a cluster must name a shared folder (HDFS, object store).
    """
    d = checkpoint_dir(spark)
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        d = _FALLBACK[_app_id(spark)] = fallback
        os.makedirs(d, exist_ok=True) if "://" not in d else None
    spark.sparkContext.setCheckpointDir(d)
    return d


def _tables_root(spark: SparkSession) -> str | None:
    d = checkpoint_dir(spark)
    return f"{d.rstrip('/')}/logscope-tables/{_app_id(spark)}" if d else None


def table_path(spark: SparkSession) -> str:
    """A new table folder of this application below the shared checkpoint folder."""
    root = _tables_root(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; call ensure_checkpoint_dir first")
    return f"{root}/{uuid.uuid4().hex}"


def materialize(df, spark: SparkSession | None = None, strict: bool = False):
    """Compute ``df`` once and cut its lineage, for frames that several actions reuse (H2).

    Writes ``df`` as a parquet table into the shared folder named by
    ``spark.checkpoint.dir`` (``<dir>/logscope-tables/<application id>/<id>``) and
    returns a frame reading it: one computation (an RDD checkpoint would compute
    an unpersisted plan twice), columnar re-reads, and the table survives the
    loss of any executor.  Never a local checkpoint.  Without a checkpoint
    folder the frame is returned lazily (recomputed per use) unless ``strict``.
    """
    spark = spark or df.sparkSession
    root = _tables_root(spark)
    if not root:
        if strict:
            raise RuntimeError("spark.checkpoint.dir is not set; call ensure_checkpoint_dir first")
        return df
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_all(spark: SparkSession, frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``frames`` (of one schema), computed one frame after the other into one table (as ``materialize`` does): what a
    frame needs on the driver, such as its listing of files, is free before the next is made.  Without a checkpoint folder, their union."""
    if not _tables_root(spark):
        return reduce(DataFrame.unionByName, frames)
    path, schema = table_path(spark), None
    for df in frames:
        df.write.mode("append").parquet(path)
        schema = df.schema
        del df
        gc.collect()        # a frame is part of reference cycles; until Python collects them the driver keeps all it holds
    return spark.read.schema(schema).parquet(path)


def clear_materialized(spark: SparkSession) -> None:
    """Delete the tables that ``materialize`` wrote for this application (call when
    the frames built on them are no longer used); other applications' tables
    below the same checkpoint folder stay."""
    root = _tables_root(spark)
    if not root:
        return
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
