"""``log_lines(path, line_no, line)``: a container-log corpus derived from ``events``.

The test tables carry no raw logs, so the corpus is generated from ``events``
by one deterministic SQL text, rendered for Spark (the query input) and for
DuckDB (the oracle input) from the same template.  Its size grows with
``events``: about 1.26 lines per event, one file per (user, event_id % 20).
"""

from __future__ import annotations

import hashlib
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.sources.balance import spread

# The corpus definition (cluster ids, level mapping, 14 line templates and their variants).
_TEMPLATE = """
WITH u AS (
  SELECT *, event_id % 14 AS k, CASE WHEN user_id % 50 = 7 THEN user_id + 10000 ELSE user_id END AS uid FROM {events}),
b AS (
  SELECT *, CASE WHEN uid < 10000 THEN lpad(cast(uid as string), 4, '0') ELSE cast(uid as string) END AS app_no,
    CASE WHEN event_id % 13 = 0 THEN '1' ELSE '0' END AS attempt,
    CASE WHEN user_id % 10 < 5 THEN '1485248649253' WHEN user_id % 10 < 7 THEN '1472621869829' WHEN user_id % 10 = 7 THEN '1448006111297'
         WHEN user_id % 10 = 8 THEN '1460011102909' WHEN user_id % 20 = 9 THEN '1474351042505' ELSE '1440487435730' END AS cl,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' WHEN 'click' THEN 'info'
         WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'DEBUG' ELSE 'INFO' END ELSE 'INFO' END AS lv
  FROM u),
p AS (
  SELECT *, concat('/logs/application_', cl, '_', app_no, '/container_', cl, '_', app_no,
                   CASE WHEN event_id % 20 = 7 THEN '_02_' ELSE '_01_' END, lpad(cast(event_id % 20 + 1 as string),6,'0'), '.log') AS path FROM b)
SELECT path, event_id*2 AS line_no,
  CASE k WHEN 11 THEN concat('    at frame ', event_type)
         WHEN 10 THEN concat(<ISO_TS>, ' ', lv, ' storage.BlockManager: Found block rdd_', cast(user_id % 9 as string), '_', cast(event_id % 6 as string),
                             CASE WHEN event_id % 3 = 0 THEN ' remotely' ELSE ' locally' END)
         ELSE concat(CASE WHEN event_id % 17 = 0 THEN '24/13/41 25:61:00' ELSE <SHORT_TS> END, ' ', lv, ' ', CASE k
           WHEN 0 THEN concat('YarnAllocator: Will request ', cast(user_id % 16 + 1 as string), ' executor containers, each with ', cast(event_id % 5 + 1 as string), ' cores and ', cast((event_id % 7 + 1) * 4096 as string), ' MB memory',
                              CASE WHEN event_id % 3 = 0 THEN '' ELSE concat(' including ', cast((event_id % 7 + 1) * 384 as string), ' MB overhead') END)
           WHEN 1 THEN concat('YarnAllocator: Container request (host: Any, capability: <memory:', cast((event_id % 7 + 1) * 4096 as string), ', vCores:', cast(event_id % 5 + 1 as string), '>)')
           WHEN 6 THEN concat('rdd.HadoopRDD: Input split: hdfs://', CASE WHEN event_id % 5 = 0 THEN concat('mesos-', CASE WHEN event_id % 2 = 0 THEN 'slave-' ELSE 'master-' END, cast(user_id % 6 as string)) ELSE concat('10.10.34.', cast(event_id % 4 + 11 as string)) END, ':9000/in/f', cast(user_id as string), '.txt:', cast(event_id * 128 as string), '+', cast(event_id % 1000 + 1 as string))
           WHEN 7 THEN concat('python.PythonRunner: Times: total = ', cast(event_id % 300 + 5 as string), ', boot = ', cast(event_id % 50 - 25 as string), ', init = ', cast(event_id % 300 + 5 - (event_id % 50 - 25) as string), ', finish = ', CASE WHEN event_id % 4 = 0 THEN '7' ELSE '0' END)
           WHEN 8 THEN concat('storage.MemoryStore: Block ', CASE WHEN event_id % 3 = 0 THEN 'rdd_' ELSE 'broadcast_' END, cast(user_id as string), CASE WHEN event_id % 2 = 0 THEN ' stored as values' ELSE ' stored as bytes' END, ' in memory (estimated size ', cast(event_id % 99 + 1 as string), '.5 KB, free ', cast(event_id % 9 + 1 as string), '.0 MB)')
           WHEN 9 THEN concat('broadcast.TorrentBroadcast: Started reading broadcast variable ', cast(event_id % 30 as string))
           WHEN 12 THEN concat('storage.ShuffleBlockFetcherIterator: Started ', cast(event_id % 6 as string), ' remote fetches in ', cast(event_id % 40 as string), ' ms')
           WHEN 13 THEN concat('storage.MemoryStore: MemoryStore started with capacity ', cast(event_id % 20 + 1 as string), '.5 GB')
           ELSE concat('executor.Executor: Running task ', cast(event_id % 7 as string), '.', attempt, ' in stage ', cast(<STAGE> as string), '.0 (TID ', cast(event_id as string), ')') END) END AS line
FROM p
UNION ALL
SELECT path, event_id*2+1, concat(CASE WHEN event_id % 19 = 0 THEN '24/13/41 25:61:00' ELSE <SHORT_TS_PLUS> END, ' INFO executor.Executor: Finished task ', cast(event_id % 7 as string), '.', attempt, ' in stage ', cast(<STAGE> as string), '.0 (TID ', cast(event_id as string), ')')
FROM p WHERE k IN (2,3,4,5) AND event_id % 11 <> 0
"""

_DIALECT = {
    "spark": {
        "<ISO_TS>": "date_format(ts,'yyyy-MM-dd HH:mm:ss,SSS')",
        "<SHORT_TS_PLUS>": "date_format(timestampadd(SECOND, cast(event_id % 90 as int), ts),'yy/MM/dd HH:mm:ss')",
        "<SHORT_TS>": "date_format(ts,'yy/MM/dd HH:mm:ss')",
        "<STAGE>": "(dayofyear(ts) div 3 + event_id % 2)",
    },
    "duckdb": {
        "<ISO_TS>": "strftime(ts,'%Y-%m-%d %H:%M:%S,%g')",
        "<SHORT_TS_PLUS>": "strftime(ts + to_seconds(event_id % 90),'%y/%m/%d %H:%M:%S')",
        "<SHORT_TS>": "strftime(ts,'%y/%m/%d %H:%M:%S')",
        "<STAGE>": "(dayofyear(ts) // 3 + event_id % 2)",
    },
}


def log_lines_sql(dialect: str, events: str = "events") -> str:
    sql = _TEMPLATE
    for k, v in _DIALECT[dialect].items():
        sql = sql.replace(k, v)
    if dialect == "spark":
        return sql  # ``{events}`` is bound by spark.sql(..., events=df)
    return sql.replace("{events}", events)


def log_lines_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The corpus as a DataFrame ``(path, line_no, line)``.

    ``events`` is spread over the cluster's cores first when its scan is a
    single split, so the line generation and every regex after it run in parallel.
    """
    cols = spread(events.select("event_id", "ts", "user_id", "event_type"))
    return spark.sql(log_lines_sql("spark"), events=cols)


CORPUS_VERSION = "v3"
CORPUS_SCHEMA = "path STRING, line_no BIGINT, line STRING"


def _checkpoint_base(spark: SparkSession) -> str | None:
    from logscope.session import checkpoint_dir
    return checkpoint_dir(spark)


# by session, so that a frame never outlives the session it belongs to
_CORPUS: weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = weakref.WeakKeyDictionary()


def log_lines(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """The corpus for the tables in ``sf_dir``.

    With ``materialized`` (default) the corpus is derived once per ``events``
    table and stored as a parquet table below the shared checkpoint folder
    (``<spark.checkpoint.dir>/logscope-corpus/<key>``, the key covering the
    events path, size and modification time); later calls read that table, as
    a log job reads its log files: the line text is a stored column, scans
    split over all cores and prune columns.  Without a checkpoint folder, or
    with ``materialized=False``, the lazy derivation is returned.
    """
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    base = _checkpoint_base(spark) if materialized else None
    if base:
        return _stored_corpus(spark, events_path, base)
    return log_lines_from_events(spark, spark.read.parquet(events_path))


def _publish(fs, jvm, tmp: str, target: str) -> None:
    """Move a finished table into place.  Only a folder with ``_SUCCESS`` counts as
    finished; a half-copied one (a rename is a copy on an object store) is replaced."""
    path = jvm.org.apache.hadoop.fs.Path
    done = path(f"{target}/_SUCCESS")
    if fs.exists(path(target)) and not fs.exists(done):
        fs.delete(path(target), True)
    if not fs.exists(path(target)):         # another writer may have finished first
        fs.rename(path(tmp), path(target))
    if fs.exists(path(tmp)):
        fs.delete(path(tmp), True)
    if not fs.exists(done):
        raise OSError(f"{target} is not complete")


def _stored_corpus(spark: SparkSession, events_path: str, base: str) -> DataFrame:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(events_path)
    fs_src = src.getFileSystem(conf)
    st = fs_src.getFileStatus(src)
    size = fs_src.getContentSummary(src).getLength()
    key = hashlib.sha1(f"{st.getPath().toString()}|{size}|{st.getModificationTime()}|{CORPUS_VERSION}"
                       .encode()).hexdigest()[:20]
    target = f"{base.rstrip('/')}/logscope-corpus/{key}"
    cached = _CORPUS.setdefault(spark, {}).get(target)
    tpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = tpath.getFileSystem(conf)
    done = jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
    if cached is not None and fs.exists(done):
        return cached
    if not fs.exists(done):
        events = spark.read.parquet(events_path)
        tmp = f"{target}.{uuid.uuid4().hex}.tmp"
        log_lines_from_events(spark, events).write.mode("overwrite").parquet(tmp)
        _publish(fs, jvm, tmp, target)
    df = spark.read.schema(CORPUS_SCHEMA).parquet(target)
    _CORPUS[spark][target] = df
    return df


_STORED: weakref.WeakKeyDictionary[SparkSession, set[str]] = weakref.WeakKeyDictionary()


def _stored(spark: SparkSession, table_file: str, tag: str, write) -> str:
    """Folder of a derived table below the shared checkpoint folder, written once per version of
    ``table_file`` by ``write(folder)``."""
    base = _checkpoint_base(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; call ensure_checkpoint_dir first")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(table_file)
    fs = src.getFileSystem(conf)
    st = fs.getFileStatus(src)
    key = hashlib.sha1(f"{st.getPath().toString()}|{fs.getContentSummary(src).getLength()}|{st.getModificationTime()}"
                       f"|{CORPUS_VERSION}|{tag}".encode()).hexdigest()[:20]
    target = f"{base.rstrip('/')}/logscope-corpus/{key}"
    if target not in _STORED.setdefault(spark, set()):
        tfs = jvm.org.apache.hadoop.fs.Path(target).getFileSystem(conf)
        if not tfs.exists(jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")):
            tmp = f"{target}.{uuid.uuid4().hex}.tmp"
            write(tmp)
            _publish(tfs, jvm, tmp, target)
        _STORED[spark].add(target)
    return target


LINES_PER_TREE_TASK = 20_000

#: A tree on a mounted folder (``file:``) is written without Hadoop's checksum files: one for each log file, so they double the files
#: made, moved, listed and opened.  A writer keeps the file system of its first use, so this one is not kept.  No other store is concerned.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_tree(lines: DataFrame, folder: str, **options: str) -> None:
    """``lines`` as text files ``<folder>/app=application_<cluster>_<n>/part-*``, one per application, lines in order.

    Each application's lines go to one task (an application's log is one file), which writes them sorted.  Opening a file
    costs more than its bytes, so the number of tasks follows the lines and is stated: left to itself, Spark merges small
    shuffle partitions by their bytes, and few tasks write all the files."""
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-lines.count() // LINES_PER_TREE_TASK))
    (lines.select(C.application_id("path").alias("app"), "line_no", F.col("line").alias("value"))
     .repartition(tasks, "app").sortWithinPartitions("app", "line_no").select("app", "value")
     .write.partitionBy("app").options(**PLAIN_FILES, **options).text(folder))


def log_tree(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as a tree of text log files (``write_tree``); returns its root."""
    return _stored(spark, f"{sf_dir.rstrip('/')}/events.parquet", "tree", lambda folder: write_tree(log_lines(spark, sf_dir), folder))


def log_tree_gzip(spark: SparkSession, sf_dir: str) -> str:
    """The same tree as gzip files."""
    return _stored(spark, f"{sf_dir.rstrip('/')}/events.parquet", "tree-gzip",
                   lambda folder: write_tree(log_lines(spark, sf_dir), folder, compression="gzip"))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's messages (``operators.events.parse_events``), stored by kind."""
    from logscope.operators.events import EVENTS_SCHEMA, event_table

    path = _stored(spark, f"{sf_dir.rstrip('/')}/events.parquet", "events",
                   lambda folder: event_table(log_lines(spark, sf_dir), folder))
    return spark.read.schema(EVENTS_SCHEMA).parquet(path)


def orders_by_month(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as files by year and month, ``<root>/yyyy=<year>/mm=<month>/``; returns the root."""
    path = f"{sf_dir.rstrip('/')}/orders.parquet"

    def write(folder: str) -> None:
        o = spark.read.parquet(path)
        (o.withColumns({"yyyy": F.year("o_orderdate"), "mm": F.month("o_orderdate")}).repartition("yyyy", "mm")
         .write.partitionBy("yyyy", "mm").parquet(folder))

    return _stored(spark, path, "orders", write)
