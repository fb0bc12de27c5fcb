"""Text log sources.

A log corpus is a tree ``application_<cluster>_<n>/container_<...>.log``; the
directory names are not hive-style, so identities come from the file path.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.session import materialize, materialize_all


def _reader(spark: SparkSession, recursive: bool, ignore_corrupt: bool, glob_filter: str | None):
    r = spark.read.format("text")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if ignore_corrupt:
        # per read, so the session's own setting is left alone
        r = r.option("ignoreCorruptFiles", "true")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    return r


LISTING_TASKS = 256
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_KEPT = "spark.sql.hive.manageFilesourcePartitions"


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def listing_tasks(spark: SparkSession, tasks: int = LISTING_TASKS) -> Iterator[None]:
    """Within it, a tree of many folders is listed by at most ``tasks`` tasks (Spark's default is 10,000: a task for each folder), and
    the listing belongs to its frame alone (by default the driver keeps listings of up to 250 MB after their frames are gone).
    ``load`` lists at once, so the session's own settings are back before anything else reads them."""
    with _settings(spark, {_LISTING: str(min(tasks, int(spark.conf.get(_LISTING)))), _KEPT: "false"}):
        yield


OPEN_COST = 64 << 10
TASKS_PER_CORE = 4


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Within it, scans that run give a task many small files.  Spark counts the opening of a file as 4 MB, so a task gets 32 files (4
    with splits of 16 MB) and costs more than they do; counted as 64 KB, with some tasks for each core, large files are split as before."""
    with _settings(spark, {"spark.sql.files.openCostInBytes": str(OPEN_COST),
                           "spark.sql.files.minPartitionNum": str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)}):
        yield


PATHS_AT_ONCE = 20_000
LISTED_ON_DRIVER = 32       # Spark itself lists up to this many paths on the driver
_INPUTS = "mapreduce.input.fileinputformat.inputdir"


def exact_path(path: str) -> str:
    """``path`` as a glob that only it matches."""
    return re.sub(r"([\\\[{*?])", r"\\\1", path)


def _hidden(path: str) -> bool:
    """Whether Spark's listing of a folder passes over this file or folder in it."""
    name = path.rpartition("/")[2]
    return (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")) \
        and not name.startswith(("_common_metadata", "_metadata"))


def tree_parts(spark: SparkSession, root: str | list[str], *, recursive: bool = True) -> Iterator[str | list[str]]:
    """``root`` in parts of at most ``PATHS_AT_ONCE`` paths, which together have its files, each once.

    The driver holds a listed file with 1.2 KB for each frame that reads it, so a frame over a tree of many folders outgrows it.  A tree
    is divided by the paths that ``root`` matches or, where these are few, by what lies directly in them; the driver holds their names.
    A tree of fewer paths is one part, ``root`` itself, and so is a list of roots; a folder is not divided."""
    if not isinstance(root, str) or re.search(r"\{[^}]*/", root):       # what these match may lie inside one another
        yield root
        return
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(hadoop)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root))
    found = [] if found is None else [found]        # arrays of file statuses; where there is none, the reader says so
    inside = recursive and sum(map(len, found)) <= LISTED_ON_DRIVER
    if inside:
        found = [fs.listStatus(x.getPath()) for matched in found for x in matched]
    if sum(map(len, found)) <= PATHS_AT_ONCE:
        yield root
        return
    # the names of a part as one string, Hadoop's own form of a job's inputs: a call for each path would take minutes
    conf, names = jvm.org.apache.hadoop.mapred.JobConf(hadoop), []
    while found:
        x = found.pop()
        for i in range(0, len(x), PATHS_AT_ONCE):
            some = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(x[i:i + PATHS_AT_ONCE])
            jvm.org.apache.hadoop.mapred.FileInputFormat.setInputPaths(conf, some)
            names.append(conf.getRaw(_INPUTS))
    del x, some, conf
    for joined in names:
        paths = [re.sub(r"\\(.)", r"\1", n, flags=re.S) for n in re.findall(r"(?:[^,\\]+|\\.)+", joined, re.S)]
        paths = [exact_path(n) for n in paths if not (inside and _hidden(n))]
        if paths:
            yield paths


def by_parts(spark: SparkSession, root: str | list[str], make: Callable[[str | list[str]], DataFrame], *, recursive: bool = True) -> DataFrame:
    """``make(root)`` for a ``make`` whose rows follow from each file by itself; a tree of many folders is read part by part
    (``tree_parts``) and the rows are stored."""
    parts = tree_parts(spark, root, recursive=recursive)
    first = next(parts, root)
    if first is root:
        return make(root)
    with small_files(spark):
        return materialize_all(spark, map(make, chain([first], parts)))


def read_logs(spark: SparkSession, root: str | list[str], *, recursive: bool = True,
              glob_filter: str | None = None, ignore_corrupt: bool = True,
              applications: Iterable[str] | None = None) -> DataFrame:
    """Every line of every file below ``root`` → ``(path, line, file_size)``.

    ``root`` may also be a glob such as ``data/application_*/*.log`` (S2); then
    pass ``recursive=False``.  ``applications`` keeps only the named
    application directories (S8), a filter on the path column.  With
    ``ignore_corrupt`` (the reference's setting) unreadable files are skipped;
    ``unread_files`` lists them.
    Line numbers are not available from the line reader; see ``read_logs_numbered``.
    """
    paths = [root] if isinstance(root, str) else list(root)
    with listing_tasks(spark):
        df = _reader(spark, recursive, ignore_corrupt, glob_filter).load(paths)
    df = df.select(F.col("_metadata.file_path").alias("path"),
                   F.col("value").alias("line"),
                   F.col("_metadata.file_size").alias("file_size"))
    if applications is not None:
        df = df.filter(C.application_id("path").isin(list(applications)))
    return df


def list_logs(spark: SparkSession, root: str | list[str], *, recursive: bool = True,
              glob_filter: str | None = None, applications: Iterable[str] | None = None) -> DataFrame:
    """``(path, file_size, modified)`` of every log file that has bytes, from the file listing alone: the
    binary source is asked for its listing columns only, so no file is opened (A17, A18)."""
    paths = [root] if isinstance(root, str) else list(root)
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    with listing_tasks(spark):
        df = r.load(paths)
    df = df.select("path", F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))
    if applications is not None:
        df = df.filter(C.application_id("path").isin(list(applications)))
    return df


def unread_files(logs: DataFrame, listing: DataFrame) -> DataFrame:
    """Files of ``listing`` (``list_logs``) with bytes of which ``logs`` (``read_logs``) has no line:
    what ``ignore_corrupt`` has skipped whole (S3); ``read_accounting`` lists files read in part as well."""
    seen = logs.select(C.plain_path("path").alias("p")).distinct()
    return (listing.filter(F.col("file_size") > 0).withColumn("p", C.plain_path("path"))
            .join(seen, "p", "left_anti").select("path", "file_size"))


def read_logs_numbered(spark: SparkSession, root: str | list[str], *, recursive: bool = True,
                       glob_filter: str | None = None, ignore_corrupt: bool = True) -> DataFrame:
    """``(path, line_no, line, file_size)`` with the 0-based line number in each file.

    The line reader keeps each split in order inside its task, so a line's
    number is (lines in the earlier splits of its file) + (its position in its
    split).  Positions come from the row id within the task, offsets from a
    per-split frame (one row per ~128 MB split) with a running sum over the
    splits of each file; no file is ever held whole, and the text is scanned once.  Lines end at ``\n``,
    ``\r\n`` or ``\r``, as in ``read_logs``; a final break opens no empty line.
    """
    paths = [root] if isinstance(root, str) else list(root)
    r = _reader(spark, recursive, ignore_corrupt, glob_filter)
    # stored first: positions and offsets come from the same reading of the files, so a split that one
    # reading skips or cuts short cannot lose or shift the lines of the other
    with listing_tasks(spark):
        df = r.load(paths)
    df = materialize(df.select(F.col("_metadata.file_path").alias("path"),
                               F.col("_metadata.file_block_start").alias("block"),
                               F.col("_metadata.file_size").alias("file_size"),
                               F.col("value").alias("line"),
                               F.monotonically_increasing_id().alias("row_id")))
    splits = df.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_id"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "block", "first_id",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return (df.join(splits, ["path", "block"])
              .select("path", (F.col("offset") + F.col("row_id") - F.col("first_id")).alias("line_no"),
                      "line", "file_size"))


COMPRESSED = r"\.(gz|bz2|deflate|zst|lz4|snappy|xz)$"


def gzip_text_bytes(spark: SparkSession, root: str | list[str], *, recursive: bool = True) -> DataFrame:
    """``(path, text_bytes)`` of every ``.gz`` file: the uncompressed length modulo 2^32 from its last four bytes.  A gzip
    file is one split for the line reader too, so a task holds one compressed file."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
    r = r.option("recursiveFileLookup", "true") if recursive else r
    with listing_tasks(spark):
        df = r.load([root] if isinstance(root, str) else list(root))
    last = F.reverse(F.hex(F.substring("content", -4, 4)))              # nibbles from the last one on
    little = F.concat(*[F.substring(last, i + 2, 1) if i % 2 == 0 else F.substring(last, i, 1) for i in range(8)])
    return df.select("path", F.when(F.length("content") >= 18, F.conv(little, 16, 10).cast("bigint")).alias("text_bytes"))


def read_accounting(logs: DataFrame, listing: DataFrame, text_sizes: DataFrame | None = None) -> DataFrame:
    """Every file of ``listing`` (``list_logs``) with what ``logs`` (``read_logs``) has of it (S3, L17): lines, their bytes, and
    whether that is the whole file.

    Lines come without their breaks of one or two bytes, and the last line may have none, so a file read whole has between
    ``line_bytes + num_lines - 1`` and ``line_bytes + 2 * num_lines`` bytes.  ``status``: ``whole``, ``part`` (``missing_bytes`` at
    least are unread), ``unread`` (no line of a file that has bytes), ``empty``, ``changed`` (more bytes read than listed), or
    ``unknown`` for a compressed file without its text size; ``text_sizes`` (``gzip_text_bytes``) gives those."""
    # by the path as it is, then by its plain form: that is worked out once a file, not once a line
    have = (logs.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("line")).alias("b"))
            .groupBy(C.plain_path("path").alias("plain")).agg(F.sum("n").alias("num_lines"), F.sum("b").alias("line_bytes")))
    files = listing.select("path", "file_size", C.plain_path("path").alias("plain"))
    packed = F.col("path").rlike(COMPRESSED)
    size = F.when(~packed, F.col("file_size"))
    if text_sizes is not None:
        files = files.join(text_sizes.select(C.plain_path("path").alias("plain"), "text_bytes"), "plain", "left")
        size = F.coalesce(size, F.col("text_bytes"))
    f = files.join(have, "plain", "left").fillna(0, ["num_lines", "line_bytes"]).withColumn("size", size)
    # the trailer of a gzip file holds the size modulo 2^32
    least = F.col("line_bytes") + F.greatest(F.col("num_lines") - 1, F.lit(0))
    most = F.col("line_bytes") + 2 * F.col("num_lines")
    size = F.when(packed & (least > F.col("size")), F.col("size") + F.ceil((least - F.col("size")) / F.lit(1 << 32)) * F.lit(1 << 32)).otherwise(F.col("size"))
    f = f.withColumn("size", size)
    status = (F.when(F.col("file_size") == 0, "empty").when((F.col("num_lines") == 0) & (F.coalesce("size", F.lit(1)) > 0), "unread")
              .when(F.col("size").isNull(), "unknown").when(F.col("size") > most, "part").when(F.col("size") < least, "changed")
              .otherwise("whole"))
    return f.select("path", "file_size", "num_lines", "line_bytes", F.col("size").alias("text_bytes"), status.alias("status"),
                    F.when(F.col("num_lines") == 0, F.col("size")).when(F.col("size") > most, F.col("size") - most)
                    .otherwise(F.lit(0)).cast("bigint").alias("missing_bytes"))


def concat_frames(*frames: DataFrame) -> DataFrame:
    """One frame from many (S12): union by column name, missing columns as NULL."""
    if not frames:
        raise ValueError("no frames")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
