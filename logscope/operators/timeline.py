"""Family B: application timelines and cluster usage (A7-A9, A12-A14, A17-A19, J1, O1-O5, L2, L6d).

Scale shape: every identity (application, cluster, container) is a function
of the file path, and min/max/count decompose.  So the line-level work is ONE
aggregate keyed by ``path`` (map-side partial aggregation collapses each file
to one row per task before the shuffle, whatever the skew of applications),
and the id regexes then run once per file instead of once per line.  All
later frames (timeline, cluster summary, stats, histogram) are per-application
sized and derived from that single scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.session import materialize


# ------------------------------------------------------------------ per file (the one line-level pass)
def file_stats(logs: DataFrame, time_mode: str = "lenient") -> DataFrame:
    """``(path, first_time, last_time, num_lines, file_bytes)`` per log file.

    ``file_bytes`` is the file size when the source provides it, else the
    bytes of the lines plus one line break each.
    """
    if "file_size" in logs.columns:
        size = F.max("file_size")
    else:
        size = F.sum(F.octet_length("line") + F.lit(1))
    timed = C.with_log_time(logs, "line", "__ts", time_mode)
    return (timed.groupBy("path")
            .agg(F.min("__ts").alias("first_time"), F.max("__ts").alias("last_time"),
                 F.count(F.lit(1)).alias("num_lines"), size.cast("bigint").alias("file_bytes")))


def with_path_ids(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumns(C.path_ids(path))


def path_ids(logs: DataFrame) -> DataFrame:
    """Distinct log files with every identity parsed from the path."""
    files = logs.select("path").distinct()
    return (with_path_ids(files)
            .withColumn("role", C.container_role("container_no"))
            .select("path", "application_id", "cluster_id", "app_number",
                    "container_id", "attempt", "container_no", "role"))


# ------------------------------------------------------------------ timelines
def app_timeline_from_files(files: DataFrame) -> DataFrame:
    """Application bounds from per-file bounds; files with no time or no
    application id are dropped (F4), as the line-level filter would drop their lines."""
    # one predicate over an aggregate output: Catalyst cannot push it below the
    # per-file aggregate, so the path regex runs once per file, not per line
    app = F.when(F.col("first_time").isNotNull(), C.application_id("path"))
    f = files.withColumn("application_id", app).filter(F.col("application_id") != "")
    return (f.groupBy(C.cluster_id("application_id").alias("cluster_id"), "application_id",
                      C.app_number("application_id").alias("app_number"))
            .agg(F.min("first_time").alias("start_time"), F.max("last_time").alias("end_time")))


def app_timeline(logs: DataFrame, time_mode: str = "lenient", ordered: bool = True) -> DataFrame:
    """``(cluster_id, application_id, app_number, start_time, end_time)``.

    Sorted by ``cluster_id, app_number`` as text (``10001`` before ``9999``).
    """
    t = app_timeline_from_files(file_stats(logs, time_mode))
    if ordered:
        t = t.orderBy("cluster_id", "app_number")
    return t.select("cluster_id", "application_id", "app_number", "start_time", "end_time")


def container_timeline(logs: DataFrame, short_lines: int = 41, time_mode: str = "lenient") -> DataFrame:
    """One row per container log (L6d): bounds, lines, duration, role and a
    short-lived flag for logs of at most ``short_lines`` lines."""
    f = file_stats(logs, time_mode)
    f = with_path_ids(f.withColumn("path", F.when(F.col("num_lines") > 0, F.col("path"))))
    f = f.filter(F.col("container_id") != "")
    return f.select(
        "application_id", "container_id", "attempt", "container_no",
        C.container_role("container_no").alias("role"),
        F.col("first_time").alias("start_time"), F.col("last_time").alias("end_time"),
        "num_lines", C.seconds_between("first_time", "last_time").alias("duration_sec"),
        (F.col("num_lines") <= F.lit(short_lines)).alias("short_lived"))


# ------------------------------------------------------------------ per cluster
def cluster_summary(timeline: DataFrame, ordered: bool = True) -> DataFrame:
    """``(cluster_id, num_applications, cluster_first_app, cluster_last_app)``.

    Ties in the application count are broken by ``cluster_id`` so the order is total.
    """
    s = (timeline.groupBy("cluster_id")
         .agg(F.count(F.lit(1)).alias("num_applications"),
              F.min("start_time").alias("cluster_first_app"),
              F.max("end_time").alias("cluster_last_app")))
    if ordered:
        s = s.orderBy(F.col("num_applications").desc(), F.col("cluster_id"))
    return s


def usage_stats(summary: DataFrame) -> DataFrame:
    """One row: clusters, applications, mean applications per cluster (0 if none)."""
    one = summary.agg(F.count(F.lit(1)).alias("total_clusters"),
                      F.coalesce(F.sum("num_applications"), F.lit(0)).cast("bigint")
                      .alias("total_applications"))
    avg = (F.when(F.col("total_clusters") == 0, F.lit(0.0))
           .otherwise(F.col("total_applications").cast("double") / F.col("total_clusters")))
    return one.select("total_clusters", "total_applications", avg.alias("avg_apps_per_cluster"))


def top_clusters(summary: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most used clusters (O4): a TakeOrderedAndProject, no full sort."""
    return summary.orderBy(F.col("num_applications").desc(), F.col("cluster_id")).limit(n)


def cluster_start_month(summary: DataFrame) -> DataFrame:
    """Cluster start (the id is epoch ms) and its month label ``MMM yyyy``."""
    start = C.cluster_start("cluster_id")
    return summary.select("cluster_id", "num_applications", start.alias("cluster_start"),
                          F.date_format(start, "MMM yyyy").alias("start_month"))


def busiest_cluster_apps(timeline: DataFrame) -> DataFrame:
    """Applications of the cluster with most applications, with durations in minutes.

    The top-1 frame is one row by construction (``limit(1)``), so the broadcast
    hint (J2) for the semi-join is size-safe at any scale.
    """
    top1 = top_clusters(cluster_summary(timeline, ordered=False), 1).select("cluster_id")
    t1 = timeline.join(F.broadcast(top1), "cluster_id", "left_semi")
    return t1.select("cluster_id", "application_id", "app_number", "start_time", "end_time",
                     C.minutes_between("start_time", "end_time").alias("duration_min"))


# ------------------------------------------------------------------ histograms
def histogram(df: DataFrame, value: str | Column, bins: int = 30) -> DataFrame:
    """Equal-width histogram, ``bins`` bins over [min, max], last bin closed.

    ``(bin, bin_lo, bin_hi, count, n)``, every bin present (zero-filled); ``n``
    is the number of values binned (the sample size, on every row).  The
    bounds come from one scalar subquery (a single-row aggregate, reused for
    both ends), so no row ever meets a cross join or a single-partition window.
    Equal values give one bin holding everything.
    """
    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    bounds = vals.select(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"),
                                  F.count(F.lit(1)).alias("n")).alias("b")).scalar()
    lo, hi = F.col("b.lo"), F.col("b.hi")
    width = (hi - lo) / F.lit(float(bins))
    b = (F.when(hi == lo, F.lit(0))
         .otherwise(F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)))).cast("int")
    counts = (vals.select("v", bounds.alias("b"))
              .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    # the bin dimension and the result are exactly ``bins`` rows: one partition
    dims = df.sparkSession.range(0, bins, 1, 1).select(F.col("id").cast("int").alias("bin"), bounds.alias("b"))
    dims = dims.select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                       (lo + (F.col("bin") + 1) * width).alias("bin_hi"), F.col("b.n").alias("n"))
    return (dims.join(F.broadcast(counts), "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "n")
            .coalesce(1).sortWithinPartitions("bin"))


def duration_histogram(timeline: DataFrame, bins: int = 30, durations: DataFrame | None = None) -> DataFrame:
    """Histogram of job durations (minutes) on the busiest cluster.

    The per-application durations are checkpointed first (a small frame), so
    the bounds subquery and the bin counts read it instead of re-running the
    whole log scan behind it.  Pass ``durations`` to reuse a checkpointed one.
    """
    d = durations if durations is not None else materialize(busiest_cluster_apps(timeline))
    return histogram(d, "duration_min", bins)


def duration_histogram_log(timeline: DataFrame, bins: int = 30, durations: DataFrame | None = None) -> DataFrame:
    """Log-spaced histogram of positive durations on the busiest cluster.

    Bins are equal in ``log10(minutes)``; edges are reported in log10 units.
    Zero durations (one-line applications) have no logarithm and are left
    out; ``excluded_nonpositive`` reports how many.
    """
    d = durations if durations is not None else materialize(busiest_cluster_apps(timeline))
    h = histogram(d.filter(F.col("duration_min") > 0), F.log10("duration_min"), bins)
    excluded = d.select(F.count_if(~(F.col("duration_min") > 0))).scalar()
    return h.select("bin", F.col("bin_lo").alias("log10_lo"), F.col("bin_hi").alias("log10_hi"), "count", "n",
                    excluded.alias("excluded_nonpositive"))


def log_density(df: DataFrame, value: str | Column, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of ``log10(value)`` of the positive values (A14): ``(point, log10_x, density, n, bandwidth)``.

    One aggregate gives the size and spread, and with them the bandwidth (Scott's rule: deviation * n^(-1/5)) and a grid of
    ``points`` from ``cut`` bandwidths below the least value to as many above the largest.  Linear binning shares every value between its two
    neighbours on the grid, in proportion to their distance: a grouped sum of at most ``points`` rows, however many values there
    are.  These weights are convolved with the kernel on the grid, one row per point.  Fewer than two values, or equal ones, have no
    density and give no row."""
    v = F.col(value) if isinstance(value, str) else value
    vals = materialize(df.select(v.alias("x")).filter(F.col("x") > 0).select(F.log10("x").alias("v")))
    s = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    s = s.filter("n > 1 AND sd > 0").select("n", h.alias("h"), (F.col("lo") - cut * h).alias("lo"),
                                            ((F.col("hi") - F.col("lo") + 2 * cut * h) / F.lit(float(points - 1))).alias("step"))
    grid = materialize(s)               # one row or none
    g = grid.select(F.struct("n", "h", "lo", "step")).scalar()
    at = (F.col("v") - F.col("g.lo")) / F.col("g.step")
    placed = vals.select("v", g.alias("g")).filter(F.col("g").isNotNull()).select(at.alias("at"), F.floor(at).alias("j"))
    share = F.col("at") - F.col("j")
    weights = (placed.select(F.explode(F.array(F.struct(F.col("j"), (1 - share).alias("w")), F.struct((F.col("j") + 1).alias("j"), share.alias("w"))))
                             .alias("p"))
               .groupBy("p.j").agg(F.sum("p.w").alias("w")))
    packed = weights.agg(F.array_sort(F.collect_list(F.struct("j", "w"))).alias("bins"))      # at most ``points`` entries
    grid_of = packed.select("bins", g.alias("g")).filter(F.col("g").isNotNull())
    out = grid_of.select("bins", "g", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    kernel = F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + b["w"] * F.exp(
        -F.pow((F.col("point") - b["j"]) * F.col("g.step") / F.col("g.h"), F.lit(2.0)) / 2))
    return out.select("point", (F.col("g.lo") + F.col("point") * F.col("g.step")).alias("log10_x"),
                      (kernel / (F.col("g.n") * F.col("g.h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
                      F.col("g.n").alias("n"), F.col("g.h").alias("bandwidth"))


def duration_density(timeline: DataFrame, points: int = 200, durations: DataFrame | None = None) -> DataFrame:
    """``log_density`` of the job durations (minutes) on the busiest cluster."""
    return log_density(durations if durations is not None else busiest_cluster_apps(timeline), "duration_min", points)


# ------------------------------------------------------------------ inventory
def app_files(logs: DataFrame) -> DataFrame:
    """``(application_id, num_files, app_bytes)`` for files below an application directory.

    ``logs`` is a file listing (``sources.list_logs``: one row per file with its size, no
    content is read) or, where there is none, a frame of lines."""
    if "line" not in logs.columns:
        f = logs.select("path", F.col("file_size").alias("file_bytes"), F.lit(1).alias("num_lines"))
    else:
        f = file_stats(logs)
    # tied to an aggregate output so the filter stays above the per-file aggregate
    f = f.withColumn("application_id", F.when(F.col("num_lines") > 0, C.application_id("path")))
    return (f.filter(F.col("application_id") != "")
            .groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("num_files"), F.sum("file_bytes").cast("bigint").alias("app_bytes")))


def app_inventory(logs: DataFrame) -> DataFrame:
    """One row: applications, files, mean files per application, min/mean/max bytes per application."""
    a = app_files(logs)
    return a.agg(F.count(F.lit(1)).alias("num_applications"),
                 F.coalesce(F.sum("num_files"), F.lit(0)).cast("bigint").alias("num_files"),
                 F.avg("num_files").alias("mean_files_per_app"),
                 F.min("app_bytes").alias("min_app_bytes"),
                 F.avg("app_bytes").alias("mean_app_bytes"),
                 F.max("app_bytes").alias("max_app_bytes"))


def top_apps_by_files(logs: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` applications with most log files."""
    return (app_files(logs).orderBy(F.col("num_files").desc(), F.col("application_id"))
            .limit(n).select("application_id", "num_files", "app_bytes"))
