"""The query catalog: one ``(spark, sf_dir) -> DataFrame`` per operator of the blueprint.

Every query reads the given tables (or the log corpus Spark derives from
``events``) in full; none caps, samples or subsets its input unless the limit
is the feature itself (top-k, sampling).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscope.functions import columns as C
from logscope.operators import activity as AC
from logscope.operators import daily as DY
from logscope.operators import events as EV
from logscope.operators import levels as LV
from logscope.operators import precedence as PR
from logscope.operators import records as RC
from logscope.operators import reports as RP
from logscope.operators import shapes as SH
from logscope.operators import tasks as TK
from logscope.operators import timeline as TL
from logscope.plans import views as VW
from logscope.session import materialize, table_path
from logscope.sinks import write_csv, write_matching_lines
from logscope.sources import (by_parts, concat_frames, gzip_text_bytes, list_logs, log_events, log_lines, log_tree, log_tree_gzip,
                              orders_by_month, profile_source, read_accounting, read_files, read_logs, read_logs_numbered,
                              read_period, read_result_csv, read_table, read_timeline)
from logscope.sources.incremental import update_manifest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ family A: levels
@query("level_counts")
def q_level_counts(spark, sf):
    return LV.level_counts(log_lines(spark, sf))


@query("level_summary")
def q_level_summary(spark, sf):
    return LV.level_summary(log_lines(spark, sf))


@query("level_counts_plain")
def q_level_counts_plain(spark, sf):
    return LV.level_counts(log_lines(spark, sf), mode="plain")


@query("level_occurrences")
def q_level_occurrences(spark, sf):
    return LV.level_occurrences(log_lines(spark, sf))


@query("sample_lines_seeded")
def q_sample_seeded(spark, sf):
    return LV.sample_lines(log_lines(spark, sf), n=10, seed=42, key="line_no")


@query("sample_lines_random")
def q_sample_random(spark, sf):
    return LV.sample_lines(log_lines(spark, sf), n=10)


@query("one_pass_summary")
def q_one_pass_summary(spark, sf):
    return LV.summary_of(LV.totals_with_sample(log_lines(spark, sf), n=10, seed=42, key="line_no"))


@query("one_pass_sample")
def q_one_pass_sample(spark, sf):
    return LV.sample_of(materialize(LV.totals_with_sample(log_lines(spark, sf), n=10, seed=42, key="line_no")))


@query("error_lines")
def q_error_lines(spark, sf):
    return LV.lines_containing(log_lines(spark, sf), "ERROR").select("path", "line_no", "line")


# ------------------------------------------------------------------ family B: timelines and cluster usage


def _timeline(spark, sf):
    return TL.app_timeline(log_lines(spark, sf), ordered=False)


def _timeline_table(spark, sf):
    """The timeline written once as a small table (one row per application), for
    queries that read it several times: the log lines are scanned once."""
    return materialize(_timeline(spark, sf))


@query("path_ids")
def q_path_ids(spark, sf):
    return TL.path_ids(log_lines(spark, sf))


@query("app_timeline")
def q_app_timeline(spark, sf):
    return TL.app_timeline(log_lines(spark, sf))


@query("app_timeline_anchored")
def q_app_timeline_anchored(spark, sf):
    """The timeline with the documented time grammar (L3b): start-of-line yy/MM/dd only."""
    return TL.app_timeline(log_lines(spark, sf), time_mode="anchored")


@query("container_timeline")
def q_container_timeline(spark, sf):
    return TL.container_timeline(log_lines(spark, sf))


@query("cluster_summary")
def q_cluster_summary(spark, sf):
    return TL.cluster_summary(_timeline(spark, sf))


@query("usage_stats")
def q_usage_stats(spark, sf):
    return TL.usage_stats(TL.cluster_summary(_timeline(spark, sf), ordered=False))


@query("top_clusters")
def q_top_clusters(spark, sf):
    return TL.top_clusters(TL.cluster_summary(_timeline(spark, sf), ordered=False), 5)


@query("cluster_start_month")
def q_cluster_start_month(spark, sf):
    return TL.cluster_start_month(TL.cluster_summary(_timeline(spark, sf)))


@query("busiest_cluster_durations")
def q_busiest(spark, sf):
    return TL.busiest_cluster_apps(_timeline_table(spark, sf))


@query("duration_histogram")
def q_duration_histogram(spark, sf):
    return TL.duration_histogram(_timeline_table(spark, sf), 30)


@query("duration_histogram_log")
def q_duration_histogram_log(spark, sf):
    return TL.duration_histogram_log(_timeline_table(spark, sf), 30)


@query("duration_density")
def q_duration_density(spark, sf):
    d = TL.duration_density(_timeline(spark, sf))
    return d.select("point", "n", *[F.round(c, 9).alias(c) for c in ("log10_x", "density", "bandwidth")])


@query("app_inventory")
def q_app_inventory(spark, sf):
    return TL.app_inventory(log_lines(spark, sf))


@query("top_apps_by_files")
def q_top_apps_by_files(spark, sf):
    return TL.top_apps_by_files(log_lines(spark, sf), 5)


# ------------------------------------------------------------------ family C: daily summaries

LINEITEM_SPEC = DY.DailySpec(
    ts="l_shipdate", count_name="num_rows",
    mean=("l_quantity", "mean_quantity"), max=("l_tax", "max_tax"),
    q95=("l_extendedprice", "q95_extendedprice"), min=("l_discount", "min_discount"),
    ceil_mean=("l_linenumber", "ceil_mean_linenumber"))
ORDERS_SPEC = DY.DailySpec(
    ts="o_orderdate", count_name="num_rows",
    mean=("o_totalprice", "mean_totalprice"), max=("o_totalprice", "max_totalprice"),
    q95=("o_totalprice", "q95_totalprice"), min=("o_totalprice", "min_totalprice"))
SUMMARY_YEAR = 1996


@query("daily_summary_lineitem")
def q_daily_lineitem(spark, sf):
    return DY.daily_summary(read_table(spark, sf, "lineitem"), LINEITEM_SPEC, SUMMARY_YEAR)


@query("daily_summary_orders")
def q_daily_orders(spark, sf):
    return DY.daily_summary(read_table(spark, sf, "orders"), ORDERS_SPEC, SUMMARY_YEAR)


@query("period_totals")
def q_period_totals(spark, sf):
    daily = DY.daily_summary(read_table(spark, sf, "lineitem"), LINEITEM_SPEC, SUMMARY_YEAR, ordered=False)
    return DY.period_totals(daily, "num_rows")


# ------------------------------------------------------------------ text sources and sinks
def _out(spark, name):
    """A new output folder of this application below the shared checkpoint folder."""
    return f"{table_path(spark)}/{name}"


@query("text_level_counts")
def q_text_level_counts(spark, sf):
    return LV.level_counts(read_logs(spark, log_tree(spark, sf)))


@query("level_groups")
def q_level_groups(spark, sf):
    return LV.level_groups(log_lines(spark, sf))


@query("text_glob_lines")
def q_text_glob_lines(spark, sf):
    logs = read_logs(spark, f"{log_tree(spark, sf)}/app=application_*/*.txt", recursive=False)
    return logs.groupBy(C.application_id("path").alias("application_id")).agg(F.count(F.lit(1)).alias("num_lines"))


@query("text_numbered_lines")
def q_text_numbered_lines(spark, sf):
    logs = read_logs_numbered(spark, log_tree(spark, sf))
    return logs.select(C.application_id("path").alias("application_id"), "line_no", "line")


@query("text_app_subset")
def q_text_app_subset(spark, sf):
    """S8 itself: one named application of the tree."""
    logs = read_logs(spark, log_tree(spark, sf), applications=["application_1485248649253_0001"])
    return (logs.groupBy(C.application_id("path").alias("application_id"), C.level("line").alias("log_level"))
            .agg(F.count(F.lit(1)).alias("count")))


@query("text_inventory")
def q_text_inventory(spark, sf):
    return TL.app_inventory(list_logs(spark, log_tree(spark, sf), glob_filter="*.txt"))


@query("text_top_apps")
def q_text_top_apps(spark, sf):
    """A18 from the listing alone: no file is opened."""
    return TL.top_apps_by_files(list_logs(spark, log_tree(spark, sf), glob_filter="*.txt"), 5)


def _runs(spark, sf):
    """Three runs over a growing tree: one cluster's applications, then all, then nothing new."""
    root, state = log_tree(spark, sf), _out(spark, "manifest")
    return [update_manifest(spark, r, state, glob_filter="*.txt") for r in (f"{root}/app=application_1485248649253_*", root, root)]


@query("incremental_timeline")
def q_incremental_timeline(spark, sf):
    t = TL.app_timeline_from_files(_runs(spark, sf)[-1].manifest)
    return t.select("cluster_id", "application_id", "app_number", "start_time", "end_time")


@query("incremental_runs")
def q_incremental_runs(spark, sf):
    rows = [(u.version, u.files_listed, u.bytes_listed, u.files_read, u.bytes_read) for u in _runs(spark, sf)]
    return spark.createDataFrame(rows, "version INT, files_listed BIGINT, bytes_listed BIGINT, files_read BIGINT, bytes_read BIGINT")


def _accounted(a):
    return a.select(C.application_id("path").alias("application_id"), "num_lines", "line_bytes", "text_bytes", "status", "missing_bytes")


@query("read_accounting")
def q_read_accounting(spark, sf):
    return by_parts(spark, log_tree(spark, sf), lambda part: _accounted(
        read_accounting(read_logs(spark, part), list_logs(spark, part, glob_filter="*.txt"))))


@query("read_accounting_gzip")
def q_read_accounting_gzip(spark, sf):
    return by_parts(spark, log_tree_gzip(spark, sf), lambda part: _accounted(
        read_accounting(read_logs(spark, part), list_logs(spark, part, glob_filter="*.gz"), gzip_text_bytes(spark, part))))


@query("crlf_csv_roundtrip")
def q_crlf_csv_roundtrip(spark, sf):
    """K2: fixed order and CRLF line ends; the file is read back as text, breaks included."""
    path = write_csv(LV.level_counts(log_lines(spark, sf)), _out(spark, "counts.csv"), line_sep="\r\n",
                     order_by=[F.col("count").desc(), "log_level"])
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("file_text"))


@query("distributed_csv_roundtrip")
def q_distributed_csv_roundtrip(spark, sf):
    """K4: a result of many files, never gathered; quotes and commas of the lines survive."""
    path = write_csv(LV.lines_containing(log_lines(spark, sf), "ERROR").select("path", "line_no", "line"), _out(spark, "errors.csv"),
                     single_file=False)
    return read_result_csv(spark, path, "path STRING, line_no BIGINT, line STRING")


@query("timeline_csv_roundtrip")
def q_timeline_csv_roundtrip(spark, sf):
    path = write_csv(_timeline(spark, sf), _out(spark, "timeline.csv"), order_by=["cluster_id", "app_number"])
    return read_timeline(spark, path)


@query("sample_csv_roundtrip")
def q_sample_csv_roundtrip(spark, sf):
    path = write_csv(q_sample_seeded(spark, sf), _out(spark, "sample.csv"))
    return read_result_csv(spark, path, "log_entry STRING, log_level STRING")


@query("error_lines_roundtrip")
def q_error_lines_roundtrip(spark, sf):
    path = write_matching_lines(log_lines(spark, sf), "ERROR", _out(spark, "errors"))
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("concat_frames")
def q_concat_frames(spark, sf):
    logs = log_lines(spark, sf)
    return concat_frames(LV.lines_containing(logs, "ERROR").select("path", "line_no", "line"),
                         LV.lines_containing(logs, "DEBUG").select("path", "line_no"))


@query("sample_random_check")
def q_sample_random_check(spark, sf):
    """O7 made checkable: the size of a random draw, how many of its lines the corpus holds, and
    how many carry their own level."""
    logs = log_lines(spark, sf)
    sample = materialize(LV.sample_lines(logs, n=10))
    known = logs.select("line").join(sample, F.col("line") == F.col("log_entry"), "left_semi").distinct()
    right = F.count_if(C.level("log_entry") == F.col("log_level"))
    return (sample.join(known, F.col("log_entry") == F.col("line"), "left")
            .agg(F.count(F.lit(1)).alias("sample_size"), F.count("line").alias("found"), right.alias("right_level")))


@query("period_scan")
def q_period_scan(spark, sf):
    """S7 itself: the files of six months."""
    o = read_period(spark, orders_by_month(spark, sf), [1996], range(3, 9), file_glob="mm={month}")
    return o.select("o_orderkey", "o_totalprice", "yyyy", "mm")


@query("multi_file_scan")
def q_multi_file_scan(spark, sf):
    return read_files(spark, f"{orders_by_month(spark, sf)}/yyyy=*/mm=*").select("o_orderkey", "o_custkey", "o_totalprice")


# ------------------------------------------------------------------ log events

for _name, _fn in {
    "executor_requests": EV.executor_requests, "container_requests": EV.container_requests,
    "request_shapes": EV.request_shapes, "input_splits": EV.input_splits,
    "python_worker_times": EV.python_worker_times, "memory_capacity": EV.memory_capacity,
    "stored_blocks": EV.stored_blocks, "broadcast_reads": EV.broadcast_reads,
    "cache_hits": EV.cache_hits, "shuffle_fetches": EV.shuffle_fetches,
    "cache_hits_by_rdd": EV.cache_hits_by_rdd, "unfinished_tasks": TK.unfinished_tasks,
    "container_failures": TK.container_failures,
}.items():
    QUERIES[_name] = (lambda fn: lambda spark, sf: fn(log_events(spark, sf)))(_fn)

for _name, _fn in {
    "parsed_records": RC.parse_records, "component_counts": RC.component_counts,
    "parse_audit": RC.parse_audit, "parse_audit_by_file": RC.parse_audit_by_file,
    "host_activity": RC.host_activity, "stitched_entries": RC.stitched_entries,
    "unparsed_templates": SH.unparsed_templates,
}.items():
    QUERIES[_name] = (lambda fn: lambda spark, sf: fn(log_lines(spark, sf)))(_fn)


# ------------------------------------------------------------------ tasks
def _tasks(spark, sf):
    return TK.task_lifecycle(log_events(spark, sf))


@query("task_lifecycle")
def q_task_lifecycle(spark, sf):
    return _tasks(spark, sf)


@query("task_time_by_app")
def q_task_time_by_app(spark, sf):
    return TK.task_time_by_app(_tasks(spark, sf))


@query("slowest_tasks")
def q_slowest_tasks(spark, sf):
    return TK.slowest_tasks(_tasks(spark, sf), 10)


@query("stage_skew")
def q_stage_skew(spark, sf):
    return TK.stage_skew(_tasks(spark, sf))


@query("stage_bottlenecks")
def q_stage_bottlenecks(spark, sf):
    return TK.stage_bottlenecks(_tasks(spark, sf))


@query("stages_per_app")
def q_stages_per_app(spark, sf):
    return TK.stages_per_app(_tasks(spark, sf))


@query("stage_precedence")
def q_stage_precedence(spark, sf):
    return PR.stage_precedence(materialize(PR.stage_spans(_tasks(spark, sf))))


@query("critical_paths")
def q_critical_paths(spark, sf):
    spans = materialize(PR.stage_spans(_tasks(spark, sf)))
    return PR.critical_paths(spans, PR.stage_precedence(spans))


# ------------------------------------------------------------------ work over time (L6, L6d, L10, L11, L15)
def _containers(spark, sf):
    return materialize(AC.container_intervals(TL.container_timeline(log_lines(spark, sf))))


@query("concurrency_by_cluster")
def q_concurrency_by_cluster(spark, sf):
    return AC.concurrency_by_cluster(_containers(spark, sf))


@query("concurrency_over_time")
def q_concurrency_over_time(spark, sf):
    return AC.concurrency_over_time(_containers(spark, sf))


@query("container_activity")
def q_container_activity(spark, sf):
    return AC.container_activity(AC.task_intervals(log_events(spark, sf)))


@query("busy_spells")
def q_busy_spells(spark, sf):
    return AC.busy_spells(AC.task_intervals(log_events(spark, sf)))


@query("memory_states")
def q_memory_states(spark, sf):
    return AC.memory_states(log_events(spark, sf))


@query("memory_lows")
def q_memory_lows(spark, sf):
    return AC.memory_lows(AC.memory_states(log_events(spark, sf)))


# ------------------------------------------------------------------ sources and SQL surface


@query("source_profile_orders")
def q_profile_orders(spark, sf):
    return profile_source(read_table(spark, sf, "orders"))


@query("source_profile_lineitem")
def q_profile_lineitem(spark, sf):
    return profile_source(read_table(spark, sf, "lineitem"))


@query("view_row_count")
def q_view_row_count(spark, sf):
    v = VW.register_tables(spark, sf, ["lineitem"])
    return VW.row_count(spark, v["lineitem"])


@query("even_keys_doubled")
def q_even_keys_doubled(spark, sf):
    v = VW.register_tables(spark, sf, ["orders"])
    return VW.even_doubled(spark, v["orders"], "o_orderkey")


# ------------------------------------------------------------------ text reports (K5)


@query("level_report")
def q_level_report(spark, sf):
    return RP.level_report(LV.level_summary(log_lines(spark, sf)))


@query("usage_report")
def q_usage_report(spark, sf):
    summary = TL.cluster_summary(_timeline(spark, sf), ordered=False)
    return RP.usage_report(TL.usage_stats(summary), TL.top_clusters(summary, 5))


@query("period_report")
def q_period_report(spark, sf):
    daily = DY.daily_summary(read_table(spark, sf, "lineitem"), LINEITEM_SPEC, SUMMARY_YEAR, ordered=False)
    return RP.period_report(DY.period_totals(daily, "num_rows"), "num_rows")
