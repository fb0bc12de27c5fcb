"""Family B job: application timeline, cluster summary, usage stats, duration histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscope.jobs.parallel import run_all
from logscope.operators import reports as RP
from logscope.operators import timeline as TL
from logscope.session import materialize
from logscope.sinks import write_csv, write_text
from logscope.sources.results import read_timeline


def run_usage_job(spark: SparkSession, logs: DataFrame | None, outdir: str, bins: int = 30,
                  skip_scan: bool = False, single_file: bool = True) -> dict[str, str]:
    """The lines are scanned once, into the application timeline, stored as a table
    in the shared checkpoint folder at full precision; every output is derived
    from that table, and the CSVs are presentation only (times to the
    millisecond).  With ``skip_scan`` the timeline CSV of a previous run is
    re-read (S11) and only the downstream outputs are rebuilt.
    ``single_file=False`` writes the per-application frames as many files."""
    out = outdir.rstrip("/")
    paths = {}
    tl_path = f"{out}/app_timeline.csv"
    if skip_scan:
        timeline = read_timeline(spark, tl_path)
    else:
        timeline = materialize(TL.app_timeline(logs, ordered=False), strict=True)     # the one scan of all lines
    summary = materialize(TL.cluster_summary(timeline, ordered=False), strict=True)
    durations = materialize(TL.busiest_cluster_apps(timeline), strict=True)

    def put(name: str, df: DataFrame, file: str, **kw):
        paths[name] = write_csv(df, f"{out}/{file}", **kw)

    run_all(
        *([] if skip_scan else [lambda: put("timeline", timeline, "app_timeline.csv", single_file=single_file,
                                            order_by=["cluster_id", "app_number"])]),
        lambda: put("cluster_summary", summary, "cluster_summary.csv",
                    order_by=[summary.num_applications.desc(), summary.cluster_id]),
        lambda: paths.__setitem__("stats", write_text(RP.usage_report(TL.usage_stats(summary), TL.top_clusters(summary, 5)),
                                                      f"{out}/usage_stats.txt", order_by="line_no")),
        lambda: put("durations", durations, "busiest_durations.csv", single_file=single_file),
        lambda: put("histogram", TL.duration_histogram(timeline, bins, durations), "duration_histogram.csv", order_by=["bin"]),
        lambda: put("histogram_log", TL.duration_histogram_log(timeline, bins, durations),
                    "duration_histogram_log.csv", order_by=["bin"]))
    return paths
