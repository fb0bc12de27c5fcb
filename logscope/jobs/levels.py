"""Family A job: level counts CSV, sample CSV and summary text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logscope.jobs.parallel import run_all
from logscope.operators import levels as LV
from logscope.operators import reports as RP
from logscope.session import materialize
from logscope.sinks import write_csv, write_text


def run_levels_job(spark: SparkSession, logs: DataFrame, outdir: str, sample_n: int = 10,
                   seed: int | None = None, crlf: bool = False) -> dict[str, str]:
    out = outdir.rstrip("/")
    sep = "\r\n" if crlf else None
    paths = {}

    # the one scan of all lines: totals and sample in one row
    totals = materialize(LV.totals_with_sample(logs, sample_n, seed), strict=True)
    got = totals.selectExpr("size(sample) AS k", "lines_with_level AS m").first()
    # a table of few lines can leave ranges of the draw empty: sampled again, in full
    sample = LV.sample_of(totals) if got["k"] >= min(sample_n, got["m"]) else LV.sample_lines(logs, n=sample_n, seed=seed)
    summary = LV.summary_of(totals)
    run_all(lambda: paths.__setitem__("counts", write_csv(summary.select("log_level", "count"), f"{out}/level_counts.csv", line_sep=sep)),
            lambda: paths.__setitem__("summary", write_text(RP.level_report(summary), f"{out}/level_summary.txt", order_by="line_no")),
            lambda: paths.__setitem__("sample", write_csv(sample, f"{out}/level_sample.csv", line_sep=sep)))
    return {k: paths[k] for k in ("counts", "sample", "summary")}
