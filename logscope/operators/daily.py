"""Family C: per-day multi-metric summaries and period totals.

The year filter is a half-open range on the raw timestamp, which parquet
receives as ``PushedFilters`` (row-group skipping); ``year(ts) = Y`` would only
push ``IsNotNull``.  The day columns are derived after the filter.  All six
metrics are one aggregate; the percentile is a mergeable sketch
(ObjectHashAggregate), so partial aggregation per task keeps the shuffle at
one digest per (task, day) even when one day holds most rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DailySpec:
    """Which column feeds which metric, and the output names (``None`` skips a metric)."""
    ts: str
    count_name: str = "num_rows"
    mean: tuple[str, str] | None = None         # (input column, output name): avg
    max: tuple[str, str] | None = None          # max
    q95: tuple[str, str] | None = None          # percentile_approx(x, 0.95)
    min: tuple[str, str] | None = None          # min
    ceil_mean: tuple[str, str] | None = None    # ceil(avg(x)) as BIGINT
    accuracy: int = 10000


# The trip table contract (input columns and output names).
TRIP_SPEC = DailySpec(
    ts="tpep_pickup_datetime", count_name="num_trips",
    mean=("trip_distance", "mean_trip_distance"),
    max=("mta_tax", "max_mta_tax"),
    q95=("fare_amount", "q95_fare_amount"),
    min=("tip_amount", "min_tip_amount"),
    ceil_mean=("passenger_count", "mean_passenger_count"),
)


def year_range(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows whose ``ts`` falls in ``year``, as a pushable half-open range."""
    typ = df.schema[ts].dataType
    lo = F.lit(f"{year:04d}-01-01 00:00:00").cast(typ)
    hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast(typ)
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def daily_summary(df: DataFrame, spec: DailySpec, year: int | None = None,
                  ordered: bool = True) -> DataFrame:
    """``(dt_year, dt_month, dt_day, <count>, <metrics...>)``, newest day first."""
    if year is not None:
        df = year_range(df, spec.ts, year)
    aggs = [F.count(F.lit(1)).alias(spec.count_name)]
    if spec.mean:
        aggs.append(F.avg(spec.mean[0]).alias(spec.mean[1]))
    if spec.max:
        aggs.append(F.max(spec.max[0]).alias(spec.max[1]))
    if spec.q95:
        aggs.append(F.percentile_approx(spec.q95[0], 0.95, spec.accuracy).alias(spec.q95[1]))
    if spec.min:
        aggs.append(F.min(spec.min[0]).alias(spec.min[1]))
    if spec.ceil_mean:
        aggs.append(F.ceil(F.avg(spec.ceil_mean[0])).cast("bigint").alias(spec.ceil_mean[1]))
    t = F.col(spec.ts)
    out = df.groupBy(F.year(t).alias("dt_year"), F.month(t).alias("dt_month"),
                     F.dayofmonth(t).alias("dt_day")).agg(*aggs)
    if ordered:
        out = out.orderBy(F.col("dt_year").desc(), F.col("dt_month").desc(), F.col("dt_day").desc())
    return out


def period_totals(daily: DataFrame, count_name: str = "num_rows") -> DataFrame:
    """One row over a daily frame: days, total and mean per day, first and last date."""
    d = F.make_date("dt_year", "dt_month", "dt_day")
    return daily.agg(F.count(F.lit(1)).alias("num_days"),
                     F.coalesce(F.sum(count_name), F.lit(0)).cast("bigint").alias(f"total_{count_name}"),
                     F.avg(count_name).alias(f"mean_daily_{count_name}"),
                     F.min(d).alias("first_date"), F.max(d).alias("last_date"))
