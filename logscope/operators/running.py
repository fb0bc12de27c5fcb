"""Running aggregates whose keys may be hot: a two-level prefix scan.

A window over a whole key is one task, however many rows the key has.  Here the rows of a key are cut
into buckets of their order (time ranges): each bucket is aggregated once (map-side combine, one narrow
row a bucket), a window over these rows carries every bucket's total to the later ones, and a second window runs
inside the buckets only.  So a key with a third of all rows is as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: name -> (aggregate, value, whether the row itself counts)
Running = dict[str, tuple[Callable[[Column], Column], Column, bool]]


def time_bucket(ts: str | Column, seconds: int) -> Column:
    """Number of the time range of ``seconds`` that a TIMESTAMP_NTZ lies in (NULL without a time)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col(ts) if isinstance(ts, str) else ts) / F.lit(seconds * 1_000_000))


def bucket_start(bucket: str | Column, seconds: int) -> Column:
    number = F.col(bucket) if isinstance(bucket, str) else bucket
    return F.timestamp_add("SECOND", number * F.lit(seconds), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def with_running(df: DataFrame, keys: list[str], bucket: str, order: list[str], running: Running) -> DataFrame:
    """``df`` (a stored table) with one column per entry of ``running``: sums or extremes over the rows of the same keys
    that come earlier in ``order``, the row itself included or not; NULL over no rows.  ``bucket`` must not fall as ``order`` rises.
    Sums and extremes only: an aggregate of the buckets' aggregates must be the aggregate of their rows."""
    part = [*keys, bucket]
    totals = df.groupBy(*part).agg(*[how(v).alias(f"__t_{n}") for n, (how, v, _) in running.items()])
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*part, *[how(F.col(f"__t_{n}")).over(earlier).alias(f"__c_{n}") for n, (how, _, _) in running.items()])
    inside = Window.partitionBy(*part).orderBy(*order)
    upto = {True: inside.rowsBetween(Window.unboundedPreceding, Window.currentRow),
            False: inside.rowsBetween(Window.unboundedPreceding, -1)}
    here = df.withColumns({f"__i_{n}": how(v).over(upto[own]) for n, (how, v, own) in running.items()})
    out = here.join(carried, part)
    both = {}
    for n, (how, _, _) in running.items():
        c, i = F.col(f"__c_{n}"), F.col(f"__i_{n}")
        if how is F.max or how is F.min:
            both[n] = (F.greatest if how is F.max else F.least)(c, i)
        elif how is F.sum:
            both[n] = F.coalesce(c + i, c, i)
        else:
            raise ValueError("sums, minima and maxima only")
    return out.withColumns(both).drop(*[f"__{x}_{n}" for n in running for x in "ci"])
