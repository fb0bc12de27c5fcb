"""Family C: the trip contract on a hand-written frame, range filter semantics, period totals."""
import datetime as dt

from pyspark.sql import functions as F

from logscope.operators import daily as DY

T = dt.datetime


def test_trip_contract(spark):
    rows = [(T(2021, 1, 1, 0, 5), 1.0, 0.5, 10.0, 0.0, 1.0), (T(2021, 1, 1, 23, 59), 3.0, 0.5, 20.0, 2.0, 2.0),
            (T(2021, 1, 2, 12, 0), 2.0, 0.0, 15.0, 1.0, None), (T(2020, 12, 31, 23, 59), 9.0, 9.0, 99.0, 9.0, 9.0),
            (T(2022, 1, 1, 0, 0), 9.0, 9.0, 99.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, trip_distance double, mta_tax double, "
                                     "fare_amount double, tip_amount double, passenger_count double")
    out = DY.daily_summary(df, DY.TRIP_SPEC, 2021)
    assert out.columns == ["dt_year", "dt_month", "dt_day", "num_trips", "mean_trip_distance", "max_mta_tax",
                           "q95_fare_amount", "min_tip_amount", "mean_passenger_count"]
    types = dict(out.dtypes)
    assert types["dt_year"] == "int" and types["num_trips"] == "bigint" and types["mean_passenger_count"] == "bigint"
    got = [tuple(r) for r in out.collect()]
    assert got == [(2021, 1, 2, 1, 2.0, 0.0, 15.0, 1.0, None), (2021, 1, 1, 2, 2.0, 0.5, 20.0, 0.0, 2)]
    tot = DY.period_totals(out, "num_trips").first()
    assert (tot["num_days"], tot["total_num_trips"], tot["first_date"], tot["last_date"]) == (
        2, 3, dt.date(2021, 1, 1), dt.date(2021, 1, 2))


def test_period_totals_first_date_is_a_real_date(spark):
    # min(month) and min(day) taken apart would give 01/05 here; the first date is 02/01
    df = spark.createDataFrame([(2021, 2, 1, 1), (2021, 1, 31, 1), (2021, 3, 5, 1)],
                               "dt_year int, dt_month int, dt_day int, num_rows long")
    t = DY.period_totals(df).first()
    assert (t["first_date"], t["last_date"]) == (dt.date(2021, 1, 31), dt.date(2021, 3, 5))


def test_year_range_on_date_column(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2021, 6, 1),)], "d date")
    assert [r[0] for r in DY.year_range(df, "d", 2021).collect()] == [dt.date(2021, 6, 1)]
    assert DY.year_range(df, "d", 2021).filter(F.col("d").isNull()).count() == 0
