"""Daily, area and period products on small tables."""

import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from brisa.operators import rollup
from brisa.operators.index import steady_mean
from brisa.params import PARAMETERS

SIX = ", ".join(f"{p} double" for p in PARAMETERS)


def hours(spark, rows):
    """rows: (station, end-of-hour stamp, o3, rest)."""
    data = [(s, t, rest, rest, o3, rest, rest, rest) for s, t, o3, rest in rows]
    return spark.createDataFrame(data, f"station_id int, published_at timestamp_ntz, {SIX}")


def stamp(hour, day=5):
    return dt.datetime(2024, 3, day) + dt.timedelta(hours=hour)


def test_day_runs_from_one_to_midnight(spark):
    df = hours(spark, [(1, stamp(1), 10.0, 2.0), (1, stamp(24), 30.0, 4.0), (1, stamp(25), 99.0, 9.0)])
    got = {r.published_at: r for r in rollup.station_day(df).collect()}
    assert got[dt.date(2024, 3, 5)].pm2_5 == 3
    assert dt.date(2024, 3, 6) in got


def test_eight_hour_ozone_takes_starts_until_seventeen(spark):
    rows = [(1, stamp(h), 100.0 if h >= 18 else 10.0, 1.0) for h in range(1, 25)]
    # the span that starts at 17:00 holds one low and seven high hours
    got = rollup.station_day(hours(spark, rows)).first()
    assert got.o3 == round((10 + 7 * 100) / 8 + 1e-9)
    assert got.o3_flag == 1 and got.pm10_flag == 1


def test_row_span_widens_over_gaps_and_clock_span_does_not(spark):
    rows = [(1, stamp(1), 0.0, 1.0), (1, stamp(20), 80.0, 1.0)]
    by_rows = rollup.station_day(hours(spark, rows), frame="rows").first()
    by_clock = rollup.station_day(hours(spark, rows), frame="range").first()
    assert (by_rows.o3, by_clock.o3) == (40, 0)


def test_flags_need_twenty_hours(spark):
    rows = [(1, stamp(h), 10.0, None if h > 19 else 1.0) for h in range(1, 25)]
    got = rollup.station_day(hours(spark, rows)).first()
    assert (got.o3_flag, got.pm2_5_flag) == (1, 0)


def test_day_without_early_hours_has_no_row(spark):
    assert rollup.station_day(hours(spark, [(1, stamp(20), 10.0, 1.0)])).count() == 0


def test_missing_parameter_does_not_hide_the_index(spark):
    rows = [(1, stamp(1), None, 70.0)]
    got = rollup.station_day(hours(spark, rows)).first()
    assert got.o3 is None and got.o3_iaqi is None and got.aqi == 500


@pytest.mark.parametrize(
    "present, members, digits, valid",
    [(1, 3, 1, 0), (2, 3, 1, 1), (1, 2, 1, 1), (2, 4, 1, 0), (3, 4, 1, 1), (3, 4, 2, 1),
     (18, 25, 1, 0), (1865, 2500, 2, 1), (186, 250, 2, 0)],
)
def test_coverage(spark, present, members, digits, valid):
    df = spark.createDataFrame([(present, members)], "p int, m int")
    got = df.select(rollup.covered(F.col("p"), F.col("m"), digits).alias("v")).first().v
    assert got == valid


def days(spark, rows):
    data = [(s, d, 10, 10, o3, 1.5, 10, 10, g) for s, d, o3, g in rows]
    schema = "station_id int, published_at date, pm2_5 int, pm10 int, o3 int, co double, no2 int, so2 int, grade int"
    return spark.createDataFrame(data, schema)


def test_month_thresholds(spark):
    feb = [(1, dt.date(2023, 2, d), 100, 1) for d in range(1, 26)]
    mar = [(1, dt.date(2023, 3, d), 100, 3) for d in range(1, 27)]
    apr = [(1, dt.date(2023, 4, d), 100, 2) for d in range(1, 28)]
    got = rollup.period_rollup(days(spark, feb + mar + apr), ["station_id"], "month")
    rows = {r.published_month: r for r in got.collect()}
    assert [rows[m].o3_flag for m in (2, 3, 4)] == [1, 0, 1]
    assert [rows[m].std_day_num for m in (2, 3, 4)] == [25, 0, 27]
    expected = 10 / 60 + 10 / 70 + 10 / 35 + 10 / 40 + 1.5 / 4 + 100 / 160
    assert rows[2].comprehensive_index == round(expected, 2)


def test_good_and_bad_days_make_one_row(spark):
    rows = [(1, dt.date(2023, 3, 1), 100, 1), (1, dt.date(2023, 3, 2), 100, 4)]
    got = rollup.period_rollup(days(spark, rows), ["station_id"], "month").collect()
    assert len(got) == 1 and got[0].std_day_num == 1


def test_report_week_runs_saturday_to_friday(spark):
    rows = [(1, dt.date(2024, 3, d), 100, 1) for d in (1, 2, 8, 9)]  # Fri, Sat, Fri, Sat
    got = rollup.period_rollup(days(spark, rows), ["station_id"], "week").orderBy("published_end")
    assert [(r.published_start.day, r.published_end.day, r.std_day_num) for r in got.collect()] == [
        (24, 1, 1), (2, 8, 2), (9, 15, 1),
    ]


def test_quarter_and_year(spark):
    rows = [(1, dt.date(2023, 3, 31), 100, 1), (1, dt.date(2023, 4, 1), 100, 1)]
    df = days(spark, rows)
    assert rollup.period_rollup(df, ["station_id"], "quarter").count() == 2
    year = rollup.period_rollup(df, ["station_id"], "year").first()
    assert year.published_year == 2023 and year.o3_flag == 0
    with pytest.raises(ValueError):
        rollup.period_rollup(df, ["station_id"], "decade")


def test_area_members_in_two_areas_and_duplicate_bridge(spark):
    station = days(spark, [(1, dt.date(2024, 3, 5), 100, 1), (2, dt.date(2024, 3, 5), 200, 1)])
    bridge = spark.createDataFrame([(7, 1), (7, 2), (7, 2), (8, 2)], "area_id int, station_id int")
    got = rollup.area_day_from(station, bridge, "station_id", ["station_id"], "monitoring", 1)
    rows = {r.area_id: r for r in got.collect()}
    assert (rows[7].o3, rows[8].o3) == (150, 200)
    assert rows[7].valid == 1


def test_mean_does_not_depend_on_row_order(spark):
    values = [0.1 * i for i in range(1000)] + [1e6, 0.3]
    up = spark.createDataFrame([(v,) for v in values], "v double")
    down = spark.createDataFrame([(v,) for v in reversed(values)], "v double").repartition(7)
    a, b = (d.agg(steady_mean("v").alias("m")).first().m for d in (up, down))
    assert a == b


@pytest.mark.parametrize("values", [[1e-7, 2e-7], [9e9] * 1000 + [0.5], [2.0**53, 1.0, 1.0], [None, 3.0], [None]])
def test_mean_keeps_small_and_large_readings(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    there = [v for v in values if v is not None]
    got = df.agg(steady_mean("v").alias("m")).first().m
    assert got == (pytest.approx(float(sum(map(Fraction, there)) / len(there)), rel=1e-15) if there else None)


def test_index_is_at_least_every_sub_index(spark, sf):
    from brisa.plans import adapters

    day = adapters.station_days(spark, sf)
    worst = F.greatest(*[F.col(f"{p}_iaqi") for p in PARAMETERS])
    assert day.filter(F.col("aqi") < worst).count() == 0
    assert day.filter((F.col("aqi") > 50) & (F.size("primary_pollutants") == 0)).count() == 0


def test_sparse_hours_are_dealt_before_they_are_combined(spark):
    stamp = F.timestamp_seconds(F.col("id") * 1800).cast("timestamp_ntz")
    readings = spark.range(0, 400, 1, 3).select(
        (F.col("id") % 4).cast("int").alias("station_id"), stamp.alias("published_at"),
        *[(F.col("id") % (n + 5)).cast("double").alias(p) for n, p in enumerate(PARAMETERS)],
    )
    readings = readings.union(readings.where("pm2_5 = 0"))
    got = rollup.hourly_means_sparse(readings, ["station_id"])
    plain = rollup.hourly_means(readings, ["station_id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    text = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.index("HashAggregate") < text.index("Exchange hashpartitioning") and text.count("Exchange") == 1
    assert "HashAggregate" not in text[text.index("Exchange hashpartitioning"):]


def test_days_have_a_given_number_of_tasks(spark):
    hours = spark.range(48).select(
        (F.col("id") % 2).alias("station_id"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("published_at"),
        *[F.lit(1.0).alias(p) for p in PARAMETERS],
    )
    text = rollup.day_profile(hours, ["station_id"])._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in text and text.count("Exchange hashpartitioning") == 1
