"""Keyed tables, densification and scores."""

import datetime as dt

import pytest
import math

from pyspark.sql import functions as F

from brisa.operators import completeness, conform, hourly, latest, score, weather
from brisa.params import PARAMETERS

SIX = ", ".join(f"{p} double" for p in PARAMETERS)


def t(hour, minute=0):
    return dt.datetime(2024, 3, 5, hour, minute)


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, at timestamp_ntz, a int, b int")


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_merge_takes_the_newer_row_whatever_the_order(spark):
    target = table(spark, [(1, t(5), 1, 1), (2, t(5), 2, 2)])
    updates = table(spark, [(1, t(4), 9, 9), (2, t(5), 8, 8), (3, t(1), 7, 7)])
    merged = latest.merge_latest(target, updates, ["k"], "at")
    assert as_set(merged) == {(1, t(5), 1, 1), (2, t(5), 8, 8), (3, t(1), 7, 7)}
    again = latest.merge_latest(merged, updates, ["k"], "at")
    assert as_set(again) == as_set(merged)


def test_merge_of_some_columns(spark):
    target = table(spark, [(1, t(5), 1, 1), (2, t(5), 2, 2), (4, t(5), 4, 4)])
    updates = table(spark, [(1, t(4), 9, 9), (2, t(6), 8, 8), (2, t(5), 0, 0), (3, t(1), 7, 7)])
    merged = latest.merge_latest(target, updates, ["k"], "at", update_cols=["a"])
    assert as_set(merged) == {(1, t(5), 1, 1), (2, t(6), 8, 2), (3, t(1), 7, 7), (4, t(5), 4, 4)}


@pytest.mark.parametrize("some", [None, ["a"]])
def test_merge_does_not_depend_on_the_order_of_rows(spark, some):
    target = [(1, t(5), 1, 1), (2, None, 2, 2), (3, None, None, 3)]
    updates = [(1, t(5), 7, 2), (1, t(5), 7, 3), (1, t(5), 6, 9), (2, t(1), 8, 8), (4, None, 1, 1), (4, None, 1, 2), (3, None, 5, 5)]
    merge = lambda u: as_set(latest.merge_latest(table(spark, target), table(spark, u).repartition(3), ["k"], "at", some))
    got = {frozenset(merge(u)) for u in (updates, updates[::-1], updates[3:] + updates[:3])}
    assert len(got) == 1
    rows = {r[0]: r for r in got.pop()}
    assert rows[1] == ((1, t(5), 7, 3) if some is None else (1, t(5), 7, 1))
    assert rows[2] == ((2, t(1), 8, 8) if some is None else (2, t(1), 8, 2))  # no time is the oldest time
    assert rows[4] == (4, None, 1, 2) and rows[3][2] == 5


def test_latest_per_key_with_ties(spark):
    df = table(spark, [(1, t(5), 1, 1), (1, t(5), 2, 0), (1, t(4), 9, 9)])
    assert as_set(latest.latest_per_key(df, ["k"], "at", ["a"])) == {(1, t(5), 2, 0)}


def test_latest_is_cut_down_before_the_shuffle(spark):
    df = table(spark, [(1, t(5), 1, 1)])
    plan = latest.latest_per_key(df, ["k"], "at")._jdf.queryExecution().toString()
    before = plan.index("Exchange") if "Exchange" in plan else -1
    assert "WindowGroupLimit" in plan[before:]


def hours(spark, rows):
    return spark.createDataFrame([(1, h, *v) for h, v in rows], f"grid_id int, published_at timestamp_ntz, {SIX}")


def test_densify_means_one_sided_and_gaps(spark):
    rows = [
        (t(1), (10, 10, 10, 1, 10, 10)),
        (t(2), (20, None, 20, 2, 20, 20)),  # dropped itself, still feeds the halves
        (t(3), (30, 30, 30, 3, 30, 30)),
        (t(5), (50, 50, 50, 5, 50, 50)),  # no neighbour
    ]
    typed = [(h, tuple(None if x is None else float(x) for x in v)) for h, v in rows]
    got = {r.published_at: r for r in score.half_hour_densify(hours(spark, typed), ["grid_id"]).collect()}
    assert sorted(got) == [t(1), t(1, 30), t(2, 30), t(3), t(5)]
    assert (got[t(1, 30)].pm2_5, got[t(1, 30)].pm10) == (15.0, 10.0)
    assert (got[t(2, 30)].pm2_5, got[t(2, 30)].pm10) == (25.0, 30.0)


def test_densify_over_midnight(spark):
    v = (10.0,) * 6
    w = (20.0,) * 6
    rows = [(dt.datetime(2024, 3, 5, 23), v), (dt.datetime(2024, 3, 6, 0), w), (dt.datetime(2024, 3, 6, 1), v)]
    got = {r.published_at: r.o3 for r in score.half_hour_densify(hours(spark, rows), ["grid_id"]).collect()}
    assert got[dt.datetime(2024, 3, 5, 23, 30)] == 15.0 and got[dt.datetime(2024, 3, 6, 0, 30)] == 15.0
    assert len(got) == 5


def pairs(spark, rows):
    fields = [f"{p}{s} double" for s in "fr" for p in PARAMETERS]
    extra = "aqif bigint, gradef int, prf array<string>, aqir bigint, grader int, prr array<string>"
    return spark.createDataFrame(rows, f"k int, {', '.join(fields)}, {extra}")


def pair(k, f, r, aqif=60, aqir=60, gradef=2, grader=2, prf=("o3",), prr=("o3",)):
    return (k, *[f] * 6, *[r] * 6, aqif, gradef, list(prf), aqir, grader, list(prr))


def test_scores_by_hand(spark):
    rows = [
        pair(1, 10.0, 12.0, aqif=60, aqir=76),
        pair(1, 20.0, 18.0, aqif=60, aqir=75, prf=("co",)),
        pair(1, 30.0, 30.0, aqif=40, aqir=40, gradef=1, grader=1, prf=(), prr=()),
    ]
    got = score.score_forecast(pairs(spark, rows), ["k"]).first()
    assert got.pm2_5_nmb == 0.0
    assert math.isclose(got.o3_rmse, math.sqrt(8 / 3))
    assert math.isclose(got.co_r, 0.9819805060619657, rel_tol=1e-9)
    assert math.isclose(got.aqi_interval_hit_rate, 200 / 3)
    assert math.isclose(got.aqi_percentage_hit_rate, 100.0)
    assert math.isclose(got.accuracy, 50.0)


def test_scores_without_spread_or_sum_are_null(spark):
    got = score.score_forecast(pairs(spark, [pair(1, 5.0, 0.0), pair(1, 5.0, 0.0)]), ["k"]).first()
    assert got.pm2_5_nmb is None and got.pm2_5_r is None and got.pm2_5_rmse == 5.0
    clean = score.score_forecast(pairs(spark, [pair(1, 1.0, 1.0, gradef=1, grader=1)]), ["k"]).first()
    assert clean.accuracy is None


def test_history_weighs_periods_alike(spark):
    one = score.score_forecast(pairs(spark, [pair(1, 2.0, 1.0)] * 9), ["k"])
    two = score.score_forecast(pairs(spark, [pair(1, 1.0, 1.0)]), ["k"])
    assert score.score_history([one, two], ["k"]).first().pm2_5_nmb == 0.5


def test_inference_pairs_need_samples_and_listed_cells(spark):
    v = (10.0,) * 6
    rows = [(g, t(5, i % 60), *v) for g, n in ((1, 60), (2, 59), (3, 60)) for i in range(n)]
    mobile = spark.createDataFrame(rows, f"grid_id int, published_at timestamp_ntz, {SIX}")
    inferred = spark.createDataFrame(
        [(t(5), g, 17, *v, 1, 20, []) for g in (1, 2, 3)],
        f"published_at timestamp_ntz, grid_id int, control_area_id int, {SIX}, grade int, aqi int, primary_pollutants array<string>",
    )
    cells = spark.createDataFrame([(1,), (2,)], "grid_id int")
    got = score.inference_pairs(mobile, inferred, cells).collect()
    assert [r.grid_id for r in got] == [1] and got[0].pm2_5r == 10.0 and (got[0].aqir, got[0].grader, got[0].prr) == (100, 2, ["co"])  # 10 mg/m3 of co


def test_clean_hourly_prefers_feeds_and_blanks_sentinels(spark):
    wide = spark.createDataFrame(
        [("A1", "2024-03-05 01:20:00", "-", "12", "7(H)", "0.4", "9", "x"),
         ("A1", "2024-03-05 02:00:00", "-", "-", "-", "-", "-", "-"),
         ("B1", "2024-03-05 01:00:00", "5", "5", "5", "5", "5", "5")],
        "station_code string, published_at string, pm2_5 string, pm10 string, o3 string, co string, no2 string, so2 string",
    )
    other = spark.createDataFrame(
        [("A1", t(1), 0.5, 0.5, 0.5, 0.5, 0.5, 0.5)],
        f"station_code string, published_at timestamp_ntz, {SIX}",
    )
    feeds = [
        (wide, hourly.Feed(sentinels=("-",), marks=("(H)",))),
        (other, hourly.Feed(scale=1000.0, priority=1)),
    ]
    stations = spark.createDataFrame([("A1", 1, 11, None)], "station_code string, station_id int, grid_id int, grid_id_two int")
    got = hourly.clean_hourly(feeds, stations).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.published_at, r.pm2_5, r.pm10, r.o3, r.co, r.no2, r.so2) == (t(1), None, 12, None, 0.4, 9, None)
    assert r.aqi == 12 and r.grade == 1 and r.station_id == 1


def test_conform_is_lenient_and_completes(spark):
    df = spark.createDataFrame([("1", "x", "1.5")], "`id no` string, b string, c string")
    out = conform.conform(df, {"id": ("id no", "int"), "b": ("b", "int"), "c": ("c", "double"), "d": (None, "date")})
    assert tuple(out.first()) == (1, None, 1.5, None)
    assert out.dtypes[-1] == ("d", "date")


def test_json_rename_leaves_values_alone(spark):
    docs = spark.createDataFrame([('[{"precip":"precip","text":"暂无"},{"precip":"999.9"}]',)], "body string")
    out = weather.flatten_weather(docs, "body", {"precip": "rainfall", "text": "weather"}, [], [])
    assert [tuple(r) for r in out.collect()] == [("precip", None), ("999.9", None)]
    numbers = weather.flatten_weather(docs, "body", {"precip": "rainfall"}, ["rainfall"], [])
    assert [r.rainfall for r in numbers.collect()] == [None, None]


def test_code_map_takes_last_average(spark):
    body = '[{"LHCodeID":"a","ValueTypeID":"Avg","DataValue":1},{"LHCodeID":"a","ValueTypeID":"Avg","DataValue":2},{"LHCodeID":"b","ValueTypeID":"Max","DataValue":3}]'
    docs = spark.createDataFrame([(1, body), (2, "[]"), (3, None)], "id int, body string")
    got = weather.map_coded_readings(docs, "body", ["id"]).collect()
    assert [(r.id, r.data) for r in got] == [(1, {"a": 2.0})]


def test_completeness_counts_missing_cells(spark):
    cells = spark.createDataFrame([(1,), (2,)], "grid_id int")
    actual = spark.createDataFrame([(1, t(1)), (1, t(1, 30)), (2, t(2)), (1, t(2))], "grid_id int, published_at timestamp_ntz")
    first, last = (F.lit(str(t(h))).cast("timestamp_ntz") for h in (1, 3))
    got = {r.published_at.hour: (r.expected, r.present, r.missing, r.complete) for r in completeness.completeness(actual, cells, first, last).collect()}
    assert got == {1: (2, 1, 1, 0), 2: (2, 2, 0, 1), 3: (2, 0, 2, 0)}
    gaps = completeness.missing_hours(actual, cells, first, last)
    assert sorted((r.grid_id, r.published_at.hour) for r in gaps.collect()) == [(1, 3), (2, 1), (2, 3)]


def test_feed_times_as_text_stamp_or_epoch(spark):
    rows = [("A", 1709600400 + 1800, "1")]  # 01:30
    feed = spark.createDataFrame(rows, "station_code string, published_at bigint, o3 string")
    got = hourly.canonical(feed, hourly.Feed()).first()
    assert (got.published_at, got.o3, got.pm10) == (t(1), 1.0, None)


def test_floors_keep_stamps_without_zone(spark):
    from brisa.functions import times

    # 02:30 does not exist in some zones on this day
    moment = dt.datetime(2024, 3, 10, 2, 30, 15, 250000)
    df = spark.createDataFrame([(moment,)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(
            times.floor_hour(F.col("ts")), times.floor_minute(F.col("ts")), times.floor_second(F.col("ts"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (
        dt.datetime(2024, 3, 10, 2), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 30, 15),
    )
