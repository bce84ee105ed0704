"""Exact means, stored products, merges by partition, newest rows as state, tiles, ranges and masks."""

import datetime as dt
import json
import math
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as contract
from brisa.functions import clean, geo
from brisa.operators import completeness, features, periods, rollup, score, score_states, spatial, tiles, weather
from brisa.operators.index import bins_sql, steady_mean
from brisa.params import PARAMETERS
from brisa.sources import sinks
from brisa.streaming import jobs
from tests.test_streams_sources import dims, land, message, text_stream

# --- means --------------------------------------------------------------------


@pytest.mark.parametrize("values, mean", [
    ([math.nan, 1.0], 1.0),
    ([math.inf, 3.0, -math.inf, 5.0], 4.0),
    ([math.nan], None),
    ([1e21], 1e21),
    ([3e19, 8e19], 5.5e19),
    ([1e-7], 1e-7),
    ([1e-7, 3e-7], 2e-7),
    ([0.1, 0.2, None], 0.15),
    ([1e308, -1e308, 2.0], 2 / 3),
])
def test_mean_of_odd_values(spark, values, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    got = df.agg(steady_mean("v").alias("m")).first().m
    assert got is None if mean is None else got == pytest.approx(mean, rel=1e-15)


def test_parts_add_up_to_the_value(spark):
    draw = random.Random(3)
    values = [draw.uniform(-1, 1) * 10 ** draw.randint(-7, 9) for _ in range(2000)]
    parts = [F.expr(text).alias(n) for n, text in bins_sql("v").items()]
    for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", *parts).collect():
        assert Fraction(r.h) + Fraction(r.m) + Fraction(r.l) == Fraction(r.v)


def test_mean_is_the_same_in_any_order(spark):
    draw = random.Random(4)
    values = [round(draw.uniform(0, 500), draw.randint(0, 3)) for _ in range(5000)]
    exact = sum(map(Fraction, values)) / len(values)
    means = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(1 + 3 * seed)
        means.add(df.agg(steady_mean("v").alias("m")).first().m)
    assert len(means) == 1 and abs(Fraction(means.pop()) / exact - 1) < Fraction(1, 2**51)


@pytest.mark.parametrize("text, number", [("NaN", None), ("Infinity", None), ("-Infinity", None), ("1e400", None), ("1e30", 1e30), ("12", 12.0), ("x", None)])
def test_text_that_is_no_finite_number_is_null(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean.to_number(F.col("t")).alias("n")).first().n == number


@pytest.mark.parametrize("name", ["A1_hour_index", "B2_station_day", "B3_grid_day", "B4_area_hour", "B5_area_day", "B6_area_year", "B7_district_day"])
def test_no_wide_decimal_in_plans(spark, sf, name):
    plan = contract.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38" not in plan


# --- states of periods --------------------------------------------------------


@pytest.fixture(scope="module")
def days(spark):
    draw = random.Random(9)
    rows = []
    for station in range(3):
        for n in range(800):
            day = dt.date(2021, 11, 20) + dt.timedelta(days=n)
            if draw.random() < 0.9:
                value = lambda top: None if draw.random() < 0.1 else draw.randint(0, top)
                co = value(60)
                rows.append((station, day, value(400), value(500), value(300), None if co is None else co / 10, value(200), value(300), draw.choice([None, 1, 2, 3, 6])))
    schema = "station_id int, published_at date, pm2_5 int, pm10 int, o3 int, co double, no2 int, so2 int, grade int"
    return spark.createDataFrame(rows, schema)


def table(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


@pytest.mark.parametrize("period", ["month", "quarter", "year"])
def test_products_of_states_equal_those_of_days(days, period):
    keys = ["station_id"]
    states = periods.period_state(days, keys, "month")
    if period != "month":
        states = periods.merge_states(states, keys, period)
    assert table(periods.period_product(states, keys, period)) == table(rollup.period_rollup(days, keys, period))


def test_week_and_other_threshold_from_states(days):
    keys = ["station_id"]
    for period, needed in (("week", None), ("year", 300)):
        states = periods.period_state(days, keys, period)
        assert table(periods.period_product(states, keys, period, needed)) == table(rollup.period_rollup(days, keys, period, needed))


def test_months_do_not_make_weeks(days):
    with pytest.raises(ValueError):
        periods.merge_states(periods.period_state(days, ["station_id"]), ["station_id"], "week")


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_refresh_writes_only_the_months_asked_for(spark, days, tmp_path):
    path, ids = str(tmp_path / "states"), ["published_year", "published_month"]
    dated = days.withColumns(rollup.period_columns("month"))
    sinks.refresh_months(dated, path, dated.select(*ids), ["station_id"])
    before = files_of(path)
    changed = dated.withColumn("so2", F.col("so2") + 1)
    sinks.refresh_months(changed, path, spark.createDataFrame([(2022, 3)], "published_year int, published_month int"), ["station_id"])
    gone = before - files_of(path)
    assert gone and all("published_year=2022/published_month=3/" in f for f in gone)
    march = F.col("published_at").between(dt.date(2022, 3, 1), dt.date(2022, 3, 31))
    expected = days.withColumn("so2", F.when(march, F.col("so2") + 1).otherwise(F.col("so2")))
    states = periods.merge_states(spark.read.parquet(path), ["station_id"], "year")
    got = periods.period_product(states, ["station_id"], "year")
    assert table(got) == table(rollup.period_rollup(expected, ["station_id"], "year"))


def physical(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_clustered_days_are_grouped_where_they_lie(spark, days, tmp_path):
    stored = sinks.save_clustered(days, "days_here", str(tmp_path / "d"), ["station_id"], 4)
    product = periods.period_product(periods.period_state(stored, ["station_id"], "year"), ["station_id"], "year")
    plan = physical(product)
    assert "Exchange" not in plan and "Aggregate" in plan
    assert table(product) == table(rollup.period_rollup(days, ["station_id"], "year"))
    bridge = spark.createDataFrame([(k % 2, k) for k in range(3)], "area_id int, station_id int")
    beside = sinks.save_clustered(bridge, "bridge_here", str(tmp_path / "b"), ["station_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.join(beside, "station_id").groupBy("area_id", "published_at").agg(F.avg("so2"))
        below = physical(joined).split("Exchange")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in below and below.count("FileScan") == 2


# --- merge by partition -------------------------------------------------------

KEYED = "k int, day date, at timestamp_ntz, v int, w string"


def keyed(spark, rows):
    stamp = lambda d, h: dt.datetime(2024, 3, d, h)
    return spark.createDataFrame([(k, d and dt.date(2024, 3, d), d and stamp(d, h), v, w) for k, d, h, v, w in rows], KEYED)


def test_merge_touches_only_its_partitions(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["k", "day"]
    first = keyed(spark, [(k, d, 5, d, "a") for k in range(20) for d in (1, 2, 3)])
    assert len(sinks.merge_partitions(first, path, keys, "at", ["day"])) == 3
    before = files_of(path)
    updates = keyed(spark, [(1, 2, 6, 100, "b"), (2, 2, 4, 200, "b"), (99, 2, 1, 300, "b"), (3, 2, 5, 400, "b")])
    for _ in range(2):  # a replay leaves the same table
        assert sinks.merge_partitions(updates, path, keys, "at", ["day"]) == [(dt.date(2024, 3, 2),)]
    after = files_of(path)
    assert {f for f in before if "day=2024-03-02" not in f} == {f for f in after if "day=2024-03-02" not in f}
    got = {(r.k, r.day.day): r.v for r in spark.read.schema(KEYED).parquet(path).collect()}
    expected = {(k, d): d for k in range(20) for d in (1, 2, 3)} | {(1, 2): 100, (99, 2): 300, (3, 2): 400}
    assert got == expected


def test_merge_of_some_columns_nothing_and_no_day(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["k", "day"]
    sinks.merge_partitions(keyed(spark, [(1, 1, 5, 1, "a"), (2, None, 5, 2, "a")]), path, keys, "at", ["day"])
    assert sinks.merge_partitions(keyed(spark, []), path, keys, "at", ["day"]) == []
    updates = keyed(spark, [(1, 1, 6, 9, "b"), (2, None, 5, 7, "b")])
    sinks.merge_partitions(updates, path, keys, "at", ["day"], update_cols=["v"])
    got = {(r.k, r.day and r.day.day, r.v, r.w) for r in spark.read.schema(KEYED).parquet(path).collect()}
    # keys are joined by equality, so a row without a day is a row of its own
    assert (1, 1, 9, "a") in got and {g for g in got if g[0] == 2} >= {(2, None, 2, "a")}
    with pytest.raises(ValueError):
        sinks.merge_partitions(updates, path, ["k"], "at", ["day"])


def test_merge_by_two_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, y int, m int, at timestamp_ntz, v int"
    at = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(k, y, m, at, 0) for k in (1, 2) for y in (2023, 2024) for m in (1, 2)], schema)
    keys = ["k", "y", "m"]
    sinks.merge_partitions(rows, path, keys, "at", ["y", "m"])
    before = files_of(path)
    sinks.merge_partitions(rows.where("k = 1 AND ((y = 2023 AND m = 1) OR (y = 2024 AND m = 2))").withColumn("v", F.lit(5)), path, keys, "at", ["y", "m"])
    kept = {f for f in before if "y=2023/m=2" in f or "y=2024/m=1" in f}
    assert kept <= files_of(path)
    got = {(r.k, r.y, r.m): r.v for r in spark.read.schema(schema).parquet(path).collect()}
    assert len(got) == 8 and {k for k, v in got.items() if v == 5} == {(1, 2023, 1), (1, 2024, 2)}


# --- newest rows as state -------------------------------------------------------


def at(day, minute):
    return f"2024-03-{day:02d} 01:{minute:02d}:00"


def dated(code, day, minute, value, lon=0.5):
    return json.dumps(json.loads(message(code, minute, value, lon=lon)) | {"time": at(day, minute)})


def land_at(folder, number, lines):
    """Files are read in the order of their times."""
    land(folder, f"{number}.txt", lines)
    os.utime(folder / f"{number}.txt", (1_700_000_000 + number, 1_700_000_000 + number))


def newest(spark, tmp_path, late="1 day"):
    stations, cells = dims(spark)
    started = jobs.ingest_newest(
        text_stream(spark, tmp_path / "in"), lambda: stations, lambda: cells, 1.0,
        str(tmp_path / "out"), str(tmp_path / "checkpoint"), late,
    )
    started.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    keys = [(r.station_code, r.published_at) for r in rows]
    assert len(keys) == len(set(keys))  # the table itself holds a key once
    state = [p.stateOperators[0].numRowsTotal for p in started.recentProgress if p.stateOperators]
    return {(r.station_code, r.published_at.day, r.published_at.minute): (r.station_id, r.grid_id, json.loads(r.data)["pm2_5"]) for r in rows}, state


def test_newest_rows_over_batches_restarts_and_late_messages(spark, tmp_path):
    land_at(tmp_path / "in", 1, [dated("M1", 1, 1, 10), dated("M2", 1, 1, 20, lon=5.0), "{broken", dated("M1", 1, 1, 9)])
    land_at(tmp_path / "in", 2, [dated("M1", 1, 1, 5), dated("M1", 1, 2, 12)])  # comes later: updates its row
    got, _ = newest(spark, tmp_path)
    assert got == {("M1", 1, 1): (1, 7, 5), ("M2", 1, 1): (None, None, 20), ("M1", 1, 2): (1, 7, 12)}
    land_at(tmp_path / "in", 3, [dated("M1", 9, 1, 13)])
    land_at(tmp_path / "in", 4, [dated("M2", 9, 3, 14)])
    land_at(tmp_path / "in", 5, [dated("M1", 1, 2, 99)])  # eight days late: dropped
    got, state = newest(spark, tmp_path)
    assert got[("M1", 1, 2)] == (1, 7, 12) and got[("M1", 9, 1)] == (1, 7, 13) and got[("M2", 9, 3)][2] == 14
    assert state[-1] == 2  # keys of the last day only


def test_state_is_bounded_by_keys_within_the_watermark(spark, tmp_path):
    for day in range(1, 8):
        land_at(tmp_path / "in", day, [dated(f"M{k}", day, 1, day) for k in range(10)])
    got, state = newest(spark, tmp_path, late="1 day")
    assert len(got) == 70 and max(state) <= 30


def test_newest_needs_its_time_in_the_key(spark, tmp_path):
    land(tmp_path / "in", "1.txt", [message("M1", 1, 1)])
    rows = jobs.parse_messages(text_stream(spark, tmp_path / "in"))
    with pytest.raises(ValueError):
        jobs.newest_per_key(rows, ["station_code"], "published_at", "1 hour")


# --- circles from tiles ---------------------------------------------------------


@pytest.mark.parametrize("lat, radius", [(30.5, 5000.0), (0.0, 800.0), (-62.0, 20000.0)])
def test_totals_by_tiles_equal_all_distances(spark, lat, radius):
    draw = random.Random(int(radius))
    reach = radius / geo.METRES_PER_DEGREE
    wide = reach / math.cos(math.radians(lat))
    spot = lambda: (round(104 + draw.uniform(-3, 3) * wide, 5), round(lat + draw.uniform(-3, 3) * reach, 5))
    crowd = spot()
    points = [(*(crowd if n % 3 == 0 else spot()), n % 7, draw.randint(0, 9)) for n in range(6000)]
    centres = [(n, *spot()) for n in range(12)] + [(99, *crowd), (100, 10.0, 80.0)]
    p = spark.createDataFrame(points, "lon double, lat double, truck int, v int")
    c = spark.createDataFrame(centres, "place int, lon double, lat double")
    near = geo.distance_m("lon", "lat", "_x", "_y") < radius
    pairs = p.crossJoin(c.select("place", F.col("lon").alias("_x"), F.col("lat").alias("_y"))).where(near)
    expected = {r.place: (r.n, r.v) for r in pairs.groupBy("place").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()}
    got = tiles.near_totals(p, c, radius, ["place"], {"n": "1", "v": "v"})
    assert {r.place: (r.n, r.v) for r in got.collect()} == expected
    trucks = {(r.place, r.truck): r.n for r in pairs.groupBy("place", "truck").agg(F.count("*").alias("n")).collect()}
    got = tiles.near_totals(p, c, radius, ["place"], {"n": "1"}, ["truck"])
    assert {(r.place, r.truck): r.n for r in got.collect()} == trucks


def test_tiles_of_a_circle_do_not_overlap_and_few_are_rim(spark):
    c = spark.createDataFrame([(1, 104.03, 30.61)], "place int, lon double, lat double")
    found = tiles.cover_circles(c, 5000.0, ["place"]).collect()
    small = set()
    for r in found:
        own = {(r._row * 2**r._level + i, r._column * 2**r._level + j) for i in range(2**r._level) for j in range(2**r._level)}
        assert not own & small
        small |= own
    inside = sum(4**r._level for r in found if r._inside)
    rim = sum(not r._inside for r in found)
    assert all(r._level == 0 for r in found if not r._inside)
    assert rim < inside / 3 and len(found) < len(small) / 2


# --- tracks in ranges ---------------------------------------------------------


def test_carried_lag_of_one_name_is_spread_and_unchanged(spark):
    rows = [(n % 5 == 0 and "rare" or None, n, (n * 7919) % 11) for n in range(4000)]
    df = spark.createDataFrame(rows, "name string, at int, cell int").repartition(7)
    got = spatial.carried_lag(df, ["name"], ["at"], "cell", ranges=16)
    plain = df.withColumn("_before", F.lag(F.struct("cell")).over(Window.partitionBy("name").orderBy("at")))
    # the struct's field is named by the column
    assert table(got) == table(plain)
    sizes = [r["count"] for r in df.repartitionByRange(16, "name", "at").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sorted(sizes)[8]


def test_trajectories_in_ranges_equal_those_in_hours(spark):
    draw = random.Random(6)
    start = dt.datetime(2024, 3, 1)
    rows = []
    for n in range(3000):
        lon = None if n % 97 == 0 else 103.8 + draw.randint(0, 3) * 0.01
        rows.append((f"P{n % 4}", draw.choice([None, "v", "w"]), start + dt.timedelta(seconds=37 * n), lon, 30.5, 1))
    df = spark.createDataFrame(rows, "plate_num string, name string, published_at timestamp_ntz, lon double, lat double, speed int")
    assert table(spatial.thin_trajectory_in_ranges(df, ranges=9)) == table(spatial.thin_trajectory(df))


# --- hours as bits ------------------------------------------------------------


@pytest.mark.parametrize("first, last", [((1, 0), (3, 23)), ((1, 5), (1, 9)), ((2, 22), (4, 1))])
def test_masks_equal_expanded_hours(spark, first, last):
    draw = random.Random(8)
    rows = [(c, dt.datetime(2024, 3, d, h, draw.randint(0, 59))) for c in range(6) for d in range(1, 5) for h in range(24) if draw.random() < (0.0 if c == 4 else 0.8)]
    actual = spark.createDataFrame(rows + [(77, dt.datetime(2024, 3, 2, 3))], "grid_id int, published_at timestamp_ntz")
    cells = spark.createDataFrame([(c,) for c in range(6)] + [(9,)], "grid_id int")
    ends = [F.lit(dt.datetime(2024, 3, d, h)).cast("timestamp_ntz") for d, h in (first, last)]
    masks = completeness.hour_masks(actual)
    assert table(completeness.missing_by_mask(masks, cells, *ends)) == table(completeness.missing_hours(actual, cells, *ends))
    assert table(completeness.completeness_by_mask(masks, cells, *ends)) == table(completeness.completeness(actual, cells, *ends))


# --- scores from states -------------------------------------------------------


def test_merged_scores_equal_direct_ones(spark):
    draw = random.Random(5)
    rows = []
    for n in range(3000):
        values = [None if draw.random() < 0.1 else 1e6 + draw.random() for _ in PARAMETERS for _ in "fr"]
        if n % 3 == 2:  # a key whose values never change
            values = [7.0] * 12
        names = lambda: draw.sample(["o3", "co", "no2"], draw.randint(0, 2))
        aqi = [draw.choice([None, 0, 40, 55, 120, 300]) for _ in "fr"]
        rows.append((n % 3, n % 40, *values, *aqi, draw.randint(1, 6), draw.choice([None, 1, 2, 3]), names(), names()))
    fields = ", ".join(f"{p}{s} double" for p in PARAMETERS for s in "fr")
    df = spark.createDataFrame(rows, f"k int, day int, {fields}, aqif int, aqir int, gradef int, grader int, prf array<string>, prr array<string>")
    states = score_states.score_state(df, ["k", "day"])
    got = score_states.scores(score_states.merge_scores(states, ["k"]), ["k"])
    direct = {r.k: r for r in score.score_forecast(df, ["k"]).collect()}
    for r in got.collect():
        for m in score.METRICS:
            a, b = r[m], direct[r.k][m]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)), (r.k, m, a, b)
    halves = score_states.merge_scores(states.withColumn("half", F.col("day") % 2), ["k", "half"])
    again = score_states.scores(score_states.merge_scores(halves, ["k"]), ["k"])
    for r in again.collect():
        assert r.pm2_5_rmse == pytest.approx(direct[r.k].pm2_5_rmse, rel=1e-12)


# --- crowded tiles --------------------------------------------------------------


def test_boxes_of_a_crowded_tile(spark):
    """A third of the points in one tile: the same boxes, and tasks of like sizes."""
    draw = random.Random(2)
    place = lambda n: (draw.random(), draw.random()) if n % 3 == 0 else (draw.uniform(-8, 8), draw.uniform(-8, 8))
    points = spark.createDataFrame([(n, *place(n)) for n in range(12_000)] + [(-1, None, 0.5)], "id int, lon double, lat double").repartition(8)
    cells = [(100 * i + j, 0.3 * i - 8, 0.7 * j - 8, 0.3 * i - 7.7, 0.7 * j - 7.3) for i in range(50) for j in range(22)]
    cells += [(-9, -3.0, -3.0, 3.0, 3.0)]  # a box over many tiles
    cells = spark.createDataFrame(cells, "grid_id int, min_lat double, min_lon double, max_lat double, max_lon double")
    for how, edges in (("left", "open_closed"), ("inner", "closed")):
        got = spatial.join_boxes_crowded(points, cells, 1.0, 150, edges, how)
        assert table(got) == table(spatial.join_boxes(points, cells, 1.0, edges, how))
    crowded = spatial.crowded_tiles(points, 1.0, 150)
    assert [(r._row, r._column) for r in crowded.collect()] == [(0, 0)]
    leaves = spatial.leaf_of(points.dropna(), crowded, 1.0)
    assert leaves.groupBy(*spatial.LEAF).count().agg(F.max("count")).first()[0] <= 150
    tasks = leaves.repartition(12, *spatial.LEAF).groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in tasks)
    assert len(sizes) == 12 and sizes[-1] < 3 * sizes[6]


# --- wind by rings ------------------------------------------------------------


def test_wind_by_rings_keeps_its_bound_and_refuses(spark):
    draw = random.Random(12)
    wind = [(f"w{n}", 104 + draw.uniform(-2, 2), 30 + draw.uniform(-2, 2), draw.uniform(0, 9)) for n in range(400)]
    wind = spark.createDataFrame(wind, "station_name string, lon double, lat double, wind_speed double")
    first = wind.first()
    stations = spark.createDataFrame(
        [(1, 104.0, 30.0), (2, 105.9, 31.9), (3, 130.0, 10.0), (4, first.lon, first.lat), (5, 104.0, 30.0), (6, None, 30.0)],
        "station_id int, lon double, lat double",
    )
    exact = {r.station_id: r.wind_speed for r in features.interpolated_wind(stations, wind, [f"w{n}" for n in range(400)]).collect()}
    got = {r.station_id: r for r in features.wind_by_rings(stations, wind, 0.5, 20_000.0, 5).collect()}
    for k in (1, 2, 5):
        assert got[k].wind_error <= 0.5 and abs(got[k].wind_speed - exact[k]) <= got[k].wind_error + 0.01
    assert got[4].wind_speed == round(first.wind_speed, 2) and got[4].wind_error == 0
    assert got[3].wind_speed is None and got[3].wind_error > 0.5
    assert got[6].wind_speed is None and len(got) == 6
    none = features.wind_by_rings(stations, wind.where("false")).collect()
    assert {r.wind_speed for r in none} == {0.0, None}


def test_a_wind_station_has_one_position(spark):
    rows = [("a", 1.0, 1.0, 2.0), ("a", 1.0, 1.0, 4.0), ("b", 2.0, 2.0, None)]
    wind = spark.createDataFrame(rows, "station_name string, lon double, lat double, wind_speed double")
    assert [tuple(r) for r in features.one_position(wind).collect()] == [("a", 1.0, 1.0, 3.0)]
    moved = wind.union(spark.createDataFrame([("a", 1.5, 1.0, 2.0)], wind.schema))
    with pytest.raises(Exception, match="two positions: a"):
        features.one_position(moved).collect()


# --- documents of several vendors -----------------------------------------------


def test_mixed_documents(spark):
    layouts = {"a": {"t": "temp", "d": "wind_dir"}, "b": {"temperature": "temp", "t": "humidity"}}
    rows = [
        (1, "a", '[{"t": 5, "d": "N", "more": {"x": [1]}}, {"t": "6.5"}, {"t": 999.9, "d": null}]'),
        (2, "b", '{"temperature": "7", "t": 40}'),
        (3, "b", '[{"temperature": {"odd": 1}, "t": "NaN"}]'),
        (4, "a", "[]"), (5, "a", '{"t": '), (6, "a", None), (7, "c", '{"t": 1}'), (8, "a", "12"),
    ]
    docs = spark.createDataFrame(rows, "id int, vendor string, body string")
    good, broken = weather.parsed_documents(docs, "body")
    assert sorted(r.id for r in broken.collect()) == [5, 6] and broken.columns == docs.columns
    got = {(r.id, r._item): (r.temp, r.wind_dir, r.humidity) for r in weather.flatten_mixed(good, "vendor", ["id"], layouts).collect()}
    assert got == {
        (1, 0): (5.0, "N", None), (1, 1): (6.5, None, None), (1, 2): (None, None, None),
        (2, 0): (7.0, None, 40.0), (3, 0): (None, None, None), (7, 0): (None, None, None), (8, 0): (None, None, None),
    }


def test_buckets_grow_with_the_tasks_of_a_shuffle(spark):
    from brisa.plans import products

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        stored = products.clustered(spark, spark.range(50).withColumnRenamed("id", "station_id"), ["station_id"])
        assert len({f.rsplit("_", 1)[1].split(".")[0] for f in stored.inputFiles()}) > 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
