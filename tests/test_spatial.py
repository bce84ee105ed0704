"""Tile joins and trajectories against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from brisa.functions import geo
from brisa.operators import features, spatial, tracks
from brisa.params import EARTH_RADIUS_M


def metres(lon1, lat1, lon2, lat2):
    a, b = math.radians(lat1 - lat2), math.radians(lon1 - lon2)
    h = math.sin(a / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(b / 2) ** 2
    return math.floor(math.floor(2 * EARTH_RADIUS_M * math.asin(math.sqrt(h)) * 10000 + 0.5) / 10000)


@pytest.mark.parametrize("lat0", [-60.0, -0.01, 0.0, 30.5, 70.0])
def test_radius_join_finds_every_pair(spark, lat0):
    rng = random.Random(7)
    spread = 0.15
    lon_spread = spread / math.cos(math.radians(lat0))

    def place():
        return 104 + rng.uniform(-1, 1) * lon_spread, lat0 + rng.uniform(-1, 1) * spread

    points = [(i, *place()) for i in range(300)]
    centres = [(i, *place()) for i in range(40)]
    got = spatial.join_radius(
        spark.createDataFrame(points, "p int, lon double, lat double"),
        spark.createDataFrame(centres, "c int, lon double, lat double"),
        5000, ["c"],
    )
    pairs = sorted((r.p, r.c) for r in got.collect())
    expected = sorted(
        (p, c) for p, x, y in points for c, u, v in centres if metres(x, y, u, v) < 5000
    )
    assert pairs == expected and len(expected) > 20


def cells(spark):
    rows = [(10 * i + j, 1, j * 1.0, i * 1.0, j + 1.0, i + 1.0) for i in range(3) for j in range(3)]
    rows.append((99, 2, 0.0, 0.0, 3.0, 3.0))
    return spark.createDataFrame(
        rows, "grid_id int, grid_scale int, min_lat double, min_lon double, max_lat double, max_lon double"
    )


def test_tag_grid_keeps_every_point_once(spark):
    rng = random.Random(3)
    data = [(i, rng.uniform(-1, 4), rng.uniform(-1, 4)) for i in range(200)]
    data += [(200, 1.0, 1.0), (201, 0.0, 0.5), (202, 3.0, 3.0)]
    points = spark.createDataFrame(data, "p int, lon double, lat double")
    got = {r.p: r for r in spatial.tag_grid(points, cells(spark), (1.0, 2.0)).collect()}
    assert len(got) == len(data)
    for p, lon, lat in data:
        i, j = math.ceil(lon) - 1, math.ceil(lat) - 1
        inside = 0 < lon <= 3 and 0 < lat <= 3
        assert got[p].grid_id == (10 * i + j if inside else None)
        assert got[p].grid_id_two == (99 if inside else None)


@pytest.mark.parametrize("edges, found", [("open_closed", [0]), ("closed_open", [11]), ("closed", [0, 1, 10, 11])])
def test_point_on_a_corner(spark, edges, found):
    point = spark.createDataFrame([(1.0, 1.0)], "lon double, lat double")
    fine = cells(spark).filter("grid_scale = 1")
    got = spatial.join_boxes(point, fine, 1.0, edges, "inner")
    assert sorted(r.grid_id for r in got.collect()) == found


def test_tile_size_does_not_change_the_result(spark):
    rng = random.Random(5)
    points = spark.createDataFrame(
        [(i, rng.uniform(0, 3), rng.uniform(0, 3)) for i in range(100)], "p int, lon double, lat double"
    )
    fine = cells(spark).filter("grid_scale = 1")
    one, two = (
        sorted((r.p, r.grid_id) for r in spatial.join_boxes(points, fine, t).collect()) for t in (0.3, 7.0)
    )
    assert one == two


def brute_track(rows):
    """(plate, name, second, lon, lat): keep entries into another cell."""
    from brisa.params import GRID_BOXES

    min_lat, max_lat, min_lon, max_lon = GRID_BOXES["inner"]

    def cell(lon, lat):
        row = math.ceil((lat - min_lat) / ((max_lat - min_lat) / 500))
        return (row + 100000) * 1000000 + math.ceil((lon - min_lon) / ((max_lon - min_lon) / 500)) + 100000

    first = {}
    for plate, name, t, lon, lat in sorted(rows, key=lambda r: (r[0], r[2], r[1], r[3], r[4])):
        first.setdefault((plate, t), (name, t, plate, lon, lat))
    kept, before = [], {}
    for name, t, plate, lon, lat in sorted(first.values()):
        if cell(lon, lat) != before.get(name, 0):
            kept.append((plate, t))
        before[name] = cell(lon, lat)
    return sorted(kept)


def test_thin_trajectory_carries_cells_over_buckets(spark):
    rng = random.Random(11)
    start = dt.datetime(2024, 3, 1)
    rows = []
    for _ in range(600):
        plate = f"P{rng.randrange(4)}"
        t = start + dt.timedelta(seconds=rng.randrange(0, 40 * 3600, 300))
        spot = (t - start).seconds // 9000 + rng.randrange(2)
        rows.append((plate, "S" + str(int(plate[1]) % 2), t, 103.8 + spot * 0.01, 30.5))
    df = spark.createDataFrame(rows, "plate_num string, name string, published_at timestamp_ntz, lon double, lat double").withColumn("speed", F.lit(1))
    got = spatial.thin_trajectory(df).select("plate_num", "published_at")
    assert sorted(tuple(r) for r in got.collect()) == brute_track(rows)


def test_points_without_position_are_kept(spark):
    start = dt.datetime(2024, 3, 1)
    spots = [103.8, 103.8, None, 103.8, 103.8]
    rows = [("P", "v", start + dt.timedelta(minutes=25 * i), x, 30.5, 1) for i, x in enumerate(spots)]
    df = spark.createDataFrame(rows, "plate_num string, name string, published_at timestamp_ntz, lon double, lat double, speed int")
    got = spatial.thin_trajectory(df).collect()
    assert sorted((r.published_at - start).seconds // 1500 for r in got) == [0, 2, 3]


def test_shift_is_identity_outside_the_box(spark):
    df = spark.createDataFrame([(0.0, 0.0), (140.0, 30.0), (104.0113972, 30.6414861)], "lon double, lat double")
    got = [tuple(r) for r in tracks.shift_positions(df).collect()]
    assert got[0] == (0.0, 0.0) and got[1] == (140.0, 30.0)
    assert 0.001 < got[2][0] - 104.0113972 < 0.004 and -0.004 < got[2][1] - 30.6414861 < -0.001


def test_grid_id_arithmetic(spark):
    df = spark.createDataFrame([(103.725943 + 0.002, 30.333579999999998 + 0.003)], "lon double, lat double")
    got = df.select(geo.grid_id("lon", "lat", "inner", 500, 500).alias("g")).first().g
    assert got == (3 + 100000) * 1000000 + 2 + 100000


def test_station_grid_keeps_stations_without_cells(spark):
    stations = spark.createDataFrame([(1, "a"), (2, "b")], "station_id int, station_code string")
    bridge = spark.createDataFrame([(0, 1), (99, 1), (12345, 2)], "grid_id int, station_id int")
    got = {r.station_id: (r.grid_id, r.grid_id_two) for r in spatial.station_grid(stations, bridge, cells(spark)).collect()}
    assert got == {1: (0, 99), 2: (None, None)}


def test_wind_is_weighted_and_an_exact_hit_wins(spark):
    stations = spark.createDataFrame([(1, 104.0, 30.0), (2, 104.5, 30.0)], "station_id int, lon double, lat double")
    wind = spark.createDataFrame(
        [("A", 104.0, 30.0, 8.0), ("B", 104.1, 30.0, 2.0), ("C", 104.2, 30.0, None), ("X", 104.5, 30.0, 50.0)],
        "station_name string, lon double, lat double, wind_speed double",
    )
    got = {r.station_id: r.wind_speed for r in features.interpolated_wind(stations, wind, ["A", "B", "C"]).collect()}
    a, b = metres(104.5, 30.0, 104.0, 30.0) ** 2, metres(104.5, 30.0, 104.1, 30.0) ** 2
    assert got == {1: 8.0, 2: round((8 / a + 2 / b) / (1 / a + 1 / b), 2)}
    none = features.interpolated_wind(stations, wind.filter("false"), ["A"]).collect()
    assert {r.wind_speed for r in none} == {0.0}
