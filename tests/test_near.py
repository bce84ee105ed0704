"""What is counted near centres without moving pairs."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from brisa.functions import geo
from brisa.operators import features, near, spatial, tiles


def spots(draw, lat, radius, n):
    reach = radius / geo.METRES_PER_DEGREE
    wide = reach / math.cos(math.radians(lat))
    return [(round(104 + draw.uniform(-9, 9) * wide, 5), round(lat + draw.uniform(-9, 9) * reach, 5)) for _ in range(n)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_cover_is_never_broadcast(spark):
    centres = frame(spark, [(n, 104.0 + n % 50 * 0.01, 30.0) for n in range(100)], "place int, lon double, lat double")
    points = frame(spark, [(104.0 + n * 0.01, 30.0) for n in range(50)], "lon double, lat double")
    got = tiles.near_totals(points, centres, 5000.0, ["place"], {"n": "1"})
    text = plan(got).split("== Initial Plan ==")[0]
    assert "SortMergeJoin [_level" in text and "SortMergeJoin [_row" in text
    by_place = {r.place: r.n for r in got.collect()}
    assert len(by_place) == 100 and all(by_place[n] == by_place[n + 50] for n in range(50))


@pytest.mark.parametrize("lat, radius", [(30.5, 5000.0), (0.0, 800.0), (-62.0, 20000.0)])
@pytest.mark.parametrize("by_tile", [False, True])
@pytest.mark.parametrize("few", [0, 10**6])
def test_members_near_centres(spark, monkeypatch, lat, radius, by_tile, few):
    monkeypatch.setattr(near, "FEW_IDS", few)
    draw = random.Random(int(radius))
    seen = [(f"P{n % 40}", None if n % 90 == 0 else n % 7, *s) for n, s in enumerate(spots(draw, lat, radius, 700) * 2)]
    rows = frame(spark, seen, "plate string, card int, lon double, lat double")
    places = frame(spark, spots(draw, lat, radius, 60), "lon double, lat double").distinct()
    centres = near.numbered(places, radius)
    far = geo.distance_m("lon", "lat", "_x", "_y") < radius
    pairs = rows.crossJoin(centres.select("_id", F.col("lon").alias("_x"), F.col("lat").alias("_y"))).where(far)
    expected = {r._id: r.n for r in pairs.select("_id", "plate", "card").distinct().groupBy("_id").agg(F.count("*").alias("n")).collect()}
    got = near.count_members(rows, centres, radius, ["plate", "card"], "n", by_tile)
    assert {r._id: r.n for r in got.collect()} == expected and max(expected.values()) > 3


def test_pairs_stay_in_their_task(spark):
    draw = random.Random(3)
    rows = frame(spark, [(f"P{n % 9}", *s) for n, s in enumerate(spots(draw, 30.5, 5000.0, 300))], "plate string, lon double, lat double")
    centres = near.numbered(frame(spark, spots(draw, 30.5, 5000.0, 40), "lon double, lat double"), 5000.0)
    for by_tile in (False, True):
        text = plan(near.count_members(rows, centres, 5000.0, ["plate"], "n", by_tile)).split("== Initial Plan ==")[0]
        dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
        assert not [d for d in dealt if "plate" in d and "_id" in d]
        assert len([d for d in dealt if "plate" in d and "_rband" in d]) == 1


def test_largest_flow_of_a_section_near_a_place(spark):
    draw = random.Random(8)
    rows = [
        (None if n % 50 == 0 else n % 120, "road" + str(n % 4) if n % 11 else None, draw.choice([None, 1.0, 4.0, 9.0]), *s)
        for n, s in enumerate(spots(draw, 30.5, 5000.0, 900))
    ]
    sections = frame(spark, rows, "id int, roadname string, flow double, lon double, lat double")
    places = features.sites(frame(spark, spots(draw, 30.5, 5000.0, 50), "lon double, lat double"))
    pairs = spatial.join_radius(sections, places, 5000.0, ["_place"])
    largest = pairs.groupBy("_place", "roadname", "id").agg(F.max("flow").alias("flow"))
    road = largest.groupBy("_place", "roadname").agg(F.avg("flow").alias("flow"))
    expected = road.groupBy("_place").agg(F.floor(F.round(F.sum("flow"), 6)).alias("f"))
    got = features.flow_feature(sections, places)
    assert {r._place: r.traffic_flow for r in got.collect()} == {r._place: r.f for r in expected.collect()}
    assert got.count() > 30


def test_trucks_without_a_plate_leave_their_track(spark):
    trucks = frame(spark, [("a", "1", 104.0, 30.0, 5), (None, "1", 104.0, 30.0, 5), (None, "2", 105.0, 30.0, 5), ("b", "1", 104.0, 30.0, 0)],
                   "plate_num string, sim_card string, lon double, lat double, speed int")
    places = features.sites(frame(spark, [(104.0, 30.0), (105.0, 30.0), (106.0, 30.0)], "lon double, lat double"))
    for f in (features.truck_features, features.truck_features_by_tile):
        got = {r._place.lon: (r.truck_num, r.truck_trajectory) for r in f(trucks, places).collect()}
        assert got == {104.0: (1, 2), 105.0: (0, 1)}


def test_wind_stations_at_one_spot_meet_a_place_once(spark, monkeypatch):
    met = []
    join = spatial.join_radius
    monkeypatch.setattr(features, "join_radius", lambda points, *a: met.append(points.count()) or join(points, *a))
    wind = frame(spark, [(f"w{n}", 104 + n % 5 * 0.1, 30.0, float(n % 16)) for n in range(200)],
                 "station_name string, lon double, lat double, wind_speed double")
    stations = frame(spark, [(1, 104.0, 30.0), (2, 104.25, 30.1)], "station_id int, lon double, lat double")
    exact = {r.station_id: r.wind_speed for r in features.interpolated_wind(stations, wind, [f"w{n}" for n in range(200)]).collect()}
    got = features.wind_by_rings(stations, wind, 0.0, 50_000.0, 2)
    assert {r.station_id: r.wind_speed for r in got.collect()} == exact
    assert met == [5, 5]
