"""Queries: grid tags, radius features, trajectories, tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.functions import geo
from brisa.functions.register import register
from brisa.operators import features, spatial, tracks
from brisa.params import GRID_BOXES, VOC_TRACK_COLUMNS
from brisa.plans import adapters, sql
from brisa.plans.registry import query
from brisa.session import shared_dir
from brisa.sources.files import read_delimited, write_csv

# --- X11..X13: geodesy --------------------------------------------------------

sql.view("event_place", f"SELECT event_id, user_id, {sql.place('event_id')} FROM events")


@query("X11_distance", sql.with_views("event_place", f"""
  SELECT event_id, CAST({sql.metres('lon', 'lat', '104.06::DOUBLE', '30.67::DOUBLE')} AS BIGINT) AS metres
  FROM event_place"""))
def distance(spark, sf):
    lon, lat = adapters.positions(F.col("event_id"))
    points = adapters.table(spark, sf, "events").select("event_id", lon.alias("lon"), lat.alias("lat"))
    return points.select("event_id", geo.distance_m("lon", "lat", "104.06D", "30.67D").alias("metres"))


def _shift_sql(source: str, keep: str) -> str:
    x, y = "(lon - 105.0::DOUBLE)", "(lat - 35.0::DOUBLE)"
    wave = f"20.0 * sin(6.0 * {x} * pi()) + 20.0 * sin(2.0 * {x} * pi())"
    north = (
        f"(-100.0::DOUBLE + 2.0 * {x} + 3.0 * {y} + 0.2::DOUBLE * {y} * {y} + 0.1::DOUBLE * {x} * {y} + 0.2::DOUBLE * sqrt(abs({x}))"
        f" + ({wave}) * 2.0 / 3.0 + (20.0 * sin({y} * pi()) + 40.0 * sin({y} / 3.0 * pi())) * 2.0 / 3.0"
        f" + (160.0 * sin({y} / 12.0 * pi()) + 320.0 * sin({y} * pi() / 30.0)) * 2.0 / 3.0)"
    )
    east = (
        f"(300.0::DOUBLE + {x} + 2.0 * {y} + 0.1::DOUBLE * {x} * {x} + 0.1::DOUBLE * {x} * {y} + 0.1::DOUBLE * sqrt(abs({x}))"
        f" + ({wave}) * 2.0 / 3.0 + (20.0 * sin({x} * pi()) + 40.0 * sin({x} / 3.0 * pi())) * 2.0 / 3.0"
        f" + (150.0 * sin({x} / 12.0 * pi()) + 300.0 * sin({x} / 30.0 * pi())) * 2.0 / 3.0)"
    )
    ee, a = "0.00669342162296594323e0", "6378245.0::DOUBLE"
    w = f"(1 - {ee} * sin(radians(lat)) * sin(radians(lat)))"
    inside = "lon BETWEEN 72.004 AND 137.8347 AND lat BETWEEN 0.8293 AND 55.8271"
    return f"""SELECT {keep},
      round(CASE WHEN {inside} THEN lon + {east} * 180.0 / ({a} / sqrt({w}) * cos(radians(lat)) * pi()) ELSE lon END, 6) AS lon,
      round(CASE WHEN {inside} THEN lat + {north} * 180.0 / (({a} * (1 - {ee})) / ({w} * sqrt({w})) * pi()) ELSE lat END, 6) AS lat
      FROM {source}"""


@query("X12_datum_shift", _shift_sql(
    "(SELECT event_id, round(60 + (event_id % 100) * 1.1::DOUBLE, 6) AS lon, round((event_id % 67) * 0.9::DOUBLE, 6) AS lat FROM events)",
    "event_id"))
def datum_shift(spark, sf):
    """Positions inside and outside the national box."""
    points = adapters.table(spark, sf, "events").select(
        "event_id",
        F.round(F.lit(60) + (F.col("event_id") % 100) * F.lit(1.1), 6).alias("lon"),
        F.round((F.col("event_id") % 67) * F.lit(0.9), 6).alias("lat"),
    )
    return tracks.shift_positions(points)


def _grid_sql(box: str, rows: int, columns: int) -> str:
    a, b, c, d = (f"{v!r}::DOUBLE" for v in GRID_BOXES[box])
    return (
        f"CAST((ceil((lat - {a}) / (({b} - {a}) / {rows})) + 100000) * 1000000"
        f" + ceil((lon - {c}) / (({d} - {c}) / {columns})) + 100000 AS BIGINT)"
    )


@query("X13_grid_id", sql.with_views("event_place", f"""
  SELECT event_id, {_grid_sql('inner', 500, 500)} AS inner_id, {_grid_sql('outer', 300, 300)} AS outer_id,
    {_grid_sql('city', 1000, 1200)} AS city_id FROM event_place"""))
def grid_id(spark, sf):
    lon, lat = adapters.positions(F.col("event_id"))
    points = adapters.table(spark, sf, "events").select("event_id", lon.alias("lon"), lat.alias("lat"))
    return points.select(
        "event_id",
        geo.grid_id("lon", "lat", "inner", 500, 500).alias("inner_id"),
        geo.grid_id("lon", "lat", "outer", 300, 300).alias("outer_id"),
        geo.grid_id("lon", "lat", "city", 1000, 1200).alias("city_id"),
    )


@query("X11_X13_sql_functions", sql.with_views("event_place", f"""
  SELECT event_id, CAST({sql.metres('lon', 'lat', '104.06::DOUBLE', '30.67::DOUBLE')} AS BIGINT) AS metres,
    {_grid_sql('inner', 500, 500)} AS inner_id, {_grid_sql('outer', 300, 300)} AS outer_id,
    {_grid_sql('city', 1000, 1200)} AS city_id FROM event_place"""))
def place_functions(spark, sf):
    """Distance and grid ids as SQL functions; the numbers of cells are arguments."""
    register(spark)
    lon, lat = adapters.positions(F.col("event_id"))
    points = adapters.table(spark, sf, "events").select("event_id", lon.alias("lon"), lat.alias("lat"))
    return spark.sql(
        """
        SELECT event_id, distance_m(lon, lat, 104.06D, 30.67D) AS metres, grid_id_inner(lon, lat, 500, 500) AS inner_id,
          grid_id_outer(lon, lat, 300, 300) AS outer_id, grid_id_city(lon, lat, 1000, 1200) AS city_id FROM {points}
        """,
        points=points,
    )


# --- B14: boxes ---------------------------------------------------------------

sql.view("tagged", """
  SELECT p.*, a.grid_id, b.grid_id AS grid_id_two FROM points p
  LEFT JOIN (SELECT * FROM cells WHERE grid_scale = 1) a ON p.lat > a.min_lat AND p.lat <= a.max_lat
    AND p.lon > a.min_lon AND p.lon <= a.max_lon
  LEFT JOIN (SELECT * FROM cells WHERE grid_scale = 2) b ON p.lat > b.min_lat AND p.lat <= b.max_lat
    AND p.lon > b.min_lon AND p.lon <= b.max_lon""", "points", "cells")


@query("B14_tag_grid", sql.with_views("tagged", "SELECT * FROM tagged"))
def tag_grid(spark, sf):
    return spatial.tag_grid(
        adapters.box_points(spark, sf), adapters.box_cells(spark, sf), (5.0, 10.0)
    )


@query("J5_box_join_half_open", sql.with_views("points cells", """
  SELECT p.*, grid_id FROM points p JOIN cells ON grid_scale = 1 AND lat >= min_lat AND lat < max_lat
    AND lon >= min_lon AND lon < max_lon"""))
def box_join_half_open(spark, sf):
    cells = adapters.box_cells(spark, sf).filter("grid_scale = 1")
    return spatial.join_boxes(
        adapters.box_points(spark, sf), cells, 5.0, edges="closed_open", how="inner"
    )


@query("D3_cells_from_json", sql.with_views("cells", "SELECT * FROM cells"))
def cells_from_json(spark, sf):
    """Cells written with JSON corners, parsed back to bounds."""
    cells = adapters.box_cells(spark, sf).select(
        F.col("grid_id").alias("id"),
        "grid_scale",
        F.to_json(F.struct(F.col("min_lat").alias("lat"), F.col("min_lon").alias("lon"))).alias(
            "bottom_left_coord"
        ),
        F.to_json(F.struct(F.col("max_lat").alias("lat"), F.col("max_lon").alias("lon"))).alias(
            "top_right_coord"
        ),
    )
    return spatial.parse_cells(cells)


# --- B13: neighbourhood -------------------------------------------------------

NEAR = sql.metres("p.lon", "p.lat", "s.lon", "s.lat") + " < 5000"
# a cheap bound the engine can test before the distance
BOX = "abs(p.lat - s.lat) < 0.05 AND abs(p.lon - s.lon) < 0.06"
sql.view("places", "SELECT DISTINCT lon, lat FROM sites", "sites")


def weather_points(spark, sf):
    lon, lat = adapters.positions(F.col("c_custkey") * 7)
    return adapters.table(spark, sf, "customer").select(
        lon.alias("lon"), lat.alias("lat"),
        F.floor("c_acctbal").cast("double").alias("rainfall"),
        (F.col("c_custkey") % 100).cast("double").alias("humidity"),
        F.col("c_nationkey").cast("double").alias("traffic_index"),
        F.when(F.col("c_custkey") % 3 != 0, (F.col("c_custkey") % 1000).cast("double")).alias("solar_radiation"),
    )


def waiting_trucks(spark, sf):
    lon, lat = adapters.positions(F.col("p_partkey") * 5)
    return adapters.table(spark, sf, "part").select(
        lon.alias("lon"), lat.alias("lat"), (F.col("p_size") % 4).cast("long").alias("waiting")
    )


def road_sections(spark, sf):
    """Road sections whose course is a text of two positions."""
    (lon1, lat1), (lon2, lat2) = (
        adapters.positions(F.col("p_partkey") * 3), adapters.positions(F.col("p_partkey") * 3 + 1)
    )

    def pair(lon, lat):
        return F.concat(F.lit("["), lon.cast("string"), F.lit(", "), lat.cast("string"), F.lit("]"))

    parts = adapters.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("roadname"),
        F.to_json(F.struct(
            F.col("p_size").alias("large"),
            F.when(F.col("p_partkey") % 4 != 0, F.col("p_partkey") % 7).alias("middle"),
            (F.col("p_partkey") % 5).alias("small"),
        )).alias("counts"),
        F.concat(F.lit("["), pair(lon1, lat1), F.lit(", "), pair(lon2, lat2), F.lit("]")).alias("trail"),
    )
    counted = parts.withColumn("flow", features.counted_flow("counts"))
    return features.trail_points(counted, "trail", ["id", "roadname", "flow"])


def dust_points(spark, sf):
    """Dust loads along a trail text of one position each."""
    lon, lat = adapters.positions(F.col("o_orderkey") * 11)
    rows = adapters.table(spark, sf, "orders").select(
        F.concat(F.lit("[["), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]]")).alias("trail"),
        (F.col("o_custkey") % 10).alias("dust"),
    )
    return features.trail_points(rows, "trail", ["dust"])


sql.view("weather_points", f"""
  SELECT {sql.place('(c_custkey * 7)')}, floor(c_acctbal) AS rainfall, CAST(c_custkey % 100 AS DOUBLE) AS humidity,
    CAST(c_nationkey AS DOUBLE) AS traffic_index,
    CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 1000 AS DOUBLE) END AS solar_radiation FROM customer""")
FLOW = "(p_size + CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % 7 ELSE 0 END + p_partkey % 5)::DOUBLE"
sql.view("sections", f"""
  SELECT p_partkey AS id, p_brand AS roadname, {FLOW} AS flow, {sql.place('(p_partkey * 3)')} FROM part
  UNION ALL
  SELECT p_partkey, p_brand, {FLOW}, {sql.place('(p_partkey * 3 + 1)')} FROM part""")
sql.view("earth_feature", f"""
  SELECT s.lon, s.lat, CAST(sum(waiting) AS BIGINT) AS earth_num FROM places s JOIN
    (SELECT {sql.place('(p_partkey * 5)')}, p_size % 4 AS waiting FROM part) p ON {BOX} AND {NEAR} GROUP BY s.lon, s.lat""", "places")
sql.view("truck_feature", f"""
  SELECT s.lon, s.lat, count(DISTINCT (plate_num, sim_card)) AS truck_num, count(*) AS truck_trajectory
  FROM places s JOIN trucks p ON {BOX} AND {NEAR} AND speed > 0 GROUP BY s.lon, s.lat""", "places", "trucks")
sql.view("weather_feature", f"""
  SELECT s.lon, s.lat, avg(rainfall) AS rainfall, avg(humidity) AS humidity, avg(traffic_index) AS traffic_index,
    avg(solar_radiation) AS solar_radiation
  FROM places s JOIN weather_points p ON {BOX} AND {NEAR} GROUP BY s.lon, s.lat""", "places", "weather_points")
sql.view("flow_feature", f"""
  SELECT lon, lat, CAST(floor(round(sum(flow), 6)) AS INTEGER) AS traffic_flow FROM
    (SELECT lon, lat, roadname, avg(flow) AS flow FROM
      (SELECT s.lon, s.lat, roadname, id, max(flow) AS flow FROM places s JOIN sections p ON {BOX} AND {NEAR}
       GROUP BY s.lon, s.lat, roadname, id) GROUP BY lon, lat, roadname)
  GROUP BY lon, lat""", "places", "sections")
sql.view("dust_feature", f"""
  SELECT s.lon, s.lat, CAST(sum(dust) AS BIGINT) AS dust_index FROM places s JOIN
    (SELECT {sql.place('(o_orderkey * 11)')}, o_custkey % 10 AS dust FROM orders) p ON {BOX} AND {NEAR} GROUP BY s.lon, s.lat""", "places")
sql.view("wind_feature", f"""
  SELECT s.station_id, round(CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(v) FILTER (d = 0)
      ELSE coalesce(sum(v / nullif(d, 0)) / nullif(sum(1 / nullif(d, 0)), 0), 0) END, 2) AS wind_speed
  FROM (SELECT s.station_id, p.wind_speed AS v,
          pow({sql.metres('s.lon', 's.lat', 'p.lon', 'p.lat')}, 2) AS d FROM sites s CROSS JOIN wind p) s
  GROUP BY s.station_id""", "sites", "wind")

NATIONS = [f"NATION_{i}" for i in range(25)]


@query("B13_station_features", sql.with_views(
    "truck_feature weather_feature flow_feature dust_feature earth_feature wind_feature", """
  SELECT station_id, station_name, lon, lat, truck_num, truck_trajectory, traffic_flow, earth_num, dust_index, wind_speed,
    CAST(CAST(rainfall AS DECIMAL(8, 2)) AS DOUBLE) AS rainfall, CAST(CAST(humidity AS DECIMAL(8, 2)) AS DOUBLE) AS humidity,
    CAST(CAST(solar_radiation AS DECIMAL(8, 2)) AS DOUBLE) AS solar_radiation,
    CAST(CAST(traffic_index AS DECIMAL(10, 6)) AS DOUBLE) AS traffic_index, (SELECT coalesce(CAST(left(arg_max(o_orderpriority, o_orderkey), 1) AS INTEGER), 0)
      FROM orders WHERE o_orderdate = TIMESTAMP '1998-03-05') AS diffusion_conditions
  FROM sites LEFT JOIN dust_feature USING (lon, lat) LEFT JOIN earth_feature USING (lon, lat) LEFT JOIN truck_feature USING (lon, lat) LEFT JOIN weather_feature USING (lon, lat)
  LEFT JOIN flow_feature USING (lon, lat) JOIN wind_feature USING (station_id)"""))
def station_features(spark, sf):
    stations = adapters.site_stations(spark, sf)
    places = features.sites(stations)
    parts = [
        features.truck_features(adapters.truck_points(spark, sf), places),
        features.flow_feature(road_sections(spark, sf), places),
        features.mean_features(
            weather_points(spark, sf), places, ["rainfall", "humidity", "traffic_index", "solar_radiation"]
        ),
        features.sum_feature(dust_points(spark, sf), places, "dust", "dust_index"),
        features.sum_feature(waiting_trucks(spark, sf), places, "waiting", "earth_num"),
    ]
    out = features.station_features(stations, parts, adapters.wind_reports(spark, sf), NATIONS)
    # compared as plain numbers
    out = features.published(out).withColumns({c: F.col(c).cast("decimal(20,6)").cast("double") for c in features.PUBLISHED})
    forecasts = adapters.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("forecast_date"),
        F.col("o_orderkey").alias("published_at"),
        F.col("o_orderpriority").alias("diffusion_conditions"),
    )
    return features.diffusion_level(out, forecasts, F.lit("1998-03-05").cast("date"))


@query("J6_radius_pairs", sql.with_views("sites weather_points", f"""
  SELECT s.station_id, count(*) AS points, sum(p.humidity) AS humidity
  FROM sites s JOIN weather_points p ON {BOX} AND {NEAR} GROUP BY s.station_id"""))
def radius_pairs(spark, sf):
    """Points near a station, summed; points at one place are summed first."""
    spots = weather_points(spark, sf).groupBy("lon", "lat").agg(
        F.count("*").alias("n"), F.sum("humidity").alias("h")
    )
    pairs = spatial.join_radius(spots, adapters.site_stations(spark, sf), 5000, ["station_id"])
    return pairs.groupBy("station_id").agg(
        F.sum("n").alias("points"), F.sum("h").alias("humidity")
    )


@query("A13_interpolated_wind", sql.with_views("wind_feature", "SELECT * FROM wind_feature"))
def interpolated_wind(spark, sf):
    stations = adapters.site_stations(spark, sf)
    out = features.interpolated_wind(stations, adapters.wind_reports(spark, sf), NATIONS)
    return out.select("station_id", "wind_speed")


@query("A14_three_level_flow", sql.with_views("flow_feature", "SELECT * FROM flow_feature"))
def three_level_flow(spark, sf):
    places = features.sites(adapters.site_stations(spark, sf))
    flow = features.flow_feature(road_sections(spark, sf), places)
    return flow.select("_place.lon", "_place.lat", "traffic_flow")


@query("A12_distinct_trucks", """
  SELECT CAST(ts AS DATE) AS day, count(DISTINCT (user_id, event_type)) AS pairs FROM events GROUP BY 1""")
def distinct_trucks(spark, sf):
    return (
        adapters.table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.count_distinct("user_id", "event_type").alias("pairs"))
    )


@query("D12_trail_points", sql.with_views("sections", "SELECT * FROM sections"))
def trail_points(spark, sf):
    return road_sections(spark, sf)


# --- B16: trajectories --------------------------------------------------------


def slow_trucks(spark, sf):
    """Trucks that stay at one place for a quarter of a day."""
    spot = F.col("user_id") * 7 + F.dayofyear("ts") * 3 + F.floor(F.hour("ts") / 6)
    lon, lat = adapters.positions(spot)
    return adapters.table(spark, sf, "events").select(
        F.concat(F.lit("P"), F.col("user_id")).alias("plate_num"),
        (F.col("user_id") % 50).cast("string").alias("name"),
        lon.alias("lon"), lat.alias("lat"),
        F.floor("value").cast("double").alias("speed"),
        F.col("ts").cast("timestamp_ntz").alias("published_at"),
    )


@query("B16_thin_trajectory", f"""
  WITH t AS (SELECT 'P' || user_id AS plate_num, CAST(user_id % 50 AS VARCHAR) AS name,
      {sql.place('(user_id * 7 + dayofyear(ts) * 3 + hour(ts) // 6)')}, floor(value) AS speed,
      date_trunc('second', ts) AS published_at FROM events),
  u AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY plate_num, published_at ORDER BY name, lon, lat, speed) = 1),
  c AS (SELECT *, {_grid_sql('inner', 500, 500)} AS cell FROM u)
  SELECT plate_num, name, lon, lat, speed, published_at FROM c
  QUALIFY cell <> lag(cell, 1, 0) OVER (PARTITION BY name ORDER BY published_at, plate_num)""")
def thin_trajectory(spark, sf):
    return spatial.thin_trajectory(slow_trucks(spark, sf))


# --- B19: tracks --------------------------------------------------------------


def track_cells(spark, sf):
    sizes = adapters.table(spark, sf, "part").select((F.col("p_size") - 1).alias("i")).distinct()
    boxes = sizes.filter("i < 8").select(
        "i", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j")
    )

    def edge(base, n):
        return F.round(F.lit(base) + n * F.lit(0.1), 6)

    return boxes.select(
        (F.col("i") * 10 + F.col("j")).alias("grid_id"),
        edge(30.3, F.col("j")).alias("min_lat"), edge(103.7, F.col("i")).alias("min_lon"),
        edge(30.3, F.col("j") + 1).alias("max_lat"), edge(103.7, F.col("i") + 1).alias("max_lon"),
    )


sql.view("track_cells", """
  SELECT CAST(i * 10 + j AS INTEGER) AS grid_id, round(30.3::DOUBLE + j * 0.1::DOUBLE, 6) AS min_lat,
    round(103.7::DOUBLE + i * 0.1::DOUBLE, 6) AS min_lon, round(30.3::DOUBLE + (j + 1) * 0.1::DOUBLE, 6) AS max_lat,
    round(103.7::DOUBLE + (i + 1) * 0.1::DOUBLE, 6) AS max_lon
  FROM (SELECT DISTINCT p_size - 1 AS i FROM part WHERE p_size <= 8), range(6) r(j)""")


@query("B19_load_track", sql.with_views("track_cells", _shift_sql(f"""
  (SELECT p.*, grid_id FROM
    (SELECT DISTINCT strftime(ts, '%Y-%m-%d %H:%M:%S') AS tvoc_time, {sql.place('event_id')}, {', '.join(
       f"CASE WHEN event_id % 11 <> {n % 11} THEN CAST(floor(value) + {n} AS DOUBLE) END AS {c}"
       for n, c in enumerate(VOC_TRACK_COLUMNS[3:]))} FROM events) p
   JOIN track_cells c ON p.lon BETWEEN min_lon AND max_lon AND p.lat BETWEEN min_lat AND max_lat)""",
    ", ".join(["tvoc_time", *VOC_TRACK_COLUMNS[3:], "grid_id"]))))
def load_track(spark, sf):
    """Track lines written as delimited text with a local encoding and read back."""
    lon, lat = adapters.positions(F.col("event_id"))
    lines = adapters.table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("tvoc_time"),
        lon.alias("lon"), lat.alias("lat"),
        *[
            F.when(F.col("event_id") % 11 != n % 11, F.floor("value") + n).alias(c)
            for n, c in enumerate(VOC_TRACK_COLUMNS[3:])
        ],
    )
    path = shared_dir(spark, "track")
    write_csv(lines, path, sep=";", encoding="GBK", header=False)
    read = read_delimited(spark, path, VOC_TRACK_COLUMNS)
    return tracks.load_track(read, track_cells(spark, sf), 0.1)


@query("B19_dust_track", _shift_sql(f"""
  (SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS published_at, {sql.place('event_id')}, floor(value) AS concentration,
     CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS speed FROM events)""",
    "published_at, concentration, speed"))
def dust_track(spark, sf):
    """Road-dust file with a foreign-language header; bad numbers become null."""
    lon, lat = adapters.positions(F.col("event_id"))
    rows = adapters.table(spark, sf, "events").select(
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("日期/时间"),
        F.floor("value").cast("string").alias("浓度"),
        lon.cast("string").alias("经度"), lat.cast("string").alias("纬度"),
        F.when(F.col("event_type") == "error", "--").otherwise(F.col("user_id").cast("string")).alias("速度"),
    )
    out = tracks.load_dust_track(rows)
    return out.withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))
