"""Queries over stored products: days, states of months, tables that are merged by partition."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brisa.operators import completeness, features, periods, rollup, score, score_states, spatial, tiles, weather
from brisa.params import WEATHER_FIELDS, WEATHER_NO_DATA
from brisa.plans import adapters, cleaning, places, scoring, sql
from brisa.plans.registry import ORACLES, flat, query
from brisa.plans.rollups import area_days
from brisa.session import shared_dir, shuffle_tasks, stored
from brisa.sources import sinks

MONTH = ["published_year", "published_month"]


def stored_days(spark, days):
    """A daily product kept by year and month, read back."""
    path, dated = shared_dir(spark, "days"), days.withColumns(rollup.period_columns("month"))
    sinks.overwrite_partitions(dated, path, MONTH)
    return spark.read.schema(dated.schema).parquet(path)


def month_states(spark, days, keys, **options):
    """States of all months of a stored daily product, kept by month and read back."""
    path = shared_dir(spark, "month-states")
    sinks.refresh_months(days, path, days.select(*MONTH), keys, **options)
    return spark.read.parquet(path)


def _states_of(states, keys, period):
    return states if period == "month" else periods.merge_states(states, keys, period)


AREA = ["area_id", "source"]

for _period in ("month", "quarter", "year"):

    @query(f"B6_area_{_period}_from_states", sql.with_views("area_day", sql.period("area_day", "area_id, source", _period)))
    def area_period(spark, sf, period=_period):
        """Days are stored, months kept as states; the period is read from these."""
        states = month_states(spark, stored_days(spark, area_days(spark, sf)), AREA)
        return flat(periods.period_product(_states_of(states, AREA, period), AREA, period))

    @query(f"B6_station_{_period}_from_states", sql.with_views("station_day", sql.period("station_day", "station_id", _period)))
    def station_period(spark, sf, period=_period):
        keys = ["station_id"]
        states = month_states(spark, stored_days(spark, adapters.station_days(spark, sf)), keys)
        return flat(periods.period_product(_states_of(states, keys, period), keys, period))


DISTRICT = ["source", "control_area_id"]

for _period in ("month", "year"):

    @query(f"B7_district_{_period}_from_states", sql.with_views("district_day", sql.district_period("district_day", _period)))
    def district_period(spark, sf, period=_period):
        days = stored_days(spark, rollup.district_rollup(adapters.grid_days(spark, sf), "day"))
        states = month_states(spark, days, DISTRICT, valid_days=periods.DAYS_WITH_FLAG)
        return flat(periods.district_product(_states_of(states, DISTRICT, period), period))


@query("B6_state_refresh", sql.with_views("station_day", sql.period(
    "(SELECT * REPLACE (CASE WHEN year(published_at) = 1996 THEN so2 + 1 ELSE so2 END AS so2) FROM station_day)", "station_id", "year")))
def state_refresh(spark, sf):
    """Days of one year are corrected: their months are written anew, the years read from all."""
    keys, path = ["station_id"], shared_dir(spark, "month-states")
    days = stored_days(spark, adapters.station_days(spark, sf))
    sinks.refresh_months(days, path, days.select(*MONTH), keys)
    later = F.col("published_year") == 1996
    corrected = days.withColumn("so2", F.when(later, F.col("so2") + 1).otherwise(F.col("so2")))
    sinks.refresh_months(corrected, path, days.where(later).select(*MONTH), keys)
    states = spark.read.parquet(path)
    return flat(periods.period_product(periods.merge_states(states, keys, "year"), keys, "year"))


# --- clustered days -----------------------------------------------------------

BUCKETS = 8


def clustered(spark, df, keys, buckets=None):
    """A table kept in buckets of ``keys``; jobs choose one bucket for each 128 MB or so.

    Without a choice there are as many as a shuffle has tasks, for each is sorted by one.
    """
    buckets = buckets or max(BUCKETS, shuffle_tasks(df))
    table = f"days_{uuid.uuid4().hex}"
    return sinks.save_clustered(df, table, shared_dir(spark, "clustered"), keys, buckets)


@query("B6_station_year_clustered", sql.with_views("station_day", sql.period("station_day", "station_id", "year")))
def station_year_clustered(spark, sf):
    """Days lie in buckets by station: they are grouped where they are."""
    days = clustered(spark, adapters.station_days(spark, sf), ["station_id"])
    return flat(periods.period_product(periods.period_state(days, ["station_id"], "year"), ["station_id"], "year"))


@query("B5_monitored_areas_clustered", sql.with_views("area_day", "SELECT * FROM area_day WHERE source = 'monitoring'"))
def monitored_areas_clustered(spark, sf):
    """Days and the bridge to areas lie in the same buckets: they are joined where they are."""
    days = clustered(spark, adapters.supplier_days(spark, sf), ["station_id"])
    bridge = clustered(spark, adapters.station_area(spark, sf), ["station_id"])
    return flat(rollup.area_day_from(days, bridge, "station_id", ["station_id"], "monitoring", 1))


# --- merge by partition -------------------------------------------------------


@query("B22_merge_partitions", """
  SELECT station_id, published_at, event_type, value, publish_date FROM (
    SELECT user_id AS station_id, date_trunc('hour', ts) AS published_at, event_type, value, CAST(ts AS DATE) AS publish_date, 0 AS n FROM events
    UNION ALL
    SELECT user_id, date_trunc('hour', ts), 'late', value + 1, CAST(ts AS DATE), 1 FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13')
  QUALIFY row_number() OVER (PARTITION BY station_id, published_at ORDER BY n DESC, event_type DESC, value DESC) = 1""")
def merge_partitions(spark, sf):
    """A month of hourly values, of which three days come again; the other days are not touched."""
    path = shared_dir(spark, "by-day")
    hours = adapters.table(spark, sf, "events").select(
        F.col("user_id").alias("station_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("published_at"),
        "event_type", "value", F.to_date("ts").alias("publish_date"),
    )
    keys, by = ["station_id", "published_at", "publish_date"], ["publish_date"]
    sinks.merge_partitions(hours, path, keys, "published_at", by)
    late = hours.where("publish_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
    late = late.withColumns({"event_type": F.lit("late"), "value": F.col("value") + 1})
    sinks.merge_partitions(late, path, keys, "published_at", by)
    return spark.read.schema(hours.schema).parquet(path)


# --- scores from stored states ------------------------------------------------


def day_states(spark, pairs, keys, said="f"):
    """States of scores per key and day, kept by month and read back."""
    path = shared_dir(spark, "score-states")
    dated = pairs.withColumn("published_at", F.to_date("published_at"))
    states = score_states.score_state(dated, [*keys, "published_at"], said).withColumns(rollup.period_columns("month"))
    sinks.overwrite_partitions(states, path, MONTH)
    return spark.read.schema(states.schema).parquet(path)


LEAD = ["control_area_id", "forecast_interval"]


@query("B9_grid_score_from_states", ORACLES["B9_grid_forecast_score"])
def grid_score_from_states(spark, sf):
    states = day_states(spark, scoring.grid_pairs(spark, sf), LEAD)
    return scoring.rounded(score_states.scores(score_states.merge_scores(states, LEAD), LEAD))


@query("B10_history_from_states", ORACLES["B10_score_history"])
def history_from_states(spark, sf):
    """Monthly scores and their mean from stored days; no pair is read again."""
    states = day_states(spark, scoring.grid_pairs(spark, sf), LEAD)
    months = [*LEAD, *MONTH]
    monthly = score_states.scores(score_states.merge_scores(states, months), months)
    return scoring.rounded(score.score_history([monthly], LEAD))


@query("B12_inference_score_from_states", ORACLES["B12_inference_score"])
def inference_score_from_states(spark, sf):
    pairs = score.inference_pairs(
        adapters.mobile_samples(spark, sf), scoring.inferred_cells(spark, sf), scoring.listed_cells(spark, sf)
    )
    states = day_states(spark, pairs, ["control_area_id"], "i")
    merged = score_states.merge_scores(states, ["control_area_id"])
    return scoring.rounded(score_states.scores(merged, ["control_area_id"]))


# --- hours as bits ------------------------------------------------------------


@query("J11_missing_by_mask", ORACLES["J11_missing_hours"])
def missing_by_mask(spark, sf):
    actual, cells = cleaning._loaded(spark, sf)
    return completeness.missing_by_mask(completeness.hour_masks(actual), cells, *cleaning._hours())


@query("B21_completeness_by_mask", ORACLES["B21_completeness"])
def completeness_by_mask(spark, sf):
    actual, cells = cleaning._loaded(spark, sf)
    return completeness.completeness_by_mask(completeness.hour_masks(actual), cells, *cleaning._hours())


# --- circles from tiles, tracks in ranges --------------------------------------


@query("J6_radius_by_tiles", ORACLES["J6_radius_pairs"])
def radius_by_tiles(spark, sf):
    return tiles.near_totals(
        places.weather_points(spark, sf), adapters.site_stations(spark, sf), 5000, ["station_id"],
        {"points": "1", "humidity": "humidity"},
    )


@query("B13_features_by_tiles", sql.with_views("truck_feature weather_feature dust_feature earth_feature", """
  SELECT station_id, lon, lat, truck_num, truck_trajectory, earth_num, dust_index, round(rainfall, 6) AS rainfall,
    round(humidity, 6) AS humidity, round(traffic_index, 6) AS traffic_index, round(solar_radiation, 6) AS solar_radiation
  FROM sites LEFT JOIN dust_feature USING (lon, lat) LEFT JOIN earth_feature USING (lon, lat)
  LEFT JOIN truck_feature USING (lon, lat) LEFT JOIN weather_feature USING (lon, lat)"""))
def features_by_tiles(spark, sf):
    stations = adapters.site_stations(spark, sf).drop("station_name")
    near = features.sites(stations)
    means = ["rainfall", "humidity", "traffic_index", "solar_radiation"]
    parts = [
        features.truck_features_by_tile(adapters.truck_points(spark, sf), near),
        features.mean_features_by_tile(places.weather_points(spark, sf), near, means),
        features.sum_feature_by_tile(places.dust_points(spark, sf), near, "dust", "dust_index"),
        features.sum_feature_by_tile(places.waiting_trucks(spark, sf), near, "waiting", "earth_num"),
    ]
    # each part is some hundred tiles a station: stored, so that they are planned one by one
    out = features.station_features(stations, [stored(p, "near") for p in parts])
    return out.withColumns({m: F.round(m, 6) for m in means})


@query("B16_thin_in_ranges", ORACLES["B16_thin_trajectory"])
def thin_in_ranges(spark, sf):
    return spatial.thin_trajectory_in_ranges(places.slow_trucks(spark, sf))


@query("J5_boxes_crowded", sql.with_views("cells points", """
  SELECT l_orderkey, l_linenumber, lon, lat, grid_id FROM points p
  LEFT JOIN (SELECT * FROM cells WHERE grid_scale = 1) c
    ON p.lat > min_lat AND p.lat <= max_lat AND p.lon > min_lon AND p.lon <= max_lon"""))
def boxes_crowded(spark, sf):
    """Tiles four times as wide as a cell, cut wherever more than a hundred points lie."""
    cells = adapters.box_cells(spark, sf).filter("grid_scale = 1")
    return spatial.join_boxes_crowded(adapters.box_points(spark, sf), cells, 20.0, 100)


@query("A13_wind_by_rings", sql.with_views("sites", f"""
  SELECT s.station_id, round(CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(v) FILTER (d = 0)
      ELSE sum(v / nullif(d, 0)) / sum(1 / nullif(d, 0)) END, 2) AS wind_speed, 0 AS wind_error
  FROM (SELECT s.station_id, c.v, pow({sql.metres('s.lon', 's.lat', 'c.lon', 'c.lat')}, 2) AS d
    FROM sites s CROSS JOIN (SELECT CAST(c_custkey % 16 AS DOUBLE) AS v, {sql.place('(c_custkey * 3 + 1)')} FROM customer) c) s
  GROUP BY s.station_id"""))
def wind_by_rings(spark, sf):
    """Every customer a wind station; the rings widen until none is left out."""
    lon, lat = adapters.positions(F.col("c_custkey") * 3 + 1)
    wind = adapters.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("station_name"), lon.alias("lon"), lat.alias("lat"),
        (F.col("c_custkey") % 16).cast("double").alias("wind_speed"),
    )
    out = features.wind_by_rings(adapters.site_stations(spark, sf), wind, tolerance=0.0, first_m=60_000.0, rings=2)
    return out.select("station_id", "wind_speed", "wind_error")


# --- documents of several vendors -----------------------------------------------

LAYOUTS = sorted(WEATHER_FIELDS)
_K = cleaning.K_SQL


def mixed_documents(spark, sf):
    """A document an event, of the layout that its number says; every seventeenth is broken.

    Every third is a single element, the others have two; layouts with odd numbers write
    numbers as text; all carry a key that no layout knows.
    """
    k, event = cleaning.counter(), F.col("event_id")

    def element(number, layout, item):
        fields = []
        for j, (source, target) in enumerate(WEATHER_FIELDS[layout].items()):
            n = k + item + j
            if target in weather.TEXT_FIELDS:
                value = F.when(n % 13 == 0, WEATHER_NO_DATA).otherwise(F.concat(F.lit("T"), n))
            else:
                value = F.when(n % 10 == 0, 999.9).otherwise(n.cast("double"))
                value = value.cast("string") if number % 2 else value
            fields.append(value.alias(source))
        return F.struct(*fields, F.lit("x").alias("unknown_key"))

    body = F.lit(None).cast("string")
    for number, layout in enumerate(LAYOUTS):
        one, two = (element(number, layout, i) for i in (0, 1))
        text = F.when(event % 3 == 0, F.to_json(one)).otherwise(F.to_json(F.array(one, two)))
        body = F.when(event % len(LAYOUTS) == number, text).otherwise(body)
    body = F.when(event % 17 == 0, F.concat(F.lit("{broken"), F.substring(body, 1, 9))).otherwise(body)
    vendor = F.array(*map(F.lit, LAYOUTS))[(event % len(LAYOUTS)).cast("int")]
    landed = adapters.table(spark, sf, "events").select("event_id", vendor.alias("vendor"), body.alias("body"))
    return stored(landed, "documents")


def _mixed_sql():
    targets = {}
    for number, layout in enumerate(LAYOUTS):
        for j, target in enumerate(WEATHER_FIELDS[layout].values()):
            n = f"(k + item + {j})"
            if target in weather.TEXT_FIELDS:
                value = f"CASE WHEN {n} % 13 <> 0 THEN 'T' || {n} END"
            else:
                value = f"CASE WHEN {n} % 10 <> 0 THEN CAST({n} AS DOUBLE) END"
            targets.setdefault(target, []).append(f"WHEN {number} THEN {value}")
    columns = ", ".join(f"CASE event_id % {len(LAYOUTS)} {' '.join(arms)} END AS {t}" for t, arms in targets.items())
    return f"""
  SELECT event_id, CAST(item AS INTEGER) AS item, {columns} FROM
    (SELECT event_id, k, unnest(CASE WHEN event_id % 3 = 0 THEN [0] ELSE [0, 1] END) AS item
     FROM (SELECT event_id, {_K} AS k FROM events WHERE event_id % 17 <> 0))"""


@query("B20_mixed_vendors", _mixed_sql())
def mixed_vendors(spark, sf):
    """Documents of all seven layouts in one pass."""
    good, _ = weather.parsed_documents(mixed_documents(spark, sf), "body")
    flat = weather.flatten_mixed(good, "vendor", ["event_id"])
    return flat.drop("_vendor").withColumnRenamed("_item", "item")


@query("B20_broken_documents", "SELECT event_id FROM events WHERE event_id % 17 = 0")
def broken_documents(spark, sf):
    _, broken = weather.parsed_documents(mixed_documents(spark, sf), "body")
    return broken.select("event_id")
