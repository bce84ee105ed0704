"""Queries: hourly cleaning, daily products, areas, districts, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.operators import conform, hourly, latest, rollup, spatial
from brisa.operators.index import payload, reported, with_index
from brisa.params import (
    CONTROL_AREA_TO_AREA, DISTRICT_CONTROL_AREA, EM_DASH, GRADE_LABELS, INVALID_MARK, PARAMETERS,
    PRIMARY_CODES,
)
from brisa.plans import adapters, sql
from brisa.plans.registry import flat, query

# --- B1: vendor feeds ---------------------------------------------------------

ITEM_FEED = hourly.Feed(
    columns={"station_code": "code", "published_at": "time_text", "pm2_5": "PM25"},
    sentinels=("-", EM_DASH, "0", "0.0"),
    marks=(INVALID_MARK,),
    priority=0,
)
CODE_FEED = hourly.Feed(
    columns={"station_code": "StationCode", "published_at": "TimePoint"},
    scale=1000.0,
    station_prefix="E",
    priority=1,
)


def item_feed(spark, sf):
    """Text feed with every kind of sentinel in it."""
    line = F.col("l_linenumber")

    def text(c):
        return c.cast("int").cast("string")

    r = adapters.item_readings()
    return adapters.table(spark, sf, "lineitem").select(
        F.concat(F.lit("A"), F.col("l_suppkey")).alias("code"),
        F.date_format(adapters.item_stamp(), "yyyy-MM-dd HH:mm:ss").alias("time_text"),
        F.when(line == 7, "-").otherwise(text(r["pm2_5"])).alias("PM25"),
        F.when(line == 6, EM_DASH).otherwise(text(r["pm10"])).alias("pm10"),
        F.when(line == 5, F.concat(text(r["o3"]), F.lit(INVALID_MARK)))
        .otherwise(text(r["o3"])).alias("o3"),
        text(r["co"]).alias("co"),
        text(r["no2"]).alias("no2"),
        text(r["so2"]).alias("so2"),
        (F.col("l_quantity") - 3).cast("int").cast("string").alias("temperature"),
        F.when(line == 4, "-").otherwise(text(F.col("l_tax") * 1000)).alias("humidity"),
        text(F.col("l_partkey") % 360).alias("wind_direction"),
        F.when(line == 2, EM_DASH).otherwise(text(line)).alias("wind_power"),
        F.concat(text(F.col("l_suppkey") + 900), F.lit(".5")).alias("pressure"),
    )


def code_feed(spark, sf):
    """Long feed in mg/m3, pivoted to one row per station and hour."""
    codes = adapters.coded_readings(spark, sf).withColumn(
        "mon_value",
        F.when(F.col("code") == "103", F.col("mon_value")).otherwise(F.col("mon_value") / 1000),
    )
    return conform.pivot_readings(
        codes, ["user_id", "published_at"], "code", "mon_value", adapters.CODE_COLUMNS
    ).withColumnsRenamed({"user_id": "StationCode", "published_at": "TimePoint"})


def station_tags(spark, sf):
    """Stations with their cells: suppliers under both feeds' codes."""
    suppliers = adapters.table(spark, sf, "supplier")
    stations = suppliers.select(
        F.col("s_suppkey").alias("station_id"),
        F.explode(
            F.array(
                F.concat(F.lit("A"), F.col("s_suppkey")), F.concat(F.lit("E"), F.col("s_suppkey"))
            )
        ).alias("station_code"),
    )
    bridge = suppliers.select(
        F.col("s_suppkey").alias("station_id"),
        F.explode(
            F.array(
                F.col("s_suppkey") % 100,
                F.when(F.col("s_acctbal") > 0, F.lit(100) + F.col("s_suppkey") % 25),
            )
        ).alias("grid_id"),
    )
    cell = F.col("p_partkey") % 125
    cells = (
        adapters.table(spark, sf, "part")
        .select(cell.alias("grid_id"), F.when(cell < 100, 1).otherwise(2).alias("grid_scale"))
        .distinct()
    )
    return spatial.station_grid(stations, bridge, cells)


sql.view("station_tags", """
  SELECT station_id, code || station_id AS station_code, grid_id, grid_id_two FROM
    (SELECT s_suppkey AS station_id, s_suppkey % 100 AS g1,
       CASE WHEN s_acctbal > 0 THEN 100 + s_suppkey % 25 END AS g2 FROM supplier)
    LEFT JOIN (SELECT DISTINCT p_partkey % 125 AS grid_id FROM part WHERE p_partkey % 125 < 100) ON grid_id = g1
    LEFT JOIN (SELECT DISTINCT p_partkey % 125 AS grid_id_two FROM part WHERE p_partkey % 125 >= 100) ON grid_id_two = g2
    CROSS JOIN (VALUES ('A'), ('E')) v(code)""")

WEATHER_NAMES = ", ".join(hourly.WEATHER)

sql.view("feeds", f"""
  SELECT 'A' || l_suppkey AS station_code, l_shipdate + to_hours(CAST(l_orderkey % 24 + 1 AS INTEGER)) AS published_at,
    CASE WHEN l_linenumber <> 7 THEN pm2_5 END AS pm2_5, CASE WHEN l_linenumber <> 6 THEN pm10 END AS pm10,
    CASE WHEN l_linenumber <> 5 THEN o3 END AS o3, nullif(co, 0) AS co, no2, nullif(so2, 0) AS so2, 0 AS prio,
    CASE WHEN l_quantity > 3 THEN l_quantity - 3 END AS temperature,
    CASE WHEN l_linenumber <> 4 THEN CAST(nullif(floor(l_tax * 1000), 0) AS DOUBLE) END AS humidity,
    CAST(nullif(l_partkey % 360, 0) AS DOUBLE) AS wind_direction, CASE WHEN l_linenumber <> 2 THEN CAST(l_linenumber AS DOUBLE) END AS wind_power,
    l_suppkey + 900.5::DOUBLE AS pressure
  FROM (SELECT *, {sql.READINGS} FROM lineitem)
  UNION ALL
  SELECT 'E' || user_id, published_at, pm2_5 / 1000 * 1000.0::DOUBLE, pm10 / 1000 * 1000.0::DOUBLE, o3 / 1000 * 1000.0::DOUBLE,
    co, no2 / 1000 * 1000.0::DOUBLE, so2 / 1000 * 1000.0::DOUBLE, 1, NULL, NULL, NULL, NULL, NULL
  FROM (SELECT user_id, published_at, {sql.PIVOT} FROM eav GROUP BY user_id, published_at)""", "eav")

sql.view("clean_hour", f"""
  SELECT station_code, published_at, station_id, grid_id, grid_id_two, {sql.each('@')}, {WEATHER_NAMES} FROM
    (SELECT *, row_number() OVER (PARTITION BY station_code, published_at ORDER BY prio,
       {sql.each('@ DESC NULLS LAST')}, {', '.join(f'{w} DESC NULLS LAST' for w in hourly.WEATHER)}) AS rn FROM feeds WHERE coalesce({sql.each('@')}) IS NOT NULL)
  JOIN station_tags USING (station_code) WHERE rn = 1""", "feeds", "station_tags")


@query("B1_clean_hourly", sql.with_views("clean_hour", f"""
  SELECT station_code, published_at, station_id, grid_id, grid_id_two, {sql.reports()}, {WEATHER_NAMES}, {sql.INDEX_COLUMNS}
  FROM {sql.indexed('clean_hour', 'hour')}"""))
def clean_hourly(spark, sf):
    feeds = [(item_feed(spark, sf), ITEM_FEED), (code_feed(spark, sf), CODE_FEED)]
    return flat(hourly.clean_hourly(feeds, station_tags(spark, sf)))


@query("B15_station_grid", sql.with_views("station_tags", "SELECT * FROM station_tags"))
def station_grid(spark, sf):
    return station_tags(spark, sf)


@query("A15_pivot_codes", sql.with_views("sensor_hour", "SELECT * FROM sensor_hour"))
def pivot_codes(spark, sf):
    return adapters.sensor_hours(spark, sf)


def graded_feed(spark, sf):
    """Readings that come with their index: text, dashes for missing values."""
    line = F.col("l_linenumber")
    r = adapters.item_readings()

    def text(c):
        return c.cast("int").cast("string")

    return adapters.table(spark, sf, "lineitem").select(
        F.concat(F.lit("C"), F.col("l_suppkey")).alias("code_map"),
        adapters.item_stamp().alias("published_at"),
        *[F.when(line == 7, EM_DASH).otherwise(text(r[p])).alias(p) for p in PARAMETERS],
        *[F.when(line == 6, EM_DASH).otherwise(text(r[p])).alias(f"{p}_iaqi") for p in PARAMETERS],
        F.when(line == 5, EM_DASH).otherwise(text(r["pm10"])).alias("aqi"),
        F.when(line != 4, "level").alias("grade"),
        F.when(line == 3, EM_DASH).when(line == 2, "PM2.5,O3").otherwise("NO2").alias("primary_pollutants"),
    )


_GRADED = f"""
  SELECT 'A' || l_suppkey AS station_code, published_at, {sql.each('CAST(@ AS INTEGER) AS @').replace('CAST(co AS INTEGER)', 'CAST(co AS DOUBLE)')},
    {sql.each('CASE WHEN l_linenumber <> 6 THEN CAST(@ AS INTEGER) END AS @_iaqi')},
    CASE WHEN l_linenumber <> 5 THEN CAST(pm10 AS INTEGER) END AS aqi,
    CASE WHEN l_linenumber = 4 THEN NULL ELSE {sql.grade('CASE WHEN l_linenumber <> 5 THEN pm10 END')} END AS grade,
    CASE l_linenumber WHEN 3 THEN '' WHEN 2 THEN 'pm2_5,o3' ELSE 'no2' END AS primary_pollutants
  FROM (SELECT *, @STAMP@ AS published_at, {sql.READINGS} FROM lineitem) WHERE l_linenumber <> 7
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, published_at ORDER BY {sql.each('@ DESC NULLS LAST')}, aqi DESC NULLS LAST) = 1"""
_STAMPS = {
    "hour": "l_shipdate + to_hours(CAST(l_orderkey % 24 + 1 AS INTEGER))",
    "day": "CAST(l_shipdate + to_hours(CAST(l_orderkey % 24 + 1 AS INTEGER)) AS DATE)",
}

for _unit in ("hour", "day"):

    @query(f"B{1 if _unit == 'hour' else 2}_official_{_unit}", sql.with_views("station_tags", f"""
      SELECT station_code, published_at, {sql.each('@')}, {sql.INDEX_COLUMNS}, station_id, grid_id, grid_id_two
      FROM ({_GRADED.replace('@STAMP@', _STAMPS[_unit])}) JOIN station_tags USING (station_code)"""))
    def official(spark, sf, unit=_unit):
        codes = adapters.table(spark, sf, "supplier").select(
            F.concat(F.lit("C"), F.col("s_suppkey")).alias("code_map"),
            F.concat(F.lit("A"), F.col("s_suppkey")).alias("station_code"),
        )
        return flat(hourly.official_readings(graded_feed(spark, sf), codes, station_tags(spark, sf), unit))


# --- B2, B3: daily products ---------------------------------------------------


@query("B2_station_day", sql.with_views("sensor_day", "SELECT * FROM sensor_day"))
def station_day(spark, sf):
    return flat(rollup.station_day(adapters.sensor_hours(spark, sf)))


@query("B2_station_day_sparse", sql.with_views("supplier_day", "SELECT * FROM supplier_day"))
def station_day_sparse(spark, sf):
    return flat(adapters.supplier_days(spark, sf))


@query("B3_grid_day", sql.with_views("grid_day", "SELECT * FROM grid_day"))
def grid_day(spark, sf):
    return flat(adapters.grid_days(spark, sf))


@query("W2_eight_hour_by_clock", sql.with_views("sensor_hour", f"""
  SELECT station_id, published_at, {sql.reports()}, {sql.each('@_hours')}
  FROM ({sql.day_profile('station_id', 'sensor_hour', 'RANGE')})"""))
def eight_hour_by_clock(spark, sf):
    return reported(rollup.day_profile(adapters.sensor_hours(spark, sf), ["station_id"], "range"))


@query("A1_hour_index", sql.with_views("station_hour", f"""
  SELECT station_id, published_at, {sql.reports()}, {sql.INDEX_COLUMNS}
  FROM {sql.indexed('station_hour', 'hour')}"""))
def hour_index(spark, sf):
    return flat(reported(with_index(adapters.station_hours(spark, sf), "hour")))


@query("D6_json_payload", sql.with_views("sensor_day", """
  SELECT station_id, published_at, aqi, grade, pm2_5, so2_flag FROM sensor_day"""))
def json_payload(spark, sf):
    """Pack the daily product into its JSON payload and read it back."""
    day = rollup.station_day(adapters.sensor_hours(spark, sf))
    packed = payload(day, ["station_id", "published_at"])
    data = F.from_json("data", "aqi bigint, grade int, pm2_5 int, so2_flag int")
    return packed.select("station_id", "published_at", data.alias("d")).select(
        "station_id", "published_at", "d.*"
    )


# --- B4, B5: areas ------------------------------------------------------------

sql.view("area_hour", f"""
  SELECT area_id, published_at, {sql.MEANS}, 'monitoring' AS source
  FROM supplier_hour JOIN station_area USING (station_id) GROUP BY area_id, published_at
  UNION ALL
  SELECT area_id, published_at, {sql.MEANS}, 'inference'
  FROM grid_hour JOIN grid_area USING (grid_id, control_area_id) GROUP BY area_id, published_at""",
  "supplier_hour", "grid_hour", "station_area", "grid_area")


@query("B4_area_hour", sql.with_views("area_hour", f"""
  SELECT area_id, published_at, {sql.reports()}, {sql.INDEX_COLUMNS}, source
  FROM {sql.indexed('area_hour', 'hour')}"""))
def area_hour(spark, sf):
    stations = adapters.supplier_hours(spark, sf)
    monitored = rollup.area_hour(
        stations, adapters.station_area(spark, sf), ["station_id"], "monitoring"
    )
    inferred = rollup.area_hour(
        adapters.grid_hours(spark, sf), adapters.grid_area(spark, sf),
        ["grid_id", "control_area_id"], "inference",
    )
    return flat(monitored.unionByName(inferred))


def _area_day_sql(day: str, bridge: str, on: str, member: str, source: str, digits: int) -> str:
    share = sql.decimal_round("(present::DOUBLE / members)", digits)
    return f"""SELECT area_id, published_at, {sql.each('@')}, {sql.INDEX_COLUMNS},
      {sql.FLAGS_PRESENT}, valid, '{source}' AS source FROM (
      SELECT area_id, published_at, {sql.reports()}, {sql.INDEX_COLUMNS},
        CASE WHEN (members < 4 AND {share} < 0.5) OR (members >= 4 AND {share} < 0.75) THEN 0 ELSE 1 END AS valid
      FROM {sql.indexed(f'''(SELECT area_id, published_at, {sql.MEANS}, count(*) AS present, any_value(members) AS members
        FROM {day} JOIN {bridge} USING ({on})
        JOIN (SELECT area_id, count(*) AS members FROM {bridge} GROUP BY area_id) USING (area_id)
        GROUP BY area_id, published_at)''', 'day')})"""


sql.view("area_day", f"""
  {_area_day_sql('supplier_day', 'station_area', 'station_id', 'station_id', 'monitoring', 1)}
  UNION ALL
  {_area_day_sql('grid_day', 'grid_area', 'grid_id, control_area_id', 'grid_id', 'inference', 2)}
  UNION ALL
  SELECT CASE control_area_id WHEN 5 THEN 60373 WHEN 7 THEN 60359 END AS area_id, published_at,
    {sql.each('@')}, {sql.INDEX_COLUMNS}, {sql.each('@_flag')}, NULL AS valid, 'inference' AS source
  FROM district_day""", "supplier_day", "grid_day", "station_area", "grid_area", "district_day")


def area_days(spark, sf):
    districts = rollup.district_rollup(adapters.grid_days(spark, sf), "day")
    return rollup.area_day(
        adapters.supplier_days(spark, sf), adapters.station_area(spark, sf),
        adapters.grid_days(spark, sf), adapters.grid_area(spark, sf),
        rollup.district_as_area(districts, CONTROL_AREA_TO_AREA),
    )


@query("B5_area_day", sql.with_views("area_day", "SELECT * FROM area_day"))
def area_day(spark, sf):
    return flat(area_days(spark, sf))


# --- B6: periods --------------------------------------------------------------

for _period in ("week", "month", "quarter", "year"):

    @query(f"B6_station_{_period}", sql.with_views("station_day", sql.period("station_day", "station_id", _period)))
    def station_period(spark, sf, period=_period):
        return flat(rollup.period_rollup(adapters.station_days(spark, sf), ["station_id"], period))


@query("B6_grid_month", sql.with_views("grid_day", sql.period("grid_day", "grid_id, control_area_id", "month")))
def grid_month(spark, sf):
    return flat(
        rollup.period_rollup(adapters.grid_days(spark, sf), ["grid_id", "control_area_id"], "month")
    )


for _period in ("month", "year"):

    @query(f"B6_area_{_period}", sql.with_views("area_day", sql.period("area_day", "area_id, source", _period)))
    def area_period(spark, sf, period=_period):
        return flat(rollup.period_rollup(area_days(spark, sf), ["area_id", "source"], period))


# --- B7: districts ------------------------------------------------------------


@query("B7_district_hour", sql.with_views("grid_hour", sql.district("grid_hour", "hour")))
def district_hour(spark, sf):
    return flat(rollup.district_rollup(adapters.grid_hours(spark, sf), "hour"))


#: Half the cells read far above the last breakpoint of every parameter.
_ABOVE = sql.each("CASE WHEN grid_id % 2 = 0 THEN @ * 40 ELSE @ END AS @")

for _level in ("hour", "day"):

    @query(f"B7_district_out_of_range_{_level}", sql.with_views("grid_hour", sql.district(
        f"(SELECT grid_id, control_area_id, published_at, {_ABOVE} FROM grid_hour)", _level)))
    def district_out_of_range(spark, sf, level=_level):
        high = adapters.grid_hours(spark, sf).withColumns(
            {p: F.when(F.col("grid_id") % 2 == 0, F.col(p) * 40).otherwise(F.col(p)) for p in PARAMETERS}
        )
        return flat(rollup.district_rollup(high, level))


@query("B7_district_day", sql.with_views("district_day", "SELECT * FROM district_day"))
def district_day(spark, sf):
    return flat(rollup.district_rollup(adapters.grid_days(spark, sf), "day"))


for _period in ("month", "year"):

    @query(f"B7_district_{_period}", sql.with_views("district_day", sql.district_period("district_day", _period)))
    def district_period(spark, sf, period=_period):
        days = rollup.district_rollup(adapters.grid_days(spark, sf), "day")
        return flat(rollup.district_period(days, period))


@query("B7_days_by_grade", sql.with_views("district_day", f"""
  SELECT control_area_id, {sql.PERIOD_KEYS['month']}, count(*) FILTER (grade IN (1, 2)) AS excellent_good,
    count(*) FILTER (grade = 1) AS excellent, count(*) FILTER (grade = 2) AS good,
    count(*) FILTER (grade = 3) AS mild, count(*) FILTER (grade = 4) AS middle,
    count(*) FILTER (grade = 5) AS severe, count(*) FILTER (grade = 6) AS very_severe
  FROM (SELECT *, {sql.period_ids('month')} FROM district_day)
  GROUP BY control_area_id, {sql.PERIOD_KEYS['month']}"""))
def days_by_grade(spark, sf):
    days = rollup.district_rollup(adapters.grid_days(spark, sf), "day")
    return rollup.days_by_grade(days, ["control_area_id"], "month")


_CODES = list(DISTRICT_CONTROL_AREA) + ["510999"]
_LABELS = list(GRADE_LABELS) + ["—"]


@query("B7_official_district", f"""
  SELECT CAST(CASE CAST(l_suppkey % 15 AS INTEGER) {' '.join(f"WHEN {i} THEN {DISTRICT_CONTROL_AREA.get(c, 0)}" for i, c in enumerate(_CODES))} END AS INTEGER) AS control_area_id,
    l_shipdate AS published_at, CAST(l_quantity * 4 AS INTEGER) AS pm2_5, CAST(l_quantity * 6 AS INTEGER) AS pm10,
    CAST(floor(l_extendedprice / 200) AS INTEGER) AS o3, CASE WHEN l_linenumber < 7 THEN round(l_tax * 100) END AS co,
    CAST(l_quantity * 2 + l_linenumber AS INTEGER) AS no2, CAST(round(l_discount * 1000) AS INTEGER) AS so2,
    CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity * 4 AS INTEGER) END AS aqi, CAST(l_linenumber AS INTEGER) AS grade,
    CASE l_returnflag WHEN 'A' THEN 'pm2_5,o3' WHEN 'N' THEN '' ELSE 'pm10,no2,so2,co' END AS primary_pollutants,
    'monitoring' AS source
  FROM lineitem WHERE l_linenumber < 7""")
def official_district(spark, sf):
    r = adapters.item_readings()
    index = F.col("l_linenumber") - 1
    feed = adapters.table(spark, sf, "lineitem").select(
        F.array(*map(F.lit, _CODES))[(F.col("l_suppkey") % 15).cast("int")].alias("district_code"),
        F.col("l_shipdate").alias("published_at"),
        *[r[p].cast("int").cast("string").alias(p) for p in PARAMETERS],
        F.when(F.col("l_linenumber") == 3, EM_DASH)
        .otherwise(r["pm2_5"].cast("int").cast("string")).alias("aqi"),
        F.array(*map(F.lit, _LABELS))[index].alias("grade_label"),
        F.when(F.col("l_returnflag") == "A", "PM25,O3")
        .when(F.col("l_returnflag") == "N", "—")
        .otherwise("PM10,NO2,H2S,SO2,CO").alias("primary_pollutant"),
    )
    return flat(
        conform.official_districts(feed, DISTRICT_CONTROL_AREA, GRADE_LABELS, PRIMARY_CODES)
    )


# --- B17, B22: keyed tables ---------------------------------------------------


@query("B17_latest_per_key", """
  SELECT user_id, event_id, ts, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_user(spark, sf):
    events = adapters.table(spark, sf, "events").select(
        "user_id", "event_id", "ts", "event_type", "value"
    )
    return latest.latest_per_key(events, ["user_id"], "ts", ["event_id"])


@query("O3_latest_value", """
  SELECT event_type, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events GROUP BY event_type""")
def latest_value(spark, sf):
    moment = F.struct("ts", "event_id")
    return adapters.table(spark, sf, "events").groupBy("event_type").agg(
        F.max_by("value", moment).alias("value"), F.max("ts").alias("ts")
    )


def _stored(spark, sf):
    """Keyed target (customers' cards) and updates (their orders)."""
    target = adapters.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"),
        F.make_timestamp_ntz(
            F.lit(1995) + (F.col("c_custkey") % 8).cast("int"), F.lit(1), F.lit(1),
            F.lit(0), F.lit(0), F.lit(0.0),
        ).alias("seen_at"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("amount"),
    )
    updates = adapters.table(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).alias("key"),
        F.col("o_orderdate").alias("seen_at"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_totalprice").alias("amount"),
    )
    return target, updates


sql.view("stored", """
  SELECT c_custkey AS key, make_timestamp(1995 + c_custkey % 8, 1, 1, 0, 0, 0) AS seen_at,
    c_mktsegment AS segment, c_acctbal AS amount FROM customer""")
sql.view("fresh", """
  SELECT * FROM (SELECT o_custkey * 2 AS key, o_orderdate AS seen_at, o_orderpriority AS segment, o_totalprice AS amount FROM orders)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY seen_at DESC, amount DESC, segment DESC) = 1""")


@query("B22_merge_latest", sql.with_views("stored", """
  SELECT key, seen_at, segment, amount FROM (SELECT *, 0 AS n FROM stored UNION ALL
    SELECT o_custkey * 2, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP), o_orderpriority, o_totalprice, 1 FROM orders)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY seen_at DESC, n DESC, segment DESC, amount DESC) = 1"""))
def merge_latest(spark, sf):
    """Updates stamped by month, so that many of a key share a time."""
    target, updates = _stored(spark, sf)
    monthly = updates.withColumn("seen_at", F.date_trunc("month", "seen_at").cast("timestamp_ntz"))
    return latest.merge_latest(target, monthly, ["key"], "seen_at")


@query("S12_merge_some_columns", sql.with_views("stored fresh", """
  SELECT coalesce(s.key, f.key) AS key,
    CASE WHEN f.key IS NOT NULL AND (s.key IS NULL OR f.seen_at >= s.seen_at) THEN f.seen_at ELSE s.seen_at END AS seen_at,
    CASE WHEN s.key IS NOT NULL THEN s.segment ELSE f.segment END AS segment,
    CASE WHEN f.key IS NOT NULL AND (s.key IS NULL OR f.seen_at >= s.seen_at) THEN f.amount ELSE s.amount END AS amount
  FROM stored s FULL JOIN fresh f ON s.key = f.key"""))
def merge_some_columns(spark, sf):
    target, updates = _stored(spark, sf)
    return latest.merge_latest(target, updates, ["key"], "seen_at", update_cols=["amount"])


@query("C13_dedup_on_key", """
  SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_quantity DESC, l_extendedprice) = 1""")
def dedup_on_key(spark, sf):
    rows = adapters.table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    order = [F.col("l_quantity").desc(), F.col("l_extendedprice").asc()]
    return latest.first_per_key(rows, ["l_suppkey", "l_shipdate"], order)
