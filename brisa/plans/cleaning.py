"""Queries: cleaning expressions, index expressions, time windows, JSON feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.functions import air, clean, times
from brisa.functions.register import register
from brisa.operators import completeness, conform, weather
from brisa.operators.index import parameter_means, with_index
from brisa.params import (
    CONTROL_AREA_TO_AREA, EM_DASH, GRADE_LABELS, INVALID_MARK, PARAMETERS, PRIMARY_CODES,
    WEATHER_FIELDS, WEATHER_NO_DATA, WEATHER_SENTINELS,
)
from brisa.plans import adapters, sql
from brisa.plans.registry import query

K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"



def counter():
    """The number inside an event's JSON text."""
    return F.get_json_object("props", "$.k").cast("int")


# --- C: cleaning --------------------------------------------------------------


def dirty(spark, sf):
    """Event values as vendor text: every tenth counter value is some filler."""
    whole = F.floor("value").cast("string")
    tenth = counter() % 10
    text = (
        F.when(tenth == 0, "-")
        .when(tenth == 1, EM_DASH)
        .when(tenth == 2, "0")
        .when(tenth == 3, "0.0")
        .when(tenth == 4, F.concat(whole, F.lit(INVALID_MARK)))
        .when(tenth == 5, "null")
        .when(tenth == 6, F.lit(None).cast("string"))
        .otherwise(whole)
    )
    return adapters.table(spark, sf, "events").select(
        "event_id", text.alias("text"), (counter() % 10).alias("tenth"), "value"
    )


@query("C1_C3_C7_sentinels", f"""
  SELECT event_id, CASE WHEN t NOT IN (0, 1, 2, 3, 4, 6) THEN CASE WHEN t = 5 THEN 'null' ELSE nullif(v, '0') END END AS cleaned,
    CASE WHEN t IN (2, 3) THEN 0 WHEN t >= 7 THEN CAST(v AS DOUBLE) END AS number,
    CASE WHEN t = 2 THEN '0' WHEN t = 3 THEN '0.0' WHEN t = 4 THEN v || '(H)' WHEN t >= 7 THEN v END AS digits
  FROM (SELECT event_id, {K_SQL} % 10 AS t, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS v FROM events)""")
def sentinels(spark, sf):
    text = F.col("text")
    return dirty(spark, sf).select(
        "event_id",
        clean.blank_sentinels(text, ["-", EM_DASH, "0", "0.0"], [INVALID_MARK]).alias("cleaned"),
        clean.to_number(clean.blank_sentinels(text, ["-", EM_DASH])).alias("number"),
        clean.numeric_text(text).alias("digits"),
    )


@query("C4_weather_fillers", f"""
  SELECT event_id, CASE WHEN k % 4 >= 2 THEN floor(value) END AS temp FROM
    (SELECT event_id, value, {K_SQL} AS k FROM events)""")
def weather_fillers(spark, sf):
    filled = F.when(counter() % 4 == 0, 999.9).when(counter() % 4 == 1, 999999.0).otherwise(
        F.floor("value").cast("double")
    )
    return adapters.table(spark, sf, "events").select(
        "event_id", clean.blank_numbers(filled, WEATHER_SENTINELS).alias("temp")
    )


@query("C5_zero_if_missing", f"""
  SELECT event_id, CASE WHEN t IN (2, 5, 6) THEN '0' WHEN t = 0 THEN '-' WHEN t = 1 THEN '—' WHEN t = 3 THEN '0.0'
    WHEN t = 4 THEN v || '(H)' ELSE v END AS filled
  FROM (SELECT event_id, {K_SQL} % 10 AS t, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS v FROM events)""")
def zero_if_missing(spark, sf):
    return dirty(spark, sf).select("event_id", clean.zero_if_missing(F.col("text")).alias("filled"))


@query("C6_drop_empty_rows", sql.with_views("sensor_hour", f"""
  SELECT station_id, published_at, CAST({sql.each('@ IS NOT NULL', ' AND ')} AS INTEGER) AS complete
  FROM sensor_hour WHERE coalesce({sql.each('@')}) IS NOT NULL"""))
def drop_empty_rows(spark, sf):
    hours = adapters.sensor_hours(spark, sf).dropna("all", subset=list(PARAMETERS))
    present = [F.col(p).isNotNull().cast("int") for p in PARAMETERS]
    return hours.select("station_id", "published_at", F.least(*present).alias("complete"))


@query("C8_pollutant_names", f"""
  SELECT event_id, CASE event_type WHEN 'click' THEN 'pm2_5,o3' WHEN 'view' THEN 'pm2_5' WHEN 'error' THEN NULL
      WHEN 'signup' THEN 'no2' ELSE 'pm10,so2' END AS names,
    CASE event_type WHEN 'click' THEN 'pm2_5,o3' WHEN 'view' THEN '' WHEN 'error' THEN '' WHEN 'signup' THEN 'no2'
      ELSE 'pm10,so2' END AS codes
  FROM events""")
def pollutant_names(spark, sf):
    names = {"click": "PM2.5,O3", "view": "PM25", "error": "—", "signup": "NO2", "purchase": "PM10,SO2"}
    codes = {"click": "PM25,O3", "view": "H2S", "error": "—", "signup": "NO2", "purchase": "PM10,XX,SO2"}
    event = F.col("event_type")
    return adapters.table(spark, sf, "events").select(
        "event_id",
        F.array_join(air.pollutant_list(adapters.lookup(names, event)), ",").alias("names"),
        F.array_join(air.pollutant_codes(adapters.lookup(codes, event), PRIMARY_CODES), ",").alias("codes"),
    )


@query("C11_C12_time_floor", """
  SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('minute', ts) AS minute, CAST(ts AS DATE) AS day,
    date_trunc('second', ts) AS from_epoch FROM events""")
def time_floor(spark, sf):
    ts = F.col("ts").cast("timestamp_ntz")
    seconds = F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return adapters.table(spark, sf, "events").select(
        "event_id",
        times.floor_hour(ts).alias("hour"),
        times.floor_minute(ts).alias("minute"),
        F.to_date("ts").alias("day"),
        clean.epoch_to_timestamp(seconds).cast("timestamp_ntz").alias("from_epoch"),
    )


@query("C14_C15_code_lookup", f"""
  SELECT l_suppkey, l_partkey, CASE CAST(l_suppkey % 26 AS INTEGER) {' '.join(f'WHEN {k} THEN {v}' for k, v in CONTROL_AREA_TO_AREA.items())} END AS area_id,
    CASE WHEN l_linenumber <= 6 THEN l_linenumber ELSE -99 END AS grade FROM lineitem""")
def code_lookup(spark, sf):
    labels = F.array(*[F.lit(x) for x in (*GRADE_LABELS, "暂无")])
    return adapters.table(spark, sf, "lineitem").select(
        "l_suppkey",
        "l_partkey",
        clean.coded((F.col("l_suppkey") % 26).cast("int"), CONTROL_AREA_TO_AREA).alias("area_id"),
        clean.coded(labels[F.col("l_linenumber") - 1], GRADE_LABELS, -99).alias("grade"),
    )


@query("C16_published_rounding", f"""
  SELECT l_orderkey, l_partkey, {sql.report('pm2_5', 'l_extendedprice / 256')} AS pm2_5,
    {sql.report('co', 'l_extendedprice / 2048')} AS co FROM lineitem""")
def published_rounding(spark, sf):
    return adapters.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        air.reported("(l_extendedprice / 256)", "pm2_5").alias("pm2_5"),
        air.reported("(l_extendedprice / 2048)", "co").alias("co"),
    )


@query("C18_month_window", """
  SELECT l_suppkey, count(*) AS n FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01'
    AND l_suppkey NOT IN (3, 5, 8) AND l_linenumber BETWEEN 2 AND 5 GROUP BY l_suppkey""")
def month_window(spark, sf):
    """Month, id list and range predicates; all of them reach the scan."""
    start = F.lit("1998-03-01").cast("timestamp_ntz")
    end = F.lit("1998-04-01").cast("timestamp_ntz")
    return (
        adapters.table(spark, sf, "lineitem")
        .filter((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
        .filter(~F.col("l_suppkey").isin(3, 5, 8) & F.col("l_linenumber").between(2, 5))
        .groupBy("l_suppkey")
        .agg(F.count("*").alias("n"))
    )


@query("C19_json_fields", f"""
  SELECT event_type, CAST(sum({K_SQL}) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY event_type""")
def json_fields(spark, sf):
    picked = conform.pick_json(F.col("props"), {"k": "counter"}, "bigint")
    events = adapters.table(spark, sf, "events").select(
        "event_type", *[c.alias(n) for n, c in picked.items()]
    )
    return events.groupBy("event_type").agg(
        F.sum("counter").alias("total"), F.count("*").alias("n")
    )


@query("C21_json_code_map", f"""
  SELECT event_id, floor(value) AS a, CASE WHEN k % 2 = 0 THEN CAST(k AS DOUBLE) END AS b
  FROM (SELECT event_id, value, event_type, {K_SQL} AS k FROM events) WHERE event_type <> 'error'""")
def json_code_map(spark, sf):
    """Coded readings of one document as a map; documents without any drop out."""

    def item(code, kind, value):
        return F.struct(
            F.lit(code).alias("LHCodeID"), kind.alias("ValueTypeID"),
            value.cast("double").alias("DataValue"),
        )

    broken = F.col("event_type") == "error"
    average = F.when(broken, "Max").otherwise("Avg")
    docs = adapters.table(spark, sf, "events").select(
        "event_id",
        F.to_json(
            F.array(
                item("a", F.lit("Min"), F.lit(-1)),
                item("a", average, F.floor("value")),
                item("b", F.when((counter() % 2 == 0) & ~broken, "Avg").otherwise("Max"), counter()),
            )
        ).alias("body"),
    )
    mapped = weather.map_coded_readings(docs, "body", ["event_id"])
    return mapped.select("event_id", F.col("data")["a"].alias("a"), F.try_element_at("data", F.lit("b")).alias("b"))


@query("C22_C23_digits_and_prefix", """
  SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, '510107' || c_custkey AS code FROM customer""")
def digits_and_prefix(spark, sf):
    return adapters.table(spark, sf, "customer").select(
        "c_custkey",
        clean.digits_only(F.col("c_name")).alias("digits"),
        clean.prefixed(F.col("c_custkey").cast("string"), "510107").alias("code"),
    )


@query("B18_conform", """
  SELECT CAST(c_custkey AS INTEGER) AS gridid, c_name AS stationid, c_acctbal AS pm10,
    TRY_CAST(regexp_replace(c_name, 'Customer#', '') AS BIGINT) AS number, CAST(NULL AS INTEGER) AS noise,
    TRY_CAST(c_mktsegment AS DOUBLE) AS status FROM customer""")
def conform_table(spark, sf):
    layout = {
        "gridid": ("c_custkey", "int"),
        "stationid": ("c_name", "string"),
        "pm10": ("c_acctbal", "double"),
        "number": (F.regexp_replace("c_name", "Customer#", ""), "bigint"),
        "noise": (None, "int"),
        "status": ("c_mktsegment", "double"),
    }
    return conform.conform(adapters.table(spark, sf, "customer"), layout)


@query("C9_C10_unit_and_layout", sql.with_views("eav", f"""
  SELECT * FROM (SELECT user_id, published_at, {sql.each('CASE WHEN @ IS NOT NULL THEN @ END AS @')} FROM
    (SELECT user_id, published_at, max(mon_value) FILTER (code = '105') * 1000 AS pm2_5, max(mon_value) FILTER (code = '104') * 1000 AS pm10,
       max(mon_value) FILTER (code = '102') * 1000 AS o3, max(mon_value) FILTER (code = '103') AS co,
       max(mon_value) FILTER (code = '101') * 1000 AS no2, max(mon_value) FILTER (code = '100') * 1000 AS so2
     FROM eav GROUP BY user_id, published_at))"""))
def unit_and_layout(spark, sf):
    wide = conform.pivot_readings(
        adapters.coded_readings(spark, sf), ["user_id", "published_at"], "code", "mon_value",
        adapters.CODE_COLUMNS,
    )
    return wide.withColumns({p: F.col(p) * 1000 for p in PARAMETERS if p != "co"})


# --- B20: weather documents ---------------------------------------------------


@query("B20_flatten_weather", f"""
  SELECT user_id, published_at, forecast_at, temp, rainfall, wind_direction, humidity FROM (
    SELECT user_id, ts AS published_at, event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS forecast_at,
      CASE WHEN k % 5 <> 0 THEN CAST(k AS DOUBLE) END AS temp, CASE WHEN k % 7 <> 0 THEN floor(value) END AS rainfall,
      CASE WHEN event_type <> 'error' THEN event_type END AS wind_direction, CAST(k AS DOUBLE) AS humidity
    FROM (SELECT *, {K_SQL} AS k FROM events)
    UNION ALL
    SELECT user_id, ts, event_id, strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S'), CAST(k AS DOUBLE) + 1, 0,
      event_type, NULL FROM (SELECT *, {K_SQL} AS k FROM events))""")
def flatten_weather(spark, sf):
    fields = WEATHER_FIELDS["grid_forecast_hour"]

    def at(hours):
        moment = times.floor_hour(F.col("ts")) + F.make_dt_interval(hours=F.lit(hours))
        return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")

    def text(c):
        return c.cast("string")

    first = F.struct(
        at(0).alias("data_time"),
        F.when(counter() % 5 == 0, "999.9").otherwise(text(counter())).alias("temp_fc"),
        F.when(counter() % 7 == 0, "999999").otherwise(text(F.floor("value"))).alias("prec_1h"),
        F.when(F.col("event_type") == "error", WEATHER_NO_DATA).otherwise(F.col("event_type")).alias("wind_dir"),
        text(counter()).alias("rh"),
    )
    second = F.struct(
        at(1).alias("data_time"), text(counter() + 1).alias("temp_fc"), F.lit("0").alias("prec_1h"),
        F.col("event_type").alias("wind_dir"), F.lit("").alias("rh"),
    )
    docs = adapters.table(spark, sf, "events").select(
        "user_id", F.col("ts").alias("published_at"), F.to_json(F.array(first, second)).alias("body")
    )
    flat = weather.flatten_weather(
        docs, "body", fields, ["temp", "rainfall", "humidity"], ["user_id", "published_at"]
    )
    return flat.select(
        "user_id", "published_at", "forecast_at", "temp", "rainfall", "wind_direction", "humidity"
    )


@query("S8_S9_json_documents", f"""
  SELECT event_id, event_type AS station_code, CAST({K_SQL} AS DOUBLE) AS pm2_5 FROM events
  UNION ALL SELECT event_id, 'second', floor(value) FROM events""")
def json_documents(spark, sf):
    docs = adapters.table(spark, sf, "events").select(
        "event_id",
        F.to_json(
            F.array(
                F.struct(F.col("event_type").alias("station_code"), counter().cast("double").alias("pm2_5")),
                F.struct(F.lit("second").alias("station_code"), F.floor("value").cast("double").alias("pm2_5")),
            )
        ).alias("body"),
    )
    return weather.explode_documents(
        docs, "body", "station_code: string, pm2_5: double", ["event_id"]
    )


@query("B18_weather_history", f"""
  SELECT CAST(h.grid_id AS INTEGER) AS grid_id, published_at, CAST(k AS DOUBLE) AS temp, event_type AS weather, CAST(k AS INTEGER) AS weather_code,
    floor(value) AS rainfall, CAST(NULL AS DOUBLE) AS humidity, s_name AS name
  FROM (SELECT user_id AS grid_id, date_trunc('second', ts) AS published_at, event_type, value, {K_SQL} AS k FROM events) h
  LEFT JOIN supplier ON s_suppkey = h.grid_id""")
def weather_history(spark, sf):
    rows = adapters.table(spark, sf, "events").select(
        F.concat(F.lit("cell-"), F.col("user_id")).alias("sid"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")).alias("date"),
        counter().cast("string").alias("temperature"),
        F.col("event_type").alias("text"),
        counter().cast("string").alias("code"),
        F.floor("value").cast("string").alias("precip"),
        F.lit("-").alias("humidity"),
    )
    cells = adapters.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("grid_id"), F.col("s_name").alias("name")
    )
    return weather.weather_history(rows, cells).select(
        "grid_id", "published_at", "temp", "weather", "weather_code", "rainfall", "humidity", "name"
    )


# --- B21: completeness --------------------------------------------------------

HOURS_SQL = """
  cells AS (SELECT s_suppkey AS grid_id FROM supplier),
  hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS published_at),
  here AS (SELECT DISTINCT user_id AS grid_id, date_trunc('hour', ts) AS published_at FROM events)"""


def _hours():
    return (
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
        F.lit("2024-01-30 23:00:00").cast("timestamp_ntz"),
    )


def _loaded(spark, sf):
    actual = adapters.table(spark, sf, "events").select(
        F.col("user_id").alias("grid_id"), F.col("ts").cast("timestamp_ntz").alias("published_at")
    )
    cells = adapters.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("grid_id"))
    return actual, cells


@query("B21_completeness", f"""WITH {HOURS_SQL}
  SELECT published_at, count(*) AS expected, count(here.grid_id) AS present, count(*) - count(here.grid_id) AS missing,
    CAST(count(*) = count(here.grid_id) AS INTEGER) AS complete
  FROM cells CROSS JOIN hours LEFT JOIN here USING (grid_id, published_at) GROUP BY published_at""")
def completeness_report(spark, sf):
    return completeness.completeness(*_loaded(spark, sf), *_hours())


@query("J11_missing_hours", f"""WITH {HOURS_SQL}
  SELECT grid_id, published_at FROM cells CROSS JOIN hours
  WHERE (grid_id, published_at) NOT IN (SELECT grid_id, published_at FROM here)""")
def missing_hours(spark, sf):
    return completeness.missing_hours(*_loaded(spark, sf), *_hours())


# --- X1..X10: index expressions -----------------------------------------------

# readings stretched over the whole breakpoint range, below zero included
STRETCH = {p: f"(l_extendedprice * {m}::DOUBLE - 10)" for p, m in
           zip(PARAMETERS, (0.0078125, 0.0078125, 0.015625, 0.001953125, 0.03125, 0.03125))}


def stretched(spark, sf):
    price = F.col("l_extendedprice")
    factors = (0.0078125, 0.0078125, 0.015625, 0.001953125, 0.03125, 0.03125)
    return adapters.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        *[(price * F.lit(f) - 10).alias(p) for p, f in zip(PARAMETERS, factors)],
    )


for _scale in ("hour", "day"):

    @query(f"X1_iaqi_{_scale}", "SELECT l_orderkey, l_partkey, " + ", ".join(
        f"{sql.iaqi(v, p, _scale)} AS {p}_iaqi" for p, v in STRETCH.items()) + " FROM lineitem")
    def iaqi(spark, sf, scale=_scale):
        return stretched(spark, sf).select(
            "l_orderkey", "l_partkey",
            *[air.iaqi(p, p, scale).alias(f"{p}_iaqi") for p in PARAMETERS],
        )

    @query(f"X2_graded_iaqi_{_scale}", "SELECT l_orderkey, l_partkey, " + ", ".join(
        f"{sql.graded(v, p, _scale)} AS {p}_iaqi" for p, v in STRETCH.items()) + " FROM lineitem")
    def graded_iaqi(spark, sf, scale=_scale):
        return stretched(spark, sf).select(
            "l_orderkey", "l_partkey",
            *[air.graded_iaqi(p, p, scale).alias(f"{p}_iaqi") for p in PARAMETERS],
        )


@query("X3_X5_index_by_grade", sql.with_views("obs", f"""
  SELECT grade, primary_pollutants, count(*) AS n, max(aqi) AS top, min(aqi) AS low
  FROM {sql.indexed('obs', 'hour')} GROUP BY grade, primary_pollutants"""))
def index_by_grade(spark, sf):
    indexed = with_index(adapters.observations(spark, sf), "hour")
    named = indexed.select("grade", "aqi", F.concat_ws(",", "primary_pollutants").alias("primary_pollutants"))
    return named.groupBy("grade", "primary_pollutants").agg(
        F.count("*").alias("n"), F.max("aqi").alias("top"), F.min("aqi").alias("low")
    )


@query("X1_X5_sql_functions", sql.with_views("obs", f"""
  SELECT grade, agrees, count(*) AS n, max(aqi) AS top FROM (SELECT *,
    CAST(grade = {sql.grade('(aqi + 15)')} AS INTEGER) AS agrees FROM {sql.indexed('obs', 'hour', sql.graded, PARAMETERS)})
  GROUP BY grade, agrees"""))
def sql_functions(spark, sf):
    """The registered functions in a SQL text; they are inlined like any expression."""
    register(spark)
    six = ", ".join(PARAMETERS)
    return spark.sql(
        f"""
        SELECT grade(aqi) AS grade, CAST(grade(aqi) = grade(aqi + 15) AS INT) AS agrees,
          count(*) AS n, max(aqi) AS top
        FROM (SELECT aqi_hour({six}) AS aqi FROM {{readings}})
        GROUP BY 1, 2
        """,
        readings=adapters.observations(spark, sf),
    )


@query("X5_X8_X10_sql_functions", sql.with_views("obs", f"""
  SELECT l_suppkey, published_at, primary_pollutants, grade AS said,
    CAST(g = grade OR (g > grade AND coalesce(g = {sql.grade('(aqi + 15)')}, false)) OR (g < grade AND coalesce(g = {sql.grade('(aqi - 15)')}, false)) AS INTEGER) AS by_points,
    CAST(g = grade OR (g > grade AND g = {sql.grade('ceil(aqi * 1.25::DOUBLE)')}) OR (g < grade AND g = {sql.grade('ceil(aqi * 0.75::DOUBLE)')}) AS INTEGER) AS by_share,
    CASE l_linenumber % 3 WHEN 0 THEN 'pm2_5,o3' WHEN 1 THEN 'no2' ELSE '' END AS codes
  FROM (SELECT *, CAST(l_linenumber % 6 + 1 AS INTEGER) AS g FROM {sql.indexed('obs', 'hour', sql.graded, PARAMETERS)})"""))
def more_sql_functions(spark, sf):
    """Primary pollutants, agreement of grades, and code lists as SQL functions."""
    register(spark)
    six = ", ".join(PARAMETERS)
    return spark.sql(
        f"""
        SELECT l_suppkey, published_at, concat_ws(',', primary_hour({six})) AS primary_pollutants, grade(a) AS said,
          grade_within_points(g, a) AS by_points, grade_within_share(g, a) AS by_share,
          concat_ws(',', primary_codes(CASE l_linenumber % 3 WHEN 0 THEN 'PM25,H2S,O3' WHEN 1 THEN 'NO2' ELSE '' END)) AS codes
        FROM (SELECT *, CAST(l_linenumber % 6 + 1 AS INT) AS g, CAST(aqi_hour({six}) AS DOUBLE) AS a FROM {{readings}})
        """,
        readings=adapters.observations(spark, sf),
    )


@query("X6_X7_percentile_and_comprehensive", sql.with_views("station_day", f"""
  SELECT station_id, round(o390 / 160.0::DOUBLE, 6) AS o3_index, round(co95 / 4.0::DOUBLE, 6) AS co_index, {sql.COMPREHENSIVE} AS comprehensive_index
  FROM (SELECT station_id, {sql.MEANS}, quantile_cont(CAST(o3 AS DOUBLE), 0.9) AS o390, quantile_cont(co, 0.95) AS co95
        FROM station_day GROUP BY station_id)"""))
def percentile_and_comprehensive(spark, sf):
    grouped = adapters.station_days(spark, sf).groupBy("station_id").agg(
        *parameter_means(),
        air.percentile_index("o3", "o3").alias("o3_index"),
        air.percentile_index("co", "co").alias("co_index"),
    )
    return grouped.select(
        "station_id", F.round("o3_index", 6).alias("o3_index"),
        F.round("co_index", 6).alias("co_index"), 
        air.comprehensive_index().alias("comprehensive_index"),
    )


@query("X8_X10_agreement", f"""
  SELECT l_orderkey, l_partkey, l_linenumber,
    CAST(g = {sql.grade('a')} OR (g > {sql.grade('a')} AND coalesce(g = {sql.grade('(a + 15)')}, false)) OR (g < {sql.grade('a')} AND coalesce(g = {sql.grade('(a - 15)')}, false)) AS INTEGER) AS by_points,
    CAST(g = {sql.grade('a')} OR (g > {sql.grade('a')} AND g = {sql.grade('ceil(a * 1.25::DOUBLE)')}) OR (g < {sql.grade('a')} AND g = {sql.grade('ceil(a * 0.75::DOUBLE)')}) AS INTEGER) AS by_share,
    CAST(l_returnflag = 'A' OR (l_returnflag = 'R' AND l_linestatus = 'F') AS INTEGER) AS primary_agrees
  FROM (SELECT *, CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS INTEGER) END AS g, floor(l_extendedprice / 256) AS a FROM lineitem)""")
def agreement(spark, sf):
    """A grade is 1..6; a forecast without one agrees with nothing and stays, as null."""
    said, seen = "(CASE WHEN l_linenumber < 7 THEN l_linenumber END)", "floor(l_extendedprice / 256)"
    empty = F.array().cast("array<string>")
    forecast = F.when(F.col("l_returnflag") == "N", empty).otherwise(F.array(F.lit("o3"), F.lit("pm10")))
    actual = F.when(
        (F.col("l_returnflag") == "A") | (F.col("l_linestatus") == "F"), F.array(F.lit("pm10"))
    ).otherwise(F.array(F.lit("co")))
    return (
        adapters.table(spark, sf, "lineitem")
        .withColumns({"prf": forecast, "prr": actual})
        .select(
            "l_orderkey", "l_partkey", "l_linenumber",
            air.grade_within_points(said, seen).alias("by_points"),
            air.grade_within_share(said, seen).alias("by_share"),
            air.primary_agrees("prf", "prr").alias("primary_agrees"),
        )
    )


# --- X14, X15: time windows ---------------------------------------------------


@query("X14_report_windows", """
  SELECT o_orderkey, date_trunc('hour', o_orderdate) - INTERVAL 3 HOUR AS three_hours_before,
    CAST(o_orderdate AS DATE) - 30 AS month_before, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
    CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS last_month,
    CAST(date_trunc('quarter', o_orderdate) - INTERVAL 3 MONTH AS DATE) AS last_quarter,
    CAST(o_orderdate AS DATE) + CAST(5 - dayofweek(o_orderdate) AS INTEGER) AS week_end,
    CAST(o_orderdate AS DATE) + CAST(5 - dayofweek(o_orderdate) AS INTEGER) - 6 AS week_start
  FROM orders""")
def report_windows(spark, sf):
    day = F.col("o_orderdate")
    return adapters.table(spark, sf, "orders").select(
        "o_orderkey",
        times.hours_before(day, 3).alias("three_hours_before"),
        times.days_before(day, 30).alias("month_before"),
        times.month_start(day).alias("month_start"),
        times.last_month_start(day).alias("last_month"),
        times.last_quarter_start(day).alias("last_quarter"),
        times.week_end(day).alias("week_end"),
        times.week_start(day).alias("week_start"),
    )


@query("X15_date_series", """
  SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM
    (SELECT user_id, date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events GROUP BY user_id)""")
def date_series(spark, sf):
    spans = adapters.table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi")
    )
    return spans.select(
        "user_id", F.explode(times.day_series(F.col("lo"), F.col("hi"))).alias("day")
    )
