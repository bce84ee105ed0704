"""The adapter views and the index arithmetic as SQL text for the other engine."""

from __future__ import annotations

from brisa.params import PARAMETERS, PRIMARY_ORDER

# --- fixed values: the standard's own table, stated here again so that the SQL does not lean on the
# --- values the jobs use: sub-index levels, and the concentration at each of them.
INDEX_LEVELS = (0, 50, 100, 150, 200, 300, 400, 500)
BREAKPOINTS = {
    "hour": {
        "pm2_5": (0, 35, 75, 115, 150, 250, 350, 500),
        "pm10": (0, 50, 150, 250, 350, 420, 500, 600),
        "o3": (0, 160, 200, 300, 400, 800, 1000, 1200),
        "co": (0, 5, 10, 35, 60, 90, 120, 150),
        "no2": (0, 100, 200, 700, 1200, 2340, 3090, 3840),
        "so2": (0, 150, 500, 650, 800, 1600, 2100, 2620),
    },
    "day": {
        "pm2_5": (0, 35, 75, 115, 150, 250, 350, 500),
        "pm10": (0, 50, 150, 250, 350, 420, 500, 600),
        "o3": (0, 100, 160, 215, 265, 800, 1000, 1200),
        "co": (0, 2, 4, 14, 24, 36, 48, 60),
        "no2": (0, 40, 80, 180, 280, 565, 750, 940),
        "so2": (0, 50, 150, 475, 800, 1600, 2100, 2620),
    },
}

# --- arithmetic ---------------------------------------------------------------


def each(template: str, joiner: str = ", ") -> str:
    """The template once per parameter, ``@`` standing for its name."""
    return joiner.join(template.replace("@", p) for p in PARAMETERS)


def iaqi(v: str, p: str, scale: str) -> str:
    c, i = BREAKPOINTS[scale][p], INDEX_LEVELS
    arms = "".join(
        f" WHEN {v} <= {c[n + 1]} THEN ceil(({i[n + 1] - i[n]}::DOUBLE / {c[n + 1] - c[n]})"
        f" * ({v} - {c[n]}) + {i[n]})"
        for n in range(7)
    )
    return f"CAST(CASE WHEN {v} IS NULL THEN NULL WHEN {v} < 0 THEN 0{arms} ELSE 500 END AS BIGINT)"


def graded(v: str, p: str, scale: str) -> str:
    c, i = BREAKPOINTS[scale][p], INDEX_LEVELS
    arms = "".join(
        f" WHEN {v} {'<=' if n == 6 else '<'} {c[n + 1]} THEN ceil({i[n + 1] - i[n]}::DOUBLE * ({v} - {c[n]})"
        f" / {c[n + 1] - c[n]} + {i[n]})"
        for n in range(7)
    )
    return f"CAST(CASE WHEN {v} IS NULL OR {v} < 0 THEN NULL{arms} ELSE 500 END AS BIGINT)"


def grade(a: str) -> str:
    return (
        f"CAST(CASE WHEN {a} IS NULL OR {a} < 0 THEN NULL WHEN {a} <= 50 THEN 1 WHEN {a} <= 100"
        f" THEN 2 WHEN {a} <= 150 THEN 3 WHEN {a} <= 200 THEN 4 WHEN {a} <= 300 THEN 5 ELSE 6 END"
        " AS INTEGER)"
    )


def primary(order=PRIMARY_ORDER, aqi: str = "aqi") -> str:
    arms = ", ".join(f"CASE WHEN {aqi} > 50 AND {p}_iaqi = {aqi} THEN '{p}' END" for p in order)
    return f"concat_ws(',', {arms})"


def decimal_round(v: str, digits: int) -> str:
    return f"CAST(round(CAST({v} AS DECIMAL(28, 8)), {digits}) AS DOUBLE)"


def report(p: str, v: str | None = None) -> str:
    v = v or p
    return decimal_round(v, 1) if p == "co" else f"CAST(round({v}) AS INTEGER)"


def reports() -> str:
    return ", ".join(f"{report(p)} AS {p}" for p in PARAMETERS)


def indexed(source: str, scale: str, method=iaqi, order=PRIMARY_ORDER) -> str:
    """Sub-select with index fields added to all columns of ``source``."""
    subs = ", ".join(f"{method(p, p, scale)} AS {p}_iaqi" for p in PARAMETERS)
    top = ", ".join(f"{p}_iaqi" for p in PARAMETERS)
    return (
        f"(SELECT *, {grade('aqi')} AS grade, {primary(order)} AS primary_pollutants FROM"
        f" (SELECT *, greatest({top}) AS aqi FROM (SELECT *, {subs} FROM {source})))"
    )


INDEX_COLUMNS = each("@_iaqi") + ", aqi, grade, primary_pollutants"
FLAGS_PRESENT = each("CAST(@ IS NOT NULL AS INTEGER) AS @_flag")

# --- views --------------------------------------------------------------------

READINGS = """
  l_quantity * 4 AS pm2_5, l_quantity * 6 AS pm10, floor(l_extendedprice / 200) AS o3,
  CASE WHEN l_linenumber < 7 THEN round(l_tax * 100) END AS co,
  l_quantity * 2 + l_linenumber AS no2, round(l_discount * 1000) AS so2
"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, text: str, *needs: str) -> None:
    VIEWS[name] = (text, needs)


def with_views(names: str, select: str) -> str:
    """``select`` preceded by the named views and all they need."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        text, needs = VIEWS[name]
        for n in needs:
            add(n)
        done[name] = text

    for n in names.split():
        add(n)
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in done.items()) + " " + select


view("obs", f"""
  SELECT CAST(l_suppkey % 10 AS INTEGER) AS station_id, CAST(l_partkey % 100 AS INTEGER) AS grid_id,
    CAST(l_partkey % 100 % 8 AS INTEGER) AS control_area_id, l_suppkey, l_linenumber,
    l_shipdate + to_hours(CAST(l_orderkey % 24 + 1 AS INTEGER)) AS published_at, {READINGS}
  FROM lineitem""")

MEANS = each("avg(@) AS @")
# published values have one decimal at most; added as such, a mean that ends in a five is met exactly
PUBLISHED_MEANS = each("avg(CAST(@ AS DECIMAL(18, 6))) AS @")


def hour_means(keys: str, source: str = "obs") -> str:
    return f"SELECT {keys}, published_at, {MEANS} FROM {source} GROUP BY {keys}, published_at"


view("station_hour", hour_means("station_id"), "obs")
view("grid_hour", hour_means("grid_id, control_area_id"), "obs")
view("supplier_hour", hour_means("l_suppkey").replace("l_suppkey,", "l_suppkey AS station_id,", 1), "obs")

view("eav", """
  SELECT CAST(user_id % 5 AS INTEGER) AS station_id, user_id,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS published_at,
    CASE event_type WHEN 'click' THEN '105' WHEN 'view' THEN '104' WHEN 'error' THEN '102'
      WHEN 'signup' THEN '101' WHEN 'purchase' THEN '100' END AS code, floor(value) AS mon_value
  FROM events
  UNION ALL
  SELECT CAST(user_id % 5 AS INTEGER), user_id, date_trunc('hour', ts) + INTERVAL 1 HOUR, '103',
    floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 10)
  FROM events""")

PIVOT = (
    "max(mon_value) FILTER (code = '105') AS pm2_5, max(mon_value) FILTER (code = '104') AS pm10,"
    " max(mon_value) FILTER (code = '102') AS o3, max(mon_value) FILTER (code = '103') AS co,"
    " max(mon_value) FILTER (code = '101') AS no2, max(mon_value) FILTER (code = '100') AS so2"
)
view("sensor_hour",
     f"SELECT station_id, published_at, {PIVOT} FROM eav GROUP BY station_id, published_at", "eav")


def day_profile(keys: str, source: str, frame: str = "ROWS") -> str:
    span = "BETWEEN CURRENT ROW AND 7 FOLLOWING"
    five = ", ".join(
        f"avg({p}) AS {p}" for p in PARAMETERS if p != "o3"
    )
    hours = each("count(@) AS @_hours")
    return f"""
  SELECT {keys}, day AS published_at, {five},
    max(CASE WHEN h <= 17 THEN o3_8h END) AS o3, {hours}
  FROM (SELECT *, avg(o3) OVER (PARTITION BY {keys}, day ORDER BY h {frame} {span}) AS o3_8h
        FROM (SELECT *, CAST(published_at - INTERVAL 1 HOUR AS DATE) AS day,
                CAST(hour(published_at - INTERVAL 1 HOUR) + 1 AS INTEGER) AS h
              FROM {source}))
  GROUP BY {keys}, day HAVING count(CASE WHEN h <= 17 THEN 1 END) > 0"""


def station_day(source_profile: str, keys: str = "station_id") -> str:
    flags = each("CAST(@_hours >= 20 AS INTEGER) AS @_flag")
    return (
        f"SELECT {keys}, published_at, {reports()}, {INDEX_COLUMNS}, {flags}"
        f" FROM {indexed(source_profile, 'day')}"
    )


def grid_day(source_profile: str) -> str:
    return (
        f"SELECT *, {FLAGS_PRESENT} FROM (SELECT grid_id, control_area_id, published_at,"
        f" {reports()}, {INDEX_COLUMNS} FROM {indexed(source_profile, 'day')})"
    )


view("station_profile", day_profile("station_id", "station_hour"), "station_hour")
view("station_day", station_day("station_profile"), "station_profile")
view("supplier_profile", day_profile("station_id", "supplier_hour"), "supplier_hour")
view("supplier_day", station_day("supplier_profile"), "supplier_profile")
view("sensor_profile", day_profile("station_id", "sensor_hour"), "sensor_hour")
view("sensor_day", station_day("sensor_profile"), "sensor_profile")
view("grid_profile", day_profile("grid_id, control_area_id", "grid_hour"), "grid_hour")
view("grid_day", grid_day("grid_profile"), "grid_profile")

view("station_area", "SELECT s_nationkey AS area_id, s_suppkey AS station_id FROM supplier")
view("grid_area", """
  SELECT grid_id, control_area_id, unnest([grid_id % 25, 30 + grid_id % 7]) AS area_id FROM
    (SELECT DISTINCT CAST(p_partkey % 100 AS INTEGER) AS grid_id,
       CAST(p_partkey % 100 % 8 AS INTEGER) AS control_area_id FROM part)""")


def period_ids(period: str, day: str = "published_at") -> str:
    end = f"({day} + CAST((((6 - (dayofweek({day}) + 1)) % 7) + 7) % 7 AS INTEGER))"
    return {
        "week": f"{end} - 6 AS published_start, {end} AS published_end",
        "month": f"CAST(year({day}) AS INTEGER) AS published_year, CAST(month({day}) AS INTEGER) AS published_month",
        "quarter": f"CAST(year({day}) AS INTEGER) AS published_year, CAST(quarter({day}) AS INTEGER) AS published_quarter",
        "year": f"CAST(year({day}) AS INTEGER) AS published_year",
    }[period]


PERIOD_KEYS = {
    "week": "published_start, published_end",
    "month": "published_year, published_month",
    "quarter": "published_year, published_quarter",
    "year": "published_year",
}
PERIOD_NEED = {
    "week": "6",
    "month": "CASE WHEN published_month = 2 THEN 25 ELSE 27 END",
    "quarter": "27",
    "year": "322",
}
COMPREHENSIVE = decimal_round(
    "coalesce(so2 / 60.0::DOUBLE, 0) + coalesce(pm10 / 70.0::DOUBLE, 0) + coalesce(pm2_5 / 35.0::DOUBLE, 0)"
    " + coalesce(no2 / 40.0::DOUBLE, 0) + coalesce(co95 / 4.0::DOUBLE, 0) + coalesce(o390 / 160.0::DOUBLE, 0)", 2)


def period(source: str, keys: str, name: str) -> str:
    counts = each("count(@) AS @_days")
    flags = each(f"CAST(@_days >= {PERIOD_NEED[name]} AS INTEGER) AS @_flag")
    inner = f"""(SELECT {keys}, {PERIOD_KEYS[name]}, {PUBLISHED_MEANS}, {counts},
      count(*) FILTER (grade IN (1, 2)) AS std_day_num,
      quantile_cont(CAST(o3 AS DOUBLE), 0.9) AS o390, quantile_cont(co, 0.95) AS co95
      FROM (SELECT *, {period_ids(name)} FROM {source}) GROUP BY {keys}, {PERIOD_KEYS[name]})"""
    return (
        f"SELECT {keys}, {PERIOD_KEYS[name]}, {reports()}, {INDEX_COLUMNS}, {flags}, std_day_num,"
        f" {COMPREHENSIVE} AS comprehensive_index FROM {indexed(inner, 'day')}"
    )


def district(source: str, level: str) -> str:
    inner = (
        f"(SELECT control_area_id, published_at, {reports()} FROM (SELECT control_area_id,"
        f" published_at, {MEANS} FROM {source} GROUP BY control_area_id, published_at))"
    )
    return (
        f"SELECT control_area_id, published_at, {each('@')}, {INDEX_COLUMNS}, {FLAGS_PRESENT},"
        f" 'inference' AS source FROM {indexed(inner, level, graded, PARAMETERS)}"
    )


view("district_day", district("grid_day", "day"), "grid_day")


def district_period(source: str, name: str) -> str:
    counts = each("coalesce(sum(@_flag), 0) AS @_days")
    flags = each(f"CAST(@_days >= {PERIOD_NEED[name]} AS INTEGER) AS @_flag")
    keys = "source, control_area_id"
    inner = f"""(SELECT * REPLACE ({reports()}) FROM (SELECT {keys}, {PERIOD_KEYS[name]}, {PUBLISHED_MEANS}, {counts},
      count(*) FILTER (grade IN (1, 2)) AS std_day_num,
      quantile_cont(CAST(o3 AS DOUBLE), 0.9) AS o390, quantile_cont(co, 0.95) AS co95
      FROM (SELECT *, {period_ids(name)} FROM {source}) GROUP BY {keys}, {PERIOD_KEYS[name]}))"""
    return (
        f"SELECT {keys}, {PERIOD_KEYS[name]}, {each('@')}, {INDEX_COLUMNS}, {flags}, std_day_num,"
        f" {COMPREHENSIVE} AS comprehensive_index FROM {indexed(inner, 'day', graded, PARAMETERS)}"
    )


view("cells", """
  SELECT CAST(n * 10 + j AS INTEGER) AS grid_id, 1 AS grid_scale, j * 5.0::DOUBLE AS min_lat,
    n * 5.0::DOUBLE AS min_lon, (j + 1) * 5.0::DOUBLE AS max_lat, (n + 1) * 5.0::DOUBLE AS max_lon
  FROM (SELECT DISTINCT p_size - 1 AS n FROM part WHERE p_size <= 10), range(10) r(j)
  UNION ALL
  SELECT CAST(1000 + n * 5 + j AS INTEGER), 2, j * 10.0::DOUBLE, n * 10.0::DOUBLE,
    (j + 1) * 10.0::DOUBLE, (n + 1) * 10.0::DOUBLE
  FROM (SELECT DISTINCT p_size - 1 AS n FROM part WHERE p_size <= 5), range(5) r(j)""")
view("points", """
  SELECT l_orderkey, l_linenumber, l_quantity AS lon, round(l_discount * 500) AS lat FROM lineitem""")


def place(key: str) -> str:
    return (
        f"round(103.7::DOUBLE + ({key} % 100) * 0.008::DOUBLE, 6) AS lon,"
        f" round(30.3::DOUBLE + ({key} % 97) * 0.006::DOUBLE, 6) AS lat"
    )


view("sites", f"SELECT s_suppkey AS station_id, s_name AS station_name, {place('s_suppkey')} FROM supplier")
view("trucks", f"""
  SELECT 'P' || user_id AS plate_num, CAST(user_id % 50 AS VARCHAR) AS sim_card, {place('event_id')},
    floor(value) AS speed, ts AS published_at FROM events""")
view("wind", f"""
  SELECT n_name AS station_name, {place('n_nationkey * 13')}, wind_speed FROM nation JOIN
    (SELECT c_nationkey, avg(c_custkey % 16) AS wind_speed FROM customer GROUP BY c_nationkey)
    ON c_nationkey = n_nationkey""")


def great_circle(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"(2.0 * 6371393 * asin(sqrt(pow(sin(radians({lat1} - {lat2}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin(radians({lon1} - {lon2}) / 2), 2))))"
    )


def metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return f"floor(floor({great_circle(lon1, lat1, lon2, lat2)} * 10000 + 0.5) / 10000)"


view("forecast", f"""
  SELECT control_area_id, grid_id, forecast_interval, published_at, {MEANS} FROM
    (SELECT control_area_id, grid_id, published_at,
       0.5::DOUBLE + 0.5::DOUBLE * (l_linenumber % 4) AS forecast_interval,
       {each('floor(@ * (90 + 3 * l_linenumber) / 100) AS @')} FROM obs)
  GROUP BY control_area_id, grid_id, forecast_interval, published_at""", "obs")
view("forecast_indexed", f"SELECT * FROM {indexed('forecast', 'hour', graded, PARAMETERS)}", "forecast")

view("dense", f"""
  WITH base AS (SELECT grid_id, control_area_id, published_at, {each('coalesce(@, 0) AS @')} FROM grid_hour)
  SELECT * FROM (
    SELECT a.grid_id, a.control_area_id, a.published_at + INTERVAL 30 MINUTE AS published_at,
      {each('CASE WHEN a.@ = 0 OR b.@ = 0 THEN a.@ + b.@ ELSE (a.@ + b.@) / 2 END AS @')}
    FROM base a JOIN base b ON a.grid_id = b.grid_id AND a.control_area_id = b.control_area_id
      AND b.published_at = a.published_at + INTERVAL 1 HOUR
    UNION ALL SELECT * FROM base)
  WHERE {each('@ <> 0', ' AND ')}""", "grid_hour")


def pairs(said: str, seen: str, on: str, extra: str, s: str = "f") -> str:
    """Joined forecast and observation with suffixed columns."""
    fields = (*PARAMETERS, "grade", "aqi")
    left = ", ".join(f"a.{c} AS {c}{s}" for c in fields)
    right = ", ".join(f"b.{c} AS {c}r" for c in fields)
    return (
        f"SELECT {extra}, {left}, {right}, a.primary_pollutants AS pr{s},"
        f" b.primary_pollutants AS prr FROM {said} a JOIN {seen} b ON {on}"
    )


view("dense_indexed", f"SELECT * FROM {indexed('dense', 'hour', graded, PARAMETERS)}", "dense")
view("grid_pairs", pairs(
    "(SELECT * FROM forecast_indexed WHERE " + each("@ IS NOT NULL", " AND ") + ")",
    "dense_indexed",
    "a.grid_id = b.grid_id AND a.control_area_id = b.control_area_id AND a.published_at = b.published_at",
    "a.grid_id, a.control_area_id, a.forecast_interval, a.published_at"), "forecast_indexed", "dense_indexed")


def metrics(s: str = "f", digits: int = 6) -> str:
    """All score aggregates over pairs; null where there is no finite value."""

    def guarded(value: str) -> str:
        return f"CASE WHEN isfinite({value}) THEN round({value}, {digits}) END"

    out = []
    for p in PARAMETERS:
        f, r = f"CAST({p}{s} AS DOUBLE)", f"CAST({p}r AS DOUBLE)"
        spread = (
            f"(stddev_pop(CASE WHEN {r} IS NOT NULL THEN {f} END)"
            f" * stddev_pop(CASE WHEN {f} IS NOT NULL THEN {r} END))"
        )
        nmb = f"sum({f} - {r}) / nullif(sum({r}), 0)"
        corr = f"covar_pop({f}, {r}) / nullif({spread}, 0)"
        rmse = f"sqrt(sum(({f} - {r}) * ({f} - {r})) / nullif(count({f}), 0))"
        out += [f"{guarded(nmb)} AS {p}_nmb", f"{guarded(corr)} AS {p}_r", f"{guarded(rmse)} AS {p}_rmse"]
    f, r, g = f"CAST(aqi{s} AS DOUBLE)", "CAST(aqir AS DOUBLE)", f"grade{s}"

    def hit(cond: str, name: str) -> str:
        return f"{guarded(f'count(*) FILTER ({cond}) * 100.0::DOUBLE / nullif(count({r}), 0)')} AS {name}"

    def agrees(up: str, down: str) -> str:
        own = grade("aqir")
        return (
            f"{g} = {own} OR ({g} > {own} AND {g} = {grade(up)}) OR ({g} < {own} AND {g} = {grade(down)})"
        )

    share = "len(list_intersect(string_split(pr@, ','), string_split(prr, ','))) > 0 AND pr@ <> '' AND prr <> ''"
    out += [
        hit(f"abs({f} - {r}) <= 15", "aqi_interval_hit_rate"),
        hit(f"abs({f} - {r}) / nullif({r}, 0) <= 0.25", "aqi_percentage_hit_rate"),
        hit(agrees("(aqir + 15)", "(aqir - 15)"), "aqi_grade_interval_hit_rate"),
        hit(agrees(f"ceil({r} * 1.25::DOUBLE)", f"ceil({r} * 0.75::DOUBLE)"), "aqi_grade_percentage_hit_rate"),
        guarded(
            f"count(*) FILTER (grader <> 1 AND {share.replace('@', s)}) * 100.0::DOUBLE"
            " / nullif(count(*) FILTER (grader <> 1), 0)"
        ) + " AS accuracy",
    ]
    return ", ".join(out)


view("mobile", f"""
  SELECT CAST(l_partkey % 6 AS INTEGER) AS grid_id,
    make_timestamp(CAST(year(l_shipdate) AS BIGINT), 1, 1, CAST(l_orderkey % 24 AS BIGINT),
      CAST(l_linenumber AS BIGINT), CAST(l_suppkey % 60 AS DOUBLE)) AS published_at, {READINGS}
  FROM lineitem""")
