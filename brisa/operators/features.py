"""Neighbourhood features of stations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import geo
from brisa.operators import near
from brisa.operators.spatial import join_radius
from brisa.operators.tiles import near_totals
from brisa.params import FEATURE_RADIUS_M
from brisa.session import shuffle_tasks, stored

PLACE = ["_place"]


def trail_points(df: DataFrame, trail: str, keep: Sequence[str]) -> DataFrame:
    """Explode a ``"[[lon,lat],[lon,lat]]"`` text into one row per position."""
    pairs = F.from_json(F.col(trail), "array<array<double>>")
    return df.select(*keep, F.explode(pairs).alias("_p")).select(
        *keep, F.col("_p")[0].alias("lon"), F.col("_p")[1].alias("lat")
    )


def sites(stations: DataFrame) -> DataFrame:
    """Distinct station positions; stations at one place share their features."""
    return stations.select("lon", "lat").distinct().withColumn("_place", F.struct("lon", "lat"))


def near_sites(points: DataFrame, places: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    """Aggregate the points within the feature radius of every station position."""
    pairs = join_radius(points, places, FEATURE_RADIUS_M, PLACE)
    return pairs.groupBy(*PLACE).agg(*aggregates)


def truck_features(trucks: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct moving trucks and their track points near each position.

    Track points at one spot are counted before the join, trucks by ``near.count_members``.
    """
    moving = trucks.filter(F.col("speed") > 0)
    spots = moving.groupBy("lon", "lat").agg(F.count("*").alias("_n"))
    seen = near_sites(spots, places, [F.sum("_n").alias("truck_trajectory")])
    return _with_trucks(seen, moving, places, by_tile=False)


def _with_trucks(seen: DataFrame, moving: DataFrame, places: DataFrame, by_tile: bool) -> DataFrame:
    """Add ``truck_num``, the distinct trucks with a plate and a card among those seen."""
    known = moving.where("plate_num IS NOT NULL AND sim_card IS NOT NULL")
    centres = near.numbered(places, FEATURE_RADIUS_M)
    counts = near.count_members(known, centres, FEATURE_RADIUS_M, ["plate_num", "sim_card"], "truck_num", by_tile)
    counts = centres.select("_id", *PLACE).join(counts, "_id").drop("_id")
    return seen.join(counts, PLACE, "left").select(
        *PLACE, F.coalesce("truck_num", F.lit(0).cast("bigint")).alias("truck_num"), "truck_trajectory"
    )


def mean_features(points: DataFrame, places: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean of point values (traffic index, rain, humidity, sun) near each position.

    Points at one spot are summed before the join.
    """
    spots = points.groupBy("lon", "lat").agg(
        *[F.sum(n).alias(f"_{n}_sum") for n in names],
        *[F.count(n).alias(f"_{n}_n") for n in names],
    )
    means = [
        F.try_divide(F.sum(f"_{n}_sum"), F.sum(f"_{n}_n")).alias(n) for n in names
    ]
    return near_sites(spots, places, means)


def sum_feature(points: DataFrame, places: DataFrame, value: str, name: str) -> DataFrame:
    """Sum of point values (dust load, waiting trucks) near each position."""
    spots = points.groupBy("lon", "lat").agg(F.sum(value).alias("_v"))
    return near_sites(spots, places, [F.sum("_v").alias(name)])


# --- the same from a pyramid of tiles: for dense fixes, whose pairs with stations would be too many


def _near(points: DataFrame, places: DataFrame, sums: dict[str, str], members: Sequence[str] = ()) -> DataFrame:
    return near_totals(points, places, FEATURE_RADIUS_M, PLACE, sums, members)


def truck_features_by_tile(trucks: DataFrame, places: DataFrame) -> DataFrame:
    """``truck_features`` with the trucks of whole tiles merged as sets."""
    moving = trucks.filter(F.col("speed") > 0)
    seen = _near(moving, places, {"truck_trajectory": "1"})
    return _with_trucks(seen, moving, places, by_tile=True)


def mean_features_by_tile(points: DataFrame, places: DataFrame, names: Sequence[str]) -> DataFrame:
    """``mean_features`` from sums and counts of whole tiles."""
    sums = {f"_{n}_sum": n for n in names} | {f"_{n}_n": f"CAST({n} IS NOT NULL AS INT)" for n in names}
    found = _near(points, places, sums)
    return found.select(*PLACE, *[F.try_divide(f"_{n}_sum", f"_{n}_n").alias(n) for n in names])


def sum_feature_by_tile(points: DataFrame, places: DataFrame, value: str, name: str) -> DataFrame:
    """``sum_feature`` from sums of whole tiles."""
    return _near(points, places, {name: value})


def flow_feature(sections: DataFrame, places: DataFrame) -> DataFrame:
    """Traffic flow: largest per section, mean per road, summed per position.

    The sum is cut to a whole number after rounding to six decimals, so adding
    the means in another order cannot change it.
    """
    centres = near.numbered(places, FEATURE_RADIUS_M)
    per_road = near.mean_of_largest(sections, centres, FEATURE_RADIUS_M, ["id", "roadname"], "flow", ["roadname"])
    total = per_road.groupBy("_id").agg(F.floor(F.round(F.sum("flow"), 6)).cast("int").alias("traffic_flow"))
    return centres.select("_id", *PLACE).join(total, "_id").drop("_id")


def counted_flow(data: str) -> Column:
    """Traffic flow of a section from the JSON counts of its vehicle classes; missing ones are 0."""
    counts = F.from_json(F.col(data), "large double, middle double, small double, unknown double")
    return sum((F.coalesce(counts[c], F.lit(0.0)) for c in ("large", "middle", "small", "unknown")), F.lit(0.0))


#: Digits of the published means: two for weather, six for the traffic index.
PUBLISHED = {
    "rainfall": "decimal(8,2)", "humidity": "decimal(8,2)", "solar_radiation": "decimal(8,2)",
    "traffic_index": "decimal(10,6)",
}


def published(features: DataFrame) -> DataFrame:
    """Features as published: means cut to their decimals, the rest as it is."""
    return features.withColumns(
        {c: F.col(c).cast(kind) for c, kind in PUBLISHED.items() if c in features.columns}
    )


def interpolated_wind(stations: DataFrame, wind: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wind speed at every station, weighted by inverse squared distance.

    All listed wind stations take part, wherever they are.  The list is fixed,
    so their reports fit one short array that is read as a scalar; no join is
    needed.  A wind station in the same place decides alone.
    """
    reports = (
        wind.filter(F.col("station_name").isin(*names) & F.col("wind_speed").isNotNull())
        .groupBy("station_name", "lon", "lat")
        .agg(F.avg("wind_speed").alias("wind_speed"))
        .agg(F.sort_array(F.collect_list(F.struct("station_name", "lon", "lat", "wind_speed"))))
    )

    metres = f"CAST({geo.distance_m_sql('lon', 'lat', 'w.lon', 'w.lat')} AS DOUBLE)"
    placed = stations.withColumn("_reports", reports.scalar()).withColumn(
        "_w",
        F.expr(f"transform(_reports, w -> struct(w.wind_speed AS v, {metres} * {metres} AS d))"),
    )

    def total(term: str) -> str:
        return f"aggregate(_w, 0D, (s, w) -> s + coalesce({term}, 0D))"

    here = "filter(_w, w -> w.d = 0D)"
    same_place = total("CASE WHEN w.d = 0D THEN w.v END")
    weighted = f"try_divide({total('try_divide(w.v, w.d)')}, {total('try_divide(1D, w.d)')})"
    speed = F.expr(
        f"CASE WHEN size({here}) > 0 THEN {same_place} / size({here})"
        f" ELSE coalesce({weighted}, 0D) END"
    )
    return placed.withColumn("wind_speed", F.round(speed, 2)).drop("_reports", "_w")


def one_position(wind: DataFrame) -> DataFrame:
    """Wind stations by name with their mean speed; a name at two positions is an error."""
    spot = F.struct("lon", "lat")
    known = wind.filter(F.col("wind_speed").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    found = known.groupBy("station_name").agg(
        F.min(spot).alias("_a"), F.max(spot).alias("_b"), F.avg("wind_speed").alias("wind_speed")
    )
    moved = F.raise_error(F.concat(F.lit("wind station at two positions: "), F.col("station_name")))
    return found.select(
        "station_name", F.col("_a.lon").alias("lon"), F.col("_a.lat").alias("lat"),
        F.when(F.col("_a") == F.col("_b"), F.col("wind_speed")).otherwise(moved.cast("double")).alias("wind_speed"),
    )


def wind_by_rings(
    stations: DataFrame, wind: DataFrame, tolerance: float = 0.005, first_m: float = 20_000.0, rings: int = 4
) -> DataFrame:
    """``interpolated_wind`` for any number of wind stations, with a bound on its error.

    A station first takes the wind stations within ``first_m``.  Each of the m others weighs
    1 / R^2 at most, so together they move the weighted mean by no more than
    (highest - lowest speed) * b / (B + b), with b = m / R^2 and B the weight of those
    taken.  Stations where that exceeds ``tolerance`` search again with twice the radius,
    ``rings`` times in all; what is uncertain then is refused: its speed is null.
    ``wind_error`` holds the bound.  A wind station in the same place decides alone.
    Wind stations at one spot are added up before they meet any station.
    Stations are told apart by position, as they share what is near them.
    """
    known = stored(one_position(wind), "wind")
    about = known.agg(
        F.count("*").alias("_all"), (F.max("wind_speed") - F.min("wind_speed")).alias("_spread")
    )
    spots = known.groupBy(F.col("lon").alias("_wlon"), F.col("lat").alias("_wlat")).agg(
        F.sum("wind_speed").alias("_v"), F.count("*").alias("_n")
    )
    spots = stored(spots.repartition(shuffle_tasks(known)), "wind-spots")
    todo, done = sites(stations.where("lon IS NOT NULL AND lat IS NOT NULL")), []
    for ring in range(rings):
        radius = first_m * 2**ring
        places = stored(todo, "places")
        near = join_radius(
            spots.withColumns({"lon": F.col("_wlon"), "lat": F.col("_wlat")}), places, radius, [*PLACE]
        )
        d = geo.distance_m("_wlon", "_wlat", "_place.lon", "_place.lat").cast("double")
        near = near.withColumn("_d", d * d)
        sums = near.groupBy(*PLACE).agg(
            F.try_divide(F.sum(F.when(F.col("_d") == 0, F.col("_v"))), F.sum(F.when(F.col("_d") == 0, F.col("_n")))).alias("_here"),
            F.sum(F.try_divide("_v", "_d")).alias("_a"), F.sum(F.try_divide("_n", "_d")).alias("_b"),
            F.sum("_n").alias("_taken"),
        )
        found = places.join(sums, PLACE, "left").crossJoin(F.broadcast(about))
        left_out = (F.col("_all") - F.coalesce("_taken", F.lit(0))) / (radius * radius)
        bound = F.coalesce(F.try_divide(F.col("_spread") * left_out, F.coalesce("_b", F.lit(0.0)) + left_out), F.lit(0.0))
        speed = F.coalesce("_here", F.try_divide("_a", "_b"))
        speed = F.when(F.col("_all") == 0, 0.0).otherwise(speed)
        found = found.withColumns({"wind_error": F.when(F.col("_here").isNotNull(), 0.0).otherwise(bound), "_speed": speed})
        found = stored(found.select(*PLACE, "_speed", "wind_error"), "ring")
        sure = (F.col("wind_error") <= tolerance) & F.col("_speed").isNotNull()
        if ring == rings - 1:
            done.append(found.withColumn("_speed", F.when(sure, F.col("_speed"))))
            break
        done.append(found.where(sure))
        todo = places.join(found.where(sure).select(*PLACE), PLACE, "left_anti")
    flat = reduce(DataFrame.unionByName, done).select(
        F.col("_place.lon").alias("lon"), F.col("_place.lat").alias("lat"), F.round("_speed", 2).alias("wind_speed"), "wind_error"
    )
    return stations.join(flat, ["lon", "lat"], "left")


def diffusion_level(stations: DataFrame, forecasts: DataFrame, day: Column) -> DataFrame:
    """Level of the newest diffusion forecast for ``day``, the same at every station.

    The level is the first character of the forecast text; 0 without a forecast.
    """
    newest = forecasts.filter(F.col("forecast_date") == day).agg(
        F.max_by(F.substring("diffusion_conditions", 1, 1), F.col("published_at"))
    )
    level = F.coalesce(newest.scalar().try_cast("int"), F.lit(0))
    return stations.withColumn("diffusion_conditions", level)


def station_features(
    stations: DataFrame, site_features: Sequence[DataFrame], wind: DataFrame | None = None,
    wind_names: Sequence[str] = (),
) -> DataFrame:
    """One row per station with all neighbourhood features.

    The feature tables are stacked and grouped by position once, instead of
    being chained by full outer joins.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), site_features
    )
    names = [c for c in stacked.columns if c not in PLACE]
    merged = stacked.groupBy(*PLACE).agg(*[F.max(n).alias(n) for n in names])
    flat = merged.select(
        F.col("_place.lon").alias("lon"), F.col("_place.lat").alias("lat"), *names
    )
    out = stations.join(flat, on=["lon", "lat"], how="left")
    return out if wind is None else interpolated_wind(out, wind, wind_names)
