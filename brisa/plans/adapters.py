"""Views of the star-schema test tables as air-quality inputs.

Concentrations are whole numbers, so sums and means do not depend on the order
in which rows are added and can be compared exactly with the SQL side
(``plans/sql.py`` holds the same views as SQL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brisa.functions import times
from brisa.operators import conform, rollup

EVENT_CODES = {"click": "105", "view": "104", "error": "102", "signup": "101", "purchase": "100"}
CODE_COLUMNS = {"100": "so2", "101": "no2", "102": "o3", "103": "co", "104": "pm10", "105": "pm2_5"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lookup(values: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def item_stamp() -> Column:
    """End-of-hour stamp 01:00..24:00 of the shipping day."""
    return F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_orderkey") % 24 + 1)


def item_readings() -> dict[str, Column]:
    quantity = F.col("l_quantity")
    return {
        "pm2_5": quantity * 4,
        "pm10": quantity * 6,
        "o3": F.floor(F.col("l_extendedprice") / 200).cast("double"),
        "co": F.when(F.col("l_linenumber") < 7, F.round(F.col("l_tax") * 100)),
        "no2": quantity * 2 + F.col("l_linenumber"),
        "so2": F.round(F.col("l_discount") * 1000),
    }


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Raw readings: station, grid cell, control area, stamp, six parameters."""
    cell = F.col("l_partkey") % 100
    return table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 10).cast("int").alias("station_id"),
        cell.cast("int").alias("grid_id"),
        (cell % 8).cast("int").alias("control_area_id"),
        F.col("l_suppkey"),
        F.col("l_linenumber"),
        item_stamp().alias("published_at"),
        *[c.alias(n) for n, c in item_readings().items()],
    )


def station_hours(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.hourly_means(observations(spark, sf), ["station_id"])


def grid_hours(spark: SparkSession, sf: str) -> DataFrame:
    # the filter that joins on the cell add as well: equal plans are run once
    located = observations(spark, sf).filter("grid_id IS NOT NULL AND control_area_id IS NOT NULL")
    return rollup.hourly_means(located, ["grid_id", "control_area_id"])


def coded_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Long readings: one pollutant code and value per row, two rows per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    own = F.struct(
        lookup(EVENT_CODES, F.col("event_type")).alias("code"),
        F.floor("value").cast("double").alias("mon_value"),
    )
    co = F.struct(F.lit("103").alias("code"), F.floor(k / 10).cast("double").alias("mon_value"))
    return table(spark, sf, "events").select(
        (F.col("user_id") % 5).cast("int").alias("station_id"),
        F.col("user_id"),
        (times.floor_hour(F.col("ts")) + F.expr("INTERVAL 1 HOUR")).alias(
            "published_at"
        ),
        F.inline(F.array(own, co)),
    )


def sensor_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly station table from the long readings; dense enough for day flags."""
    return conform.pivot_readings(
        coded_readings(spark, sf), ["station_id", "published_at"], "code", "mon_value", CODE_COLUMNS
    )


def station_days(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.station_day(station_hours(spark, sf))


def supplier_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of every supplier as a station; few have a second reading."""
    return rollup.hourly_means_sparse(
        observations(spark, sf).withColumn("station_id", F.col("l_suppkey")), ["station_id"]
    )


def supplier_days(spark: SparkSession, sf: str) -> DataFrame:
    """Daily product of every supplier as a station."""
    return rollup.station_day(supplier_hours(spark, sf))


def grid_days(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.grid_day(grid_hours(spark, sf))


def station_area(spark: SparkSession, sf: str) -> DataFrame:
    """Bridge of areas (nations) and stations (suppliers)."""
    return table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("area_id"), F.col("s_suppkey").alias("station_id")
    )


def grid_area(spark: SparkSession, sf: str) -> DataFrame:
    """Bridge of areas and grid cells: each cell lies in two areas."""
    cell = (F.col("p_partkey") % 100).cast("int")
    return (
        table(spark, sf, "part")
        .select(cell.alias("grid_id"), (cell % 8).alias("control_area_id"))
        .distinct()
        .select(
            "grid_id",
            "control_area_id",
            F.explode(F.array(F.col("grid_id") % 25, F.lit(30) + F.col("grid_id") % 7)).alias(
                "area_id"
            ),
        )
    )


def box_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes over lon = quantity and lat = scaled discount, at two scales.

    Derived from the part sizes 1..50, so the cells come from a table.
    """
    sizes = table(spark, sf, "part").select((F.col("p_size") - 1).alias("n")).distinct()

    def scale(step: int, level: int, offset: int) -> DataFrame:
        side = 50 // step
        rows = sizes.filter(F.col("n") < side).select(
            F.col("n").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("j")
        )
        return rows.select(
            (F.lit(offset) + F.col("i") * side + F.col("j")).cast("int").alias("grid_id"),
            F.lit(level).alias("grid_scale"),
            (F.col("j") * float(step)).alias("min_lat"),
            (F.col("i") * float(step)).alias("min_lon"),
            ((F.col("j") + 1) * float(step)).alias("max_lat"),
            ((F.col("i") + 1) * float(step)).alias("max_lon"),
        )

    return scale(5, 1, 0).unionByName(scale(10, 2, 1000))


def box_points(spark: SparkSession, sf: str) -> DataFrame:
    """Mobile readings as points; quantities lie on the cell edges on purpose."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("lon"),
        F.round(F.col("l_discount") * 500).alias("lat"),
    )


def positions(key: Column) -> tuple[Column, Column]:
    """A position in the city per key, to six decimals."""
    return (
        F.round(F.lit(103.7) + (key % 100) * F.lit(0.008), 6),
        F.round(F.lit(30.3) + (key % 97) * F.lit(0.006), 6),
    )


def site_stations(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = positions(F.col("s_suppkey"))
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        lon.alias("lon"),
        lat.alias("lat"),
    )


def truck_points(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = positions(F.col("event_id"))
    return table(spark, sf, "events").select(
        F.concat(F.lit("P"), F.col("user_id")).alias("plate_num"),
        (F.col("user_id") % 50).cast("string").alias("sim_card"),
        lon.alias("lon"),
        lat.alias("lat"),
        F.floor("value").alias("speed"),
        F.col("ts").alias("published_at"),
    )


def wind_reports(spark: SparkSession, sf: str) -> DataFrame:
    """One wind station per nation; its speed is a mean over its customers."""
    lon, lat = positions(F.col("n_nationkey") * 13)
    nations = table(spark, sf, "nation").select(
        "n_nationkey", F.col("n_name").alias("station_name"), lon.alias("lon"), lat.alias("lat")
    )
    speeds = (
        table(spark, sf, "customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.avg(F.col("c_custkey") % 16).alias("wind_speed"))
    )
    return nations.join(speeds, on="n_nationkey").drop("n_nationkey")


def forecast_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts with a lead: observed values bent by the line number."""
    factor = F.lit(90) + 3 * F.col("l_linenumber")
    bent = observations(spark, sf).withColumns(
        {
            **{
                p: F.floor(F.col(p) * factor / 100).cast("double")
                for p in ("pm2_5", "pm10", "o3", "co", "no2", "so2")
            },
            "forecast_interval": F.lit(0.5) + F.lit(0.5) * (F.col("l_linenumber") % 4),
        }
    )
    return rollup.hourly_means(
        bent, ["control_area_id", "grid_id", "forecast_interval"]
    )


def mobile_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Mobile readings of six cells, squeezed into one day per year."""
    moment = F.make_timestamp_ntz(
        F.year("l_shipdate"), F.lit(1), F.lit(1),
        (F.col("l_orderkey") % 24).cast("int"), F.col("l_linenumber"),
        (F.col("l_suppkey") % 60).cast("double"),
    )
    return table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 6).cast("int").alias("grid_id"),
        moment.alias("published_at"),
        *[c.alias(n) for n, c in item_readings().items()],
    )
