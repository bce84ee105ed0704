"""Roll-ups from hours to days, areas, districts and periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window, functions as F

from brisa.functions import air, clean, times
from brisa.operators.index import (
    parameter_means,
    presence_flags,
    published_means,
    reported,
    steady_mean,
    with_index,
)
from brisa.params import (
    GRADE_BOUNDS,
    LARGE_AREA_SHARE,
    LAST_EIGHT_HOUR_START,
    MIN_DAYS_PER_FEBRUARY,
    MIN_DAYS_PER_MONTH,
    MIN_DAYS_PER_WEEK,
    MIN_DAYS_PER_YEAR,
    MIN_HOURS_PER_DAY,
    PARAMETERS,
    SMALL_AREA_MEMBERS,
    SMALL_AREA_SHARE,
)
from brisa.session import shuffle_tasks


def hourly_means(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One mean row per key and hour from any number of raw readings."""
    return readings.groupBy(*keys, "published_at").agg(*parameter_means())


def hourly_means_sparse(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``hourly_means`` where most hours of a key have a single reading.

    Combining before the shuffle would keep a state for nearly every row of a file's
    part.  Readings are dealt by key and hour first, to as many tasks as a shuffle has.
    """
    dealt = readings.select(*keys, "published_at", *PARAMETERS)
    return hourly_means(dealt.repartition(shuffle_tasks(readings), *keys, "published_at"), keys)


def eight_hour_mean(keys: Sequence[str], frame: str = "rows") -> Column:
    """Mean of o3 over this and the next seven rows (or hours) of the day.

    With ``rows`` a missing hour widens the span; with ``range`` it does not.
    """
    window = Window.partitionBy(*keys, "_day").orderBy("_hour")
    span = window.rowsBetween(0, 7) if frame == "rows" else window.rangeBetween(0, 7)
    return F.avg("o3").over(span)


def day_profile(hourly: DataFrame, keys: Sequence[str], frame: str = "rows") -> DataFrame:
    """Unrounded day means, largest 8 h ozone mean and hours with a value.

    ``hourly`` has one row per key and hour, so a window holds at most 24 rows
    however large an entity is.  Window and grouping share one shuffle.  A day
    without any reading up to 17:00 gives no row.
    """
    early = F.col("_hour") <= LAST_EIGHT_HOUR_START
    staged = hourly.select(
        *keys,
        times.observation_day(F.col("published_at")).alias("_day"),
        times.observation_hour(F.col("published_at")).alias("_hour"),
        *PARAMETERS,
    )
    # a row becomes far more in the window than its compressed bytes tell: the number of tasks is given
    staged = staged.repartition(shuffle_tasks(hourly), *keys, "_day")
    staged = staged.withColumn("_o3_8h", eight_hour_mean(keys, frame))
    profile = staged.groupBy(*keys, "_day").agg(
        *[steady_mean(p).alias(p) for p in PARAMETERS if p != "o3"],
        F.max(F.when(early, F.col("_o3_8h"))).alias("o3"),
        *[F.expr(f"count({p})").alias(f"{p}_hours") for p in PARAMETERS],
        F.count_if(early).alias("_early"),
    )
    return (
        profile.filter(F.col("_early") > 0)
        .drop("_early")
        .withColumnRenamed("_day", "published_at")
    )


def station_day(
    hourly: DataFrame, keys: Sequence[str] = ("station_id",), frame: str = "rows"
) -> DataFrame:
    """Daily station product; a flag is 1 from 20 hours with a value on."""
    profile = with_index(day_profile(hourly, keys, frame), "day")
    flags = {
        f"{p}_flag": F.expr(f"CAST({p}_hours >= {MIN_HOURS_PER_DAY} AS INT)") for p in PARAMETERS
    }
    return reported(profile.withColumns(flags)).drop(*[f"{p}_hours" for p in PARAMETERS])


def grid_day(
    hourly: DataFrame,
    keys: Sequence[str] = ("grid_id", "control_area_id"),
    frame: str = "rows",
) -> DataFrame:
    """Daily grid product; a flag is 1 where the day has a value at all."""
    profile = day_profile(hourly, keys, frame).drop(*[f"{p}_hours" for p in PARAMETERS])
    return presence_flags(reported(with_index(profile, "day"), blank_negative=False))


def area_hour(
    readings: DataFrame, members: DataFrame, on: Sequence[str], source: str
) -> DataFrame:
    """Hourly area product: mean over the members of each area.

    No broadcast hint: the optimiser compares the bridge's size with its
    threshold, and splits skewed partitions where it has to shuffle.
    """
    means = (
        readings.join(members, on=list(on), how="inner")
        .groupBy("area_id", "published_at")
        .agg(*parameter_means())
    )
    product = reported(with_index(means, "hour"), blank_negative=source == "monitoring")
    return product.withColumn("source", F.lit(source))


def covered(present: Column, members: Column, digits: int) -> Column:
    """1 if enough members of an area reported, by the share rule for its size."""
    share = F.round(present / members, digits)
    small = (members < SMALL_AREA_MEMBERS) & (share < SMALL_AREA_SHARE)
    large = (members >= SMALL_AREA_MEMBERS) & (share < LARGE_AREA_SHARE)
    return F.when(small | large, 0).otherwise(1)


def area_day_from(
    day: DataFrame,
    members: DataFrame,
    member: str,
    on: Sequence[str],
    source: str,
    digits: int,
) -> DataFrame:
    """Daily area product of one source, with its coverage flag ``valid``.

    ``day`` has one row per member and day.
    """
    bridge = members.select("area_id", *on).distinct()
    sizes = bridge.groupBy("area_id").agg(F.count(member).alias("_members"))
    means = (
        day.select(*on, "published_at", *PARAMETERS)
        .join(bridge, on=list(on), how="inner")
        .groupBy("area_id", "published_at")
        .agg(*parameter_means(), F.count(member).alias("_present"))
        .join(sizes, on="area_id")
        .withColumn("valid", covered(F.col("_present"), F.col("_members"), digits))
        .drop("_present", "_members")
    )
    product = reported(with_index(means, "day"), blank_negative=source == "monitoring")
    return presence_flags(product).withColumn("source", F.lit(source))


def area_day(
    stations: DataFrame,
    station_area: DataFrame,
    grids: DataFrame,
    grid_area: DataFrame,
    districts: DataFrame | None = None,
) -> DataFrame:
    """Daily area product of both sources, plus district rows copied as areas.

    Stations make the ``monitoring`` source (share to one decimal), grid cells
    the ``inference`` source (two decimals).
    """
    monitored = area_day_from(stations, station_area, "station_id", ["station_id"], "monitoring", 1)
    inferred = area_day_from(
        grids, grid_area, "grid_id", ["grid_id", "control_area_id"], "inference", 2
    )
    both = monitored.unionByName(inferred)
    if districts is None:
        return both
    return both.unionByName(districts, allowMissingColumns=True)


def district_as_area(districts: DataFrame, area_of: dict[int, int]) -> DataFrame:
    """District rows under the id of the area that covers the same ground.

    A district without such an area keeps its row with a null area.
    """
    area = clean.coded(F.col("control_area_id"), area_of).cast("int")
    return districts.withColumn("area_id", area).drop("control_area_id")


# --- periods ------------------------------------------------------------------


def period_columns(period: str) -> dict[str, Column]:
    """Columns that identify the period a day belongs to."""
    day = F.col("published_at")
    if period == "week":
        # report weeks run Saturday to Friday
        end = F.date_add(day, F.pmod(F.lit(6) - F.dayofweek(day), F.lit(7)))
        return {"published_start": F.date_sub(end, 6), "published_end": end}
    if period == "month":
        return {"published_year": F.year(day), "published_month": F.month(day)}
    if period == "quarter":
        return {"published_year": F.year(day), "published_quarter": F.quarter(day)}
    if period == "year":
        return {"published_year": F.year(day)}
    raise ValueError(f"unknown period: {period}")


def days_needed(period: str, needed: int | None = None) -> Column:
    """Days with a value that make a period valid; ``needed`` replaces the usual number."""
    if needed is not None:
        return F.lit(needed)
    if period == "week":
        return F.lit(MIN_DAYS_PER_WEEK)
    if period == "year":
        return F.lit(MIN_DAYS_PER_YEAR)
    if period == "month":
        return F.when(F.col("published_month") == 2, MIN_DAYS_PER_FEBRUARY).otherwise(
            MIN_DAYS_PER_MONTH
        )
    return F.lit(MIN_DAYS_PER_MONTH)


def _by_period(day: DataFrame, keys: Sequence[str], ids: dict[str, Column]) -> GroupedData:
    """Daily rows grouped by key and period, brought together as plain rows.

    A key has at most 366 days in a period, so no group can be large, and a
    partial percentile is bigger than the few rows it stands for: the rows are
    moved first and aggregated once.
    """
    placed = day.withColumns(ids)
    return placed.repartition(*keys, *ids).groupBy(*keys, *ids)


def _period_aggregates(valid_days: dict[str, str]) -> list[Column]:
    return [
        *published_means(),
        *[F.expr(valid_days[p]).alias(f"_{p}_days") for p in PARAMETERS],
        F.count_if(F.col("grade").isin(1, 2)).alias("std_day_num"),
        air.percentile_index(air.reported_sql("o3", "o3"), "o3").alias("o3_index"),
        air.percentile_index(air.reported_sql("co", "co"), "co").alias("co_index"),
    ]


def period_flags(period: str, needed: int | None = None, days: str = "_{}_days") -> dict[str, Column]:
    """``*_flag`` = 1 where a period has days enough; ``days`` names their counts."""
    enough = days_needed(period, needed)
    return {f"{p}_flag": (F.col(days.format(p)) >= enough).cast("int") for p in PARAMETERS}


def period_rollup(
    day: DataFrame, keys: Sequence[str], period: str, needed: int | None = None
) -> DataFrame:
    """Week, month, quarter or year product of stations, grid cells or areas.

    ``day`` is a daily product (published concentrations and ``grade``), one
    row per key and day.  The exact percentiles work on published values, so
    their state is bounded by the distinct published values of a period.
    """
    ids = period_columns(period)
    grouped = (
        _by_period(day, keys, ids)
        .agg(*_period_aggregates({p: f"count({p})" for p in PARAMETERS}))
        .withColumns(period_flags(period, needed))
        .withColumn("comprehensive_index", air.comprehensive_index())
    )
    dropped = [f"_{p}_days" for p in PARAMETERS]
    return reported(with_index(grouped, "day")).drop("o3_index", "co_index", *dropped)


# --- districts ----------------------------------------------------------------


def district_rollup(
    grid: DataFrame, level: str, districts: Sequence[int] | None = None
) -> DataFrame:
    """Hour or day product of districts: grid means, rounded, then graded.

    ``districts`` limits the product to these control areas, such as a ring.
    """
    if districts is not None:
        grid = grid.filter(F.col("control_area_id").isin(*districts))
    means = grid.groupBy("control_area_id", "published_at").agg(*parameter_means())
    product = with_index(reported(means, blank_negative=False), level, air.graded_iaqi, PARAMETERS)
    return presence_flags(product).withColumn("source", F.lit("inference"))


def district_period(day: DataFrame, period: str) -> DataFrame:
    """Month or year product of districts per source, graded on rounded means.

    Valid days are counted from the daily flags.
    """
    ids = period_columns(period)
    keys = ["source", "control_area_id"]
    flagged = {p: f"coalesce(sum({p}_flag), 0L)" for p in PARAMETERS}
    grouped = (
        _by_period(day, keys, ids)
        .agg(*_period_aggregates(flagged))
        .withColumns(period_flags(period))
    )
    rounded = reported(grouped).withColumn("comprehensive_index", air.comprehensive_index())
    dropped = [f"_{p}_days" for p in PARAMETERS]
    return with_index(rounded, "day", air.graded_iaqi, PARAMETERS).drop(
        "o3_index", "co_index", *dropped
    )


def days_by_grade(day: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Days of every grade, and of grades 1 and 2 together, per key and period."""
    ids = period_columns(period)
    names = ("excellent", "good", "mild", "middle", "severe", "very_severe")
    levels = range(1, len(GRADE_BOUNDS) + 2)
    return (
        day.withColumns(ids)
        .groupBy(*keys, *ids)
        .agg(
            F.count_if(F.col("grade").isin(1, 2)).alias("excellent_good"),
            *[F.count_if(F.col("grade") == g).alias(n) for g, n in zip(levels, names)],
        )
    )
