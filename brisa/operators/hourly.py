"""Vendor feeds to canonical hourly readings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import air, clean, times
from brisa.operators.index import reported, with_index
from brisa.operators.latest import first_per_key
from brisa.params import DASH, EM_DASH, PARAMETERS

WEATHER = ("temperature", "humidity", "wind_direction", "wind_power", "pressure")


@dataclass(frozen=True)
class Feed:
    """How one vendor writes its hourly readings.

    ``columns`` maps canonical names to the vendor's; names left out are
    missing in the feed; times are text, timestamps or epoch seconds.  ``scale`` multiplies every parameter but co (feeds
    in mg/m3 use 1000).  ``priority`` settles two feeds reporting one hour:
    the smaller wins.
    """

    columns: dict[str, str] = field(default_factory=dict)
    sentinels: Sequence[str] = (DASH,)
    marks: Sequence[str] = ()
    scale: float = 1.0
    station_prefix: str = ""
    priority: int = 0


def canonical(df: DataFrame, feed: Feed) -> DataFrame:
    """One feed in the canonical layout, sentinels blanked, units applied."""

    def source(name: str) -> Column:
        vendor = feed.columns.get(name, name)
        if vendor not in df.columns:
            return F.lit(None).cast("string")
        return F.col(f"`{vendor}`").cast("string")

    def reading(name: str) -> Column:
        value = clean.to_number(clean.blank_sentinels(source(name), feed.sentinels, feed.marks))
        if feed.scale != 1.0 and name in PARAMETERS and name != "co":
            value = value * F.lit(feed.scale)
        return value.alias(name)

    stamp = feed.columns.get("published_at", "published_at")
    ts = F.col(f"`{stamp}`")
    dtype = dict(df.dtypes)[stamp]
    if dtype == "string":
        ts = F.try_to_timestamp(ts)
    elif dtype in ("int", "bigint"):
        ts = clean.epoch_to_timestamp(ts)
    readings = df.select(
        F.concat(F.lit(feed.station_prefix), source("station_code")).alias("station_code"),
        times.floor_hour(ts.cast("timestamp_ntz")).alias("published_at"),
        *[reading(p) for p in PARAMETERS],
        *[reading(w) for w in WEATHER],
        F.lit(feed.priority).alias("_priority"),
    )
    # below zero, weather fields of these feeds hold fillers
    return readings.withColumns(
        {w: F.when(F.col(w) >= 0, F.col(w)) for w in WEATHER}
    ).filter(F.coalesce(*PARAMETERS).isNotNull())


def clean_hourly(
    feeds: Sequence[tuple[DataFrame, Feed]], station_grid: DataFrame
) -> DataFrame:
    """Canonical hourly readings of all feeds with index fields and grid tags.

    One row per station and hour: the preferred feed wins, then the larger
    readings, so the choice does not depend on the order of arrival.
    Stations missing from ``station_grid`` are dropped.
    """
    merged = reduce(
        DataFrame.unionByName, [canonical(df, feed) for df, feed in feeds]
    )
    order = [
        F.col("_priority").asc(),
        *[F.col(c).desc_nulls_last() for c in (*PARAMETERS, *WEATHER)],
    ]
    # tags first: readings of unknown stations are never ranked or shuffled
    known = merged.join(station_grid, on="station_code", how="inner")
    unique = first_per_key(known, ["station_code", "published_at"], order).drop("_priority")
    return reported(with_index(unique, "hour"))


def official_readings(
    feed: DataFrame, station_map: DataFrame, station_grid: DataFrame, unit: str = "hour"
) -> DataFrame:
    """Readings that arrive graded, in the canonical layout.

    ``feed`` has ``code_map``, ``published_at``, the six concentrations and
    their ``*_iaqi``, ``aqi``, ``grade`` and ``primary_pollutants`` as text;
    ``station_map`` translates ``code_map`` to ``station_code``.  Dashes become
    null, the grade is taken from the index, and there is one row per station
    and hour (or day, with ``unit="day"``): the one with the larger readings.
    """
    dashes = (DASH, EM_DASH)

    def number(name: str, dtype: str) -> Column:
        return clean.blank_sentinels(F.col(name), dashes).try_cast(dtype).alias(name)

    at = F.col("published_at")
    stamp = F.to_date(at) if unit == "day" else times.floor_hour(at)
    typed = feed.select(
        "code_map",
        stamp.alias("published_at"),
        *[number(p, "double" if p == "co" else "int") for p in PARAMETERS],
        *[number(f"{p}_iaqi", "int") for p in PARAMETERS],
        clean.numeric_text(F.col("aqi")).try_cast("int").alias("aqi"),
        F.col("grade").isNotNull().alias("_graded"),
        air.pollutant_list(F.col("primary_pollutants")).alias("primary_pollutants"),
    ).filter(F.coalesce(*PARAMETERS).isNotNull())
    mapped = typed.join(station_map, on="code_map").drop("code_map")
    order = [F.col(c).desc_nulls_last() for c in (*PARAMETERS, "aqi")]
    unique = first_per_key(mapped, ["station_code", "published_at"], order)
    graded = unique.withColumn("grade", F.when(F.col("_graded"), air.grade("aqi")))
    return graded.drop("_graded").join(station_grid, on="station_code")
