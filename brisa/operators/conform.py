"""Bring a vendor table to a target layout: rename, cast, complete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import clean
from brisa.functions.air import pollutant_codes
from brisa.params import FENCE_MEANS, FENCE_MINUTES, PARAMETERS, READING_CODES, REMOTE_SENSING

# target column -> (source column or expression or None, target type)
Layout = Mapping[str, tuple[str | Column | None, str]]


def conform(df: DataFrame, layout: Layout) -> DataFrame:
    """One projection to the target layout.

    A source of ``None`` adds the column as null.  Casts are lenient: text that
    does not parse becomes null.
    """
    out = []
    for name, (source, dtype) in layout.items():
        if source is None:
            value = F.lit(None)
        elif isinstance(source, str):
            value = F.col(f"`{source}`")
        else:
            value = source
        cast = value.cast(dtype) if source is None else value.try_cast(dtype)
        out.append(cast.alias(name))
    return df.select(*out)


def renamed(columns: Mapping[str, str], dtype: str = "string") -> dict:
    """Layout of a plain vendor-name to canonical-name mapping."""
    return {target: (source, dtype) for source, target in columns.items()}


def pick_json(
    text: Column, fields: Mapping[str, str], dtype: str = "string"
) -> dict[str, Column]:
    """Fields of a JSON text under new names; the text is parsed once."""
    schema = ", ".join(f"`{source}` {dtype}" for source in fields)
    parsed = F.from_json(text, schema)
    return {target: parsed[source] for source, target in fields.items()}


def pivot_readings(
    readings: DataFrame,
    keys: Sequence[str],
    code: str,
    value: str,
    codes: Mapping[str, str],
) -> DataFrame:
    """Long readings to one wide row per key, largest value per code.

    The codes are listed, so no job runs to find them, and the maximum is
    combined before the shuffle.
    """
    return readings.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(code) == source, F.col(value))).alias(target)
            for source, target in codes.items()
        ]
    )


def official_districts(
    feed: DataFrame,
    district_codes: Mapping[str, int],
    grade_labels: Mapping[str, int],
    primary_codes: Mapping[str, str],
) -> DataFrame:
    """Officially graded district rows in the district layout.

    Unknown districts map to 0; rows without a known grade label are dropped.
    """
    out = feed.select(
        clean.coded(F.col("district_code"), district_codes, 0).alias("control_area_id"),
        F.col("published_at"),
        *[
            F.col(p).try_cast("double" if p == "co" else "int").alias(p)
            for p in PARAMETERS
        ],
        F.col("aqi").try_cast("int").alias("aqi"),
        clean.coded(F.col("grade_label"), grade_labels, -99).alias("grade"),
        pollutant_codes(F.col("primary_pollutant"), primary_codes).alias("primary_pollutants"),
        F.lit("monitoring").alias("source"),
    )
    return out.filter(F.col("grade") != -99)


def typed(
    columns: Sequence[str], whole: Sequence[str] = (), times: Sequence[str] = (), text: Sequence[str] = ()
) -> dict:
    """Layout of a table whose columns keep their names: numbers, but for those listed."""
    kinds = {**dict.fromkeys(whole, "int"), **dict.fromkeys(times, "timestamp_ntz"), **dict.fromkeys(text, "string")}
    return {c: (c, kinds.get(c, "double")) for c in columns}


_FENCE_WHOLE = ("gridid", "stationid", "oilstatus", "status")

#: Layouts of the wide tables: 50 columns of means by hour and day, 39 by minute, 39 of passing vehicles.
WIDE = {
    "fence_hour": typed(FENCE_MEANS, _FENCE_WHOLE, ["avgdate"], ["deviceid"]),
    "fence_day": typed(FENCE_MEANS, _FENCE_WHOLE, ["avgdate"], ["deviceid"]),
    "fence_minute": typed(FENCE_MINUTES, (*_FENCE_WHOLE, "p7"), ["createdate"], ["deviceid"]),
    "remote_sensing": typed(
        REMOTE_SENSING,
        times=["published_at", "record_time"],
        text=[
            "record_number", "point_number", "lane_number", "plate_number", "plate_color", "record", "modified_by",
            "dynamic_mode", "pass", "result", "equipment_mark", "ringelman", "fueltype",
        ],
    ),
}


def conform_wide(df: DataFrame, table: str) -> DataFrame:
    """A copied table in its typed layout; columns the source lacks come out null."""
    there = set(df.columns)
    return conform(df, {c: (s if s in there else None, kind) for c, (s, kind) in WIDE[table].items()})


def district_readings(feed: DataFrame, prefix: str) -> DataFrame:
    """A district's long feed (StationCode, TimePoint, PollutantCode, MonValue) as hourly rows.

    The largest value per station, time and code; pollutants but co come in mg/m3.  Weather
    codes go along; rows without any pollutant are dropped.  Unknown codes are ignored.
    """
    wide = pivot_readings(feed, ["StationCode", "TimePoint"], "PollutantCode", "MonValue", READING_CODES)
    scaled = wide.withColumns({p: F.col(p) * 1000 for p in PARAMETERS if p != "co"})
    weather = ("temperature", "humidity", "wind_direction", "wind_power", "pressure")
    return scaled.dropna("all", subset=list(PARAMETERS)).select(
        clean.prefixed(F.col("StationCode"), prefix).alias("station_code"),
        F.col("TimePoint").alias("published_at"), *PARAMETERS, *weather,
    )
