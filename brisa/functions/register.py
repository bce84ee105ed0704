"""The index expressions as SQL functions of a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from brisa.functions import air, geo
from brisa.params import (
    ANNUAL_STANDARD, PARAMETERS, PERIOD_PERCENTILE, PRIMARY_CODES, PRIMARY_ORDER,
)


def definitions() -> dict[str, str]:
    """Name and signature of every function -> the expression it returns.

    ``iaqi_<scale>_<parameter>(v)`` and ``graded_iaqi_...`` give sub-indices;
    ``aqi_...``, ``grade_...`` and ``primary_...`` work on six concentrations in
    the order of ``PARAMETERS``.
    """
    out: dict[str, str] = {}
    methods: dict[str, Callable[..., str]] = {
        "iaqi": air.iaqi_sql, "graded_iaqi": air.graded_iaqi_sql
    }
    six = ", ".join(f"{p} DOUBLE" for p in PARAMETERS)
    for scale in ("hour", "day"):
        for name, method in methods.items():
            for p in PARAMETERS:
                out[f"{name}_{scale}_{p}(v DOUBLE) RETURNS BIGINT"] = method("v", p, scale)
        out[f"aqi_{scale}({six}) RETURNS BIGINT"] = air.aqi_sql(
            lambda p, s=scale: f"graded_iaqi_{s}_{p}({p})"
        )
        out[f"primary_{scale}({six}) RETURNS ARRAY<STRING>"] = air.primary_pollutants_sql(
            f"aqi_{scale}({', '.join(PARAMETERS)})",
            lambda p, s=scale: f"graded_iaqi_{s}_{p}({p})",
            PARAMETERS,
        )
    subs = ", ".join(f"{p}_iaqi BIGINT" for p in PARAMETERS)
    out["grade(aqi DOUBLE) RETURNS INT"] = air.grade_sql("aqi")
    out[f"primary_of(aqi BIGINT, {subs}) RETURNS ARRAY<STRING>"] = air.primary_pollutants_sql(
        order=PRIMARY_ORDER
    )
    out["grade_within_points(grade INT, aqi DOUBLE) RETURNS INT"] = air.grade_within_points_sql(
        "grade", "aqi"
    )
    out["grade_within_share(grade INT, aqi DOUBLE) RETURNS INT"] = air.grade_within_share_sql(
        "grade", "aqi"
    )
    out["primary_agrees(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS INT"] = air.primary_agrees_sql(
        "a", "b"
    )
    singles = {
        p: f"{air.array_percentile_sql(f'{p}_values', PERIOD_PERCENTILE[p])} / {ANNUAL_STANDARD[p]}D"
        for p in PERIOD_PERCENTILE
    }
    out[
        "comprehensive_index(pm2_5 DOUBLE, pm10 DOUBLE, o3_values ARRAY<DOUBLE>,"
        " co_values ARRAY<DOUBLE>, no2 DOUBLE, so2 DOUBLE) RETURNS DOUBLE"
    ] = air.comprehensive_index_sql(singles["o3"], singles["co"])
    pair = "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE"
    out[f"distance_m({pair}) RETURNS BIGINT"] = geo.distance_m_sql("lon1", "lat1", "lon2", "lat2")
    for axis, text in (("lon", geo.shifted_lon_sql), ("lat", geo.shifted_lat_sql)):
        out[f"shifted_{axis}(lon DOUBLE, lat DOUBLE) RETURNS DOUBLE"] = text("lon", "lat")
    for box, (rows, columns) in (("inner", (500, 500)), ("outer", (500, 500)), ("city", (1000, 1200))):
        cells = f"n_rows INT DEFAULT {rows}, n_columns INT DEFAULT {columns}"
        out[f"grid_id_{box}(lon DOUBLE, lat DOUBLE, {cells}) RETURNS BIGINT"] = geo.grid_id_sql(
            "lon", "lat", box, "n_rows", "n_columns"
        )
    codes = ", ".join(f"'{code}', '{name}'" for code, name in PRIMARY_CODES.items())
    out["primary_codes(codes STRING) RETURNS ARRAY<STRING>"] = (
        f"filter(transform(split(codes, ','), c -> element_at(map({codes}), trim(c))), x -> x IS NOT NULL)"
    )
    return out


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; they are inlined into queries."""
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in definitions()]
