"""Geodesy expressions: distance, map-datum shift, grid arithmetic, tiles.

As in :mod:`brisa.functions.air`, ``name_sql`` gives SQL text over operand
texts and ``name`` the same as a ``Column``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column

from brisa.functions.text import as_column
from brisa.params import EARTH_RADIUS_M, GRID_BOXES

# --- fixed values: national datum shift ---------------------------------------
AXIS = 6378245.0
ECCENTRICITY_SQ = 0.00669342162296594323
SHIFT_LON_RANGE = (72.004, 137.8347)
SHIFT_LAT_RANGE = (0.8293, 55.8271)
SHIFT_ORIGIN = (105.0, 35.0)

METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0


def great_circle_m_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Haversine distance in metres, not rounded."""
    half_lat = f"sin(radians({lat1} - {lat2}) / 2D)"
    half_lon = f"sin(radians({lon1} - {lon2}) / 2D)"
    parallels = f"cos(radians({lat1})) * cos(radians({lat2}))"
    h = f"{half_lat} * {half_lat} + {parallels} * {half_lon} * {half_lon}"
    return f"({2.0 * EARTH_RADIUS_M!r}D * asin(sqrt({h})))"


def distance_m_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Haversine distance in whole metres (cut, after rounding to 0.1 mm)."""
    metres = great_circle_m_sql(lon1, lat1, lon2, lat2)
    return f"floor(floor({metres} * 10000D + 0.5D) / 10000D)"


def _waves(x: str, *terms: tuple[float, str]) -> str:
    """Two thirds of the sum of ``amplitude * sin(x * pi * pace)``."""
    waves = " + ".join(f"{a!r}D * sin({x} * pi() * {pace})" for a, pace in terms)
    return f"({waves}) * 2D / 3D"


def _shift_sql(lon: str, lat: str, axis: str) -> str:
    x, y = f"({lon} - {SHIFT_ORIGIN[0]!r}D)", f"({lat} - {SHIFT_ORIGIN[1]!r}D)"
    short = _waves(x, (20.0, "6D"), (20.0, "2D"))
    phi = f"radians({lat})"
    w = f"(1D - {ECCENTRICITY_SQ!r}D * sin({phi}) * sin({phi}))"
    if axis == "lat":
        offset = (
            f"-100D + 2D * {x} + 3D * {y} + 0.2D * {y} * {y} + 0.1D * {x} * {y}"
            f" + 0.2D * sqrt(abs({x})) + {short} + "
            + _waves(y, (20.0, "1D"), (40.0, "1D / 3D"))
            + " + "
            + _waves(y, (160.0, "1D / 12D"), (320.0, "1D / 30D"))
        )
        degree = f"({AXIS * (1 - ECCENTRICITY_SQ)!r}D / ({w} * sqrt({w})) * pi() / 180D)"
        base = lat
    else:
        offset = (
            f"300D + {x} + 2D * {y} + 0.1D * {x} * {x} + 0.1D * {x} * {y}"
            f" + 0.1D * sqrt(abs({x})) + {short} + "
            + _waves(x, (20.0, "1D"), (40.0, "1D / 3D"))
            + " + "
            + _waves(x, (150.0, "1D / 12D"), (300.0, "1D / 30D"))
        )
        degree = f"({AXIS!r}D / sqrt({w}) * cos({phi}) * pi() / 180D)"
        base = lon
    (west, east), (south, north) = SHIFT_LON_RANGE, SHIFT_LAT_RANGE
    inside = f"{lon} BETWEEN {west}D AND {east}D AND {lat} BETWEEN {south}D AND {north}D"
    return f"round(CASE WHEN {inside} THEN {base} + ({offset}) / {degree} ELSE {base} END, 6)"


def shifted_lon_sql(lon: str, lat: str) -> str:
    """Longitude on the national map datum, six decimals; unchanged outside its box."""
    return _shift_sql(lon, lat, "lon")


def shifted_lat_sql(lon: str, lat: str) -> str:
    """Latitude on the national map datum, six decimals; unchanged outside its box."""
    return _shift_sql(lon, lat, "lat")


def grid_index_sql(value: str, low: float, high: float, cells: int | str) -> str:
    """1-based cell number of a coordinate along one side of a box."""
    step = f"({high - low!r}D / {cells})" if isinstance(cells, str) else f"{(high - low) / cells!r}D"
    return f"ceil(({value} - {low!r}D) / {step})"


def grid_id_sql(lon: str, lat: str, box: str, rows: int | str, columns: int | str) -> str:
    """Arithmetic grid id: ``(row + 100000) * 1000000 + column + 100000``."""
    min_lat, max_lat, min_lon, max_lon = GRID_BOXES[box]
    row = grid_index_sql(lat, min_lat, max_lat, rows)
    column = grid_index_sql(lon, min_lon, max_lon, columns)
    return f"(({row} + 100000) * 1000000 + {column} + 100000)"


def tile_sql(value: str, size: float) -> str:
    """Number of the tile of the given size that holds a coordinate."""
    return f"floor({value} / {float(size)!r}D)"


def lat_band_sql(lat: str, radius_m: float) -> str:
    """Number of the latitude band of height ``radius_m`` that holds ``lat``."""
    return tile_sql(lat, radius_m / METRES_PER_DEGREE)


def band_lon_step_sql(band: str, radius_m: float) -> str:
    """Width in degrees of the tiles of a band: at least ``radius_m`` everywhere in it."""
    height = radius_m / METRES_PER_DEGREE
    edge = f"greatest(abs({band}), abs({band} + 1)) * {height!r}D"
    return f"({height!r}D / cos(radians(least({edge}, 89D))))"


distance_m = as_column(distance_m_sql)
grid_id = as_column(grid_id_sql)
tile = as_column(tile_sql)
lat_band = as_column(lat_band_sql)
band_lon_step = as_column(band_lon_step_sql)


def shifted(lon: str, lat: str) -> tuple[Column, Column]:
    """Both shifted coordinates, each from the original pair."""
    return as_column(shifted_lon_sql)(lon, lat), as_column(shifted_lat_sql)(lon, lat)
