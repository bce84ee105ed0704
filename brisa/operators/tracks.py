"""Track files of survey vehicles and ships."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brisa.functions import clean, geo
from brisa.operators.conform import conform, renamed
from brisa.operators.spatial import join_boxes
from brisa.params import DUST_TRACK_COLUMNS, VOC_TRACK_COLUMNS


def shift_positions(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Replace WGS-84 positions by the national map datum."""
    new_lon, new_lat = geo.shifted(lon, lat)
    return df.withColumns({lon: new_lon, lat: new_lat})


def load_track(lines: DataFrame, cells: DataFrame, tile: float) -> DataFrame:
    """Organic-compound track: distinct rows inside a grid cell, positions shifted.

    Cells are matched on the measured position, both edges included.
    """
    numbers = conform(
        lines.distinct(),
        {
            "tvoc_time": ("tvoc_time", "string"),
            **{c: (c, "double") for c in VOC_TRACK_COLUMNS[1:] if c in lines.columns},
        },
    )
    inside = join_boxes(numbers, cells, tile, edges="closed", how="inner")
    return shift_positions(inside)


def load_dust_track(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Road-dust track: canonical names, numbers, times, shifted positions."""
    present = {s: t for s, t in DUST_TRACK_COLUMNS.items() if s in rows.columns}
    named = conform(rows, renamed(present))
    typed = named.select(
        *[
            clean.vendor_time(F.col(c)).alias(c)
            if c == "published_at"
            else clean.to_number(F.col(c)).alias(c)
            for c in named.columns
        ]
    )
    shifted = shift_positions(typed)
    return shifted if columns is None else shifted.select(*columns)
