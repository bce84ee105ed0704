"""Totals inside circles from a pyramid of tiles: whole tiles are added, distances tested on the rim."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from brisa.functions import geo
from brisa.session import shuffle_tasks, stored

LEVELS = 4  # sides 1, 2, 4 and 8
PER_RADIUS = 16  # smallest tiles along a radius
TILE = ["_level", "_row", "_column"]


def smallest_side(radius_m: float) -> float:
    return radius_m / geo.METRES_PER_DEGREE / PER_RADIUS


def cover_circles(
    centres: DataFrame, radius_m: float, centre_cols: Sequence[str], side: float | None = None, levels: int = LEVELS
) -> DataFrame:
    """The tiles that a circle around each centre touches: ``_level``, ``_row``, ``_column``, ``_inside``.

    Large tiles are classed first.  One whose farthest corner is within the circle
    is listed as inside; one whose nearest point is beyond it is left out; any other is
    cut in four.  Smallest tiles that are neither are the rim.  A thousandth of the radius
    and a metre are left on both sides, so that rounding cannot put a tile in the
    wrong class.  Longitudes must not wrap.
    """
    side = side or smallest_side(radius_m)
    slack = radius_m * 1e-3 + 1
    reach = radius_m / geo.METRES_PER_DEGREE * 1.01

    def corners(df: DataFrame, level: int) -> DataFrame:
        width = side * 2**level
        edges = {"_s": f"_row * {width!r}D", "_n": f"(_row + 1) * {width!r}D", "_w": f"_column * {width!r}D", "_e": f"(_column + 1) * {width!r}D"}
        far = ", ".join(geo.great_circle_m_sql("_clon", "_clat", lon, lat) for lon in ("_w", "_e") for lat in ("_s", "_n"))
        near = geo.great_circle_m_sql("_clon", "_clat", "least(greatest(_clon, _w), _e)", "least(greatest(_clat, _s), _n)")
        df = df.withColumns({name: F.expr(text) for name, text in edges.items()})
        df = df.withColumns({"_inside": F.expr(f"greatest({far}) < {radius_m - slack!r}D"), "_near": F.expr(near)})
        return df.where(F.col("_near") <= radius_m + slack).drop("_s", "_n", "_w", "_e", "_near")

    widest = side * 2 ** (levels - 1)
    west = f"({reach!r}D / cos(radians(least(abs(lat) + {reach!r}D, 89D))))"
    steps = lambda v, r: F.expr(f"explode(sequence(floor(({v} - {r}) / {widest!r}D), floor(({v} + {r}) / {widest!r}D)))")
    listed = centres.select(
        *centre_cols, F.col("lon").alias("_clon"), F.col("lat").alias("_clat"),
        steps("lat", f"{reach!r}D").alias("_row"), "lon", "lat",
    ).withColumn("_column", steps("lon", west)).drop("lon", "lat")
    found = []
    names = [*centre_cols, "_clon", "_clat", *TILE, "_inside"]
    for level in reversed(range(levels)):
        classed = corners(listed, level).withColumn("_level", F.lit(level))
        if level == 0:
            found.append(classed.select(*names))
            break
        found.append(classed.where("_inside").select(*names))
        quarter = F.inline(F.array(*[F.struct((F.col("_row") * 2 + i).alias("_r"), (F.col("_column") * 2 + j).alias("_c")) for i in (0, 1) for j in (0, 1)]))
        listed = classed.where("NOT _inside").select(*centre_cols, "_clon", "_clat", quarter)
        listed = listed.withColumnsRenamed({"_r": "_row", "_c": "_column"})
    return reduce(DataFrame.unionByName, found)


def stored_cover(
    centres: DataFrame, radius_m: float, centre_cols: Sequence[str], side: float | None = None, levels: int = LEVELS
) -> DataFrame:
    """``cover_circles`` computed once, in as many tasks as a shuffle has.

    A centre becomes some hundred tiles, which no estimate of sizes knows of: the centres
    are dealt out before, and joins with the cover are hinted to merge, so that it is never broadcast.
    """
    return stored(cover_circles(centres.repartition(shuffle_tasks(centres)), radius_m, centre_cols, side, levels), "cover")


def near_totals(
    points: DataFrame,
    centres: DataFrame,
    radius_m: float,
    centre_cols: Sequence[str],
    sums: Mapping[str, str],
    members: Sequence[str] = (),
    side: float | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """Sums over the points closer than ``radius_m`` to each centre, per centre (and ``members``).

    ``sums`` gives each total's name and value.  Points are added up by spot and tile
    before anything is joined, so a crowded tile counts as one row (one for each of its
    ``members``, as the trucks seen in it) for every centre whose circle holds all of it.
    """
    side = side or smallest_side(radius_m)
    totals = [F.sum(n).alias(n) for n in sums]
    placed = points.withColumns({"_row": geo.tile("lat", side), "_column": geo.tile("lon", side)})
    spots = placed.groupBy("_row", "_column", "lon", "lat", *members).agg(*[F.expr(f"sum({v})").alias(n) for n, v in sums.items()])
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_level")
    wider = {c: F.expr(f"shiftright({c}, _level)") for c in ("_row", "_column")}
    tiles = spots.groupBy("_row", "_column", *members).agg(*totals).select("*", level).withColumns(wider)
    tiles = tiles.groupBy(*TILE, *members).agg(*totals)

    spot = ["_clon", "_clat"]  # centres at one place share its totals
    at = centres.select("lon", "lat").distinct()
    cover = stored_cover(at, radius_m, [], side, levels)
    names = [*spot, *members, *sums]
    whole = cover.where("_inside").hint("merge").join(tiles, TILE).select(*names)
    near = geo.distance_m("lon", "lat", "_clon", "_clat") < radius_m
    rim = cover.where("NOT _inside").hint("merge").join(spots, ["_row", "_column"]).where(near).select(*names)
    found = whole.unionByName(rim).groupBy(*spot, *members).agg(*totals)
    placed = centres.select(*centre_cols, F.col("lon").alias("_clon"), F.col("lat").alias("_clat"))
    return placed.join(found, spot).groupBy(*centre_cols, *members).agg(*totals)
