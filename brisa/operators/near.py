"""What is counted once near a centre (trucks, road sections), without moving pairs of the two.

Every spot, or tile that lies inside a circle, has the list of centres it is near to.  What is
counted is dealt by itself and by regions of centres before it meets the lists; its lists
are united in the task that holds it, and only totals of centres leave that task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brisa.functions import geo
from brisa.operators import tiles
from brisa.operators.spatial import join_radius
from brisa.session import shuffle_tasks, stored

REGION = ["_rband", "_rtile"]
REGION_RADII = 4  # side of a region, in radii
KEY = [*tiles.TILE, "lon", "lat"]
SPOT = -1  # level of keys that are a spot, not a tile
FEW_IDS = 4_000_000  # numbers of centres that are broadcast, once counted


def numbered(centres: DataFrame, radius_m: float) -> DataFrame:
    """Centres with a number ``_id`` and the region they lie in."""
    wide = REGION_RADII * radius_m
    placed = centres.withColumn("_rband", geo.lat_band("lat", wide)).withColumn(
        "_rtile", F.expr(f"floor(lon / {geo.band_lon_step_sql('_rband', wide)})")
    )
    return stored(placed.withColumn("_id", F.monotonically_increasing_id()), "centres")


def dealt(rows: DataFrame, radius_m: float, by: Sequence[str]) -> DataFrame:
    """Rows under every region whose centres can be within ``radius_m``, dealt by ``by`` and region.

    The number of tasks is given: what a row becomes there is far more than its own bytes.
    """
    wide = REGION_RADII * radius_m
    reach = radius_m / geo.METRES_PER_DEGREE * 1.01
    step = geo.band_lon_step_sql("_rband", wide)
    own = geo.band_lon_step_sql(geo.lat_band_sql("lat", wide), wide)
    height = repr(wide / geo.METRES_PER_DEGREE) + "D"
    bands = f"explode(sequence(floor((lat - {reach!r}D) / {height}), floor((lat + {reach!r}D) / {height})))"
    west = f"(greatest({step}, {own}) / {REGION_RADII} * 1.01D)"
    columns = f"explode(sequence(floor((lon - {west}) / {step}), floor((lon + {west}) / {step})))"
    listed = rows.withColumn("_rband", F.expr(bands)).withColumn("_rtile", F.expr(columns))
    return listed.repartition(shuffle_tasks(rows), *by, *REGION)


def _lists(pairs: DataFrame) -> DataFrame:
    """Numbers of the centres by key and region; broadcast if they are few."""
    lists = stored(pairs.groupBy(*KEY, *REGION).agg(F.collect_list("_id").alias("_ids")), "near-lists")
    count = lists.agg(F.sum(F.size("_ids"))).first()[0] or 0
    return F.broadcast(lists) if count <= FEW_IDS else lists


def _spot_key() -> dict:
    return {"_level": F.lit(SPOT), "_row": F.lit(0).cast("bigint"), "_column": F.lit(0).cast("bigint")}


def lists_by_spot(rows: DataFrame, centres: DataFrame, radius_m: float) -> DataFrame:
    """The numbered centres closer than ``radius_m`` to each spot."""
    spots = rows.select("lon", "lat").distinct().repartition(shuffle_tasks(rows))
    return _lists(join_radius(spots, centres, radius_m, ["_id", *REGION]).withColumns(_spot_key()))


def lists_by_tile(rows: DataFrame, centres: DataFrame, radius_m: float) -> DataFrame:
    """The numbered centres whose circle holds a tile, and those of the spots on its rim."""
    side = tiles.smallest_side(radius_m)
    cover = tiles.stored_cover(centres, radius_m, ["_id", *REGION], side)
    nowhere = {"lon": F.lit(0.0), "lat": F.lit(0.0)}
    whole = cover.where("_inside").withColumns(nowhere).select(*KEY, *REGION, "_id")
    spots = rows.select("lon", "lat", geo.tile("lat", side).alias("_row"), geo.tile("lon", side).alias("_column")).distinct()
    near = geo.distance_m("lon", "lat", "_clon", "_clat") < radius_m
    rim = cover.where("NOT _inside").hint("merge").join(spots, ["_row", "_column"]).where(near)
    return _lists(whole.unionByName(rim.withColumns(_spot_key()).select(*KEY, *REGION, "_id")))


def _united(column: str):
    return F.array_distinct(F.flatten(F.collect_list(column)))


def count_members(
    rows: DataFrame, centres: DataFrame, radius_m: float, members: Sequence[str], name: str, by_tile: bool = False
) -> DataFrame:
    """Distinct ``members`` with a row closer than ``radius_m`` to each numbered centre: ``_id``, ``name``.

    By tile, the rows of a member in one tile count as one for every circle that holds the tile.
    """
    spots = rows.select(*members, "lon", "lat").distinct()
    lists = (lists_by_tile if by_tile else lists_by_spot)(spots, centres, radius_m)
    placed = dealt(spots, radius_m, members)
    if by_tile:
        side = tiles.smallest_side(radius_m)
        row, column = geo.tile("lat", side), geo.tile("lon", side)
        spot = F.struct(*[c.alias(n) for n, c in _spot_key().items()], F.col("lon"), F.col("lat"))
        tile = [
            F.struct(
                F.lit(level).alias("_level"), F.shiftright(row, level).alias("_row"), F.shiftright(column, level).alias("_column"),
                F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"),
            )
            for level in range(tiles.LEVELS)
        ]
        placed = placed.select(*members, *REGION, F.inline(F.array(spot, *tile))).distinct()
    else:
        placed = placed.withColumns(_spot_key())
    sets = placed.join(lists, [*KEY, *REGION]).groupBy(*members, *REGION).agg(_united("_ids").alias("_ids"))
    return sets.select(F.explode("_ids").alias("_id")).groupBy("_id").agg(F.count("*").alias(name))


def mean_of_largest(
    rows: DataFrame, centres: DataFrame, radius_m: float, member: Sequence[str], value: str, by: Sequence[str]
) -> DataFrame:
    """Mean per numbered centre and ``by`` of each member's largest ``value`` closer than ``radius_m``.

    ``by`` is part of ``member``.  Centres that a member reaches with a larger value are taken
    out of the lists of its smaller ones.
    """
    spots = rows.groupBy(*member, "lon", "lat").agg(F.max(value).alias(value))
    lists = lists_by_spot(spots, centres, radius_m)
    placed = dealt(spots, radius_m, member).withColumns(_spot_key())
    levels = placed.join(lists, [*KEY, *REGION]).groupBy(*member, *REGION, value).agg(_united("_ids").alias("_ids"))
    sets = levels.groupBy(*member, *REGION).agg(F.sort_array(F.collect_list(F.struct(value, "_ids")), asc=False).alias("_sets"))
    larger = "flatten(transform(slice(_sets, 1, i), y -> y._ids))"
    rest = f"transform(_sets, (x, i) -> struct(x.{value} AS {value}, if(i = 0, x._ids, array_except(x._ids, {larger})) AS _ids))"
    reached = sets.select(*by, F.expr(f"inline({rest})"))
    return reached.select(*by, value, F.explode("_ids").alias("_id")).groupBy("_id", *by).agg(F.avg(value).alias(value))
