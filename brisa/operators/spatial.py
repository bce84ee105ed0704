"""Spatial joins and trajectories, planned as equi-joins on computed tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.functions import geo, times
from brisa.operators.latest import first_per_key
from brisa.session import stored

# How a box treats its own edges: low side, high side.
EDGES = {
    "open_closed": (lambda v, low: v > low, lambda v, high: v <= high),
    "closed_open": (lambda v, low: v >= low, lambda v, high: v < high),
    "closed": (lambda v, low: v >= low, lambda v, high: v <= high),
}


def parse_cells(cells: DataFrame) -> DataFrame:
    """Grid cells whose corners are JSON texts as plain bounds."""
    corner = "lat double, lon double"
    low = F.from_json("bottom_left_coord", corner)
    high = F.from_json("top_right_coord", corner)
    return cells.select(
        F.col("id").alias("grid_id"),
        "grid_scale",
        low["lat"].alias("min_lat"),
        low["lon"].alias("min_lon"),
        high["lat"].alias("max_lat"),
        high["lon"].alias("max_lon"),
    )


def _tiles(low: str, high: str, size: float) -> Column:
    return F.explode(F.sequence(geo.tile(low, size), geo.tile(high, size)))


def join_boxes(
    points: DataFrame,
    cells: DataFrame,
    tile: float,
    edges: str = "open_closed",
    how: str = "left",
) -> DataFrame:
    """Every point with the box it lies in.

    Points get the number of their tile of ``tile`` degrees; each box is listed
    under every tile it touches.  The join is on the tile numbers and the exact
    bounds are checked on the matches, so points are neither duplicated nor
    compared with far boxes.  Choose ``tile`` near the size of a box.
    """
    above, below = EDGES[edges]
    boxed = cells.select(
        "grid_id",
        *[F.col(c).alias(f"_{c}") for c in ("min_lat", "min_lon", "max_lat", "max_lon")],
        _tiles("min_lat", "max_lat", tile).alias("_row"),
        "min_lon",
        "max_lon",
    ).withColumn("_column", _tiles("min_lon", "max_lon", tile))
    boxed = boxed.drop("min_lon", "max_lon")
    placed = points.withColumns(
        {"_prow": geo.tile("lat", tile), "_pcolumn": geo.tile("lon", tile)}
    )
    inside = (
        (F.col("_prow") == F.col("_row"))
        & (F.col("_pcolumn") == F.col("_column"))
        & above(F.col("lat"), F.col("_min_lat"))
        & below(F.col("lat"), F.col("_max_lat"))
        & above(F.col("lon"), F.col("_min_lon"))
        & below(F.col("lon"), F.col("_max_lon"))
    )
    return placed.join(boxed, on=inside, how=how).drop(
        "_prow", "_pcolumn", "_row", "_column", "_min_lat", "_min_lon", "_max_lat", "_max_lon"
    )


def tag_grid(
    points: DataFrame, cells: DataFrame, tiles: tuple[float, float], edges: str = "open_closed"
) -> DataFrame:
    """Points with the fine (``grid_id``) and coarse (``grid_id_two``) cell.

    ``cells`` holds both scales; ``tiles`` gives the tile size of each.  Points
    outside all cells keep null ids.
    """
    fine, coarse = tiles
    once = join_boxes(points, cells.filter(F.col("grid_scale") == 1), fine, edges)
    once = once.withColumnRenamed("grid_id", "_fine")
    twice = join_boxes(once, cells.filter(F.col("grid_scale") == 2), coarse, edges)
    return twice.withColumnsRenamed({"grid_id": "grid_id_two", "_fine": "grid_id"})


def station_grid(stations: DataFrame, bridge: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per station with its fine and coarse cell.

    Stations without a fine cell stay (null); those without a coarse one too.
    The bridge is grouped once instead of being joined once per scale.
    """
    scaled = bridge.join(cells.select("grid_id", "grid_scale"), on="grid_id")
    per_station = scaled.groupBy("station_id").agg(
        F.min(F.when(F.col("grid_scale") == 1, F.col("grid_id"))).alias("grid_id"),
        F.min(F.when(F.col("grid_scale") == 2, F.col("grid_id"))).alias("grid_id_two"),
    )
    return stations.join(per_station, on="station_id", how="left")


def join_radius(
    points: DataFrame, centres: DataFrame, radius_m: float, centre_cols: Sequence[str]
) -> DataFrame:
    """Pairs of points and centres closer than ``radius_m``.

    The plane is cut into latitude bands as high as the radius and, per band,
    tiles at least as wide.  A point belongs to one tile.  A centre is listed
    under the tiles its circle can touch in its own and both adjoining bands.
    Distances are computed for tile matches only.  Longitudes must not wrap.
    """
    step = geo.band_lon_step_sql("_band", radius_m)
    own_step = geo.band_lon_step_sql(geo.lat_band_sql("_clat", radius_m), radius_m)
    placed = points.withColumn("_pband", geo.lat_band("lat", radius_m)).withColumn(
        "_ptile", F.expr(f"floor(lon / {geo.band_lon_step_sql('_pband', radius_m)})")
    )
    band = geo.lat_band_sql("lat", radius_m)
    listed = (
        centres.select(
            *centre_cols,
            F.col("lon").alias("_clon"),
            F.col("lat").alias("_clat"),
            F.expr(f"explode(sequence({band} - 1, {band} + 1))").alias("_band"),
        )
        # the reach in a band is at most the wider of its tiles and the centre's own
        .withColumns(
            {"_step": F.expr(step), "_reach": F.expr(f"greatest({step}, {own_step}) * 1.01D")}
        )
        .withColumn(
            "_tile",
            F.expr(
                "explode(sequence(floor((_clon - _reach) / _step), floor((_clon + _reach) / _step)))"
            ),
        )
        .drop("_step", "_reach")
    )
    metres = geo.distance_m("lon", "lat", "_clon", "_clat")
    pairs = placed.join(
        listed,
        on=(F.col("_pband") == F.col("_band"))
        & (F.col("_ptile") == F.col("_tile"))
        & (metres < radius_m),
    )
    return pairs.drop("_pband", "_ptile", "_band", "_tile", "_clon", "_clat")


def thin_trajectory(
    points: DataFrame,
    vehicle: str = "name",
    box: str = "inner",
    cells: int = 500,
) -> DataFrame:
    """Points where a vehicle enters another grid cell; the first one counts too.

    A point without a position counts, and so does the one after it.

    One row per plate and second is kept before (the smallest position of it).
    A vehicle's track is cut into hours, so even a vehicle with most of the
    points is ranked in many tasks, at most 3600 seconds per plate each; only
    the first and last points of the hours are then compared across hours.
    """
    clean = first_per_key(
        points.withColumn("published_at", times.floor_second(F.col("published_at"))),
        ["plate_num", "published_at"],
        [F.col(c).asc_nulls_last() for c in (vehicle, "lon", "lat", "speed")],
    )
    staged = clean.withColumns(
        {
            "_cell": geo.grid_id("lon", "lat", box, cells, cells),
            "_bucket": times.floor_hour(F.col("published_at")),
        }
    )
    # plates sharing a vehicle name settle ties
    order = ["published_at", "plate_num"]
    here = F.struct("_cell")
    within = Window.partitionBy(vehicle, "_bucket").orderBy(*order)
    seen = staged.withColumns(
        {"_before": F.lag(here).over(within), "_after": F.lead(here).over(within)}
    )
    stays = F.coalesce(F.col("_cell") == F.col("_before._cell"), F.lit(False))
    inner = seen.filter(F.col("_before").isNotNull() & ~stays)

    # the first and last points of the hours, at most two per hour and vehicle
    edges = seen.filter(F.col("_before").isNull() | F.col("_after").isNull())
    across = F.lag(here).over(Window.partitionBy(vehicle).orderBy(*order))
    linked = edges.withColumns({"_first": F.col("_before").isNull(), "_before": across})
    entries = linked.filter(F.col("_first") & ~stays).drop("_first")
    return inner.unionByName(entries).drop("_cell", "_bucket", "_before", "_after")


def carried_lag(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """Add ``_before``: ``value`` of the row before, per ``by`` in ``order``, as a struct; null at the first one.

    The lag of a window, for keys of any size.  Rows are dealt to ranges of (by, order),
    so a key with most of the rows fills many ranges.  Each range finds the
    predecessors of its rows but the first, which takes the last row of the nearest range
    before it that has any: a table with one row for each range.  The ranges are
    stored, because their bounds come from a sample and must not be drawn twice.
    ``by`` and ``order`` together should tell all rows apart.
    """
    spark = df.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order]
    dealt = df.repartitionByRange(count, *keys).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    row = F.struct(*by, F.struct(value).alias("_value"))
    within = Window.partitionBy("_range").orderBy(*keys)
    seen = dealt.withColumns({"_last": F.lag(row).over(within)})
    ends = dealt.groupBy("_range").agg(F.max_by(row, F.struct(*keys)).alias("_end"))
    # one row for each range
    carried = ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_carried"))
    joined = seen.join(F.broadcast(carried) if count <= 100_000 else carried, "_range", "left")
    last = F.coalesce("_last", "_carried")
    same = F.lit(True)
    for c in by:
        same = same & last[c].eqNullSafe(F.col(c))
    return joined.withColumn("_before", F.when(same, last["_value"])).drop("_range", "_last", "_carried")


def thin_trajectory_in_ranges(
    points: DataFrame, vehicle: str = "name", box: str = "inner", cells: int = 500, ranges: int | None = None
) -> DataFrame:
    """``thin_trajectory`` for names with any number of points.

    Also where the points have no name at all: ranges of time are ranked on their own, and
    only their last cells are handed on.
    """
    clean = first_per_key(
        points.withColumn("published_at", times.floor_second(F.col("published_at"))),
        ["plate_num", "published_at"],
        [F.col(c).asc_nulls_last() for c in (vehicle, "lon", "lat", "speed")],
    )
    staged = clean.withColumn("_cell", geo.grid_id("lon", "lat", box, cells, cells))
    linked = carried_lag(staged, [vehicle], ["published_at", "plate_num"], "_cell", ranges)
    stays = F.coalesce(F.col("_cell") == F.col("_before._cell"), F.lit(False))
    return linked.filter(~stays).drop("_cell", "_before")


# --- crowded tiles --------------------------------------------------------------

DEPTH = 6  # times a tile can be cut in four
FEW_TILES = 10_000  # crowded tiles that are broadcast, once counted


def _node(level: int, depth: int = DEPTH) -> str:
    """Code of the node that holds a finest tile ``level`` cuts below its base tile."""
    mask = 2**level - 1
    row, column = (f"(shiftright({c}, {depth - level}) & {mask})" for c in ("_frow", "_fcolumn"))
    return f"CAST({4**level} + {row} * {2**level} + {column} AS INT)"


def _finest(tile: float) -> dict[str, Column]:
    return {"_frow": geo.tile("lat", tile / 2**DEPTH), "_fcolumn": geo.tile("lon", tile / 2**DEPTH)}


def crowded_tiles(points: DataFrame, tile: float, limit: int) -> DataFrame:
    """Tiles with more than ``limit`` points: ``_row``, ``_column`` and the nodes to cut, ``_cut``.

    An adaptive quadtree: a node with more than ``limit`` points is cut in four, DEPTH
    times at most.  Only counts are moved: of tiles, and of crowded ones' finest
    parts, at most 4^DEPTH each, added up from the bottom.
    """
    base = {c: F.expr(f"shiftright({f}, {DEPTH})") for c, f in (("_row", "_frow"), ("_column", "_fcolumn"))}
    counts = points.withColumns(_finest(tile)).groupBy("_frow", "_fcolumn").agg(F.count("*").alias("_n"))
    counts = stored(counts.where("_frow IS NOT NULL AND _fcolumn IS NOT NULL").withColumns(base), "tile-counts")
    crowded = counts.groupBy("_row", "_column").agg(F.sum("_n").alias("_n")).where(F.col("_n") > limit)
    inside = counts.join(crowded.select("_row", "_column"), ["_row", "_column"], "left_semi")
    nodes = F.explode(F.expr(f"array({', '.join(_node(d) for d in range(1, DEPTH))})")).alias("_node")
    full = inside.select("_row", "_column", "_n", nodes).groupBy("_row", "_column", "_node").agg(F.sum("_n").alias("_n"))
    cut = full.where(F.col("_n") > limit).groupBy("_row", "_column").agg(F.collect_list("_node").alias("_cut"))
    return crowded.drop("_n").join(cut, ["_row", "_column"], "left").withColumn("_cut", F.coalesce("_cut", F.array().cast("array<int>")))


LEAF = ["_depth", "_lrow", "_lcolumn"]


def leaf_of(points: DataFrame, crowded: DataFrame, tile: float) -> DataFrame:
    """Points with the leaf they lie in: its depth, and row and column of tiles of that depth."""
    base = {"_row": F.expr(f"shiftright(_frow, {DEPTH})"), "_column": F.expr(f"shiftright(_fcolumn, {DEPTH})")}
    arms = " ".join(f"WHEN NOT array_contains(_cut, {_node(d)}) THEN {d}" for d in range(1, DEPTH))
    depth = F.expr(f"CASE WHEN _cut IS NULL THEN 0 {arms} ELSE {DEPTH} END")
    placed = points.withColumns(_finest(tile)).withColumns(base).join(crowded, ["_row", "_column"], "left")
    placed = placed.withColumn("_depth", depth)
    up = f"{DEPTH} - _depth"
    leaf = {"_lrow": F.expr(f"shiftright(_frow, {up})"), "_lcolumn": F.expr(f"shiftright(_fcolumn, {up})")}
    return placed.withColumns(leaf).drop("_row", "_column", "_cut", "_frow", "_fcolumn")


def _leaves_of_boxes(boxes: DataFrame, crowded: DataFrame, tile: float) -> DataFrame:
    """Boxes with every leaf they touch, cut by cut from the tiles of depth 0."""
    listed = boxes.withColumn("_lrow", _tiles("_min_lat", "_max_lat", tile)).withColumn(
        "_lcolumn", _tiles("_min_lon", "_max_lon", tile)
    )
    at = (F.col("_lrow") == F.col("_row")) & (F.col("_lcolumn") == F.col("_column"))
    listed = listed.join(crowded, at, "left").withColumn("_open", F.col("_cut").isNotNull())
    found = []
    for depth in range(DEPTH + 1):
        found.append(listed.where("NOT _open").withColumn("_depth", F.lit(depth)).drop("_row", "_column", "_cut", "_open"))
        if depth == DEPTH:
            break
        width, level = tile / 2 ** (depth + 1), depth + 1
        quarter = F.array(*[F.struct((F.col("_lrow") * 2 + i).alias("_r"), (F.col("_lcolumn") * 2 + j).alias("_c")) for i in (0, 1) for j in (0, 1)])
        kept = [c for c in listed.columns if c not in ("_lrow", "_lcolumn", "_open")]
        listed = listed.where("_open").select(*kept, F.inline(quarter)).withColumnsRenamed({"_r": "_lrow", "_c": "_lcolumn"})
        touches = (
            (F.col("_lrow") >= geo.tile("_min_lat", width)) & (F.col("_lrow") <= geo.tile("_max_lat", width))
            & (F.col("_lcolumn") >= geo.tile("_min_lon", width)) & (F.col("_lcolumn") <= geo.tile("_max_lon", width))
        )
        mask = 2**level - 1
        code = F.expr(f"CAST({4**level} + (_lrow & {mask}) * {2**level} + (_lcolumn & {mask}) AS INT)")
        again = F.array_contains("_cut", code) if level < DEPTH else F.lit(False)
        listed = listed.where(touches).withColumn("_open", again)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def join_boxes_crowded(
    points: DataFrame, cells: DataFrame, tile: float, limit: int, edges: str = "open_closed", how: str = "left"
) -> DataFrame:
    """``join_boxes`` where single tiles hold a large part of the points.

    Tiles with more than ``limit`` points are cut into quarters until none holds
    more (points at one spot stay together); boxes are listed under every leaf that they
    touch.  So what meets by key is at most about ``limit`` points.
    """
    above, below = EDGES[edges]
    crowded = stored(crowded_tiles(points, tile, limit), "crowded")
    crowded = F.broadcast(crowded) if crowded.count() <= FEW_TILES else crowded
    bounds = ("min_lat", "min_lon", "max_lat", "max_lon")
    boxes = cells.select("grid_id", *[F.col(c).alias(f"_{c}") for c in bounds])
    boxes = _leaves_of_boxes(boxes, crowded, tile).withColumnsRenamed({c: f"{c}_box" for c in LEAF})
    placed = leaf_of(points, crowded, tile)
    inside = (
        above(F.col("lat"), F.col("_min_lat")) & below(F.col("lat"), F.col("_max_lat"))
        & above(F.col("lon"), F.col("_min_lon")) & below(F.col("lon"), F.col("_max_lon"))
    )
    for c in LEAF:
        inside = (F.col(c) == F.col(f"{c}_box")) & inside
    dropped = [*LEAF, *[f"{c}_box" for c in LEAF], *[f"_{c}" for c in bounds]]
    return placed.join(boxes, inside, how).drop(*dropped)
