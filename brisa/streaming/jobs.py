"""Streaming jobs: ingest, tag, last seen, append, presence.

Every job takes an unstarted stream of ``value`` texts (or rows), a target path
and a checkpoint path, and returns the started query.  The trigger defaults to
draining what is there; pass ``processingTime`` options for a standing job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from brisa.functions import times
from brisa.operators.latest import latest_per_key, settling
from brisa.operators.spatial import join_boxes, tag_grid
from brisa.sources import sinks

DRAIN = {"availableNow": True}

MESSAGE = (
    "station_code string, station_id string, message_type string, "
    "coord struct<lon: double, lat: double>, data string, time string"
)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message texts as columns; the payload stays text, the time is typed."""
    m = F.from_json(F.col("value"), MESSAGE)
    return messages.select(m.alias("m")).select(
        "m.station_code",
        "m.station_id",
        "m.message_type",
        F.col("m.coord.lon").alias("lon"),
        F.col("m.coord.lat").alias("lat"),
        "m.data",
        F.try_to_timestamp(F.col("m.time")).cast("timestamp_ntz").alias("published_at"),
    )


def _each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_ingest(
    messages: DataFrame,
    stations: Callable[[], DataFrame],
    cells: Callable[[], DataFrame],
    tile: float,
    target: str,
    checkpoint: str,
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Raw readings with station id and fine cell, kept per station and time.

    The dimensions are read again for every batch, so changes to them are seen
    without a restart.  Read the result with ``sinks.read_latest`` on
    ``(station_code, published_at)``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = stations().select("station_code", F.col("station_id").alias("_id"))
        rows = (
            batch.filter(F.col("station_code").isNotNull())
            .join(known, on="station_code", how="left")
            .withColumn("station_id", F.col("_id"))
            .drop("_id")
        )
        fine = cells().filter(F.col("grid_scale") == 1)
        tagged = join_boxes(rows, fine, tile, edges="closed_open")
        sinks.write_batch(
            latest_per_key(
                tagged, ["station_code", "published_at"], "published_at",
                ties=settling(tagged, ["data"], ["station_code", "published_at"]),
            ),
            target,
            batch_id,
        )

    return _each_batch(parse_messages(messages), write, checkpoint, trigger)


def stream_tag_grid(
    rows: DataFrame,
    cells: Callable[[], DataFrame],
    tiles: tuple[float, float],
    target: str,
    checkpoint: str,
    keys: Sequence[str] = ("published_at", "station_id"),
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """Readings with both cells, kept once per key: a message that comes again updates its row.

    The cells are read again for every batch.  Read the result with
    ``sinks.read_latest`` on ``keys``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_grid(batch, cells(), tiles).withColumn("publish_date", F.to_date("published_at"))
        once = latest_per_key(tagged, keys, "published_at", ties=settling(tagged, [], keys))
        sinks.write_batch(once, target, batch_id)

    return _each_batch(rows, write, checkpoint, trigger)


def stream_last_seen(
    rows: DataFrame, key: str, ts: str, target: str, checkpoint: str, trigger: Mapping = DRAIN
) -> StreamingQuery:
    """Time of the newest message per station; state is one row per station.

    Read the result with ``sinks.read_latest`` on the key.
    """
    seen = rows.groupBy(key).agg(F.max(ts).alias(ts))

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_batch(batch, target, batch_id)

    return (
        seen.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def flatten_payload(messages: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Owned-station messages: nested payload fields as text columns, plus the day."""
    inner = ", ".join(f"`{f}`: string" for f in fields)
    schema = f"station_code string, coord string, published_at string, data struct<{inner}>"
    m = F.from_json(F.col("value"), schema)
    return messages.select(m.alias("m")).select(
        "m.station_code",
        "m.coord",
        *[F.col(f"m.data.{f}").alias(f) for f in fields],
        "m.published_at",
        F.to_date(F.substring("m.published_at", 1, 10)).alias("publish_date"),
    )


def append_stream(
    rows: DataFrame, by: Sequence[str], target: str, checkpoint: str, trigger: Mapping = DRAIN
) -> StreamingQuery:
    """Append rows to a partitioned parquet table, exactly once."""
    return (
        rows.writeStream.format("parquet")
        .partitionBy(*by)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def minute_presence(rows: DataFrame, key: str, ts: str, late: str | None = None) -> DataFrame:
    """Minutes in which a station was heard, once each.

    On a stream give ``late``: minutes older than that are forgotten.
    """
    minutes = rows.select(F.col(key), times.floor_minute(F.col(ts)).alias(ts))
    if late is None:
        return minutes.distinct()
    # a watermark needs a timestamp with zone
    zoned = minutes.withColumn(ts, F.col(ts).cast("timestamp"))
    return zoned.withWatermark(ts, late).dropDuplicates([key, ts])


def presence_of_area(presence: DataFrame, members: DataFrame, area: int, key: str) -> DataFrame:
    """The part of a presence table that belongs to one control area's stations."""
    listed = members.filter(F.col("control_area_id") == area).select(key)
    return presence.join(listed, on=key, how="left_semi")


# --- keyed state ----------------------------------------------------------------


def newest_per_key(rows: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    """The row of every key that came last, held as streaming state; ``ts`` is one of the keys.

    Of rows that come together the larger values of the other columns win.  A key
    stays in the state until the stream's time is ``late`` beyond it; messages
    later than that are dropped.  Read in update mode: a batch gives the keys it changed.
    """
    if ts not in keys:
        raise ValueError("the time has to be part of the key, or its state would never end")
    others = [c for c in rows.columns if c not in keys]
    settled = settling(rows, [], keys)
    kind = dict(rows.dtypes)[ts]
    arrived = rows.withColumns({"_at": F.col(ts).cast("timestamp"), "_arrived": F.current_timestamp()})
    order = F.struct("_arrived", *settled)
    newest = (
        arrived.withWatermark("_at", late)
        .groupBy(*[c for c in keys if c != ts], "_at")
        .agg(F.max_by(F.struct(*others), order).alias("_row"))
    )
    named = {c: F.col(f"_row.`{c}`") for c in others} | {ts: F.col("_at").cast(kind)} | {c: F.col(c) for c in keys if c != ts}
    return newest.select(*[named[c].alias(c) for c in rows.columns])


def _keep_newest(
    rows: DataFrame, complete: Callable[[DataFrame], DataFrame], keys: Sequence[str], ts: str, late: str,
    target: str, checkpoint: str, trigger: Mapping,
) -> StreamingQuery:
    """Changed keys of each batch, completed, into a table by day that holds one row per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        dated = complete(batch).withColumn("publish_date", F.to_date(ts))
        sinks.merge_partitions(dated, target, [*keys, "publish_date"], ts, ["publish_date"])

    return (
        newest_per_key(rows, keys, ts, late)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def ingest_newest(
    messages: DataFrame,
    stations: Callable[[], DataFrame],
    cells: Callable[[], DataFrame],
    tile: float,
    target: str,
    checkpoint: str,
    late: str = "1 hour",
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """``stream_ingest`` with its newest rows in a state store and one row per key in the table.

    Only changed keys are joined with the dimensions, which are read again for every
    batch, and only the days they fall on are rewritten.  The table is read as it is.
    """

    def complete(batch: DataFrame) -> DataFrame:
        known = stations().select("station_code", F.col("station_id").alias("_id"))
        rows = batch.join(known, on="station_code", how="left").withColumn("station_id", F.col("_id")).drop("_id")
        return join_boxes(rows, cells().filter(F.col("grid_scale") == 1), tile, edges="closed_open")

    rows = parse_messages(messages).filter(F.col("station_code").isNotNull())
    return _keep_newest(
        rows, complete, ["station_code", "published_at"], "published_at", late, target, checkpoint, trigger
    )


def tag_newest(
    rows: DataFrame,
    cells: Callable[[], DataFrame],
    tiles: tuple[float, float],
    target: str,
    checkpoint: str,
    keys: Sequence[str] = ("published_at", "station_id"),
    ts: str = "published_at",
    late: str = "1 hour",
    trigger: Mapping = DRAIN,
) -> StreamingQuery:
    """``stream_tag_grid`` with its newest rows in a state store and one row per key in the table."""
    return _keep_newest(
        rows, lambda batch: tag_grid(batch, cells(), tiles), keys, ts, late, target, checkpoint, trigger
    )
