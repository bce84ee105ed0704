"""What should have been loaded and is not there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import times


def expected_hours(cells: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every cell at every hour between the two ends, both included."""
    return cells.select("grid_id", F.explode(times.hour_series(first, last)).alias("published_at"))


def missing_hours(actual: DataFrame, cells: DataFrame, first: Column, last: Column) -> DataFrame:
    """The (cell, hour) pairs that have no row.

    Only hours that lack a cell are expanded: they are counted first and read
    as one list, which has no more entries than the period has hours.
    """
    present = actual.select(
        "grid_id", times.floor_hour(F.col("published_at")).alias("published_at")
    ).distinct()
    lacking = completeness(actual, cells, first, last).filter("complete = 0")
    hours = lacking.agg(F.array_sort(F.collect_list("published_at"))).scalar()
    expected = cells.select("grid_id").distinct().withColumn("_hours", hours)
    return expected.select("grid_id", F.explode("_hours").alias("published_at")).join(
        present, on=["grid_id", "published_at"], how="left_anti"
    )


def completeness(actual: DataFrame, cells: DataFrame, first: Column, last: Column) -> DataFrame:
    """Per hour: cells expected, present and missing, and whether all are there.

    The expected number is the same for every hour, so cells and hours are
    counted apart and never multiplied out.
    """
    listed = cells.select("grid_id").distinct()
    present = (
        actual.select("grid_id", times.floor_hour(F.col("published_at")).alias("published_at"))
        .distinct()
        .join(listed, on="grid_id", how="left_semi")
        .groupBy("published_at")
        .agg(F.count("*").alias("_present"))
    )
    hours = listed.agg(F.count("*").alias("expected")).select(
        F.explode(times.hour_series(first, last)).alias("published_at"), "expected"
    )
    found = F.coalesce("_present", F.lit(0))
    return hours.join(present, on="published_at", how="left").select(
        "published_at",
        "expected",
        found.alias("present"),
        (F.col("expected") - found).alias("missing"),
        (F.col("expected") == found).cast("int").alias("complete"),
    )


# --- hours as bits --------------------------------------------------------------


def hour_masks(actual: DataFrame) -> DataFrame:
    """(grid_id, day, hours): bit h is set if the cell has a row in hour h of the day.

    Combined before the shuffle: a cell with any number of rows sends a few bytes a day.
    """
    at = F.col("published_at")
    return actual.groupBy("grid_id", F.to_date(at).alias("day")).agg(
        F.bit_or(F.expr("shiftleft(1, hour(published_at))")).alias("hours")
    )


def _wanted(first: Column, last: Column) -> Column:
    """The days of a period with the hours of each that belong to it, as an array."""
    start, end = F.hour(first), F.hour(last)

    def hours(day: Column) -> Column:
        low = F.when(day == F.to_date(first), start).otherwise(0)
        high = F.when(day == F.to_date(last), end).otherwise(23)
        return F.sequence(low, high)

    def bits(day: Column) -> Column:
        return F.aggregate(hours(day), F.lit(0), lambda s, h: s + F.power(F.lit(2), h).cast("int"))

    days = F.sequence(F.to_date(first), F.to_date(last))
    return F.transform(days, lambda d: F.struct(d.alias("day"), bits(d).alias("hours")))


def missing_by_mask(masks: DataFrame, cells: DataFrame, first: Column, last: Column) -> DataFrame:
    """``missing_hours`` from masks: days that lack nothing cost one comparison of bits.

    A cell's masks are gathered next to it (one for each day of the period), and only
    missing hours become rows; cells and hours are never multiplied out.
    """
    within = masks.where(F.col("day").between(F.to_date(first), F.to_date(last)))
    held = within.groupBy("grid_id").agg(F.map_from_entries(F.collect_list(F.struct("day", "hours"))).alias("_held"))
    lacking = F.expr(
        "filter(transform(_wanted, w -> struct(w.day, w.hours & ~coalesce(try_element_at(_held, w.day), 0) AS hours)),"
        " w -> w.hours != 0)"
    )
    listed = cells.select("grid_id").distinct().join(held, "grid_id", "left")
    days = listed.withColumn("_wanted", _wanted(first, last)).select("grid_id", F.inline(lacking))
    each = days.select("grid_id", "day", F.explode(F.expr("filter(sequence(0, 23), h -> getbit(hours, h) = 1)")).alias("_h"))
    return each.select("grid_id", (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours="_h")).alias("published_at"))


def completeness_by_mask(masks: DataFrame, cells: DataFrame, first: Column, last: Column) -> DataFrame:
    """``completeness`` from masks: the cells of every hour are counted bit by bit, by day."""
    listed = cells.select("grid_id").distinct()
    counts = (
        masks.join(listed, "grid_id", "left_semi")
        .groupBy("day")
        .agg(F.array(*[F.sum(F.getbit("hours", F.lit(h)).cast("long")) for h in range(24)]).alias("_present"))
    )
    expected = listed.agg(F.count("*").alias("expected"))
    hours = expected.select(F.explode(times.hour_series(first, last)).alias("published_at"), "expected")
    found = F.coalesce(F.get("_present", F.hour("published_at")), F.lit(0))
    return (
        hours.withColumn("day", F.to_date("published_at"))
        .join(counts, "day", "left")
        .select(
            "published_at", "expected", found.alias("present"), (F.col("expected") - found).alias("missing"),
            (F.col("expected") == found).cast("int").alias("complete"),
        )
    )
