"""Queries: densification, forecast and inference scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisa.functions import air, times
from brisa.operators import rollup, score
from brisa.operators.index import parameter_means, with_index
from brisa.params import INNER_RING, OUTER_RING, PARAMETERS
from brisa.plans import adapters, sql
from brisa.plans.registry import query

CELL = ["grid_id", "control_area_id"]


def rounded(df):
    """Scores to six decimals, for results that are compared as tables."""
    return df.withColumns({m: F.round(m, 6) for m in score.METRICS})


def dense_hours(spark, sf):
    return score.half_hour_densify(adapters.grid_hours(spark, sf), CELL)


@query("B8_half_hour_densify", sql.with_views("dense", "SELECT * FROM dense"))
def half_hour_densify(spark, sf):
    return dense_hours(spark, sf)


def grid_pairs(spark, sf):
    return score.pair_forecast(
        adapters.forecast_rows(spark, sf), dense_hours(spark, sf), [*CELL, "published_at"],
        ["control_area_id", "forecast_interval"],
    )


@query("B9_grid_forecast_score", sql.with_views("grid_pairs", f"""
  SELECT control_area_id, forecast_interval, {sql.metrics()} FROM grid_pairs
  GROUP BY control_area_id, forecast_interval"""))
def grid_forecast_score(spark, sf):
    pairs = grid_pairs(spark, sf)
    return rounded(score.score_forecast(pairs, ["control_area_id", "forecast_interval"]))


def graded_sql(source: str, scale: str = "hour") -> str:
    """Sub-select with graded index fields."""
    return f"(SELECT * FROM {sql.indexed(source, scale, sql.graded, PARAMETERS)})"


COMPLETE = sql.each("@ IS NOT NULL", " AND ")

sql.view("lowest", f"""
  SELECT station_id, published_at, {sql.each('min(@) AS @')} FROM obs GROUP BY station_id, published_at""", "obs")
sql.view("station_pairs", sql.pairs(
    f"(SELECT * FROM {graded_sql('lowest')} WHERE {COMPLETE})", graded_sql("station_hour"),
    "a.station_id = b.station_id AND a.published_at = b.published_at",
    "a.station_id, a.published_at"), "lowest", "station_hour")


@query("B9_station_forecast_score", sql.with_views("station_pairs", f"""
  SELECT station_id, {sql.metrics()} FROM station_pairs GROUP BY station_id"""))
def station_forecast_score(spark, sf):
    """Scores per station; the lowest reading of an hour plays the forecast."""
    lowest = adapters.observations(spark, sf).groupBy("station_id", "published_at").agg(
        *[F.min(p).alias(p) for p in PARAMETERS]
    )
    pairs = score.pair_forecast(
        lowest, adapters.station_hours(spark, sf), ["station_id", "published_at"], ["station_id"]
    )
    return rounded(score.score_forecast(pairs, ["station_id"]))


sql.view("district_mean", f"""
  SELECT control_area_id, time_step, published_at, {sql.each('round(avg(@)) AS @')} FROM
    (SELECT * EXCLUDE (published_at), CAST(l_linenumber % 3 AS INTEGER) AS time_step,
       CAST(published_at - INTERVAL 1 HOUR AS DATE) AS published_at FROM obs)
  GROUP BY control_area_id, time_step, published_at""", "obs")
sql.view("district_pairs", sql.pairs(
    f"(SELECT * FROM {graded_sql('district_mean', 'day')} WHERE {COMPLETE})", "district_day",
    "a.control_area_id = b.control_area_id AND a.published_at = b.published_at",
    "a.control_area_id, a.time_step"), "district_mean", "district_day")


def _district_means(spark, sf):
    """Daily means of a district and lead day, which play the forecast."""
    return (
        adapters.observations(spark, sf)
        .withColumn("time_step", (F.col("l_linenumber") % 3).cast("int"))
        .groupBy(
            "control_area_id", "time_step",
            F.to_date(F.col("published_at") - F.expr("INTERVAL 1 HOUR")).alias("published_at"),
        )
        .agg(*[F.round(F.avg(p)).alias(p) for p in PARAMETERS])
    )


@query("B9_district_forecast_score", sql.with_views("district_pairs", f"""
  SELECT control_area_id, time_step, {sql.metrics()} FROM district_pairs
  GROUP BY control_area_id, time_step"""))
def district_forecast_score(spark, sf):
    """Scores per district and lead day against the graded district product."""
    said = _district_means(spark, sf)
    actual = rollup.district_rollup(adapters.grid_days(spark, sf), "day")
    keys = ["control_area_id", "time_step"]
    pairs = score.pair_forecast(said, actual, ["control_area_id", "published_at"], keys, "day")
    return rounded(score.score_forecast(pairs, keys))


for _ring, _listed in (("inner", INNER_RING), ("outer", OUTER_RING)):

    @query(f"B9_{_ring}_ring_score", sql.with_views("district_mean grid_day", f"""
      SELECT control_area_id, time_step, {sql.metrics()} FROM ({sql.pairs(
          f"(SELECT * REPLACE (control_area_id + 10 AS control_area_id) FROM {graded_sql('district_mean', 'day')} WHERE {COMPLETE})",
          f"({sql.district('(SELECT * REPLACE (control_area_id + 10 AS control_area_id) FROM grid_day)', 'day')})",
          "a.control_area_id = b.control_area_id AND a.published_at = b.published_at",
          "a.control_area_id, a.time_step")}) WHERE control_area_id IN {_listed}
      GROUP BY control_area_id, time_step"""))
    def ring_score(spark, sf, listed=_listed):
        """The district scores of one list of districts."""
        area = F.col("control_area_id") + 10
        said = _district_means(spark, sf).withColumn("control_area_id", area)
        grid = adapters.grid_days(spark, sf).withColumn("control_area_id", area)
        actual = rollup.district_rollup(grid, "day", listed)
        keys = ["control_area_id", "time_step"]
        pairs = score.pair_forecast(said, actual, ["control_area_id", "published_at"], keys, "day")
        return rounded(score.score_forecast(pairs, keys))


sql.view("monthly_scores", f"""
  SELECT control_area_id, forecast_interval, {sql.metrics(digits=14)} FROM grid_pairs
  GROUP BY control_area_id, forecast_interval, year(published_at), month(published_at)""", "grid_pairs")


@query("B10_score_history", sql.with_views("monthly_scores", f"""
  SELECT control_area_id, forecast_interval,
    {', '.join(f'round(avg({m}), 6) AS {m}' for m in score.METRICS)}
  FROM monthly_scores GROUP BY control_area_id, forecast_interval"""))
def score_history(spark, sf):
    """Mean of the monthly scores, all months weighing the same."""
    keys = ["control_area_id", "forecast_interval"]
    pairs = score.pair_forecast(
        adapters.forecast_rows(spark, sf), dense_hours(spark, sf), [*CELL, "published_at"], keys
    )
    months = score.score_forecast(
        pairs.withColumns({"y": F.year("published_at"), "m": F.month("published_at")}),
        [*keys, "y", "m"],
    )
    return rounded(score.score_history([months], keys))


# --- B11, B12 -----------------------------------------------------------------


def inferred_cells(spark, sf):
    """Inferred values: the largest reading of a cell and hour, lowered a little."""
    low = (
        adapters.mobile_samples(spark, sf)
        .groupBy(times.floor_hour(F.col("published_at")).alias("published_at"), "grid_id")
        .agg(*[F.floor(F.max(p) * 9 / 10).cast("double").alias(p) for p in PARAMETERS])
        .withColumn("control_area_id", F.col("grid_id") % 2)
    )
    return with_index(low, "hour", air.graded_iaqi, PARAMETERS)


def listed_cells(spark, sf):
    return (
        adapters.table(spark, sf, "part")
        .select((F.col("p_partkey") % 5).cast("int").alias("grid_id"))
        .distinct()
    )


sql.view("inferred", f"""
  SELECT date_trunc('hour', published_at) AS published_at, grid_id, grid_id % 2 AS control_area_id,
    {sql.each('floor(max(@) * 9 / 10) AS @')} FROM mobile GROUP BY 1, 2""", "mobile")
sql.view("measured", f"""
  SELECT date_trunc('hour', published_at) AS published_at, grid_id, {sql.MEANS} FROM mobile
  WHERE grid_id IN (SELECT p_partkey % 5 FROM part) GROUP BY 1, 2 HAVING count(*) >= 60""", "mobile")
sql.view("infer_pairs", sql.pairs(
    graded_sql("inferred"), graded_sql("measured"),
    "a.grid_id = b.grid_id AND a.published_at = b.published_at",
    "a.published_at, a.grid_id, a.control_area_id", "i"), "inferred", "measured")


@query("B11_inference_pairs", sql.with_views("infer_pairs", "SELECT * FROM infer_pairs"))
def inference_pairs(spark, sf):
    pairs = score.inference_pairs(
        adapters.mobile_samples(spark, sf), inferred_cells(spark, sf), listed_cells(spark, sf)
    )
    return pairs.withColumns({c: F.concat_ws(",", c) for c in ("pri", "prr")})


@query("B12_inference_score", sql.with_views("infer_pairs", f"""
  SELECT control_area_id, {sql.metrics('i')} FROM infer_pairs GROUP BY control_area_id"""))
def inference_score(spark, sf):
    pairs = score.inference_pairs(
        adapters.mobile_samples(spark, sf), inferred_cells(spark, sf), listed_cells(spark, sf)
    )
    return rounded(score.score_inference(pairs))


@query("A11_min_sample_mean", sql.with_views("mobile", f"""
  SELECT date_trunc('hour', published_at) AS published_at, grid_id, {sql.MEANS}, count(*) AS samples
  FROM mobile GROUP BY 1, 2 HAVING count(*) >= 60"""))
def min_sample_mean(spark, sf):
    return (
        adapters.mobile_samples(spark, sf)
        .groupBy(times.floor_hour(F.col("published_at")).alias("published_at"), "grid_id")
        .agg(*parameter_means(), F.count("grid_id").alias("samples"))
        .filter(F.col("samples") >= 60)
    )
