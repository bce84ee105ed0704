"""Forecast and inference scoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from brisa.functions import air, times
from brisa.operators.index import parameter_means, with_index
from brisa.params import MIN_SAMPLES_PER_CELL_HOUR, PARAMETERS

ERRORS = tuple(f"{p}_{m}" for p in PARAMETERS for m in ("nmb", "r", "rmse"))
HITS = (
    "aqi_interval_hit_rate",
    "aqi_percentage_hit_rate",
    "aqi_grade_interval_hit_rate",
    "aqi_grade_percentage_hit_rate",
    "accuracy",
)
METRICS = ERRORS + HITS


def half_hour_densify(hourly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a row at half past between every two adjacent hours.

    Its value is the mean of both hours, or the one that is not missing.  Rows
    with any parameter missing or zero are dropped.  ``hourly`` has one row per
    key and hour.

    Hours meet their successor in a window per key and day, where the next
    day's first hour is listed as well: one shuffle of little more than the
    input, and never more than 25 rows per window.
    """
    hour, half = F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 30 MINUTES")
    at = F.col("published_at")
    listed = hourly.select(
        *keys,
        "published_at",
        *[F.expr(f"coalesce(CAST({p} AS DOUBLE), 0D)").alias(p) for p in PARAMETERS],
        F.explode(F.array_distinct(F.array(F.to_date(at), F.to_date(at - hour)))).alias("_day"),
    )
    window = Window.partitionBy(*keys, "_day").orderBy("published_at")
    following = F.lead(F.struct("published_at", *PARAMETERS)).over(window)
    met = listed.withColumn("_next", following).filter(F.col("_day") == F.to_date(at))

    def between(p: str) -> Column:
        other = f"_next.{p}"
        return F.expr(
            f"CASE WHEN {p} = 0D OR {other} = 0D THEN {p} + {other} ELSE ({p} + {other}) / 2D END"
        ).alias(p)

    adjacent = F.col("_next.published_at") == at + hour
    rows = F.array_compact(
        F.array(
            F.struct("published_at", *PARAMETERS),
            F.when(
                adjacent,
                F.struct((at + half).alias("published_at"), *[between(p) for p in PARAMETERS]),
            ),
        )
    )
    complete = " AND ".join(f"{p} != 0D" for p in PARAMETERS)
    return met.select(*keys, F.inline(rows)).filter(complete)


def suffixed(df: DataFrame, suffix: str) -> list[Column]:
    """The scored fields of a table under names that end in ``suffix``."""
    return [
        *[F.col(p).alias(f"{p}{suffix}") for p in PARAMETERS],
        F.col("grade").alias(f"grade{suffix}"),
        F.col("aqi").alias(f"aqi{suffix}"),
        F.col("primary_pollutants").alias(f"pr{suffix}"),
    ]


def pair_forecast(
    forecast: DataFrame,
    actual: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    scale: str = "hour",
) -> DataFrame:
    """Forecast rows next to what was observed at the same place and time.

    Forecasts with a missing field are left out.  A side without index fields
    of its own is graded here, on ``scale``; the forecast after that filter, so
    the filter works on stored columns.
    """
    index_fields = ["grade", "aqi", "primary_pollutants"]
    ids = list(dict.fromkeys([*on, *keys]))
    stored = [c for c in index_fields if c in forecast.columns]
    said = forecast.select(*ids, *PARAMETERS, *stored).dropna("any")
    if not stored:
        said = with_index(said, scale, air.graded_iaqi, PARAMETERS)
    if "aqi" not in actual.columns:
        actual = with_index(actual, scale, air.graded_iaqi, PARAMETERS)
    return said.select(*ids, *suffixed(said, "f")).join(
        actual.select(*on, *suffixed(actual, "r")), on=list(on), how="inner"
    )


def metrics(said: str = "f", seen: str = "r") -> list[Column]:
    """All score aggregates over pairs with the given column suffixes.

    Every one is combined before the shuffle, so a key with most of the pairs
    costs no more than any other.
    """
    out = {}
    for p in PARAMETERS:
        f, r = f"CAST({p}{said} AS DOUBLE)", f"CAST({p}{seen} AS DOUBLE)"
        both = f"FILTER (WHERE {p}{said} IS NOT NULL AND {p}{seen} IS NOT NULL)"
        spread = f"stddev_pop({f}) {both} * stddev_pop({r}) {both}"
        out[f"{p}_nmb"] = f"try_divide(sum({f} - {r}), sum({r}))"
        out[f"{p}_r"] = f"try_divide(covar_pop({f}, {r}), {spread})"
        out[f"{p}_rmse"] = f"sqrt(try_divide(sum(({f} - {r}) * ({f} - {r})), count({f})))"
    f, r, g = f"CAST(aqi{said} AS DOUBLE)", f"CAST(aqi{seen} AS DOUBLE)", f"CAST(grade{said} AS INT)"
    near = air.primary_agrees_sql(f"pr{said}", f"pr{seen}")
    polluted = f"CAST(grade{seen} AS INT) != 1"

    def share(hits: str, of: str) -> str:
        return f"try_divide({hits} * 100D, {of})"

    total = f"count({r})"
    out["aqi_interval_hit_rate"] = share(f"count_if(abs({f} - {r}) <= 15)", total)
    out["aqi_percentage_hit_rate"] = share(
        f"count_if(try_divide(abs({f} - {r}), {r}) <= 0.25D)", total
    )
    out["aqi_grade_interval_hit_rate"] = share(f"sum({air.grade_within_points_sql(g, r)})", total)
    out["aqi_grade_percentage_hit_rate"] = share(f"sum({air.grade_within_share_sql(g, r)})", total)
    out["accuracy"] = share(f"count_if({polluted} AND {near} = 1)", f"count_if({polluted})")
    return [F.expr(text).alias(name) for name, text in out.items()]


def score_forecast(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bias, correlation, RMSE and hit rates of forecast pairs per key."""
    return pairs.groupBy(*keys).agg(*metrics("f", "r"))


def score_inference(pairs: DataFrame, keys: Sequence[str] = ("control_area_id",)) -> DataFrame:
    """The same scores for inferred against measured cells."""
    return pairs.groupBy(*keys).agg(*metrics("i", "r"))


def score_history(periods: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Mean of period scores: every period weighs the same, whatever its size."""
    columns = [*keys, *METRICS]
    merged = reduce(DataFrame.unionByName, [p.select(*columns) for p in periods])
    return merged.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in METRICS])


def inference_pairs(
    mobile: DataFrame,
    inferred: DataFrame,
    cells: DataFrame,
    min_samples: int = MIN_SAMPLES_PER_CELL_HOUR,
) -> DataFrame:
    """Inferred cells next to the hourly mean measured by mobile stations.

    A cell-hour counts with ``min_samples`` samples or more and only for cells
    listed in ``cells``.
    """
    measured = (
        mobile.withColumn("published_at", times.floor_hour(F.col("published_at")))
        .groupBy("published_at", "grid_id")
        .agg(*parameter_means(), F.count("grid_id").alias("_samples"))
        .filter(F.col("_samples") >= min_samples)
        .join(cells.select("grid_id"), on="grid_id", how="left_semi")
    )
    graded = with_index(measured, "hour", air.graded_iaqi, PARAMETERS)
    seen = graded.select("published_at", "grid_id", *suffixed(graded, "r"))
    said = inferred.select(
        "published_at", "grid_id", "control_area_id", *suffixed(inferred, "i")
    )
    return said.join(seen, on=["published_at", "grid_id"], how="inner")
