"""Air-quality index expressions.

Every function exists twice: ``name_sql`` writes the expression as SQL text over
operand texts (column names or expressions), ``name`` gives it as a ``Column``.
The texts expand to ``CASE`` chains, so they run inside generated code and the
optimiser sees through them; :mod:`brisa.functions.register` publishes the same
texts as SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

from brisa.functions.text import as_column
from brisa.params import (
    ANNUAL_STANDARD,
    BREAKPOINTS,
    GRADE_BOUNDS,
    GRADED_LIMIT,
    INDEX_LEVELS,
    PARAMETERS,
    PERIOD_PERCENTILE,
    PRIMARY_ORDER,
)


HALF = "0.5000000001"


def segments(parameter: str, scale: str) -> list[tuple[int, int, int, int]]:
    """``(c_low, c_high, i_low, i_high)`` of every breakpoint segment."""
    knots = BREAKPOINTS[scale][parameter]
    return list(zip(knots, knots[1:], INDEX_LEVELS, INDEX_LEVELS[1:]))


def iaqi_sql(v: str, parameter: str, scale: str = "hour") -> str:
    """Sub-index of a concentration; ``scale`` is ``hour`` or ``day``.

    Null stays null, below zero is 0, above the last breakpoint is 500.
    """
    arms = [f"WHEN {v} < 0D THEN 0L"]
    for c_low, c_high, i_low, i_high in segments(parameter, scale):
        slope = (i_high - i_low) / (c_high - c_low)
        arms.append(f"WHEN {v} <= {c_high}D THEN ceil({slope!r}D * ({v} - {c_low}D) + {i_low}D)")
    return f"(CASE {' '.join(arms)} WHEN {v} IS NOT NULL THEN {INDEX_LEVELS[-1]}L END)"


def graded_iaqi_sql(v: str, parameter: str, scale: str = "hour", above: str = "table") -> str:
    """Sub-index of district products and scores; the slope is divided last.

    Below zero it is null.  ``above`` says what a concentration gives that is
    higher than the range the standard grades on this scale: ``table`` goes on
    with the breakpoints and ends at 500, so a high reading never lowers a
    grade; ``null`` grades nothing there.
    """
    top = BREAKPOINTS[scale][parameter][-1]
    limit = top if above == "table" else GRADED_LIMIT[scale].get(parameter, top)
    beyond = f"{INDEX_LEVELS[-1]}L" if above == "table" else "NULL"
    arms = [f"WHEN {v} < 0D THEN NULL WHEN {v} > {limit}D THEN {beyond}"]
    for c_low, c_high, i_low, i_high in segments(parameter, scale):
        if c_low >= limit:
            break
        closes = "<=" if c_high == limit else "<"
        arms.append(
            f"WHEN {v} {closes} {c_high}D THEN"
            f" ceil({i_high - i_low}D * ({v} - {c_low}D) / {c_high - c_low}D + {i_low}D)"
        )
    return f"(CASE {' '.join(arms)} END)"


def aqi_sql(sub_index: Callable[[str], str] = "{}_iaqi".format) -> str:
    """Largest sub-index; missing ones are skipped."""
    return f"greatest({', '.join(sub_index(p) for p in PARAMETERS)})"


def grade_sql(index: str) -> str:
    """Grade 1..6 of an index; null and negative indices have no grade."""
    arms = [f"WHEN {index} < 0 THEN NULL"]
    arms += [f"WHEN ceil({index}) <= {b} THEN {g}" for g, b in enumerate(GRADE_BOUNDS, start=1)]
    top = len(GRADE_BOUNDS) + 1
    return f"(CASE {' '.join(arms)} WHEN {index} IS NOT NULL THEN {top} END)"


def primary_pollutants_sql(
    index: str = "aqi",
    sub_index: Callable[[str], str] = "{}_iaqi".format,
    order: tuple[str, ...] = PRIMARY_ORDER,
) -> str:
    """Names of the parameters that reach the index, empty unless it is > 50."""
    names = ", ".join(f"CASE WHEN {index} > 50 AND {sub_index(p)} = {index} THEN '{p}' END" for p in order)
    return f"array_compact(array({names}))"


def reported_sql(v: str, parameter: str) -> str:
    """Concentration as published: co to one decimal, the others whole; halves go away from zero.

    A half counts as met from 1e-10 below on, as a mean of decimals may miss it by its last bit.
    """
    if parameter == "co":
        return f"sign({v}) * floor(abs({v}) * 10D + {HALF}D) / 10D"
    return f"TRY_CAST(sign({v}) * floor(abs({v}) + {HALF}D) AS INT)"


def percentile_index_sql(v: str, parameter: str) -> str:
    """Aggregate: the period percentile over its yearly standard; 0 if empty."""
    p, standard = PERIOD_PERCENTILE[parameter], ANNUAL_STANDARD[parameter]
    return f"coalesce(percentile({v}, {p}D) / {standard}D, 0D)"


def array_percentile_sql(values: str, share: float) -> str:
    """The same percentile of a short array, nulls left out; 0 if there are none."""
    kept = f"array_sort(filter({values}, x -> x IS NOT NULL))"
    at = f"((size({kept}) - 1) * {share!r}D)"
    low = f"element_at({kept}, CAST(floor({at}) AS INT) + 1)"
    high = f"element_at({kept}, CAST(ceil({at}) AS INT) + 1)"
    return (
        f"(CASE WHEN coalesce(size({kept}), 0) < 1 THEN 0D"
        f" ELSE {low} + ({high} - {low}) * ({at} - floor({at})) END)"
    )


def mean_index_sql(mean: str, parameter: str) -> str:
    """A period mean over its yearly standard; 0 where the mean is missing."""
    return f"coalesce({mean} / {ANNUAL_STANDARD[parameter]}D, 0D)"


def comprehensive_index_sql(o3_index: str = "o3_index", co_index: str = "co_index") -> str:
    """Sum of the six single indices, two decimals (halves go up, on 8 decimals)."""
    means = " + ".join(mean_index_sql(p, p) for p in ("so2", "pm10", "pm2_5", "no2"))
    total = f"{means} + {co_index} + {o3_index}"
    return f"CAST(round(CAST({total} AS DECIMAL(20, 8)), 2) AS DOUBLE)"


def _agreement_sql(forecast_grade: str, actual: str, raised: str, lowered: str) -> str:
    own, g = grade_sql(actual), forecast_grade
    return (
        f"(CASE WHEN {g} IS NULL OR {actual} IS NULL THEN NULL WHEN {g} = {own} THEN 1"
        f" WHEN {g} > {own} AND {g} = {grade_sql(raised)} THEN 1"
        f" WHEN {g} < {own} AND {g} = {grade_sql(lowered)} THEN 1 ELSE 0 END)"
    )


def grade_within_points_sql(forecast_grade: str, actual_aqi: str, points: int = 15) -> str:
    """1 if moving the actual index by ``points`` reaches the forecast grade."""
    a = actual_aqi
    return _agreement_sql(forecast_grade, a, f"({a} + {points})", f"({a} - {points})")


def grade_within_share_sql(forecast_grade: str, actual_aqi: str, share: float = 0.25) -> str:
    """1 if moving the actual index by ``share`` of itself reaches the forecast grade."""
    a = actual_aqi
    return _agreement_sql(
        forecast_grade, a, f"ceil({a} * {1.0 + share!r}D)", f"ceil({a} * {1.0 - share!r}D)"
    )


def primary_agrees_sql(forecast: str, actual: str) -> str:
    """1 if the two lists of primary pollutants share a name, else 0."""
    return f"(CASE WHEN arrays_overlap({forecast}, {actual}) THEN 1 ELSE 0 END)"


iaqi = as_column(iaqi_sql)
graded_iaqi = as_column(graded_iaqi_sql)
aqi = as_column(aqi_sql)
grade = as_column(grade_sql)
primary_pollutants = as_column(primary_pollutants_sql)
reported = as_column(reported_sql)
percentile_index = as_column(percentile_index_sql)
mean_index = as_column(mean_index_sql)
comprehensive_index = as_column(comprehensive_index_sql)
grade_within_points = as_column(grade_within_points_sql)
grade_within_share = as_column(grade_within_share_sql)
primary_agrees = as_column(primary_agrees_sql)


def pollutant_list(text: Column) -> Column:
    """Free-text pollutant names (``"PM2.5,O3"``) as canonical names; null if none."""
    lowered = F.lower(text)
    cleaned = F.regexp_replace(lowered, r"pm2\.5|pm25", "pm2_5")
    return F.when(lowered.rlike("[a-z]"), F.split(cleaned, ","))


def pollutant_codes(text: Column, codes: Mapping[str, str]) -> Column:
    """Comma-separated vendor codes as canonical names; unknown codes drop out."""
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.array_compact(F.transform(F.split(text, ","), lambda c: F.try_element_at(lookup, c)))
