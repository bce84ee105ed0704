"""Scores from states that merge: kept by key and day, added up to any period.

A state holds what every score follows from: per parameter the sums of errors, squared
errors and observations, the number of forecasts, and the moments of pairs (number,
means, squared deviations, co-deviations); and the counts of hits.  Sums are added;
moments are merged by the pairwise formula, which does not cancel as sums of squares do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brisa.functions import air
from brisa.params import PARAMETERS

HIT_COUNTS = ("within_points", "within_share", "grade_within_points", "grade_within_share", "primary", "polluted", "graded")
_SUMS = [f"{p}_{c}" for p in PARAMETERS for c in ("error", "seen", "square", "said")] + list(HIT_COUNTS)


def score_state(pairs: DataFrame, keys: Sequence[str], said: str = "f", seen: str = "r") -> DataFrame:
    """One row per key from pairs with the given column suffixes; a day belongs to the key."""
    out = {}
    for p in PARAMETERS:
        f, r = f"CAST({p}{said} AS DOUBLE)", f"CAST({p}{seen} AS DOUBLE)"
        both = f"FILTER (WHERE {p}{said} IS NOT NULL AND {p}{seen} IS NOT NULL)"
        out[f"{p}_error"] = f"sum({f} - {r})"
        out[f"{p}_seen"] = f"sum({r})"
        out[f"{p}_square"] = f"sum(({f} - {r}) * ({f} - {r}))"
        out[f"{p}_said"] = f"count({f})"
        n = f"count(*) {both}"
        out[f"{p}_moments"] = (
            f"named_struct('n', CAST({n} AS DOUBLE), 'f', avg({f}) {both}, 'r', avg({r}) {both},"
            f" 'ff', var_pop({f}) {both} * {n}, 'rr', var_pop({r}) {both} * {n}, 'fr', covar_pop({f}, {r}) * {n})"
        )
    f, r, g = f"CAST(aqi{said} AS DOUBLE)", f"CAST(aqi{seen} AS DOUBLE)", f"CAST(grade{said} AS INT)"
    polluted = f"CAST(grade{seen} AS INT) != 1"
    out["within_points"] = f"count_if(abs({f} - {r}) <= 15)"
    out["within_share"] = f"count_if(try_divide(abs({f} - {r}), {r}) <= 0.25D)"
    out["grade_within_points"] = f"sum({air.grade_within_points_sql(g, r)})"
    out["grade_within_share"] = f"sum({air.grade_within_share_sql(g, r)})"
    out["primary"] = f"count_if({polluted} AND {air.primary_agrees_sql(f'pr{said}', f'pr{seen}')} = 1)"
    out["polluted"] = f"count_if({polluted})"
    out["graded"] = f"count({r})"
    return pairs.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in out.items()])


_NOTHING = "named_struct('n', 0D, 'f', 0D, 'r', 0D, 'ff', 0D, 'rr', 0D, 'fr', 0D)"


def _merged_moments(states: str) -> str:
    """Moments of all pairs from an array of moments."""
    share = "(b.n / (a.n + b.n))"
    step = (
        f"CASE WHEN coalesce(b.n, 0D) = 0D THEN a WHEN a.n = 0D THEN b ELSE named_struct('n', a.n + b.n,"
        f" 'f', a.f + (b.f - a.f) * {share}, 'r', a.r + (b.r - a.r) * {share},"
        f" 'ff', a.ff + b.ff + (b.f - a.f) * (b.f - a.f) * a.n * {share},"
        f" 'rr', a.rr + b.rr + (b.r - a.r) * (b.r - a.r) * a.n * {share},"
        f" 'fr', a.fr + b.fr + (b.f - a.f) * (b.r - a.r) * a.n * {share}) END"
    )
    return f"aggregate({states}, {_NOTHING}, (a, b) -> {step})"


def merge_scores(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of longer periods or fewer keys: ``keys`` says what stays apart.

    Moments of a group are gathered before they are merged: a row for each day of a key.
    """
    gathered = states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        *[F.sort_array(F.collect_list(f"{p}_moments")).alias(f"{p}_moments") for p in PARAMETERS],
    )
    return gathered.withColumns({f"{p}_moments": F.expr(_merged_moments(f"{p}_moments")) for p in PARAMETERS})


def scores(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The scores of ``score.score_forecast`` and ``score_inference`` from states."""
    out = {}
    for p in PARAMETERS:
        m = f"{p}_moments"
        out[f"{p}_nmb"] = f"try_divide({p}_error, {p}_seen)"
        out[f"{p}_r"] = f"try_divide({m}.fr, sqrt({m}.ff) * sqrt({m}.rr))"
        out[f"{p}_rmse"] = f"sqrt(try_divide({p}_square, {p}_said))"
    for name, count in (
        ("aqi_interval_hit_rate", "within_points"),
        ("aqi_percentage_hit_rate", "within_share"),
        ("aqi_grade_interval_hit_rate", "grade_within_points"),
        ("aqi_grade_percentage_hit_rate", "grade_within_share"),
    ):
        out[name] = f"try_divide({count} * 100D, graded)"
    out["accuracy"] = "try_divide(primary * 100D, polluted)"
    return states.select(*keys, *[F.expr(text).alias(name) for name, text in out.items()])
