"""States of periods that merge: kept by month, and added up to quarters and years.

A state holds, per key and month, what every product of a period follows from: for
each parameter the sum of its published values, a whole number of their last digit, and
the number of values and of valid days; the days of grades 1 and 2; and how many days
had each published value of o3 and co, for the percentiles.  States are added; a merged
one equals that of all the days, so quarters and years need neither days nor hours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import air
from brisa.operators.index import published_mean_sql, published_state, reported, with_index
from brisa.operators.rollup import period_columns, period_flags
from brisa.params import ANNUAL_STANDARD, PARAMETERS, PERIOD_PERCENTILE

#: Days of a station, cell or area count where the parameter is there, days of a district where its flag is set.
DAYS_WITH_VALUE = {p: f"count({p})" for p in PARAMETERS}
DAYS_WITH_FLAG = {p: f"coalesce(sum({p}_flag), 0L)" for p in PARAMETERS}
COUNTED = tuple(PERIOD_PERCENTILE)


def _counts_of(values: str) -> str:
    """A short array as a map from value to its number of occurrences."""
    return (
        f"map_from_entries(transform(array_distinct({values}),"
        f" v -> struct(v, CAST(size(filter({values}, x -> x = v)) AS LONG))))"
    )


def _added_counts(entries: str) -> str:
    """Entries of several such maps as one map; values that occur in several are added."""
    keys = f"array_distinct(transform({entries}, e -> e.key))"
    total = f"aggregate(filter({entries}, e -> e.key = v), 0L, (s, e) -> s + e.value)"
    return f"map_from_entries(transform({keys}, v -> struct(v, {total})))"


def period_state(
    day: DataFrame, keys: Sequence[str], period: str = "month", valid_days: Mapping[str, str] = DAYS_WITH_VALUE
) -> DataFrame:
    """States per key and period from a daily product, one row per key and day.

    Rows are grouped as they lie: days stored clustered by ``keys`` need no exchange.
    """
    ids = period_columns(period)
    gathered = (
        day.withColumns(ids)
        .groupBy(*keys, *ids)
        .agg(
            *[F.expr(total).alias(c) for p in PARAMETERS for c, total in published_state(p).items()],
            *[F.expr(valid_days[p]).alias(f"{p}_days") for p in PARAMETERS],
            F.count_if(F.col("grade").isin(1, 2)).alias("std_day_num"),
            # a key has at most 366 days in a period
            *[F.expr(f"collect_list({air.reported_sql(p, p)})").alias(f"{p}_values") for p in COUNTED],
        )
    )
    return gathered.withColumns({f"{p}_values": F.expr(_counts_of(f"{p}_values")) for p in COUNTED})


def _longer(period: str) -> dict[str, Column]:
    if period == "quarter":
        quarter = F.ceil(F.col("published_month") / 3).cast("int")
        return {"published_year": F.col("published_year"), "published_quarter": quarter}
    if period == "year":
        return {"published_year": F.col("published_year")}
    raise ValueError(f"months do not add up to a {period}")


def merge_states(months: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """States of quarters or years from those of months."""
    ids = _longer(period)
    added = [f"{p}_{c}" for p in PARAMETERS for c in ("sum", "n", "days")]
    gathered = (
        months.withColumns(ids)
        .groupBy(*keys, *ids)
        .agg(
            *[F.sum(c).alias(c) for c in (*added, "std_day_num")],
            # three or twelve short maps
            *[F.flatten(F.collect_list(F.map_entries(f"{p}_values"))).alias(f"{p}_values") for p in COUNTED],
        )
    )
    return gathered.withColumns({f"{p}_values": F.expr(_added_counts(f"{p}_values")) for p in COUNTED})


def _percentile_index(p: str) -> Column:
    days = f"flatten(transform(map_entries({p}_values), e -> array_repeat(e.key, CAST(e.value AS INT))))"
    return F.expr(f"{air.array_percentile_sql('_values', PERIOD_PERCENTILE[p])} / {ANNUAL_STANDARD[p]}D".replace("_values", days))


def _finished(states: DataFrame, keys: Sequence[str], period: str, needed: int | None) -> DataFrame:
    ids = [c for c in states.columns if c.startswith("published_")]
    return states.select(
        *keys,
        *ids,
        *[F.expr(published_mean_sql(p, f"{p}_sum", f"{p}_n")).alias(p) for p in PARAMETERS],
        *[flag.alias(name) for name, flag in period_flags(period, needed, "{}_days").items()],
        "std_day_num",
        *[_percentile_index(p).alias(f"{p}_index") for p in COUNTED],
    )


def period_product(
    states: DataFrame, keys: Sequence[str], period: str, needed: int | None = None
) -> DataFrame:
    """The week, month, quarter or year product of stations, cells or areas from their states."""
    done = _finished(states, keys, period, needed).withColumn("comprehensive_index", air.comprehensive_index())
    return reported(with_index(done, "day")).drop(*[f"{p}_index" for p in COUNTED])


def district_product(states: DataFrame, period: str) -> DataFrame:
    """The month, quarter or year product of districts per source, graded on rounded means."""
    done = _finished(states, ["source", "control_area_id"], period, None)
    rounded = reported(done).withColumn("comprehensive_index", air.comprehensive_index())
    return with_index(rounded, "day", air.graded_iaqi, PARAMETERS).drop(*[f"{p}_index" for p in COUNTED])
