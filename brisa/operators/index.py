"""Index fields of a wide table: sub-indices, index, grade, primary pollutants."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions import air
from brisa.params import PARAMETERS, PRIMARY_ORDER


def with_index(
    df: DataFrame,
    scale: str,
    method: Callable[[str, str, str], Column] = air.iaqi,
    order: tuple[str, ...] = PRIMARY_ORDER,
) -> DataFrame:
    """Add ``*_iaqi``, ``aqi``, ``grade`` and ``primary_pollutants``.

    Three projections, because each level is used several times by the next:
    the optimiser keeps them apart and evaluates every sub-index once.
    """
    return (
        df.withColumns({f"{p}_iaqi": method(p, p, scale) for p in PARAMETERS})
        .withColumn("aqi", air.aqi())
        .withColumns(
            {
                "grade": air.grade("aqi"),
                "primary_pollutants": air.primary_pollutants(order=order),
            }
        )
    )


def reported(df: DataFrame, blank_negative: bool = True) -> DataFrame:
    """Replace concentrations by their published form (co 0.1, others whole).

    Station products blank negative concentrations, grid products keep them.
    """

    def form(p: str) -> Column:
        text = air.reported_sql(p, p)
        return F.expr(f"CASE WHEN {p} >= 0D THEN {text} END" if blank_negative else text)

    return df.withColumns({p: form(p) for p in PARAMETERS})


def presence_flags(df: DataFrame) -> DataFrame:
    """``*_flag`` = 1 where the concentration is there."""
    return df.withColumns(
        {f"{p}_flag": F.expr(f"CAST({p} IS NOT NULL AS INT)") for p in PARAMETERS}
    )


# Grids that a value is split on, as powers of two; what is left lies on none.
_GRIDS = {"h": -9, "m": -36}


def finite_sql(value: str) -> str:
    """A number as a double; null where it is NaN or infinite, which no reading is."""
    x = f"CAST({value} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) <= 1.7976931348623157E308D THEN {x} END)"


def bins_sql(value: str) -> dict[str, str]:
    """``value`` split exactly into a part on the grid 2^-9, one on 2^-36, and the rest.

    Adding and taking away 1.5 * 2^(52 + power) rounds to a grid; what is taken off
    is exact.  Sums of parts of one grid are whole multiples of it and so exact, the
    same in any order, for 2^27 values that add up to 10^13.  The rest is under 2^-36
    and a multiple of a value's last bit: its sums are exact for 2^25 values of 0.001
    or more.  A retried or differently partitioned run gives the same bits.  Beyond
    these bounds sums round as plain ones do.
    """
    rest, out = finite_sql(value), {}
    for name, power in _GRIDS.items():
        constant = f"{1.5 * 2.0 ** (52 + power)!r}D"
        out[name] = f"(({rest} + {constant}) - {constant})"
        rest = f"({rest} - {out[name]})"
    return {**out, "l": rest}


def steady_mean(value: str) -> Column:
    """Mean that does not depend on the order in which rows are added; see ``bins_sql``.

    Null, NaN and infinite values are left out, of the number of values, too.
    """
    total = " + ".join(f"sum({part})" for part in bins_sql(value).values())
    return F.expr(f"({total}) / nullif(count({finite_sql(value)}), 0L)")


# Published concentrations are whole numbers of these parts of a unit.
_PARTS_OF_UNIT = {"co": 10}


def published_state(parameter: str) -> dict[str, str]:
    """Aggregates that a mean of published values follows from: their sum in the last
    published digit, a whole number, and how many there are.  States are added to merge."""
    parts = _PARTS_OF_UNIT.get(parameter)
    digits = f"CAST(round({parameter} * {parts}D) AS LONG)" if parts else f"CAST({parameter} AS LONG)"
    return {f"{parameter}_sum": f"sum({digits})", f"{parameter}_n": f"count({parameter})"}


def published_mean_sql(parameter: str, total: str, count: str) -> str:
    return f"CAST({total} AS DOUBLE) / nullif({_PARTS_OF_UNIT.get(parameter, 1)}L * {count}, 0L)"


def published_means() -> list[Column]:
    """Mean of every published parameter, the double nearest to its decimal value."""
    return [F.expr(published_mean_sql(p, *published_state(p).values())).alias(p) for p in PARAMETERS]


def parameter_means() -> list[Column]:
    """Mean of every parameter under its own name."""
    return [steady_mean(p).alias(p) for p in PARAMETERS]


def payload(df: DataFrame, keep: Iterable[str], null_fields: bool = True) -> DataFrame:
    """Pack all columns but ``keep`` into one JSON ``data`` column for a text sink."""
    kept = list(keep)
    packed = [c for c in df.columns if c not in kept]
    options = {"ignoreNullFields": "false" if null_fields else "true"}
    return df.select(*kept, F.to_json(F.struct(*packed), options).alias("data"))
