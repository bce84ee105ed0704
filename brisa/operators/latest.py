"""Keyed tables: one row per key, latest wins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Ranking with a limit of one is cut down inside each map task before the
    shuffle, so a key that holds much of the table sends one row per task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Iterable[str] = ()
) -> DataFrame:
    """The newest row of every key; ``ties`` (largest first) settle equal times."""
    order = [F.col(ts).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]]
    return first_per_key(df, keys, order)


def settling(df: DataFrame, first: Iterable[str], known: Iterable[str]) -> list[str]:
    """``first``, then every other column that can be ordered, so that no tie is left to arrival."""
    first = list(first)
    taken = {*first, *known}
    return first + [c for c, t in df.dtypes if c not in taken and "map<" not in t and t != "variant"]


def merge_latest(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    ts: str,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Target after a keyed upsert, as a new DataFrame.

    An update replaces the stored row unless the stored one is newer, whatever
    order they arrive in.  Updates of one key and time are settled by their
    other columns, larger values first.  A stored row without a time is the
    oldest of all.  With ``update_cols`` only those columns (and the time)
    change on rows that exist already; new keys are inserted whole, and ties
    look at those columns first.
    """
    if update_cols is None:
        both = target.withColumn("_new", F.lit(0)).unionByName(
            updates.select(*target.columns).withColumn("_new", F.lit(1))
        )
        ties = settling(both, ["_new"], [*keys, ts])
        return latest_per_key(both, keys, ts, ties=ties).drop("_new")

    updates = updates.select(*target.columns)
    fresh = latest_per_key(updates, keys, ts, ties=settling(updates, update_cols, [*keys, ts]))
    fresh = fresh.select(
        *keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_u")
    )
    old = target.select(
        *keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_t")
    )
    stored, update = F.col("_t"), F.col("_u")
    newer = update.isNotNull()
    if ts not in keys:  # else the times are equal
        newer = newer & (
            stored.isNull() | stored[ts].isNull() | F.coalesce(update[ts] >= stored[ts], F.lit(False))
        )
    changing = {*update_cols, ts}
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in changing:
            out.append(F.when(newer, update[c]).otherwise(stored[c]).alias(c))
        else:
            out.append(F.when(stored.isNotNull(), stored[c]).otherwise(update[c]).alias(c))
    return old.join(fresh, on=list(keys), how="full").select(*out)
