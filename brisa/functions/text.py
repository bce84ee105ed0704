"""Expressions written once as SQL text, used as columns and as SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def as_column(text: Callable[..., str]) -> Callable[..., Column]:
    """The Column form of a text builder."""

    def build(*args, **kwargs) -> Column:
        return F.expr(text(*args, **kwargs))

    build.__doc__ = text.__doc__
    build.__name__ = text.__name__.removesuffix("_sql")
    return build
