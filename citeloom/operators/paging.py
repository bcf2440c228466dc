"""Order, pages, prefixes and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page(df: DataFrame, order: Sequence[Column], page: int = 0, size: int = 10, base: int = 0, cap: int | None = None) -> DataFrame:
    """A page of `size` rows (at most `cap`); `base` is the number of the first page. A page before it is the first."""
    size = min(size, cap) if cap is not None else size
    return window_of(df, order, max(0, page - base) * size, size)


def window_of(df: DataFrame, order: Sequence[Column], offset: int = 0, limit: int = 10) -> DataFrame:
    """Rows from `offset` on: one ordered take, no full sort."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset > 0 else ordered).limit(max(0, limit))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int, rank: str = "ordinal") -> DataFrame:
    """The first `most` rows of each key, numbered from 1; the planner limits groups before the shuffle."""
    return numbered(df, keys, order, rank).where(F.col(rank) <= most)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "ordinal") -> DataFrame:
    """All rows of each key, numbered from 1."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def by(column: str, key: str) -> list[Column]:
    """Falling by a column, nulls last, then by key."""
    return [F.desc_nulls_last(column), F.asc(key)]
