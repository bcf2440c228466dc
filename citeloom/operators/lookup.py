"""Lookups by key: one, a list or a frame of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys up to which a list becomes a pushed IN condition.
INLINE_KEYS = 1000


def by_key(df: DataFrame, key: str, value, columns: Sequence[str] | None = None) -> DataFrame:
    """The record of one key; narrow with `columns`."""
    out = df.where(F.col(key) == F.lit(value))
    return out.select(*columns) if columns else out


def by_keys(df: DataFrame, key: str, values: Sequence, columns: Sequence[str] | None = None) -> DataFrame:
    """Records of a list of keys, each once; nulls and repeats in the list add nothing."""
    values = list(dict.fromkeys(v for v in values if v is not None))
    if len(values) <= INLINE_KEYS:
        out = df.where(F.col(key).isin(values))
    else:
        kind = df.schema[key].dataType.simpleString()
        out = by_frame(df, key, df.sparkSession.createDataFrame([(v,) for v in values], f"{key} {kind}"))
    return out.select(*columns) if columns else out


def by_frame(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Records whose key is in a frame of keys; the planner broadcasts it if it is small."""
    return df.join(keys.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
