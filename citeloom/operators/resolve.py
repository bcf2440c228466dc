"""Resolution of names to institutions, and fallbacks between results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import normalised_name

INGEST_NAMES = {"一级": "primary_name", "一级ID": "primary_id", "二级": "secondary_name", "二级ID": "secondary_id"}


def renamed(raw: DataFrame) -> DataFrame:
    """Resolution records under canonical column names."""
    return raw.withColumnsRenamed({k: v for k, v in INGEST_NAMES.items() if k in raw.columns})


def queries_frame(like: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row a name, with its normal form."""
    rows = like.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], "query string")
    return rows.withColumn("alias_norm", normalised_name(F.col("query")))


def disambiguate_pro(aliases: DataFrame, names: Sequence[str]) -> DataFrame:
    """(query, primary and secondary id and name) of each name that an alias fits."""
    wanted = queries_frame(aliases, names)
    return aliases.join(F.broadcast(wanted), "alias_norm").select("query", "primary_id", "primary_name", "secondary_id", "secondary_name")


def disambiguate(aliases: DataFrame, names: Sequence[str]) -> DataFrame:
    """(query, name): the most specific normal name."""
    return disambiguate_pro(aliases, names).select("query", F.coalesce("secondary_name", "primary_name").alias("org_name"))


def with_fallback(first: DataFrame, second: DataFrame, keys: Sequence[str], routes: tuple[str, str]) -> DataFrame:
    """Rows of `first`, and rows of `second` for keys that `first` lacks; `route` tells which. Each key decides for itself."""
    missing = second.join(first.select(*keys).distinct(), list(keys), "left_anti")
    a = first.withColumn("route", F.lit(routes[0]))
    return a.unionByName(missing.withColumn("route", F.lit(f"{routes[0]} -> {routes[1]}")))


def if_empty(first: DataFrame, second: DataFrame, routes: tuple[str, str]) -> DataFrame:
    """`first`, or `second` where it has no row at all."""
    some = first.limit(1).select(F.lit(1).alias("__some"))
    rest = second.join(F.broadcast(some), F.lit(True), "left_anti")
    return first.withColumn("route", F.lit(routes[0])).unionByName(rest.withColumn("route", F.lit(f"{routes[0]} -> {routes[1]}")))
