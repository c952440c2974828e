"""Lookups, directories of entities and indicators, and set logic on keys.

No broadcast hints on data: a dimension is broadcast when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (at planning or, after a shuffle, by adaptive
execution), and joined by shuffle with skew splitting otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.functions.classify import style_lookup
from hazardlake.functions.display import region_label
from hazardlake.operators.clean import entity_kind, matches


def lookup(
    df: DataFrame, dim: DataFrame, key: str, out: str, fallback: str | Column | None = None
) -> DataFrame:
    """Add ``out`` from a dimension with columns ``(key, out)``, one row per key.

    Keys that are not in the dimension get the fallback, by default the key itself.
    """
    other = F.col(key) if fallback is None else fallback
    other = F.col(other) if isinstance(other, str) else other
    found = dim.select(F.col(key).alias("_key"), F.col(out).alias("_found"))
    joined = df.join(found, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_found"), other)).drop("_key", "_found")


def self_dimension(
    df: DataFrame, code: str = "country_code", name: str = "country_name"
) -> DataFrame:
    """One name per code, taken from the data; the last name in text order wins.

    The pairs are made distinct first: that is a hash aggregate, whereas the maximum of a
    text column sorts its input, and by then there is little left to sort.
    """
    return df.select(code, name).distinct().groupBy(code).agg(F.max(name).alias(name))


def request_plan(entities: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Every entity with every indicator of a short fixed list, without a join."""
    listed = F.array(*[F.lit(i) for i in indicators])
    return entities.withColumn("indicator_id", F.explode(listed))


def without_data(universe: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Universe rows whose key never occurs in the data.

    The data is reduced to distinct keys before it is shuffled, so a hot key costs one row
    per task.
    """
    return universe.join(df.select(key).distinct(), key, "left_anti")


def indicator_name(df: DataFrame, indicator: str) -> Column:
    """Display name of an indicator as a scalar subquery; the id when there is none."""
    names = df.filter(F.col("indicator_id") == indicator).agg(F.min("indicator_name"))
    return F.coalesce(names.scalar(), F.lit(indicator))


def map_country_name(code: Column) -> Column:
    """Name of a country on the map, the code where none is known."""
    return F.coalesce(style_lookup(code, K.MAP_COUNTRY_NAMES, None), code)


def entity_pairs(
    df: DataFrame, code: str = "country_code", name: str = "country_name"
) -> DataFrame:
    return df.select(code, name).na.drop().dropDuplicates()


def indicator_directory(df: DataFrame) -> DataFrame:
    """Name and number of values per indicator, most data first; empty ones left out."""
    named = df.groupBy("indicator_id", "indicator_name").agg(F.count("value").alias("n"))
    counted = named.groupBy("indicator_id").agg(
        F.min("indicator_name").alias("indicator_name"), F.sum("n").alias("n_values")
    )
    return counted.filter(F.col("n_values") > 0).orderBy(F.desc("n_values"), "indicator_id")


def entity_directory(
    df: DataFrame,
    aggregate_pattern: str = K.AGGREGATE_PATTERN,
    important_pattern: str = K.IMPORTANT_PATTERN,
) -> DataFrame:
    """Selection list: everything first, then countries and important regions by label."""
    kinds = entity_kind(entity_pairs(df), aggregate_pattern)
    name, kind = F.col("country_name"), F.col("kind")
    label = F.when(kind == "country", name).when(
        (kind == "region") & matches(name, important_pattern), region_label(name)
    )
    listed = kinds.select(
        label.alias("label"), F.col("country_code").alias("code"), F.lit(1).alias("pin")
    ).filter(F.col("label").isNotNull())
    everything = df.sparkSession.range(1).select(
        F.lit(K.ALL_LABEL).alias("label"), F.lit(K.ALL_CODE).alias("code"), F.lit(0).alias("pin")
    )
    return everything.unionByName(listed).orderBy("pin", "label", "code").select("label", "code")
