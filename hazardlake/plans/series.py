"""Indicator time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.functions.convert import to_number
from hazardlake.functions.display import series_title
from hazardlake.operators.aggregate import mean
from hazardlake.operators.clean import (
    drop_incomplete,
    iso2_only,
    select_entity,
    select_indicator,
)
from hazardlake.operators.lookup import lookup, self_dimension
from hazardlake.operators.order import first_entities


def observations(df: DataFrame, indicator: str) -> DataFrame:
    """Readable year and value of one indicator for two-letter codes."""
    rows = select_indicator(df, indicator)
    numbers = {
        name: to_number(F.col(name), df.schema[name].dataType) for name in ("year", "value")
    }
    rows = drop_incomplete(rows.withColumns(numbers), ["year", "value"])
    return iso2_only(rows.withColumn("year", F.col("year").cast("int")))


def indicator_series(
    df: DataFrame,
    indicator: str,
    entity: str | None = None,
    n: int | None = K.FIRST_ENTITIES,
    exact_scale: int | None = None,
) -> DataFrame:
    """Yearly mean of an indicator with names and title, by entity and year.

    One entity, or the first ``n`` in code order when none is chosen, or all of them with
    ``n=None``. The names come from all of the data, not just from this indicator's rows; the
    title from the rows that give the means. Two passes over the data, and the choice of an
    entity reaches the scan of both.
    """
    everything = not entity or entity == K.ALL_CODE
    rows = select_entity(observations(df, indicator), entity)
    means = rows.groupBy("country_code", "year").agg(
        mean("value", exact_scale).alias("value"), F.min("indicator_name").alias("_indicator")
    )
    # the same aggregate, whose exchange is used twice
    name = F.coalesce(means.agg(F.min("_indicator")).scalar(), F.lit(indicator))
    chosen = means.drop("_indicator")
    if everything and n is not None:
        chosen = first_entities(chosen, n)
    names = self_dimension(select_entity(df, entity))
    named = lookup(chosen, names, "country_code", "country_name")
    title = series_title(name, None if everything else F.col("country_name"))
    return named.select(
        "country_code", "country_name", "year", "value", title.alias("title")
    ).orderBy("country_code", "year")
