"""Indicator layers: raw observations to bronze, silver and gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.functions.classify import (
    is_complete,
    quality_flag,
    value_category,
    year_category,
)
from hazardlake.operators.aggregate import layer_counts
from hazardlake.operators.clean import (
    conform,
    drop_incomplete,
    require_columns,
    year_between,
)
from hazardlake.operators.project import (
    add_ingest_meta,
    add_processing_meta,
    gold_projection,
)
from hazardlake.schemas import INDICATOR_GOLD, INDICATOR_RAW, INDICATOR_SILVER
from hazardlake.sources.tables import export_csv, read_table, write_table

# Columns that an observation must have.
CRITICAL = ["country_code", "indicator_id", "year", "value"]
# Gold is a projection of all silver columns.
GOLD_REQUIRED = INDICATOR_SILVER.fieldNames()


def bronze(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Typed observations of valid years with ingestion metadata."""
    typed = conform(year_between(df, column="year"), INDICATOR_RAW)
    return add_ingest_meta(drop_incomplete(typed, CRITICAL), now=now)


def add_quality_columns(df: DataFrame) -> DataFrame:
    value, year = F.col("value"), F.col("year")
    return df.withColumns(
        {
            "data_quality_flag": quality_flag(value, F.col("indicator_id")),
            "is_complete": is_complete(*[F.col(c) for c in CRITICAL]),
            "value_category": value_category(value),
            "year_category": year_category(year),
        }
    )


def silver(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Complete rows of valid years with quality and category columns."""
    kept = year_between(drop_incomplete(df, ["value", "year", "country_code"]))
    return add_processing_meta(add_quality_columns(kept), now=now)


def gold(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Silver columns in fixed order with analysis metadata; empty if one is missing."""
    checked = require_columns(df, GOLD_REQUIRED, INDICATOR_GOLD)
    return checked if checked is not df else gold_projection(df, now)


def run_batch(
    spark: SparkSession, raw: DataFrame, paths: Mapping[str, str], csv: Mapping[str, str] = {}
) -> DataFrame:
    """Build the three layers and return their record counts.

    Each layer is written once and the next one starts from the written table, so nothing
    is computed twice and a lost executor costs one layer at most. ``csv`` names layers
    that also get a CSV copy.
    """
    steps = {"bronze": bronze, "silver": silver, "gold": gold}
    tables = {}
    source = raw
    for layer, step in steps.items():
        write_table(step(source), paths[layer])
        source = tables[layer] = read_table(spark, paths[layer])
        if layer in csv:
            export_csv(source, csv[layer])
    return layer_counts(tables)
