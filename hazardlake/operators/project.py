"""Metadata columns and fixed projections of the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.schemas import INDICATOR_SILVER


def add_ingest_meta(
    df: DataFrame,
    source: str = K.INDICATOR_SOURCE,
    layer: str = "bronze",
    now: Column | None = None,
) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if now is None else now,
            "data_source": F.lit(source),
            "layer": F.lit(layer),
        }
    )


def processing_meta(
    layer: str = "silver", version: str = K.PIPELINE_VERSION, now: Column | None = None
) -> list[Column]:
    return [
        (F.current_timestamp() if now is None else now).alias("processing_timestamp"),
        F.lit(layer).alias("layer"),
        F.lit(version).alias("processing_version"),
    ]


def add_processing_meta(
    df: DataFrame,
    layer: str = "silver",
    version: str = K.PIPELINE_VERSION,
    now: Column | None = None,
) -> DataFrame:
    """Processing columns; an existing layer column is replaced."""
    return df.withColumns(
        {
            "processing_timestamp": F.current_timestamp() if now is None else now,
            "layer": F.lit(layer),
            "processing_version": F.lit(version),
        }
    )


def add_analytics_meta(
    df: DataFrame,
    data_type: str,
    layer: str = "gold",
    version: str = K.PIPELINE_VERSION,
    now: Column | None = None,
) -> DataFrame:
    return df.withColumns(
        {
            "analytics_timestamp": F.current_timestamp() if now is None else now,
            "layer": F.lit(layer),
            "analytics_version": F.lit(version),
            "data_type": F.lit(data_type),
        }
    )


def gold_projection(df: DataFrame, now: Column | None = None) -> DataFrame:
    """The silver columns in fixed order with score, time and version of the analysis.

    ``layer`` keeps its silver value.
    """
    return df.select(
        *INDICATOR_SILVER.fieldNames(),
        F.lit(K.QUALITY_SCORE).cast("double").alias("data_quality_score"),
        (F.current_timestamp() if now is None else now).alias("analytics_timestamp"),
        F.lit(K.PIPELINE_VERSION).alias("analytics_version"),
    )
