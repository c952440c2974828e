"""Frames behind the map and the detail table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.functions.classify import recency_class, style_lookup
from hazardlake.functions.display import (
    age_minutes,
    fmt_ts,
    quake_label,
    round_display,
    round_exact,
    title_case,
    volcano_label,
    yes_no,
)
from hazardlake.operators.clean import require_position, select_with_defaults
from hazardlake.operators.order import newest_first, recent_events


def quake_markers(quakes: DataFrame, now: Column) -> DataFrame:
    """Marker of each quake with a position: size by severity, colour by age."""
    placed = require_position(quakes)
    severity = F.col("severity_level") if "severity_level" in quakes.columns else F.lit(K.UNKNOWN)
    age = age_minutes(F.col("timestamp"), now)
    return placed.select(
        F.lit("quake").alias("kind"),
        "latitude",
        "longitude",
        style_lookup(F.lower(severity), K.SEVERITY_SIZE, K.SEVERITY_SIZE_DEFAULT).alias("size"),
        recency_class(age).alias("colour"),
        F.lit(K.QUAKE_OPACITY).alias("opacity"),
        quake_label(
            F.col("magnitude"), F.col("place"), F.col("timestamp"), severity, age
        ).alias("label"),
    )


def volcano_markers(volcanoes: DataFrame) -> DataFrame:
    return require_position(volcanoes).select(
        F.lit("volcano").alias("kind"),
        "latitude",
        "longitude",
        F.lit(K.VOLCANO_SIZE).alias("size"),
        F.lit(K.VOLCANO_COLOUR).alias("colour"),
        F.lit(K.VOLCANO_OPACITY).alias("opacity"),
        volcano_label(
            F.col("title"), F.col("date"), F.col("latitude"), F.col("longitude")
        ).alias("label"),
    )


def map_features(
    quakes: DataFrame, volcanoes: DataFrame, now: Column, n: int = K.RECENT_EVENTS
) -> DataFrame:
    """Markers of the ``n`` most recent quakes and of all volcano events."""
    recent = quake_markers(recent_events(quakes, n), now)
    return recent.unionByName(volcano_markers(volcanoes))


def detail_rows(df: DataFrame) -> DataFrame:
    """Display columns of the detail table, in the order of the input."""
    shown = select_with_defaults(
        df,
        {
            "timestamp": None,
            "magnitude": None,
            "place": None,
            "depth": None,
            "severity_level": K.UNKNOWN,
            "region": K.BAND_UNKNOWN,
            "status": K.BAND_UNKNOWN,
            "significance": "N/A",
            "alert": "None",
            "tsunami": None,
            "latitude": None,
            "longitude": None,
        },
    )
    return shown.withColumns(
        {
            "timestamp": fmt_ts(F.col("timestamp")),
            "magnitude": round_display(F.col("magnitude"), 1),
            "depth": round_display(F.col("depth"), 1),
            "severity_level": title_case(F.col("severity_level")),
            "tsunami": yes_no(F.col("tsunami")),
            "latitude": round_exact(F.col("latitude"), 3),
            "longitude": round_exact(F.col("longitude"), 3),
        }
    )


def detail_table(df: DataFrame) -> DataFrame:
    """Detail rows, newest first.

    Sorted before they are formatted: the sort samples its input, and so would format
    every row twice.
    """
    return detail_rows(newest_first(df))
