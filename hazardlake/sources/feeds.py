"""Landed documents of the indicator, quake and volcano feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazardlake import constants as K
from hazardlake.functions.display import snapshot_time
from hazardlake.operators.clean import feed_window
from hazardlake.operators.flatten import (
    corrupt_documents,
    flatten_events_latest_geom,
    flatten_features,
    indicator_entries,
    parse_documents,
)
from hazardlake.schemas import EVENTS_DOC, FEATURES_DOC


def read_indicator_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed responses as ``(country_code, indicator_id, entries)``.

    Files lie under ``country_code=<code>/indicator_id=<id>/`` and hold one document each,
    or one per line without ``multi_line``. The partition columns are declared, because
    inference would read codes such as ``1D`` as numbers.
    """
    documents = _responses(spark, path, multi_line)
    return documents.select(
        "country_code", "indicator_id", indicator_entries(F.col("value")).alias("entries")
    )


def _responses(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    layout = "value STRING, country_code STRING, indicator_id STRING"
    return spark.read.schema(layout).text(path, wholetext=multi_line)


def unreadable_indicators(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed responses that give no entries, unchanged, with the reason.

    ``unparseable`` is no JSON, or no list of entries where one belongs; ``no entries`` is a
    response without a second element, as the service sends for unknown codes.
    """
    value = F.col("value")
    entries = F.explode(F.array(indicator_entries(value))).alias("entries")
    whole = F.get_json_object(value, "$").isNotNull() & F.get_json_object(value, "$[1]").isNull()
    documents = _responses(spark, path, multi_line).select("*", entries)
    return documents.filter(F.col("entries").isNull()).select(
        "country_code",
        "indicator_id",
        "value",
        F.when(whole, F.lit("no entries")).otherwise(F.lit("unparseable")).alias("reason"),
    )


def landed_since(files: DataFrame, since: Column, dated_by: str = "modified") -> DataFrame:
    """Rows of the files that landed at ``since`` or later; the others are listed and never opened.

    ``dated_by`` is ``"modified"`` (modification time) or ``"name"`` (the time in a snapshot's name; files
    without one are kept). ``files`` comes straight from a reader of files.
    """
    if dated_by == "modified":
        landed = F.col("_metadata.file_modification_time")
    elif dated_by == "name":
        landed = F.coalesce(snapshot_time(F.col("_metadata.file_path")), since)
    else:
        raise ValueError(f"unknown way to date files: {dated_by}")
    return files.filter(landed >= since)


def read_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = True,
    since: Column | None = None,
    dated_by: str = "modified",
) -> DataFrame:
    """Landed JSON documents, one per file, or one per line without ``multi_line``.

    With ``since``, only of files that landed from then on (see ``landed_since``).
    """
    documents = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return documents if since is None else landed_since(documents, since, dated_by)


def unreadable_documents(
    spark: SparkSession, path: str, schema: StructType, items: str, multi_line: bool = True
) -> DataFrame:
    """Landed documents that could not be read in full, unchanged, with the reason.

    ``partial`` ones also give records.
    """
    layout = StructType([StructField("value", StringType())])
    documents = spark.read.schema(layout).text(path, wholetext=multi_line)
    bad = corrupt_documents(parse_documents(documents.filter(F.trim("value") != ""), schema), items)
    return bad.select("value", "reason")


def read_quake_feed(
    spark: SparkSession,
    path: str,
    end: Column,
    hours: int = K.FEED_HOURS,
    min_magnitude: float = K.FEED_MIN_MAGNITUDE,
    multi_line: bool = True,
    dated_by: str | None = "modified",
    slack_hours: int = 1,
) -> DataFrame:
    """Events of landed feature collections inside the trailing window.

    A document holds what happened before it landed, so one that landed before the window (by
    more than ``slack_hours``, for clocks that differ) has nothing to add: its file is not opened.
    ``dated_by`` says how files are dated (see ``landed_since``); None opens them all.
    """
    since = end - F.expr(f"INTERVAL {int(hours) + int(slack_hours)} HOURS") if dated_by else None
    documents = read_documents(spark, path, FEATURES_DOC, multi_line, since, dated_by or "modified")
    return feed_window(flatten_features(documents, "features"), end, hours, min_magnitude)


def read_volcano_feed(
    spark: SparkSession,
    path: str,
    category: str = "volcanoes",
    status: str = "open",
    multi_line: bool = True,
) -> DataFrame:
    """Landed events of one category and status."""
    documents = read_documents(spark, path, EVENTS_DOC, multi_line)
    events = flatten_events_latest_geom(documents, "events")
    return events.filter((F.col("category") == category) & (F.col("status") == status))
