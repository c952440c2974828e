"""Queries over nested documents built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import schemas as S
from hazardlake.operators import aggregate as G
from hazardlake.operators import flatten as flat
from hazardlake.queries import sql
from hazardlake.queries.registry import query
from hazardlake.streaming import hazards as H

_FLAT_COLUMNS = """id, time, magnitude, place, latitude, longitude, depth, status, tsunami,
    significance, title"""


def quake_docs(spark, sf_dir):
    return flat.parse_documents(A.quake_documents(spark, sf_dir), S.FEATURES_DOC)


def volcano_docs(spark, sf_dir):
    return flat.parse_documents(A.volcano_documents(spark, sf_dir), S.EVENTS_DOC)


@query(f"WITH {sql.FLAT} SELECT {_FLAT_COLUMNS} FROM flat")
def flatten_features(spark, sf_dir):
    rows = flat.flatten_features(quake_docs(spark, sf_dir))
    return rows.withColumn("time", F.unix_millis("timestamp")).drop("timestamp", "alert", "url")


@query(
    f"""WITH {sql.QUAKES} SELECT COALESCE(magnitude, 0) AS magnitude, place, time, latitude,
    longitude, CASE WHEN event_id % 13 = 0 THEN 0 ELSE depth END AS depth
    FROM quakes WHERE event_id % 17 <> 0"""
)
def flatten_features_view(spark, sf_dir):
    return flat.flatten_features_view(quake_docs(spark, sf_dir))


@query(
    f"""WITH {sql.VOLCANOES} SELECT id, title, description, category, status, latitude, longitude,
    date FROM volcanoes"""
)
def latest_geometry(spark, sf_dir):
    return flat.flatten_events_latest_geom(volcano_docs(spark, sf_dir))


@query(
    f"""WITH {sql.PANEL} SELECT country_code, country_code AS country_name, indicator_id,
    indicator_name, indicator_category, year, value, unit, obs_status, 0 AS decimal,
    CASE WHEN o_orderkey % 7 = 0 THEN indicator_name ELSE indicator_description END
    AS indicator_description, source FROM panel WHERE value IS NOT NULL AND NOT isnan(value)"""
)
def flatten_indicators(spark, sf_dir):
    entries = flat.indicator_entries(F.col("value")).alias("entries")
    pages = A.indicator_documents(spark, sf_dir).select("country_code", "indicator_id", entries)
    return flat.flatten_indicators(pages, "entries", {}, A.STATUS_LABELS, A.STATUS_CATEGORIES)


@query(
    f"""SELECT CAST(event_id // {A.DOCUMENT_SIZE} AS VARCHAR) AS message_id,
    CAST(COUNT(*) AS INTEGER) AS n_items FROM events GROUP BY 1"""
)
def batch_sizes(spark, sf_dir):
    return G.batch_sizes(quake_docs(spark, sf_dir), "message_id", "doc.features")


_SILVER = f"""{_FLAT_COLUMNS}, severity_level, region, 'silver' AS layer,
    '1.0' AS processing_version"""


@query(f"WITH {sql.FLAT} SELECT {_SILVER} FROM flat")
def quake_silver(spark, sf_dir):
    rows = H.silver_rows(A.quake_documents(spark, sf_dir), H.QUAKE)
    rows = rows.withColumn("time", F.unix_millis("timestamp"))
    return rows.drop("message_id", "timestamp", "alert", "url", "processing_timestamp")


@query(
    f"""WITH {sql.VOLCANOES} SELECT id, title, description, category, status, latitude, longitude,
    date, severity_level, region, 'silver' AS layer, '1.0' AS processing_version FROM volcanoes"""
)
def volcano_silver(spark, sf_dir):
    rows = H.silver_rows(A.volcano_documents(spark, sf_dir), H.VOLCANO)
    return rows.drop("message_id", "processing_timestamp")
