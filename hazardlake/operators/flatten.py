"""Nested documents to flat rows.

Each record layout is a set of named columns over one feature or event. The same set serves
the row form (``explode`` and project, inside generated code) and the message form
(``transform`` over the array, without a shuffle or regrouping).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.functions.classify import (
    keyword_class,
    latitude_band,
    severity_level,
    style_lookup,
)
from hazardlake.functions.convert import decode, epoch_ms, from_end, from_start
from hazardlake.schemas import CORRUPT, INDICATOR_ENTRIES

Fields = Callable[[Column], dict[str, Column]]
# Columns by name: a mapping, or a struct column.
Record = Mapping[str, Column] | Column


def parse_documents(df: DataFrame, schema, value: str = "value", doc: str = "doc") -> DataFrame:
    """Add the parsed document.

    It comes out of a one-element generator, because a filter on a plain parsed column is
    pushed below it with the parser inside and parses every document once more.
    """
    return df.select("*", F.explode_outer(F.array(decode(F.col(value), schema))).alias(doc))


def items_of(df: DataFrame, array: str | Column, *keep: str) -> DataFrame:
    """One row per array element that is not null, as ``_item``.

    The plain ``explode`` adds a filter on the size of the array, which would evaluate (and
    for documents parse) the array twice; the outer form with a filter behind it does not.
    """
    return df.select(*keep, F.explode_outer(array).alias("_item")).filter(
        F.col("_item").isNotNull()
    )


def corrupt_documents(df: DataFrame, items: str, doc: str = "doc") -> DataFrame:
    """Documents that did not parse, with a reason; ``partial`` ones still gave records."""
    parsed = F.col(doc)
    bad = parsed.isNull() | parsed[CORRUPT].isNotNull()
    usable = F.coalesce(F.size(parsed[items]) > 0, F.lit(False))
    return df.filter(bad).withColumn(
        "reason", F.when(usable, F.lit("partial")).otherwise(F.lit("unparseable"))
    )


def _coordinates(geometry: Column) -> Column:
    """Coordinates, all zero when the document leaves them out."""
    return F.coalesce(geometry["coordinates"], F.array(*[F.lit(0.0)] * 3))


def quake_fields(feature: Column) -> dict[str, Column]:
    properties = feature["properties"]
    position = _coordinates(feature["geometry"])
    return {
        "id": F.coalesce(properties["id"], feature["id"]),
        "timestamp": epoch_ms(properties["time"]),
        "magnitude": properties["mag"],
        "place": properties["place"],
        "latitude": from_start(position, 1),
        "longitude": from_start(position, 0),
        "depth": from_start(position, 2),
        "status": properties["status"],
        "alert": properties["alert"],
        "tsunami": properties["tsunami"],
        "significance": properties["sig"],
        "title": properties["title"],
        "url": properties["url"],
    }


def quake_view_fields(feature: Column) -> dict[str, Column]:
    """Map view of a feature: absent values get a default instead of null."""
    properties = feature["properties"]
    coordinates = feature["geometry"]["coordinates"]
    position = _coordinates(feature["geometry"])
    depth = F.when(F.size(coordinates) > 2, from_start(coordinates, 2)).otherwise(F.lit(0.0))
    return {
        "magnitude": F.coalesce(properties["mag"], F.lit(0.0)),
        "place": F.coalesce(properties["place"], F.lit(K.BAND_UNKNOWN)),
        "time": F.coalesce(properties["time"], F.lit(0).cast("bigint")),
        "latitude": from_start(position, 1),
        "longitude": from_start(position, 0),
        "depth": depth,
    }


def volcano_fields(event: Column) -> dict[str, Column]:
    """Event with the position of its last geometry; all null without any geometry."""
    latest = from_end(event["geometry"])
    position = F.when(latest.isNotNull(), _coordinates(latest))
    return {
        "id": event["id"],
        "title": event["title"],
        "description": event["description"],
        "category": event["category"],
        "status": event["status"],
        "latitude": from_start(position, 1),
        "longitude": from_start(position, 0),
        "date": latest["date"],
    }


def flatten(df: DataFrame, items: str | Column, fields: Fields, *keep: str) -> DataFrame:
    """One row per array element; nothing but ``keep`` travels along with it."""
    rows = items_of(df, items, *keep)
    columns = fields(F.col("_item"))
    return rows.select(*keep, *[column.alias(name) for name, column in columns.items()])


def flatten_features(df: DataFrame, items: str = "doc.features", *keep: str) -> DataFrame:
    return flatten(df, items, quake_fields, *keep)


def flatten_features_view(df: DataFrame, items: str = "doc.features", *keep: str) -> DataFrame:
    array = F.filter(
        F.col(items), lambda f: f["properties"].isNotNull() & f["geometry"].isNotNull()
    )
    return flatten(df, array, quake_view_fields, *keep)


def flatten_events_latest_geom(df: DataFrame, items: str = "doc.events", *keep: str) -> DataFrame:
    return flatten(df, items, volcano_fields, *keep)


def quake_classes(record: Record) -> dict[str, Column]:
    return {
        "severity_level": severity_level(record["magnitude"]),
        "region": latitude_band(record["latitude"], record["longitude"]),
    }


def volcano_classes(record: Record) -> dict[str, Column]:
    return {
        "severity_level": keyword_class(record["title"]),
        "region": latitude_band(record["latitude"], record["longitude"]),
    }


def _columns(df: DataFrame) -> dict[str, Column]:
    return {name: F.col(name) for name in df.columns}


def classify_quakes(df: DataFrame) -> DataFrame:
    return df.withColumns(quake_classes(_columns(df)))


def classify_volcanoes(df: DataFrame) -> DataFrame:
    return df.withColumns(volcano_classes(_columns(df)))


def _struct(columns: Mapping[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def records_array(
    items: Column, fields: Fields, extra: Callable[[Column], dict[str, Column]], names: Sequence[str]
) -> Column:
    """Array of records with the named fields, element by element, for message values.

    Two steps, so that the extra columns read finished fields instead of deriving each of
    them again wherever they use it.
    """

    def finish(record: Column) -> Column:
        more = extra(record)
        return _struct({name: more[name] if name in more else record[name] for name in names})

    return F.transform(F.transform(items, lambda item: _struct(fields(item))), finish)


def indicator_entries(document: Column) -> Column:
    """Entries of a two-element ``[meta, entries]`` response; null when there are none."""
    return F.from_json(F.get_json_object(document, "$[1]"), INDICATOR_ENTRIES)


def flatten_indicators(
    df: DataFrame,
    entries: str = "entries",
    names: Mapping[str, str] = K.COUNTRY_NAMES,
    labels: Mapping[str, str] = K.INDICATOR_LABELS,
    categories: Mapping[str, str] = K.INDICATOR_CATEGORIES,
) -> DataFrame:
    """Response entries to the 12 observation columns; entries without a value are skipped.

    Input rows carry ``country_code`` and ``indicator_id`` of the request. The year stays
    text, as it arrives.
    """
    code, indicator = F.col("country_code"), F.col("indicator_id")
    label = style_lookup(indicator, labels, None) if labels else F.lit(None).cast("string")
    name = style_lookup(code, names, None) if names else F.lit(None).cast("string")
    rows = items_of(df, entries, "country_code", "indicator_id")
    return rows.filter(F.col("_item.value").isNotNull()).select(
        "country_code",
        F.coalesce(name, code).alias("country_name"),
        "indicator_id",
        F.coalesce(label, indicator).alias("indicator_name"),
        style_lookup(indicator, categories, K.OTHER_CATEGORY).alias("indicator_category"),
        F.col("_item.date").alias("year"),
        F.col("_item.value").alias("value"),
        F.coalesce("_item.unit", F.lit("")).alias("unit"),
        F.coalesce("_item.obs_status", F.lit("")).alias("obs_status"),
        F.coalesce("_item.decimal", F.lit(0)).alias("decimal"),
        F.coalesce("_item.indicator.value", label, indicator).alias("indicator_description"),
        F.coalesce("_item.source.value", F.lit(K.DEFAULT_SOURCE)).alias("source"),
    )
