"""Explicit schemas of documents, messages and layer tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, DOUBLE, INT, LONG = StringType(), DoubleType(), IntegerType(), LongType()
BOOLEAN, TIMESTAMP = BooleanType(), TimestampType()

CORRUPT = "_corrupt_record"


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def extend(base: StructType, **fields: DataType) -> StructType:
    return StructType([*base.fields, *struct(**fields).fields])


# --- documents -----------------------------------------------------------------------
POSITION = ArrayType(DOUBLE)
FEATURE = struct(
    id=STRING,
    properties=struct(
        id=STRING,
        mag=DOUBLE,
        place=STRING,
        time=LONG,
        status=STRING,
        alert=STRING,
        tsunami=INT,
        sig=INT,
        title=STRING,
        url=STRING,
    ),
    geometry=struct(coordinates=POSITION),
)
FEATURES_DOC = struct(features=ArrayType(FEATURE), **{CORRUPT: STRING})

EVENT = struct(
    id=STRING,
    title=STRING,
    description=STRING,
    category=STRING,
    status=STRING,
    geometry=ArrayType(struct(date=STRING, coordinates=POSITION)),
)
EVENTS_DOC = struct(events=ArrayType(EVENT), **{CORRUPT: STRING})

INDICATOR_ENTRIES = ArrayType(
    struct(
        date=STRING,
        value=DOUBLE,
        unit=STRING,
        obs_status=STRING,
        decimal=INT,
        indicator=struct(id=STRING, value=STRING),
        source=struct(value=STRING),
    )
)

# One record of a topic, also the layout of file-backed topics.
MESSAGE = struct(message_id=STRING, key=STRING, value=STRING)

# --- layer tables --------------------------------------------------------------------
INDICATOR_RAW = struct(
    country_code=STRING,
    country_name=STRING,
    indicator_id=STRING,
    indicator_name=STRING,
    indicator_category=STRING,
    year=INT,
    value=DOUBLE,
    unit=STRING,
    obs_status=STRING,
    decimal=INT,
    indicator_description=STRING,
    source=STRING,
)
INDICATOR_BRONZE = extend(
    INDICATOR_RAW, ingestion_timestamp=TIMESTAMP, data_source=STRING, layer=STRING
)
INDICATOR_SILVER = extend(
    INDICATOR_BRONZE,
    data_quality_flag=STRING,
    is_complete=BOOLEAN,
    value_category=STRING,
    year_category=STRING,
    processing_timestamp=TIMESTAMP,
    processing_version=STRING,
)
INDICATOR_GOLD = extend(
    INDICATOR_SILVER,
    data_quality_score=DOUBLE,
    analytics_timestamp=TIMESTAMP,
    analytics_version=STRING,
)

QUAKE_SILVER = struct(
    id=STRING,
    timestamp=TIMESTAMP,
    magnitude=DOUBLE,
    place=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    depth=DOUBLE,
    status=STRING,
    alert=STRING,
    tsunami=INT,
    significance=INT,
    title=STRING,
    url=STRING,
    processing_timestamp=TIMESTAMP,
    layer=STRING,
    processing_version=STRING,
    severity_level=STRING,
    region=STRING,
)
VOLCANO_SILVER = struct(
    id=STRING,
    title=STRING,
    description=STRING,
    category=STRING,
    status=STRING,
    processing_timestamp=TIMESTAMP,
    layer=STRING,
    processing_version=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    date=STRING,
    severity_level=STRING,
    region=STRING,
)
QUAKE_GOLD = struct(
    region=STRING,
    severity_level=STRING,
    earthquake_count=LONG,
    avg_magnitude=DOUBLE,
    max_magnitude=DOUBLE,
    min_magnitude=DOUBLE,
    avg_depth=DOUBLE,
    tsunami_count=LONG,
    analytics_timestamp=TIMESTAMP,
    layer=STRING,
    analytics_version=STRING,
    data_type=STRING,
)
VOLCANO_GOLD = struct(
    region=STRING,
    severity_level=STRING,
    part=LONG,
    volcano_count=LONG,
    part_count=LONG,
    volcano_titles=ArrayType(STRING),
    analytics_timestamp=TIMESTAMP,
    layer=STRING,
    analytics_version=STRING,
    data_type=STRING,
)
QUAKE_VIEW = struct(
    magnitude=DOUBLE, place=STRING, time=LONG, latitude=DOUBLE, longitude=DOUBLE, depth=DOUBLE
)
VOLCANO_VIEW = struct(
    id=STRING,
    title=STRING,
    description=STRING,
    category=STRING,
    status=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    date=STRING,
)
LISTING = struct(path=STRING, modification_time=TIMESTAMP, length=LONG)
