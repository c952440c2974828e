"""SQL building blocks shared by the comparison queries."""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def position(key: str, shift: str = "0") -> tuple[str, str]:
    lat = f"CAST(({key} * 37 + {shift} * 11) % 1900 AS DOUBLE) / 10 - 95"
    lon = f"CAST(({key} * 53 + {shift} * 7) % 3700 AS DOUBLE) / 10 - 185"
    return lat, lon


def severity(magnitude: str) -> str:
    return f"""CASE WHEN {magnitude} IS NULL THEN 'unknown' WHEN {magnitude} < 2 THEN 'micro'
        WHEN {magnitude} < 4 THEN 'minor' WHEN {magnitude} < 5 THEN 'light'
        WHEN {magnitude} < 6 THEN 'moderate' WHEN {magnitude} < 7 THEN 'strong'
        WHEN {magnitude} < 8 THEN 'major' ELSE 'great' END"""


def band(lat: str, lon: str) -> str:
    return f"""CASE WHEN {lat} IS NULL OR {lon} IS NULL OR {lat} = 0 OR {lon} = 0
        OR abs({lat}) > 90 OR abs({lon}) > 180 THEN 'Unknown'
        WHEN {lat} > 60 THEN 'Arctic' WHEN {lat} < -60 THEN 'Antarctic'
        WHEN {lat} >= 23.5 THEN 'Northern Temperate' WHEN {lat} >= -23.5 THEN 'Tropical'
        ELSE 'Southern Temperate' END"""


def title_severity(title: str) -> str:
    return f"""CASE WHEN lower({title}) LIKE '%major%' OR lower({title}) LIKE '%large%' THEN 'major'
        WHEN lower({title}) LIKE '%minor%' OR lower({title}) LIKE '%small%' THEN 'minor'
        WHEN lower({title}) LIKE '%moderate%' THEN 'moderate' ELSE 'unknown' END"""


def exact_mean(column: str, scale: int) -> str:
    factor = 10**scale
    return (
        f"CAST(SUM(CAST(ROUND({column} * {factor}.0::DOUBLE) AS BIGINT)) AS DOUBLE)"
        f" / {factor}.0::DOUBLE / COUNT({column})"
    )


_LAT, _LON = position("event_id")

QUAKES = f"""quakes AS (
    SELECT event_id, CAST(event_id AS VARCHAR) AS id, ts AS timestamp, epoch_us(ts) // 1000 AS time,
        CASE WHEN event_id % 97 <> 0 THEN value / 40 END AS magnitude,
        'Zone ' || user_id AS place,
        CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 199 = 0 THEN 0.0::DOUBLE
            ELSE {_LAT} END AS latitude,
        {_LON} AS longitude,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS depth,
        CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS tsunami,
        CAST(user_id AS INTEGER) AS significance,
        event_type AS status,
        'Quake, ' || event_type AS title
    FROM events)"""

CLASSED = f"""{QUAKES}, classed AS (
    SELECT *, {severity("magnitude")} AS severity_level, {band("latitude", "longitude")} AS region
    FROM quakes)"""

# Quake records as they come back out of the documents.
FLAT = f"""{QUAKES}, placed AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 17 = 0 THEN 0.0::DOUBLE ELSE latitude END AS latitude,
        CASE WHEN event_id % 17 = 0 THEN 0.0::DOUBLE ELSE longitude END AS longitude,
        CASE WHEN event_id % 17 = 0 THEN 0.0::DOUBLE WHEN event_id % 13 = 0 THEN NULL
            ELSE depth END AS depth)
    FROM quakes), flat AS (
    SELECT *, {severity("magnitude")} AS severity_level, {band("latitude", "longitude")} AS region
    FROM placed)"""

_VLAT, _VLON = position("event_id", "(event_id % 4)")

VOLCANOES = f"""raw_volcanoes AS (
    SELECT event_id, CAST(event_id AS VARCHAR) AS id,
        CASE event_type WHEN 'click' THEN 'Minor volcanic unrest'
            WHEN 'error' THEN 'Major volcano eruption' WHEN 'purchase' THEN 'Moderate lava flow'
            WHEN 'signup' THEN 'Etna volcano' WHEN 'view' THEN 'Large lava flow' END
            || ' ' || user_id AS title,
        props AS description,
        CASE WHEN event_type = 'purchase' THEN 'wildfires' ELSE 'volcanoes' END AS category,
        CASE WHEN user_id % 4 = 0 THEN 'closed' ELSE 'open' END AS status,
        CASE WHEN event_id % 4 > 0 THEN {_VLAT} END AS latitude,
        CASE WHEN event_id % 4 > 0 THEN {_VLON} END AS longitude,
        CASE WHEN event_id % 4 > 0 THEN '2024-02-0' || (event_id % 4) END AS date
    FROM events), volcanoes AS (
    SELECT *, {title_severity("title")} AS severity_level, {band("latitude", "longitude")} AS region
    FROM raw_volcanoes)"""

CODE = """chr(CAST(65 + n_nationkey AS INTEGER)) || chr(CAST(65 + (n_nationkey * 7) % 26 AS INTEGER))"""

PANEL = f"""panel AS (
    SELECT o_orderkey, {CODE} AS country_code, n_name AS country_name,
        o_orderstatus AS indicator_id,
        CASE o_orderstatus WHEN 'F' THEN 'Filled orders' WHEN 'O' THEN 'Open orders'
            WHEN 'P' THEN 'Pending orders' ELSE o_orderstatus END AS indicator_name,
        CASE o_orderstatus WHEN 'F' THEN 'Economic' WHEN 'O' THEN 'Demographic'
            ELSE 'Other' END AS indicator_category,
        CASE WHEN o_orderkey % 79 = 0 THEN 'n/a'
            ELSE CAST(2 * year(o_orderdate) - 1976 AS VARCHAR) END AS year,
        CASE WHEN o_orderkey % 89 = 0 THEN NULL
            WHEN o_orderkey % 83 = 0 THEN CAST('NaN' AS DOUBLE)
            WHEN o_orderkey % 101 = 0 THEN 0 ELSE c_acctbal END AS value,
        '' AS unit, o_orderpriority AS obs_status, '0' AS decimal,
        'Balance of status ' || o_orderstatus AS indicator_description, 'World Bank' AS source
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

# Complete observations of valid years, typed.
CLEAN = f"""{PANEL}, clean AS (
    SELECT * REPLACE (CAST(TRY_CAST(year AS DOUBLE) AS INTEGER) AS year,
        CAST(decimal AS INTEGER) AS decimal)
    FROM panel
    WHERE TRY_CAST(year AS DOUBLE) BETWEEN 2015 AND 2025 AND value IS NOT NULL
        AND NOT isnan(value))"""

RAW_COLUMNS = """o_orderkey, country_code, country_name, indicator_id, indicator_name,
    indicator_category, year, value, unit, obs_status, decimal, indicator_description, source"""

VALUE_CATEGORY = """CASE WHEN value < 0 THEN 'Negative' WHEN value = 0 THEN 'Zero'
    WHEN value < 100 THEN 'Low' WHEN value < 1000 THEN 'Medium' ELSE 'High' END"""
YEAR_CATEGORY = """CASE WHEN year < 2018 THEN 'Early Period' WHEN year < 2021 THEN 'Mid Period'
    ELSE 'Recent Period' END"""
QUALITY_FLAG = """CASE WHEN value IS NULL THEN 'Missing Value' WHEN value < 0 THEN 'Negative Value'
    WHEN indicator_id IS NULL THEN 'Missing Indicator' ELSE 'Valid' END"""

ENTITIES = f"""entities AS (
    SELECT c_custkey, {CODE} AS country_code, n_name AS country_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL
    SELECT c_custkey, 'R0' || r_regionkey, CASE r_name WHEN 'AFRICA' THEN 'Sub-Saharan Africa'
        WHEN 'AMERICA' THEN 'Latin America' WHEN 'ASIA' THEN 'East Asia'
        WHEN 'EUROPE' THEN 'European Union' WHEN 'MIDDLE EAST' THEN 'Middle East'
        ELSE r_name END
    FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)"""

AGGREGATES = (
    "regexp_matches(country_name, '(?i)Africa|Asia|Europe|America|Caribbean|Pacific|World|income"
    "|dividend|states|area|Union|IDA|IBRD|HIPC|fragile|conflict')"
)
IMPORTANT = (
    "regexp_matches(country_name, '(?i)World|European Union|Euro area|Arab World|East Asia"
    "|South Asia|Sub-Saharan Africa|Latin America')"
)

LISTING = """listing AS (
    SELECT event_id, event_type AS prefix,
        event_id || '/' || event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS path,
        ts AS modification_time
    FROM events)"""
