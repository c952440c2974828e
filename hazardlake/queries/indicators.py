"""Queries over the indicator panel: cleaning, layers, statistics and series."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import schemas as S
from hazardlake.functions import classify as C
from hazardlake.functions.convert import to_number
from hazardlake.operators import aggregate as G
from hazardlake.operators import clean as R
from hazardlake.operators import lookup as J
from hazardlake.operators import order as O
from hazardlake.operators import project as P
from hazardlake.operators.quality import flag_summary as summarise_flags
from hazardlake.plans import batch, series
from hazardlake.queries import sql
from hazardlake.queries.registry import query
from hazardlake.session import scratch_path
from hazardlake.sources import tables

_CATEGORIES = f"""{sql.QUALITY_FLAG} AS data_quality_flag, TRUE AS is_complete,
    {sql.VALUE_CATEGORY} AS value_category, {sql.YEAR_CATEGORY} AS year_category"""


@query(
    f"""WITH {sql.PANEL} SELECT o_orderkey, value FROM panel
    WHERE value IS NOT NULL AND NOT isnan(value)"""
)
def drop_incomplete(spark, sf_dir):
    rows = R.drop_incomplete(A.panel(spark, sf_dir), ["value", "year", "country_code"])
    return rows.select("o_orderkey", "value")


@query(
    f"""WITH {sql.PANEL} SELECT o_orderkey, CAST(TRY_CAST(year AS DOUBLE) AS INTEGER) AS year
    FROM panel WHERE TRY_CAST(year AS DOUBLE) BETWEEN 2015 AND 2025"""
)
def year_between(spark, sf_dir):
    return R.year_between(A.panel(spark, sf_dir)).select("o_orderkey", "year")


@query(
    f"""WITH {sql.PANEL} SELECT COUNT(*) AS n, COUNT(TRY_CAST(year AS DOUBLE)) AS n_numbers,
    MIN(TRY_CAST(year AS DOUBLE)) AS low, MAX(TRY_CAST(year AS DOUBLE)) AS high FROM panel"""
)
def numeric_coercion(spark, sf_dir):
    year = to_number(F.col("year"))
    return A.panel(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(year).alias("n_numbers"),
        F.min(year).alias("low"),
        F.max(year).alias("high"),
    )


@query(
    f"""WITH {sql.PANEL} SELECT COUNT_IF(value IS NULL OR isnan(value)) AS missing,
    COUNT_IF(value IS NOT NULL AND NOT isnan(value)) AS present FROM panel"""
)
def missing_counts(spark, sf_dir):
    missing = C.is_missing(F.col("value"))
    return A.panel(spark, sf_dir).agg(
        F.count_if(missing).alias("missing"), F.count_if(~missing).alias("present")
    )


@query(
    f"""WITH {sql.PANEL} SELECT country_code, country_name, indicator_id, indicator_name,
    indicator_category, CAST(TRY_CAST(year AS DOUBLE) AS INTEGER) AS year, unit, obs_status,
    CAST(decimal AS INTEGER) AS decimal, indicator_description, source,
    CAST(COUNT(*) AS BIGINT) AS n FROM panel GROUP BY ALL"""
)
def conform(spark, sf_dir):
    typed = R.conform(A.panel(spark, sf_dir), S.INDICATOR_RAW).drop("value")
    return typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql.PANEL}, gaps AS (SELECT * REPLACE (
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE indicator_id END AS indicator_id,
        CASE WHEN isnan(value) THEN NULL ELSE value END AS value,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE country_code END AS country_code) FROM panel)
    SELECT o_orderkey, {sql.QUALITY_FLAG} AS data_quality_flag,
    country_code IS NOT NULL AND indicator_id IS NOT NULL AND year IS NOT NULL
        AND value IS NOT NULL AS is_complete FROM gaps"""
)
def quality_flags(spark, sf_dir):
    """Flags of rows with gaps: no filter goes before them."""
    key, value = F.col("o_orderkey"), F.col("value")
    rows = A.panel(spark, sf_dir).withColumns(
        {
            "indicator_id": F.when(key % 7 != 0, F.col("indicator_id")),
            "country_code": F.when(key % 11 != 0, F.col("country_code")),
            "value": F.when(~F.isnan(value), value),
        }
    )
    return rows.select(
        "o_orderkey",
        C.quality_flag(F.col("value"), F.col("indicator_id")).alias("data_quality_flag"),
        C.is_complete(*[F.col(c) for c in batch.CRITICAL]).alias("is_complete"),
    )


@query(
    f"""WITH {sql.CLEAN} SELECT {sql.VALUE_CATEGORY} AS value_category,
    {sql.YEAR_CATEGORY} AS year_category, COUNT(*) AS n FROM clean GROUP BY 1, 2"""
)
def value_and_year_categories(spark, sf_dir):
    rows = R.year_between(R.drop_incomplete(A.panel(spark, sf_dir), ["value"]))
    return rows.groupBy(
        C.value_category(F.col("value")).alias("value_category"),
        C.year_category(F.col("year")).alias("year_category"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql.CLEAN} SELECT {sql.RAW_COLUMNS}, 'world_bank_api' AS data_source,
    'bronze' AS layer FROM clean"""
)
def bronze_panel(spark, sf_dir):
    rows = A.panel(spark, sf_dir)
    keyed = S.extend(S.struct(o_orderkey=S.LONG), **{f.name: f.dataType for f in S.INDICATOR_RAW})
    typed = R.conform(R.year_between(rows), keyed)
    kept = R.drop_incomplete(typed, batch.CRITICAL)
    return P.add_ingest_meta(kept).drop("ingestion_timestamp")


@query(
    f"""WITH {sql.CLEAN} SELECT {sql.RAW_COLUMNS}, {_CATEGORIES}, 'silver' AS layer,
    '1.0' AS processing_version FROM clean"""
)
def silver_panel(spark, sf_dir):
    rows = A.panel(spark, sf_dir).withColumn("decimal", F.col("decimal").cast("int"))
    return batch.silver(rows).drop("processing_timestamp")


_GOLD = """country_code, country_name, indicator_id, indicator_name, indicator_category, year,
    unit, obs_status, decimal, indicator_description, source"""


@query(
    f"""WITH {sql.CLEAN} SELECT {_GOLD}, 'world_bank_api' AS data_source, 'silver' AS layer,
    {_CATEGORIES}, '1.0' AS processing_version, 0.95::DOUBLE AS data_quality_score,
    '1.0' AS analytics_version, value, COUNT(*) AS n FROM clean GROUP BY ALL"""
)
def gold_panel(spark, sf_dir):
    layers = batch.gold(batch.silver(batch.bronze(A.panel(spark, sf_dir))))
    rows = layers.drop("ingestion_timestamp", "processing_timestamp", "analytics_timestamp")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql.CLEAN}, flagged AS (SELECT {_CATEGORIES} FROM clean)
    SELECT data_quality_flag, is_complete, COUNT(*) AS n_records FROM flagged GROUP BY ALL"""
)
def flag_summary(spark, sf_dir):
    return summarise_flags(batch.silver(A.panel(spark, sf_dir)))


@query(
    f"""WITH {sql.CLEAN} SELECT country_code, year, round(AVG(value), 6) AS value
    FROM clean GROUP BY country_code, year"""
)
def entity_year_average(spark, sf_dir):
    """The plain average of each entity and year."""
    rows = R.year_between(R.drop_incomplete(A.panel(spark, sf_dir), ["value"]))
    return G.entity_year_mean(rows).withColumn("value", F.round("value", 6))


@query(
    f"""WITH {sql.CLEAN} SELECT country_code, year, {sql.exact_mean("value", 2)} AS value
    FROM clean GROUP BY country_code, year"""
)
def entity_year_mean(spark, sf_dir):
    rows = R.year_between(R.drop_incomplete(A.panel(spark, sf_dir), ["value"]))
    return G.entity_year_mean(rows, exact_scale=2)


@query(
    f"""WITH {sql.CLEAN}, layers AS (SELECT 'raw' AS layer FROM panel UNION ALL
    SELECT unnest(['bronze', 'silver', 'gold']) FROM clean)
    SELECT layer, COUNT(*) AS records FROM layers GROUP BY layer"""
)
def layer_counts(spark, sf_dir):
    steps = {"bronze": batch.bronze, "silver": batch.silver, "gold": batch.gold}
    return G.observed_counts(A.panel(spark, sf_dir), steps)


@query(
    f"""WITH {sql.CLEAN} SELECT 'complete' AS silver, COUNT(*) AS n, 24 AS n_columns FROM clean
    UNION ALL SELECT 'lacks a column', 0, 24"""
)
def gold_without_columns(spark, sf_dir):
    """A stored silver table that lacks a column gives an empty gold table of the full layout."""
    silver = batch.silver(batch.bronze(A.panel(spark, sf_dir)))
    counts = []
    for name, layer in (("complete", silver), ("lacks a column", silver.drop("unit"))):
        path = scratch_path(spark, "silver")
        tables.write_table(layer, path)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            gold = batch.gold(tables.read_table(spark, path))
        n = gold.agg(F.count(F.lit(1)).alias("n"))
        counts.append(n.select(F.lit(name).alias("silver"), "n", F.lit(len(gold.columns)).alias("n_columns")))
    return counts[0].unionByName(counts[1])


@query(
    f"""WITH {sql.CLEAN} SELECT COUNT(*) AS n_rows, 15 AS n_columns, TRUE AS entities_close,
    TRUE AS indicators_close, MIN(year) AS first_year, MAX(year) AS last_year
    FROM clean"""
)
def merged_profile(spark, sf_dir):
    """Sketches of four portions, stored and merged, against the exact profile."""
    rows = batch.bronze(A.panel(spark, sf_dir))
    path = scratch_path(spark, "profiles")
    portion = F.pmod(F.xxhash64("country_name", "year"), F.lit(4)).alias("portion")
    parts = G.profile_sketch(rows.withColumn("portion", portion), ["portion"])
    tables.write_table(parts.withColumn("n_columns", F.lit(len(rows.columns))), path)
    merged = G.merge_profiles(tables.read_table(spark, path))
    exact = G.profile(rows).select(F.struct("n_entities", "n_indicators").alias("exact"))
    close = lambda c: (F.abs(F.col(c) - F.col(f"exact.{c}")) <= 0.05 * F.col(f"exact.{c}"))
    return merged.withColumn("exact", exact.scalar()).select(
        "n_rows",
        "n_columns",
        close("n_entities").alias("entities_close"),
        close("n_indicators").alias("indicators_close"),
        "first_year",
        "last_year",
    )


@query(
    f"""WITH {sql.CLEAN} SELECT COUNT(*) AS n_rows, 15 AS n_columns,
    COUNT(DISTINCT country_name) AS n_entities, COUNT(DISTINCT indicator_name) AS n_indicators,
    MIN(year) AS first_year, MAX(year) AS last_year FROM clean"""
)
def profile(spark, sf_dir):
    return G.profile(batch.bronze(A.panel(spark, sf_dir)))


@query(
    f"""WITH {sql.PANEL} SELECT indicator_id, MIN(indicator_name) AS indicator_name,
    COUNT(value) AS n_values FROM panel GROUP BY indicator_id HAVING COUNT(value) > 0"""
)
def indicator_directory(spark, sf_dir):
    return J.indicator_directory(A.panel(spark, sf_dir))


@query(f"WITH {sql.PANEL} SELECT o_orderkey, country_code FROM panel WHERE indicator_id = 'F'")
def select_indicator(spark, sf_dir):
    return R.select_indicator(A.panel(spark, sf_dir), "F").select("o_orderkey", "country_code")


@query(f"WITH {sql.PANEL} SELECT o_orderkey, year FROM panel WHERE country_code = 'CO'")
def select_entity(spark, sf_dir):
    return R.select_entity(A.panel(spark, sf_dir), " co").select("o_orderkey", "year")


@query(
    f"""WITH {sql.ENTITIES} SELECT c_custkey, upper(trim(country_code)) AS country_code
    FROM entities WHERE length(trim(country_code)) = 2"""
)
def iso2_only(spark, sf_dir):
    rows = A.entities(spark, sf_dir)
    noisy = F.concat(F.lit(" "), F.lower("country_code"), F.lit(" "))
    codes = R.iso2_only(rows.withColumn("country_code", noisy))
    return codes.select("c_custkey", "country_code")


_OBSERVED = f"""{sql.PANEL}, observed AS (
    SELECT upper(trim(country_code)) AS country_code,
        CAST(TRY_CAST(year AS DOUBLE) AS INTEGER) AS year, value FROM panel
    WHERE indicator_id = 'O' AND TRY_CAST(year AS DOUBLE) IS NOT NULL AND value IS NOT NULL
        AND NOT isnan(value) AND length(trim(country_code)) = 2),
    means AS (SELECT country_code, year, {sql.exact_mean("value", 2)} AS value
        FROM observed GROUP BY country_code, year),
    names AS (SELECT country_code, MAX(country_name) AS country_name FROM panel GROUP BY 1)"""


@query(
    f"""WITH {_OBSERVED} SELECT country_code, country_name, year, value,
    ' Open orders - All Countries (2015-2025) - Click legend to filter' AS title
    FROM means JOIN names USING (country_code) WHERE country_code IN (
        SELECT DISTINCT country_code FROM means ORDER BY country_code LIMIT 20)"""
)
def indicator_series(spark, sf_dir):
    return series.indicator_series(A.panel(spark, sf_dir), "O", exact_scale=2)


@query(
    f"""WITH {_OBSERVED} SELECT country_code, country_name, year, value,
    ' Open orders - ' || country_name || ' (2015-2025)' AS title
    FROM means JOIN names USING (country_code) WHERE country_code = 'CO'"""
)
def series_one_entity(spark, sf_dir):
    return series.indicator_series(A.panel(spark, sf_dir), "O", "co", exact_scale=2)


@query(
    f"""WITH {_OBSERVED} SELECT country_code, year, value FROM means WHERE country_code IN (
    SELECT DISTINCT country_code FROM means ORDER BY country_code LIMIT 5)"""
)
def first_entities(spark, sf_dir):
    means = G.entity_year_mean(series.observations(A.panel(spark, sf_dir), "O"), exact_scale=2)
    return O.first_entities(means, 5)
