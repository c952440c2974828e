"""Queries for lookups, directories and set logic."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import constants as K
from hazardlake.functions.classify import style_lookup
from hazardlake.operators import clean as R
from hazardlake.operators import lookup as J
from hazardlake.queries import sql
from hazardlake.queries.registry import query

# Names are known for the nations of four of the five regions; the rest falls back.
_DIM = f"""{sql.PANEL}, dim AS (SELECT {sql.CODE} AS country_code, n_name AS known_name
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST')"""


def _dimension(spark, sf_dir):
    nations = A.table(spark, sf_dir, "nation")
    regions = A.table(spark, sf_dir, "region").filter(F.col("r_name") != "MIDDLE EAST")
    known = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return known.select(
        A.country_code(F.col("n_nationkey")).alias("country_code"), F.col("n_name").alias("known_name")
    )


@query(
    f"""WITH {_DIM} SELECT o_orderkey, country_code, COALESCE(known_name, country_code) AS known_name
    FROM panel LEFT JOIN dim USING (country_code)"""
)
def lookup_names(spark, sf_dir):
    rows = A.panel(spark, sf_dir).select("o_orderkey", "country_code")
    return J.lookup(rows, _dimension(spark, sf_dir), "country_code", "known_name")


@query(
    """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'Australia' WHEN 1 THEN 'Brazil'
    WHEN 2 THEN 'United Kingdom' WHEN 3 THEN 'South Korea' WHEN 4 THEN 'Chile'
    WHEN 5 THEN 'United States' WHEN 6 THEN 'XX' END AS country_name FROM customer"""
)
def map_country_names(spark, sf_dir):
    """Codes of the wider and the narrower list, an unknown one, and null."""
    codes = F.array(*[F.lit(c) for c in ("AU", "BR", "GB", "KR", "CL", "US", "XX", None)])
    code = F.get(codes, F.col("c_custkey") % 8)
    customers = A.table(spark, sf_dir, "customer").select("c_custkey", code.alias("code"))
    return customers.select("c_custkey", J.map_country_name(F.col("code")).alias("country_name"))


@query(
    f"""WITH {sql.PANEL} SELECT o_orderkey, CASE indicator_id WHEN 'F' THEN 'Filled orders'
    WHEN 'O' THEN 'Open orders' ELSE indicator_id END AS label,
    CASE indicator_id WHEN 'F' THEN 'Economic' WHEN 'O' THEN 'Demographic' ELSE 'Other' END
    AS category FROM panel"""
)
def lookup_categories(spark, sf_dir):
    status = F.col("indicator_id")
    known = {k: v for k, v in A.STATUS_LABELS.items() if k in A.STATUS_CATEGORIES}
    return A.panel(spark, sf_dir).select(
        "o_orderkey",
        F.coalesce(style_lookup(status, known, None), status).alias("label"),
        style_lookup(status, A.STATUS_CATEGORIES, K.OTHER_CATEGORY).alias("category"),
    )


@query(
    f"""WITH {_DIM} SELECT o_orderkey, country_name AS known_name,
    COALESCE(dim.country_code, country_name) AS country_code
    FROM panel LEFT JOIN dim ON country_name = known_name"""
)
def reverse_lookup(spark, sf_dir):
    rows = A.panel(spark, sf_dir).select("o_orderkey", F.col("country_name").alias("known_name"))
    return J.lookup(rows, _dimension(spark, sf_dir), "known_name", "country_code")


@query(
    f"""WITH {sql.ENTITIES} SELECT country_code, MAX(country_name) AS country_name
    FROM entities GROUP BY country_code"""
)
def self_dimension(spark, sf_dir):
    return J.self_dimension(A.entities(spark, sf_dir))


@query(
    f"""WITH {sql.ENTITIES} SELECT DISTINCT country_code, indicator_id FROM entities,
    (VALUES ('NY.GDP.MKTP.CD'), ('NY.GDP.MKTP.KD.ZG'), ('FP.CPI.TOTL.ZG'), ('EN.POP.DNST'))
    AS i(indicator_id)"""
)
def request_plan(spark, sf_dir):
    codes = A.entities(spark, sf_dir).select("country_code").distinct()
    return J.request_plan(codes, list(K.INDICATOR_LABELS))


@query(
    f"""WITH {sql.PANEL} SELECT {sql.CODE} AS country_code, n_name FROM nation
    WHERE {sql.CODE} NOT IN (SELECT country_code FROM panel
    WHERE value > 9900 AND NOT isnan(value) AND indicator_id = 'F')"""
)
def entities_without_data(spark, sf_dir):
    code = A.country_code(F.col("n_nationkey")).alias("country_code")
    universe = A.table(spark, sf_dir, "nation").select(code, "n_name")
    rows = R.drop_incomplete(A.panel(spark, sf_dir), ["value"])
    rows = R.select_indicator(rows, "F").filter(F.col("value") > 9900)
    return J.without_data(universe, rows, "country_code")


@query(f"WITH {sql.ENTITIES} SELECT DISTINCT country_code, country_name FROM entities")
def entity_pairs(spark, sf_dir):
    return J.entity_pairs(A.entities(spark, sf_dir))


_KINDS = f"""{sql.ENTITIES}, kinds AS (SELECT *, CASE WHEN {sql.AGGREGATES} THEN 'region'
    WHEN length(country_code) = 2 THEN 'country' ELSE 'neither' END AS kind FROM entities)"""


@query(f"WITH {_KINDS} SELECT c_custkey, country_code, country_name, kind FROM kinds")
def entity_kinds(spark, sf_dir):
    return R.entity_kind(A.entities(spark, sf_dir))


@query(
    f"""WITH {_KINDS} SELECT c_custkey, country_name FROM kinds
    WHERE kind = 'region' AND {sql.IMPORTANT}"""
)
def important_regions(spark, sf_dir):
    rows = R.important_regions(R.entity_kind(A.entities(spark, sf_dir)))
    return rows.select("c_custkey", "country_name")


@query(
    f"""WITH {_KINDS} SELECT 'All Countries' AS label, 'ALL' AS code UNION ALL
    SELECT DISTINCT country_name, country_code FROM kinds WHERE kind = 'country' UNION ALL
    SELECT DISTINCT country_name || ' (Region)', country_code FROM kinds
    WHERE kind = 'region' AND {sql.IMPORTANT}"""
)
def entity_directory(spark, sf_dir):
    return J.entity_directory(A.entities(spark, sf_dir))


@query(
    f"""WITH {_DIM}, found AS (SELECT DISTINCT country_code FROM panel)
    SELECT country_code FROM found EXCEPT SELECT country_code FROM dim"""
)
def unknown_entities(spark, sf_dir):
    """Entity codes of the data that the dimension does not know."""
    found = A.panel(spark, sf_dir).select("country_code").distinct()
    return J.without_data(found, _dimension(spark, sf_dir), "country_code")
