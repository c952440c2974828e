"""Queries for quality checks and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import schemas as S
from hazardlake.functions.convert import to_number
from hazardlake.operators import quality as Q
from hazardlake.queries import sql
from hazardlake.queries.registry import query
from hazardlake.session import scratch_path
from hazardlake.sources.tables import write_table

# The last check fails on purpose: no order is older than the data.
_CHECKS = """checks AS (
    SELECT 'events' AS check_name, COUNT(*) > 0 AS ok FROM events
    UNION ALL SELECT 'orders', COUNT(*) > 0 FROM orders
    UNION ALL SELECT 'customers', COUNT(*) > 0 FROM customer
    UNION ALL SELECT 'early_orders', COUNT(*) > 0 FROM orders
        WHERE o_orderdate < TIMESTAMP '1990-01-01 00:00:00')"""


def _checks(spark, sf_dir):
    orders = A.table(spark, sf_dir, "orders")
    return Q.rows_check(
        {
            "events": A.table(spark, sf_dir, "events"),
            "orders": orders,
            "customers": A.table(spark, sf_dir, "customer"),
            "early_orders": orders.filter(F.col("o_orderdate") < "1990-01-01"),
        }
    )


@query(
    f"""WITH {_CHECKS} SELECT COUNT_IF(ok) AS passed, COUNT(*) AS total,
    bool_and(ok) AS complete FROM checks"""
)
def completeness(spark, sf_dir):
    return Q.completeness(_checks(spark, sf_dir))


@query(
    f"""WITH {_CHECKS} SELECT check_name,
    CASE WHEN ok THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status FROM checks"""
)
def completeness_status(spark, sf_dir):
    return Q.completeness_status(_checks(spark, sf_dir))


@query(
    f"""WITH {_CHECKS} SELECT COUNT_IF(ok) AS passed, COUNT(*) AS total,
    COUNT_IF(ok) / COUNT(*) AS score,
    CASE WHEN bool_and(ok) THEN 'quality_passed' ELSE 'quality_issues' END AS status FROM checks"""
)
def quality_report(spark, sf_dir):
    return Q.quality_report(_checks(spark, sf_dir))


@query(
    f"""WITH {_CHECKS} SELECT array_to_string(list_sort(list(check_name) FILTER (ok)), ',')
    AS present, bool_or(ok) AS ok FROM checks"""
)
def tables_present(spark, sf_dir):
    return Q.tables_present(_checks(spark, sf_dir))


@query(
    f"""WITH {sql.PANEL}, typed AS (SELECT country_code, indicator_id,
        TRY_CAST(year AS DOUBLE) AS year, value FROM panel)
    SELECT 'country_code' AS field, 'string' AS expected_type, 'string' AS actual_type,
        TRUE AS type_ok, COUNT_IF(country_code IS NULL) AS n_null, 0 AS n_outside FROM typed
    UNION ALL SELECT 'indicator_id', 'string', 'string', TRUE, COUNT_IF(indicator_id IS NULL),
        COUNT_IF(indicator_id NOT IN ('F', 'O')) FROM typed
    UNION ALL SELECT 'year', 'int', 'double', FALSE, COUNT_IF(year IS NULL),
        COUNT_IF(year NOT BETWEEN 2015 AND 2025) FROM typed
    UNION ALL SELECT 'value', 'double', 'double', TRUE, COUNT_IF(value IS NULL), 0 FROM typed"""
)
def schema_check(spark, sf_dir):
    rows = A.panel(spark, sf_dir).select(
        "country_code", "indicator_id", to_number(F.col("year")).alias("year"), "value"
    )
    expected = S.struct(country_code=S.STRING, indicator_id=S.STRING, year=S.INT, value=S.DOUBLE)
    return Q.schema_check(
        rows, expected, ranges={"year": (2015, 2025)}, domains={"indicator_id": ["F", "O"]}
    )


@query(
    f"""WITH {sql.LISTING} SELECT arg_max(path, (modification_time, path)) AS path,
    arg_max(prefix, (modification_time, path)) = 'click' AS ok FROM listing"""
)
def snapshot_name_check(spark, sf_dir):
    return Q.snapshot_name_check(A.listing(spark, sf_dir), "click")


@query(
    f"""WITH {sql.LISTING} SELECT strftime(MAX(modification_time), '%Y-%m-%d') AS newest_day,
    CAST(MAX(modification_time) AS DATE) = DATE '2024-01-30' AS ok FROM listing"""
)
def freshness(spark, sf_dir):
    checked = Q.freshness(A.listing(spark, sf_dir), F.to_date(F.lit("2024-01-30")))
    return checked.withColumn("newest_day", F.date_format("newest_day", "yyyy-MM-dd"))


@query(
    """SELECT 'events' AS layer, 3::BIGINT AS files, COUNT(*) > 0 AS ok FROM events
    UNION ALL SELECT 'orders', 1, COUNT(*) > 0 FROM orders UNION ALL SELECT 'absent', 0, FALSE"""
)
def volume_check(spark, sf_dir):
    root = scratch_path(spark, "volume")
    for name, files in (("events", 3), ("orders", 1)):
        rows = A.table(spark, sf_dir, name)
        if files > 1:
            rows = rows.repartition(files)
        # a single file is written from where the rows lie: its one task reads Parquet, not a shuffle of all rows
        write_table(rows, f"{root}/{name}", files=files)
    paths = {name: f"{root}/{name}" for name in ("events", "orders", "absent")}
    return Q.volume_check(spark, paths)
