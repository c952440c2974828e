"""Data quality checks; every check is a row, every report an aggregate of such rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardlake.functions.display import snapshot_kind, snapshot_time
from hazardlake.sources.tables import list_files

# Overall status of a report.
PASSED = "quality_passed"
ISSUES = "quality_issues"


def volume_check(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """Number of files of each layer; a layer passes with at least one."""
    rows = []
    for layer, path in layers.items():
        counted = list_files(spark, path).agg(F.count(F.lit(1)).alias("files"))
        rows.append(counted.select(F.lit(layer).alias("layer"), "files"))
    return reduce(DataFrame.unionByName, rows).withColumn("ok", F.col("files") > 0)


def rows_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One check per table: does it have rows."""
    rows = [
        df.agg((F.count(F.lit(1)) > 0).alias("ok")).select(F.lit(name).alias("check_name"), "ok")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def snapshot_name_check(files: DataFrame, kind: str) -> DataFrame:
    """Newest file and whether its name is a snapshot of the expected kind."""
    newest = files.agg(F.max(F.struct("modification_time", "path")).alias("newest"))
    path = F.col("newest.path")
    return newest.select(
        path.alias("path"), F.coalesce(snapshot_kind(path) == kind, F.lit(False)).alias("ok")
    )


def freshness(files: DataFrame, today: Column) -> DataFrame:
    """Day of the newest snapshot by name and whether that is today."""
    newest = files.agg(F.to_date(F.max(snapshot_time(F.col("path")))).alias("newest_day"))
    return newest.withColumn("ok", F.coalesce(F.col("newest_day") == today, F.lit(False)))


def completeness_status(checks: DataFrame) -> DataFrame:
    status = F.when(F.col("ok"), "COMPLETE").otherwise("INCOMPLETE")
    return checks.select("check_name", status.alias("status"))


def completeness(checks: DataFrame) -> DataFrame:
    """Passed and total checks, and whether all of them passed."""
    return checks.agg(
        F.count_if("ok").alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.bool_and(F.coalesce("ok", F.lit(False))), F.lit(True)).alias("complete"),
    )


def quality_report(checks: DataFrame, passed: str = PASSED, issues: str = ISSUES) -> DataFrame:
    """Score (share of passed checks) and overall status."""
    counts = completeness(checks)
    return counts.select(
        "passed",
        "total",
        (F.col("passed") / F.nullif(F.col("total"), F.lit(0))).alias("score"),
        F.when(F.col("complete"), passed).otherwise(issues).alias("status"),
    )


def tables_present(checks: DataFrame) -> DataFrame:
    """Names of the tables that are there, and whether there is any."""
    return checks.agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("ok"), F.col("check_name")))), ",").alias(
            "present"
        ),
        F.coalesce(F.bool_or("ok"), F.lit(False)).alias("ok"),
    )


def schema_check(
    df: DataFrame,
    schema: StructType,
    ranges: Mapping[str, tuple[Any, Any]] | None = None,
    domains: Mapping[str, Sequence[Any]] | None = None,
) -> DataFrame:
    """One row per expected field: types, nulls, and values outside a range or domain.

    The types are compared when the plan is built; all counts come from one aggregate.
    """
    ranges, domains = ranges or {}, domains or {}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    zero = F.lit(0).cast("bigint")
    counts, rows = [F.count(F.lit(1)).alias("_all")], []
    for i, field in enumerate(schema.fields):
        name, present = field.name, field.name in actual
        nulls, outside = zero, zero
        if present:
            counts.append(F.count_if(F.col(name).isNull()).alias(f"_nulls{i}"))
            nulls = F.col(f"_nulls{i}")
            tests = []
            if name in ranges:
                tests.append(~F.col(name).between(*ranges[name]))
            if name in domains:
                tests.append(~F.col(name).isin(*domains[name]))
            if tests:
                test = reduce(lambda a, b: a | b, tests)
                counts.append(F.count_if(test).alias(f"_outside{i}"))
                outside = F.col(f"_outside{i}")
        expected = field.dataType.simpleString()
        rows.append(
            F.struct(
                F.lit(name).alias("field"),
                F.lit(expected).alias("expected_type"),
                F.lit(actual.get(name)).cast("string").alias("actual_type"),
                F.lit(actual.get(name) == expected).alias("type_ok"),
                nulls.alias("n_null"),
                outside.alias("n_outside"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def flag_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("data_quality_flag", "is_complete").agg(
        F.count(F.lit(1)).alias("n_records")
    )
