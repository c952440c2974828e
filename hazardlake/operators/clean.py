"""Filters, guards and type normalisation."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StructType

from hazardlake import constants as K
from hazardlake.functions.classify import contains_any
from hazardlake.functions.convert import to_number


def missing_tests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """One null test per column, that also finds NaN in floating columns."""
    tests = []
    for name in columns:
        test = F.col(name).isNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            test = test | F.isnan(name)
        tests.append(test)
    return tests


def any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(or_, missing_tests(df, columns))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows that are null or NaN in any of the columns.

    One predicate per column, so that each goes down to the scan or the join side that
    holds its column; ``na.drop`` tests all columns in a single one that cannot.
    """
    return df.filter(reduce(and_, [~test for test in missing_tests(df, columns)]))


def require_position(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return drop_incomplete(df, [lat, lon])


def year_between(
    df: DataFrame, low: int = K.FIRST_YEAR, high: int = K.LAST_YEAR, column: str = "year"
) -> DataFrame:
    """Years inside the inclusive range, as integers; unreadable years are dropped.

    An integer column is compared as it is, so the range reaches the file scan.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, IntegralType):
        return df.filter(F.col(column).between(low, high)).withColumn(
            column, F.col(column).cast("int")
        )
    year = to_number(F.col(column), kind)
    # Distance from the middle instead of two bounds, so the text is parsed once.
    inside = F.abs(year - (low + high) / 2) <= (high - low) / 2
    return df.filter(inside).withColumn(column, year.cast("int"))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema in its order; values that do not fit the type become null."""
    columns = []
    for field in schema.fields:
        source = F.col(field.name)
        kind = df.schema[field.name].dataType
        if isinstance(field.dataType, NumericType) and not isinstance(kind, NumericType):
            number = to_number(source, kind)
            columns.append(number.try_cast(field.dataType).alias(field.name))
        else:
            columns.append(source.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def feed_window(
    df: DataFrame,
    end: Column,
    hours: int = K.FEED_HOURS,
    min_magnitude: float = K.FEED_MIN_MAGNITUDE,
    ts: str = "timestamp",
    magnitude: str = "magnitude",
) -> DataFrame:
    """Events of the trailing window up to ``end`` with at least the given magnitude."""
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.filter(F.col(ts).between(start, end) & (F.col(magnitude) >= min_magnitude))


def title_contains_any(
    df: DataFrame, column: str = "title", words: Sequence[str] = K.ERUPTION_WORDS
) -> DataFrame:
    return df.filter(contains_any(F.col(column), words))


def select_indicator(df: DataFrame, indicator: str) -> DataFrame:
    return df.filter(F.col("indicator_id") == indicator)


def select_entity(df: DataFrame, code: str | None) -> DataFrame:
    """Rows of one entity; ``ALL`` or nothing keeps everything."""
    if not code or code == K.ALL_CODE:
        return df
    return df.filter(F.col("country_code") == code.strip().upper())


def iso2_only(df: DataFrame, column: str = "country_code") -> DataFrame:
    """Trimmed upper-case codes of length two."""
    code = F.upper(F.trim(F.col(column)))
    return df.withColumn(column, code).filter(F.length(column) == 2)


def matches(name: Column, pattern: str) -> Column:
    """Case-insensitive pattern search; false for null."""
    return F.coalesce(name.rlike(f"(?i){pattern}"), F.lit(False))


def entity_kind(
    df: DataFrame,
    pattern: str = K.AGGREGATE_PATTERN,
    code: str = "country_code",
    name: str = "country_name",
) -> DataFrame:
    """``region`` for names like the pattern, ``country`` for other two-letter codes.

    Whatever is left belongs to neither list.
    """
    aggregate = matches(F.col(name), pattern)
    kind = (
        F.when(aggregate, "region").when(F.length(code) == 2, "country").otherwise("neither")
    )
    return df.withColumn("kind", kind)


def important_regions(
    df: DataFrame, pattern: str = K.IMPORTANT_PATTERN, name: str = "country_name"
) -> DataFrame:
    return df.filter((F.col("kind") == "region") & matches(F.col(name), pattern))


def highlight_flags(df: DataFrame) -> DataFrame:
    """Names of the table highlights that apply to a detail row."""
    rules = {
        "critical": F.col("severity_level") == "Critical",
        "high": F.col("severity_level") == "High",
        "strong": F.col("magnitude") >= K.HIGHLIGHT_MAGNITUDE,
        "tsunami": F.col("tsunami") == "Yes",
    }
    flags = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))
    return df.withColumn("highlights", flags)


def filter_rows(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.filter(predicate)


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str], empty: StructType) -> DataFrame:
    """The same DataFrame, or an empty one and a warning that names what is missing."""
    absent = missing_columns(df, columns)
    if not absent:
        return df
    warnings.warn(f"missing required columns: {', '.join(absent)}", stacklevel=2)
    return df.sparkSession.createDataFrame([], empty)


def select_with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Project the named columns; a literal default stands in for an absent column."""
    return df.select(
        *[
            F.col(name) if name in df.columns else F.lit(value).alias(name)
            for name, value in defaults.items()
        ]
    )
