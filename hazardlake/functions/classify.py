"""Classification columns: ladders, bands, keyword classes and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake import constants as K


def ladder(
    value: Column,
    steps: Sequence[tuple[float, str]],
    top: str,
    missing: str | None = None,
    closed: bool = False,
) -> Column:
    """Label of the first step whose upper bound lies above the value.

    Bounds are exclusive, or inclusive when ``closed``. NaN sorts above every number, so
    it gets the top label. Nulls get ``missing``.
    """
    branch = F.when(value.isNull(), F.lit(missing))
    for bound, label in steps:
        branch = branch.when(value <= bound if closed else value < bound, F.lit(label))
    return branch.otherwise(F.lit(top))


def severity_level(magnitude: Column) -> Column:
    return ladder(magnitude, K.MAGNITUDE_STEPS, K.MAGNITUDE_TOP, K.UNKNOWN)


def latitude_band(lat: Column, lon: Column, zero_is_missing: bool = True) -> Column:
    """Latitude band of a position; missing and impossible positions are unknown.

    A coordinate of exactly zero counts as missing by default.
    """
    usable = [lat.isNotNull(), lon.isNotNull(), lat.between(-90, 90), lon.between(-180, 180)]
    if zero_is_missing:
        usable += [lat != 0, lon != 0]
    return (
        F.when(~F.coalesce(reduce(and_, usable), F.lit(False)), K.BAND_UNKNOWN)
        .when(lat > K.POLAR_LATITUDE, K.BAND_ARCTIC)
        .when(lat < -K.POLAR_LATITUDE, K.BAND_ANTARCTIC)
        .when(lat >= K.TROPIC_LATITUDE, K.BAND_NORTH)
        .when(lat >= -K.TROPIC_LATITUDE, K.BAND_TROPICAL)
        .otherwise(K.BAND_SOUTH)
    )


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when the lower-cased text contains one of the words; false for null."""
    lowered = F.lower(text)
    return F.coalesce(reduce(or_, [lowered.contains(w) for w in words]), F.lit(False))


def keyword_class(
    text: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = K.TITLE_SEVERITY,
    default: str = K.UNKNOWN,
) -> Column:
    """Label of the first rule with a word in the text."""
    branch: Any = F
    for label, words in rules:
        branch = branch.when(contains_any(text, words), label)
    return branch.otherwise(default)


def value_category(value: Column) -> Column:
    branch = F.when(value < 0, K.VALUE_NEGATIVE).when(value == 0, K.VALUE_ZERO)
    for bound, label in K.VALUE_STEPS:
        branch = branch.when(value < bound, label)
    return branch.otherwise(K.VALUE_TOP)


def year_category(year: Column) -> Column:
    return ladder(year, K.YEAR_STEPS, K.YEAR_TOP, missing=K.YEAR_TOP)


def quality_flag(value: Column, indicator: Column) -> Column:
    return (
        F.when(value.isNull(), K.FLAG_MISSING)
        .when(value < 0, K.FLAG_NEGATIVE)
        .when(indicator.isNull(), K.FLAG_NO_INDICATOR)
        .otherwise(K.FLAG_VALID)
    )


def is_complete(*columns: Column) -> Column:
    return reduce(and_, [c.isNotNull() for c in columns])


def is_missing(column: Column) -> Column:
    """Null or NaN."""
    return column.isNull() | F.isnan(column)


def style_lookup(key: Column, styles: Mapping[str, Any], default: Any) -> Column:
    """Value of a small fixed map, or the default; the map is a literal in the plan."""
    pairs = [F.lit(part) for item in styles.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def recency_class(age: Column) -> Column:
    """Colour by age in minutes, upper bounds inclusive."""
    return ladder(age, K.RECENCY_STEPS, K.RECENCY_TOP, missing=K.RECENCY_TOP, closed=True)
