"""Conversions: numbers, times, JSON and array access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from hazardlake.schemas import CORRUPT


def to_number(column: Column, source_type: DataType | None = None) -> Column:
    """Double, or null for text that is not a number.

    The JVM also reads ``1D``, ``2f`` and hex floats as numbers; those are codes here, so
    such text is unreadable. Pass ``source_type`` to skip that test on columns that are
    not text.
    """
    number = column.try_cast("double")
    if source_type is not None and not isinstance(source_type, StringType):
        return number
    return F.when(~column.cast("string").rlike(r"(?i)[0-9.][df]\s*$|x"), number)


def epoch_ms(milliseconds: Column) -> Column:
    return F.timestamp_millis(milliseconds)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def from_start(items: Column, index: int) -> Column:
    """Element counted from 0, null when the array is shorter."""
    return F.get(items, F.lit(index))


def from_end(items: Column, index: int = 1) -> Column:
    """Element counted back from the end (1 is the last), null when out of range."""
    return F.try_element_at(items, F.lit(-index))


def encode(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def decode(text: Column, schema: StructType | str) -> Column:
    """Parsed document; ``_corrupt_record`` keeps the text of what did not parse cleanly."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
