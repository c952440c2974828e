"""Display columns: formatted times, rounded numbers, ages and text templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.functions.classify import is_missing


def fmt_ts(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts, pattern)


def round_display(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def round_exact(value: Column, digits: int) -> Column:
    """Nearest decimal to the exact binary value, half to even.

    Scaling rounds, and so can move a value onto a tie that it is not on (35.1235 is stored
    slightly below the tie). The value is therefore split in two parts whose products with
    the scale are exact. Their distance to the first guess, less one half, shows on which
    side of the tie the value lies; one half goes first, as the sum with it would round.
    NaN stays as it is, and so do numbers from 2**52 on, which have no fraction.
    """
    scale = float(10**digits)
    guess = F.rint(value * scale)
    spread = value * 134217729.0
    high = spread - (spread - value)
    main, rest = high * scale - guess, (value - high) * scale
    step = F.when((main - 0.5) + rest > 0, 1.0).when((main + 0.5) + rest < 0, -1.0)
    rounded = (guess + step.otherwise(0.0)) / scale
    return F.when(F.abs(value) < float(2**52), rounded).otherwise(value)


def age_minutes(ts: Column, now: Column) -> Column:
    return (F.unix_millis(now) - F.unix_millis(ts)) / F.lit(60000.0)


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, "Yes").otherwise("No")


def title_case(text: Column) -> Column:
    """A capital after everything that is no letter, small letters elsewhere.

    ``initcap`` knows white space only; a mark before each letter run makes it see all.
    """
    words = F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(words, F.initcap), "")


def fixed(value: Column, digits: int) -> Column:
    """Number with a fixed count of decimals as text, ``nan`` when missing."""
    text = F.format_string(f"%.{digits}f", round_exact(value, digits))
    return F.when(is_missing(value), "nan").otherwise(text)


def _shown(text: Column) -> Column:
    return F.coalesce(text, F.lit("None"))


def quake_label(
    magnitude: Column, place: Column, ts: Column, severity: Column, age: Column
) -> Column:
    return F.concat(
        F.lit("M"),
        fixed(magnitude, 1),
        F.lit(" - "),
        _shown(place),
        F.lit("<br>Time: "),
        _shown(fmt_ts(ts, "HH:mm:ss")),
        F.lit("<br>Severity: "),
        _shown(severity),
        F.lit("<br>Age: "),
        fixed(age, 0),
        F.lit(" min ago"),
    )


def volcano_label(title: Column, date: Column, lat: Column, lon: Column) -> Column:
    return F.concat(
        F.lit("Volcano: "),
        _shown(title),
        F.lit("<br>Date: "),
        _shown(date),
        F.lit("<br>Location: "),
        fixed(lat, 2),
        F.lit(", "),
        fixed(lon, 2),
    )


def region_label(name: Column) -> Column:
    return F.concat(name, F.lit(K.REGION_SUFFIX))


def series_title(indicator: Column, entity: Column | None = None) -> Column:
    span = f"({K.FIRST_YEAR}-{K.LAST_YEAR})"
    if entity is None:
        tail = F.lit(f" - {K.ALL_LABEL} {span} - Click legend to filter")
        return F.concat(F.lit(" "), indicator, tail)
    return F.concat(F.lit(" "), indicator, F.lit(" - "), entity, F.lit(f" {span}"))


# Snapshots are named <kind>_<yyyymmdd>_<hhmmss>. Folders above may have such
# names too, so only the last part of a path that is a snapshot counts: one that ends in .json.
SNAPSHOT_NAME = r"(?:^|/)([A-Za-z]+)_(\d{8}_\d{6})[^/]*\.json(?:/[^/]*)?$"


def snapshot_kind(path: Column) -> Column:
    """Kind part of a snapshot path, empty when there is none."""
    return F.regexp_extract(path, SNAPSHOT_NAME, 1)


def snapshot_time(path: Column) -> Column:
    stamp = F.regexp_extract(path, SNAPSHOT_NAME, 2)
    return F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss"))
