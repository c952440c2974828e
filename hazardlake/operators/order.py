"""Sorting, top-k, paging and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlake import constants as K


def newest_first(df: DataFrame, ts: str = "timestamp", tie: str = "id") -> DataFrame:
    return df.orderBy(F.desc(ts), tie)


def sort_rows(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort by ``(column, "asc" | "desc")`` pairs."""
    return df.orderBy(*[F.desc(c) if way == "desc" else F.asc(c) for c, way in order])


def recent_events(
    df: DataFrame, n: int = K.RECENT_EVENTS, ts: str = "timestamp", tie: str = "id"
) -> DataFrame:
    return newest_first(df, ts, tie).limit(n)


def first_entities(
    df: DataFrame,
    n: int = K.FIRST_ENTITIES,
    code: str = "country_code",
    value: str = "value",
) -> DataFrame:
    """Rows with a value of the first ``n`` entities in code order.

    Both sides of the join start from the same filtered rows. When those are an aggregate,
    it is computed once and its exchange used twice.
    """
    rows = df.filter(F.col(code).isNotNull() & F.col(value).isNotNull())
    chosen = rows.select(code).distinct().orderBy(code).limit(n)
    # At most n rows, so the hint is safe at any input size.
    return rows.join(F.broadcast(chosen), code, "left_semi")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def page(
    df: DataFrame, order: Sequence[tuple[str, str]], number: int, size: int
) -> DataFrame:
    """Page ``number`` (from 0) of the sorted rows, for the first few pages.

    All rows before a page are kept on the way to it; further on, use ``page_after``.
    """
    return sort_rows(df, order).offset(number * size).limit(size)


def page_after(
    df: DataFrame, order: Sequence[tuple[str, str]], last: Mapping[str, object], size: int
) -> DataFrame:
    """The page behind the row with the key ``last``; no task keeps more than a page.

    The columns of ``order`` must tell rows apart. As in ``sort_rows``, nulls come first in
    ascending and last in descending order.
    """
    behind, equal = F.lit(False), F.lit(True)
    for name, direction in order:
        column, value = F.col(name), last[name]
        down = direction == "desc"
        if value is None:
            here, same = (F.lit(False) if down else column.isNotNull()), column.isNull()
        elif down:
            here, same = (column < F.lit(value)) | column.isNull(), column == F.lit(value)
        else:
            here, same = column > F.lit(value), column == F.lit(value)
        behind = behind | (equal & here)
        equal = equal & same
    return sort_rows(df.filter(F.coalesce(behind, F.lit(False))), order).limit(size)


def newest_per_prefix(
    files: DataFrame,
    n: int = K.SNAPSHOTS_KEPT,
    prefix: str = "prefix",
    mtime: str = "modification_time",
    path: str = "path",
) -> DataFrame:
    """The ``n`` newest files of each prefix; ties go to the smaller path.

    The rank filter limits every task to ``n`` rows per prefix before the shuffle.
    """
    newest = Window.partitionBy(prefix).orderBy(F.desc(mtime), path)
    ranked = files.select(prefix, path, mtime, F.row_number().over(newest).alias("rank"))
    return ranked.filter(F.col("rank") <= n)


def expired_snapshots(
    files: DataFrame,
    n: int = K.SNAPSHOTS_KEPT,
    prefix: str = "prefix",
    mtime: str = "modification_time",
    path: str = "path",
) -> DataFrame:
    """Everything but the ``n`` newest files of each prefix.

    A prefix with most of the files never meets in one task: only the kept files are
    ranked, the rest is what is not among them.
    """
    kept = newest_per_prefix(files, n, prefix, mtime, path).select(
        F.col(prefix).alias("_prefix"), F.col(path).alias("_path")
    )
    same = F.col(prefix).eqNullSafe(F.col("_prefix")) & F.col(path).eqNullSafe(F.col("_path"))
    return files.join(kept, same, "left_anti")


def expired_by_age(
    files: DataFrame, now, hours: int = K.RETENTION_HOURS, mtime: str = "modification_time"
) -> DataFrame:
    return files.filter(F.col(mtime) < now - F.expr(f"INTERVAL {int(hours)} HOURS"))
