"""Aggregations. Every one of them combines inside the map tasks before it shuffles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

GROUP = ("region", "severity_level")
TITLES_PER_ROW = 10_000
#: Copies of a group's total that its titles are spread over.
SALTS = 64


def mean(column: str | Column, exact_scale: int | None = None) -> Column:
    """Average; with ``exact_scale`` independent of the order of summation.

    The exact form sums integers of ``column * 10**exact_scale``, so it only suits columns
    with at most that many decimals.
    """
    value = F.col(column) if isinstance(column, str) else column
    if exact_scale is None:
        return F.avg(value)
    scale = float(10**exact_scale)
    total = F.sum(F.rint(value * scale).try_cast("bigint")).cast("double")
    # NaN and infinite values give what F.avg gives
    odd = F.sum(F.when(~(F.abs(value) < float("inf")), value))
    return F.coalesce(odd, total / scale / F.nullif(F.count(value), F.lit(0)))


def event_stats(
    df: DataFrame,
    keys: Sequence[str] = GROUP,
    measure: str = "magnitude",
    depth: str = "depth",
    flag: str = "tsunami",
    exact_scale: int | None = None,
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("earthquake_count"),
        mean(measure, exact_scale).alias("avg_magnitude"),
        F.max(measure).alias("max_magnitude"),
        F.min(measure).alias("min_magnitude"),
        mean(depth, exact_scale).alias("avg_depth"),
        F.sum(F.when(F.col(flag) == 1, 1).otherwise(0)).alias("tsunami_count"),
    )


#: Columns of ``event_parts`` besides the keys, and how two rows of one group make one.
EVENT_PARTS = {
    "events": F.sum,
    "measure_sum": F.sum,
    "measure_odd": F.sum,
    "measure_count": F.sum,
    "measure_max": F.max,
    "measure_min": F.min,
    "depth_sum": F.sum,
    "depth_odd": F.sum,
    "depth_count": F.sum,
    "flags": F.sum,
    "scale": F.max,
}


def event_parts(
    df: DataFrame,
    keys: Sequence[str] = GROUP,
    measure: str = "magnitude",
    depth: str = "depth",
    flag: str = "tsunami",
    exact_scale: int | None = None,
) -> DataFrame:
    """What ``event_stats`` can be put together from, for rows that come in several portions.

    Parts of different portions merge with ``merge_event_parts`` in any order and grouping. With
    ``exact_scale`` sums are integers of ``column * 10**exact_scale``, as in ``mean``.
    """
    scale = float(10**exact_scale) if exact_scale is not None else 1.0

    def sums(column: str, name: str) -> list[Column]:
        value = F.col(column).cast("double")
        odd = ~(F.abs(value) < float("inf"))
        whole = F.rint(value * scale).try_cast("bigint") if exact_scale is not None else value
        return [
            F.sum(F.when(~odd, whole)).alias(f"{name}_sum"),
            F.sum(F.when(odd, value)).alias(f"{name}_odd"),
            F.count(value).alias(f"{name}_count"),
        ]

    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        *sums(measure, "measure"),
        F.max(measure).alias("measure_max"),
        F.min(measure).alias("measure_min"),
        *sums(depth, "depth"),
        F.sum(F.when(F.col(flag) == 1, 1).otherwise(0)).alias("flags"),
        F.lit(scale).alias("scale"),
    )


def merge_event_parts(parts: DataFrame, keys: Sequence[str] = GROUP, *more: Column) -> DataFrame:
    """``event_stats`` of all rows behind the parts; ``more`` are further aggregates of theirs."""
    merged = parts.groupBy(*keys).agg(*[how(c).alias(c) for c, how in EVENT_PARTS.items()], *more)

    def average(name: str) -> Column:
        count = F.nullif(F.col(f"{name}_count"), F.lit(0))
        return F.coalesce(f"{name}_odd", F.col(f"{name}_sum").cast("double") / F.col("scale") / count)

    given = [*keys, *EVENT_PARTS]
    return merged.select(
        *keys,
        F.col("events").alias("earthquake_count"),
        average("measure").alias("avg_magnitude"),
        F.col("measure_max").alias("max_magnitude"),
        F.col("measure_min").alias("min_magnitude"),
        average("depth").alias("avg_depth"),
        F.col("flags").alias("tsunami_count"),
        *[c for c in merged.columns if c not in given],
    )


def document_titles(df: DataFrame, keys: Sequence[str], title: str = "title") -> DataFrame:
    """Count and sorted titles per group, for keys that include the source document.

    Such a group came out of one document, so its list is no larger than that document.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("volcano_count"),
        F.sort_array(F.collect_list(title)).alias("volcano_titles"),
    )


def count_titles(
    df: DataFrame, keys: Sequence[str] = GROUP, title: str = "title"
) -> DataFrame:
    """Copies per group and title, the part of a title list that can run incrementally."""
    return df.groupBy(*keys, title).agg(F.count(F.lit(1)).alias("copies"))


def pack_titles(
    counted: DataFrame,
    keys: Sequence[str] = GROUP,
    title: str = "title",
    per_row: int = TITLES_PER_ROW,
) -> DataFrame:
    """Title lists out of title counts, split into rows of about ``per_row`` titles.

    ``volcano_count`` is the count of the whole group on each of its rows, ``part_count`` that of
    the row. A group that fits gives one row with ``part`` 0. A larger one is dealt out by
    title hash over as many parts as it needs, and a title with more copies than fit into a
    row is cut into pieces first, so no row or task ever holds a whole hot group: the titles
    meet the total of their group at one of ``SALTS`` copies of it.
    """
    size = F.lit(int(per_row)).cast("bigint")
    totals = (
        counted.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .agg(F.sum("copies").alias("_count"))
        .withColumn("_parts", F.ceil(F.col("_count") / size))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    last_piece = F.expr(f"(copies - 1) div {int(per_row)}")
    pieces = counted.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece))
    ).withColumn("copies", F.least(size, F.col("copies") - F.col("_piece") * size))
    digest = F.md5(F.concat_ws("#", F.coalesce(title, F.lit("")), F.col("_piece").cast("string")))
    slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    salt = F.pmod(F.xxhash64(title, "_piece"), F.lit(SALTS)).cast("int")
    same_group = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    repeated = F.array_repeat(F.col(title), F.col("copies").cast("int"))
    dealt = pieces.withColumn("_at", salt).join(totals, same_group & (F.col("_at") == F.col("_salt"))).select(
        *keys,
        (slot % F.col("_parts")).alias("part"),
        "_count",
        "copies",
        F.when(F.col(title).isNotNull(), repeated).alias("_titles"),
    )
    return dealt.groupBy(*keys, "part").agg(
        F.max("_count").alias("volcano_count"),
        F.sum("copies").alias("part_count"),
        F.sort_array(F.flatten(F.collect_list("_titles"))).alias("volcano_titles"),
    )


def event_titles(
    df: DataFrame,
    keys: Sequence[str] = GROUP,
    title: str = "title",
    per_row: int = TITLES_PER_ROW,
) -> DataFrame:
    """Event count and title list per group; see ``pack_titles`` for large groups."""
    return pack_titles(count_titles(df, keys, title), keys, title, per_row)


def entity_year_mean(df: DataFrame, exact_scale: int | None = None) -> DataFrame:
    return df.groupBy("country_code", "year").agg(mean("value", exact_scale).alias("value"))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each layer, for layers that are stored; see ``observed_counts`` for chained ones."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("layer"), "records")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def observed_counts(
    source: DataFrame, steps: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """Rows of the source (``raw``) and behind each step, counted in one pass.

    Each layer is observed on the way to the next one, so chained layers are not computed
    again for each count.
    """
    seen, rows = {}, source
    for name, step in {"raw": lambda df: df, **steps}.items():
        seen[name] = Observation(name)
        rows = step(rows).observe(seen[name], F.count(F.lit(1)).alias("records"))
    rows.write.format("noop").mode("overwrite").save()
    counts = [(name, seen[name].get["records"]) for name in seen]
    return source.sparkSession.createDataFrame(counts, "layer STRING, records BIGINT")


def profile(
    df: DataFrame,
    entity: str = "country_name",
    indicator: str = "indicator_name",
    year: str = "year",
) -> DataFrame:
    """Rows, columns, distinct entities and indicators, first and last year.

    The rows are first reduced to one per entity, indicator and year, so the distinct
    counts run over that small table instead of expanding every row.
    """
    cells = df.groupBy(entity, indicator, year).agg(F.count(F.lit(1)).alias("_rows"))
    return cells.agg(
        F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_distinct(entity).alias("n_entities"),
        F.count_distinct(indicator).alias("n_indicators"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
    )


#: Log of the number of registers of distinct-count sketches: errors of about 1.6 % (one deviation).
SKETCH_REGISTERS = 12


def profile_sketch(
    df: DataFrame,
    keys: Sequence[str] = (),
    entity: str = "country_name",
    indicator: str = "indicator_name",
    year: str = "year",
    registers: int = SKETCH_REGISTERS,
) -> DataFrame:
    """A profile that can be stored and merged with others: a few kilobytes for any number of rows.

    Like ``profile``, with distinct-count sketches in place of the distinct counts, one row for each
    group of ``keys``.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.hll_sketch_agg(F.col(entity).cast("string"), registers).alias("entities"),
        F.hll_sketch_agg(F.col(indicator).cast("string"), registers).alias("indicators"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
    )


def merge_profiles(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profiles out of stored sketches of parts; parts may overlap in entities and indicators.

    Distinct counts are estimates of the same error however the rows were divided.
    """
    return sketches.groupBy(*keys).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.max("n_columns").alias("n_columns"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("entities")), F.lit(0).cast("bigint")).alias("n_entities"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("indicators")), F.lit(0).cast("bigint")).alias("n_indicators"),
        F.min("first_year").alias("first_year"),
        F.max("last_year").alias("last_year"),
    )


def batch_sizes(df: DataFrame, key: str, items: str) -> DataFrame:
    """Number of features in each message; zero where there are none."""
    size = F.when(F.col(items).isNotNull(), F.size(items)).otherwise(F.lit(0))
    return df.select(key, size.alias("n_items"))
