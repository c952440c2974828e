from __future__ import annotations

import random
import warnings
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake import schemas as S
from hazardlake.operators import aggregate as G
from hazardlake.operators import clean as R
from hazardlake.operators import lookup as J
from hazardlake.operators import order as O
from hazardlake.operators import project as P
from hazardlake.plans import batch, series, views

NAN = float("nan")


def values(df, column):
    return [r[column] for r in df.collect()]


# --- filters ---------------------------------------------------------------------------
def test_drop_incomplete_drops_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (NAN, "a"), (2.0, None)], "v double, c string")
    assert values(R.drop_incomplete(df, ["v", "c"]), "v") == [1.0]


def test_year_between_text(spark):
    years = ["2014", "2015", "2025", "2026", "n/a", None, "2020D"]
    df = spark.createDataFrame([(y,) for y in years], "year string")
    got = R.year_between(df)
    assert values(got, "year") == [2015, 2025]
    assert got.schema["year"].dataType == S.INT


def test_year_range_is_pushed_to_the_scan(spark, folder):
    spark.createDataFrame([(2014, 1.0), (2020, 2.0)], "year int, v double").write.parquet(f"{folder}/t")
    plan = R.year_between(spark.read.parquet(f"{folder}/t"))._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(year,2015)" in plan.toString()


def test_title_words(spark):
    titles = ["Etna Eruption", "volcanic ash", "VOLCANO x", "Lava flow", None]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    assert values(R.title_contains_any(df), "title") == titles[:3]


def test_entity_filters(spark):
    df = spark.createDataFrame([(" us ",), ("WLD",), ("jp",), (None,)], "country_code string")
    codes = R.iso2_only(df)
    assert sorted(values(codes, "country_code")) == ["JP", "US"]
    assert values(R.select_entity(codes, "jp "), "country_code") == ["JP"]
    assert R.select_entity(codes, "ALL").count() == R.select_entity(codes, None).count() == 2


def test_entity_kind_keeps_the_pattern_quirks(spark):
    rows = [
        ("JP", "Japan", "country"), ("US", "United States", "region"),
        ("ZA", "South Africa", "region"), ("1W", "World", "region"), ("XYZ", "Foo", "neither"),
    ]
    df = spark.createDataFrame(rows, "country_code string, country_name string, want string")
    assert all(r.kind == r.want for r in R.entity_kind(df).collect())


def test_feed_window_is_inclusive(spark):
    rows = [("2024-01-01 00:00:00", 2.5), ("2023-12-31 23:59:59", 5.0), ("2024-01-02 00:00:00", 2.4)]
    df = spark.createDataFrame(rows, "t string, magnitude double")
    df = df.withColumn("timestamp", F.to_timestamp("t"))
    end = F.to_timestamp(F.lit("2024-01-02 00:00:00"))
    assert values(R.feed_window(df, end), "magnitude") == [2.5]


def test_required_columns(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert R.require_columns(df, ["x"], S.INDICATOR_GOLD) is df
    with pytest.warns(UserWarning, match="y, z"):
        empty = R.require_columns(df, ["x", "y", "z"], S.INDICATOR_GOLD)
    assert empty.count() == 0 and empty.schema == S.INDICATOR_GOLD


def test_defaults_for_absent_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    row = R.select_with_defaults(df, {"a": None, "b": "N/A", "c": 0}).first()
    assert tuple(row) == (1, "N/A", 0)


def test_conform_keeps_real_nulls(spark):
    columns = ", ".join(f"{f.name} string" for f in S.INDICATOR_RAW)
    row = ["A", None, "I", "n", "c", "2020", "1.5", "", "", "0", "d", "s"]
    bad = ["A", None, "I", "n", "c", "20x", "1D", "", "", "z", "d", "s"]
    got = R.conform(spark.createDataFrame([row, bad], columns), S.INDICATOR_RAW)
    assert got.schema == S.INDICATOR_RAW
    first, second = got.collect()
    assert (first.year, first.value, first.decimal, first.country_name) == (2020, 1.5, 0, None)
    assert (second.year, second.value, second.decimal) == (None, None, None)


def test_highlights(spark):
    rows = [("Critical", 5.0, "Yes"), ("High", 4.9, "No"), ("Minor", None, "No")]
    df = spark.createDataFrame(rows, "severity_level string, magnitude double, tsunami string")
    got = values(R.highlight_flags(df), "highlights")
    assert got == [["critical", "strong", "tsunami"], ["high"], []]


def test_any_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, "a"), (1.0, None)], "v double, c string")
    assert df.filter(R.any_missing(df, ["v", "c"])).count() == 2


# --- aggregates ------------------------------------------------------------------------
def quake_rows(spark, n=500, seed=3):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["Arctic", "Tropical", "Unknown"]),
            "micro" if rng.random() < 0.8 else "great",
            None if rng.random() < 0.1 else rng.randrange(0, 900) / 100,
            float(rng.randrange(0, 700)),
            rng.choice([0, 1, None]),
        )
        for _ in range(n)
    ]
    schema = "region string, severity_level string, magnitude double, depth double, tsunami int"
    return rows, spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("exact", [None, 2])
def test_event_stats_against_plain_python(spark, exact):
    rows, df = quake_rows(spark)
    got = {(r.region, r.severity_level): r for r in G.event_stats(df, exact_scale=exact).collect()}
    assert sum(r.earthquake_count for r in got.values()) == len(rows)
    for key, stats in got.items():
        group = [r for r in rows if r[:2] == key]
        magnitudes = [r[2] for r in group if r[2] is not None]
        assert stats.earthquake_count == len(group)
        assert stats.avg_magnitude == pytest.approx(sum(magnitudes) / len(magnitudes))
        assert (stats.max_magnitude, stats.min_magnitude) == (max(magnitudes), min(magnitudes))
        assert stats.avg_depth == pytest.approx(sum(r[3] for r in group) / len(group))
        assert stats.tsunami_count == sum(r[4] == 1 for r in group)


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(G.mean("v", 2).alias("m"), G.mean("v").alias("n")).first() == (None, None)


@pytest.mark.parametrize("per_row", [1, 3, 10, 1000])
def test_title_lists_stay_whole_when_split(spark, per_row):
    """A third of the rows are copies of one title in one group; some titles are null."""
    rng = random.Random(5)
    rows = [("A", "x", "hot")] * 120 + [("A", "x", None)] * 7
    rows += [(rng.choice("AB"), rng.choice("xy"), f"t{rng.randrange(40)}") for _ in range(240)]
    rows += [(None, "x", "lost")]
    df = spark.createDataFrame(rows, "region string, severity_level string, title string")
    got = G.event_titles(df, per_row=per_row).collect()
    count, titles, whole = Counter(), Counter(), defaultdict(set)
    for r in got:
        count[r.region, r.severity_level] += r.part_count
        whole[r.region, r.severity_level].add(r.volcano_count)
        titles.update((r.region, r.severity_level, t) for t in r.volcano_titles or [])
    assert count == Counter((r[0], r[1]) for r in rows)
    # every part of a group carries the count of the group
    assert whole == {k: {n} for k, n in count.items()}
    assert titles == Counter(r for r in rows if r[2] is not None)
    if per_row == 1000:
        assert len(got) == len(count) and all(r.part == 0 for r in got)
    if per_row == 10:
        assert max(len(r.volcano_titles) for r in got) < 100


def test_document_titles(spark):
    df = spark.createDataFrame([("d", "b"), ("d", "a"), ("d", None)], "k string, title string")
    row = G.document_titles(df, ["k"]).first()
    assert (row.volcano_count, row.volcano_titles) == (3, ["a", "b"])


def test_profile_and_counts(spark):
    rows = [("A", "i", 2015), ("A", "j", 2016), ("B", "i", 2015), ("B", None, 2020)]
    df = spark.createDataFrame(rows, "country_name string, indicator_name string, year int")
    assert tuple(G.profile(df).first()) == (4, 3, 2, 2, 2015, 2020)
    assert tuple(G.profile(df.limit(0)).first()) == (0, 3, 0, 0, None, None)
    counts = {r.layer: r.records for r in G.layer_counts({"a": df, "b": df.limit(1)}).collect()}
    assert counts == {"a": 4, "b": 1}


# --- lookups ---------------------------------------------------------------------------
def test_lookup_falls_back_to_the_key(spark):
    df = spark.createDataFrame([("MX",), ("XX",), (None,)], "code string")
    dim = spark.createDataFrame([("MX", "Mexico")], "code string, name string")
    assert set(values(J.lookup(df, dim, "code", "name"), "name")) == {"Mexico", "XX", None}
    assert set(values(J.lookup(df, dim, "code", "name", F.lit("?")), "name")) == {"Mexico", "?"}
    back = J.lookup(dim.select("name"), dim, "name", "code")
    assert values(back, "code") == ["MX"]


def test_directories(spark):
    rows = [
        ("i1", "One", 1.0, "JP", "Japan"), ("i1", "One", 2.0, "1W", "World"),
        ("i2", "Two", None, "US", "United States"), ("i3", "Three", 1.0, None, "Nowhere"),
    ]
    df = spark.createDataFrame(
        rows,
        "indicator_id string, indicator_name string, value double, country_code string,"
        " country_name string",
    )
    got = [(r.indicator_id, r.n_values) for r in J.indicator_directory(df).collect()]
    assert got == [("i1", 2), ("i3", 1)]
    listed = [tuple(r) for r in J.entity_directory(df).collect()]
    assert listed == [("All Countries", "ALL"), ("Japan", "JP"), ("World (Region)", "1W")]


def test_request_plan_and_missing_entities(spark):
    entities = spark.createDataFrame([(c,) for c in K.ENTITIES], "country_code string")
    plan = J.request_plan(entities, list(K.INDICATOR_LABELS))
    assert plan.distinct().count() == 40
    data = spark.createDataFrame([("MX",)] * 5 + [("JP",), (None,)], "country_code string")
    left = J.without_data(entities, data, "country_code")
    assert set(values(left, "country_code")) == set(K.ENTITIES) - {"MX", "JP"}


# --- order -----------------------------------------------------------------------------
def test_expired_snapshots(spark):
    rows = [("a", f"a{i}", i) for i in range(7)] + [("b", f"b{i}", i) for i in range(3)]
    rows += [("c", f"c{i}", 0) for i in range(6)]
    df = spark.createDataFrame(rows, "prefix string, path string, s bigint")
    files = df.withColumn("modification_time", F.timestamp_seconds("s"))
    assert sorted(values(O.expired_snapshots(files), "path")) == ["a0", "a1", "c5"]


def test_expired_by_age(spark):
    df = spark.createDataFrame([("old", "2024-01-01"), ("new", "2024-01-09")], "path string, d string")
    files = df.withColumn("modification_time", F.to_timestamp("d"))
    now = F.to_timestamp(F.lit("2024-01-10"))
    assert values(O.expired_by_age(files, now), "path") == ["old"]


def test_page_and_sort(spark):
    df = spark.range(50).withColumn("m", F.col("id") % 5)
    order = [("m", "desc"), ("id", "asc")]
    everything = values(O.sort_rows(df, order), "id")
    pages = [i for n in range(5) for i in values(O.page(df, order, n, 10), "id")]
    assert pages == everything


def test_first_entities(spark):
    rows = [("C", 1.0), ("A", 1.0), ("A", 2.0), ("B", None), ("D", 1.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "country_code string, value double")
    assert sorted(values(O.first_entities(df, 2), "country_code")) == ["A", "A", "C"]


# --- plans -----------------------------------------------------------------------------
def raw_panel(spark):
    rows = [
        ("MX", "Mexico", "I", "Ind", "2015", "1"), ("MX", "Mexico", "I", "Ind", "2015", "3"),
        ("US", "United States", "I", "Ind", "2018", "-5"), ("1WD", "World", "I", "Ind", "2018", "7"),
        ("MX", "Mexico", "I", "Ind", "2030", "1"), ("MX", "Mexico", "J", "Other", "2020", "x"),
    ]
    df = spark.createDataFrame(
        rows,
        "country_code string, country_name string, indicator_id string, indicator_name string,"
        " year string, value string",
    )
    rest = {
        c: F.lit("0" if c == "decimal" else "-")
        for c in S.INDICATOR_RAW.fieldNames()
        if c not in df.columns
    }
    return df.withColumns(rest)


def test_layers_have_the_documented_columns(spark):
    bronze = batch.bronze(raw_panel(spark))
    assert bronze.schema.fieldNames() == S.INDICATOR_BRONZE.fieldNames()
    silver = batch.silver(bronze)
    assert set(silver.columns) == set(S.INDICATOR_SILVER.fieldNames())
    assert values(silver.select("layer").distinct(), "layer") == ["silver"]
    gold = batch.gold(silver)
    assert gold.schema.fieldNames() == S.INDICATOR_GOLD.fieldNames()
    row = gold.filter("country_code = 'US'").first()
    assert (row.data_quality_flag, row.value_category, row.year_category, row.layer) == (
        "Negative Value", "Negative", "Mid Period", "silver",
    )
    assert gold.count() == 4


def test_gold_without_a_required_column_is_empty(spark):
    silver = batch.silver(batch.bronze(raw_panel(spark))).drop("country_name")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert batch.gold(silver).count() == 0
    assert "country_name" in str(caught[0].message)


def test_run_batch(spark, folder):
    paths = {layer: f"{folder}/{layer}" for layer in ("bronze", "silver", "gold")}
    counts = batch.run_batch(spark, raw_panel(spark), paths, {"gold": f"{folder}/csv"})
    assert {r.layer: r.records for r in counts.collect()} == dict.fromkeys(paths, 4)
    assert spark.read.option("header", True).csv(f"{folder}/csv").count() == 4


def test_indicator_series(spark):
    got = [tuple(r) for r in series.indicator_series(raw_panel(spark), "I").collect()]
    title = " Ind - All Countries (2015-2025) - Click legend to filter"
    assert got == [
        ("MX", "Mexico", 2015, 2.0, title),
        ("MX", "Mexico", 2030, 1.0, title),
        ("US", "United States", 2018, -5.0, title),
    ]
    one = series.indicator_series(raw_panel(spark), "I", " us").collect()
    assert [(r.country_code, r.title) for r in one] == [
        ("US", " Ind - United States (2015-2025)")
    ]
    assert series.indicator_series(raw_panel(spark), "none").count() == 0


def test_metadata_columns(spark):
    df = spark.createDataFrame([(1, "bronze")], "a int, layer string")
    now = F.to_timestamp(F.lit("2024-01-01"))
    row = P.add_processing_meta(df, now=now).first()
    assert (row.layer, row.processing_version) == ("silver", "1.0")
    row = P.add_analytics_meta(df, "volcano", now=now).first()
    assert (row.layer, row.analytics_version, row.data_type) == ("gold", "1.0", "volcano")
    row = P.add_ingest_meta(df, now=now).first()
    assert (row.layer, row.data_source) == ("bronze", "world_bank_api")


def test_map_and_detail_frames(spark):
    rows = [(f"{i}", i * 60_000, 4.35, "P", 35.1235, 1.0, 1.25, 1) for i in range(30)]
    rows.append(("late", 40 * 60_000, 1.0, "Q", None, 1.0, 2.0, 0))
    df = spark.createDataFrame(
        rows,
        "id string, ms bigint, magnitude double, place string, latitude double,"
        " longitude double, depth double, tsunami int",
    ).withColumn("timestamp", F.timestamp_millis("ms"))
    volcanoes = spark.createDataFrame(
        [("V", 1.0, 2.0, "d"), ("W", None, 2.0, "d")],
        "title string, latitude double, longitude double, date string",
    )
    now = F.timestamp_millis(F.lit(40 * 60_000))
    markers = views.map_features(df, volcanoes, now).collect()
    quakes = [m for m in markers if m.kind == "quake"]
    assert len(quakes) == 19 and len(markers) == 20
    assert {m.size for m in quakes} == {12}
    assert {m.colour for m in quakes} == {"#ff6600"}
    first = views.detail_table(df).first()
    assert (first.severity_level, first.region, first.alert, first.significance) == (
        "Unknown", "Unknown", "None", "N/A",
    )
    second = views.detail_table(df).collect()[1]
    assert (second.timestamp, second.magnitude, second.latitude, second.depth, second.tsunami) == (
        "1970-01-01 00:29:00", 4.4, 35.123, 1.2, "Yes",
    )


def test_titles_meet_their_totals_in_many_tasks(spark):
    """No shuffle on region and severity alone carries the titles."""
    rows = [("A", "x", f"t{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "region string, severity_level string, title string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.event_titles(df, per_row=5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 1 and "_at" in joins[0] and "_salt" in joins[0]


def test_exact_mean_of_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("n", nan), ("n", 1.0), ("i", inf), ("i", 2.0), ("m", -inf), ("p", 1.25), ("p", 2.5), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.plain, r.exact) for r in df.groupBy("k").agg(G.mean("v").alias("plain"), G.mean("v", 2).alias("exact")).collect()}
    assert {k: str(a) for k, (a, _) in got.items()} == {k: str(b) for k, (_, b) in got.items()}


def test_pages_after_a_key(spark):
    values = [3.0, None, 1.0, 3.0, 2.0, None, 1.0, 5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    for order in ([("v", "desc"), ("id", "asc")], [("v", "asc"), ("id", "desc")]):
        whole = O.sort_rows(df, order).collect()
        page, seen = O.page(df, order, 0, 3).collect(), []
        while page:
            seen += page
            page = O.page_after(df, order, page[-1].asDict(), 3).collect()
        assert seen == whole


def test_retention_of_files_without_a_prefix(spark):
    import datetime as dt

    rows = [(None, f"f{i}", dt.datetime(2024, 1, i)) for i in range(1, 9)]
    files = spark.createDataFrame(rows, "prefix string, path string, modification_time timestamp")
    assert sorted(r.path for r in O.expired_snapshots(files).collect()) == ["f1", "f2", "f3"]


def test_counts_of_chained_layers_take_one_pass(spark):
    source = spark.range(100)
    steps = {"even": lambda df: df.filter("id % 2 = 0"), "tens": lambda df: df.filter("id % 10 = 0")}
    got = {r.layer: r.records for r in G.observed_counts(source, steps).collect()}
    assert got == {"raw": 100, "even": 50, "tens": 10}


def test_series_of_all_entities_in_two_passes(spark):
    from hazardlake.plans.series import indicator_series

    rows = [(f"{a}{b}", f"Land {a}{b}", "I", "Name", str(2015 + y), 1.0 * y) for a in "ABC" for b in "ABCDEFGHIJ" for y in range(2)]
    rows += [("ZZ", "Other", "J", "Else", "2016", 1.0)]
    df = spark.createDataFrame(rows, "country_code string, country_name string, indicator_id string, indicator_name string, year string, value double")
    assert indicator_series(df, "I").select("country_code").distinct().count() == 20
    whole = indicator_series(df, "I", n=None)
    assert whole.count() == 60 and "Name" in whole.first().title
    single = indicator_series(df, "I", entity="AA").collect()
    assert [(r.country_code, r.year, r.value) for r in single] == [("AA", 2015, 0.0), ("AA", 2016, 1.0)]
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 3


@pytest.mark.parametrize("scale", [None, 2])
def test_event_parts_merge_to_the_statistics_of_all(spark, scale):
    odd = [float("nan"), float("inf"), None, -0.5]
    rows = [("A" if k % 3 else None, "x", float(k) / 4 if k % 7 else odd[k % 4], k / 2, k % 2, k % 5) for k in range(90)]
    rows += [("B", "y", None, None, None, 0)]
    df = spark.createDataFrame(rows, "region string, severity_level string, magnitude double, depth double, tsunami int, portion int")
    keys = ["region", "severity_level"]
    whole = {str(r[:2]): r for r in G.event_stats(df, keys, exact_scale=scale).collect()}
    parts = G.event_parts(df, [*keys, "portion"], exact_scale=scale)
    # parts of parts merge as well
    merged = G.merge_event_parts(parts, keys)
    got = {str(r[:2]): r for r in merged.collect()}
    assert merged.columns == G.event_stats(df, keys).columns and set(got) == set(whole)
    for key, row in whole.items():
        assert repr(got[key]) == repr(row) if scale else got[key][2:] == pytest.approx(row[2:], nan_ok=True)


def test_profiles_merge_like_their_rows(spark):
    rows = [(f"entity {k % 1700}", f"i{k % 40}", 1990 + k % 30, k % 5) for k in range(6000)] + [(None, None, None, 0)]
    df = spark.createDataFrame(rows, "country_name string, indicator_name string, year int, portion int")
    parts = G.profile_sketch(df, ["portion"])
    assert parts.count() == 5
    merged, whole = G.merge_profiles(parts).first(), G.merge_profiles(G.profile_sketch(df)).first()
    assert abs(merged.n_entities - whole.n_entities) <= 0.08 * whole.n_entities
    exact = G.profile(df).first()
    assert (merged.n_rows, merged.first_year, merged.last_year) == (exact.n_rows, exact.first_year, exact.last_year)
    # five times the standard error of the sketch
    assert abs(merged.n_entities - exact.n_entities) <= 0.08 * exact.n_entities and merged.n_indicators == exact.n_indicators
    nothing = G.merge_profiles(G.profile_sketch(df.limit(0))).first()
    assert (nothing.n_rows, nothing.n_entities, nothing.first_year) == (0, 0, None)
