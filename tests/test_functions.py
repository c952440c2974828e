from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hazardlake import constants as K
from hazardlake.functions import classify as C
from hazardlake.functions import convert as V
from hazardlake.functions import display as D

NAN = float("nan")


def test_severity_edges(label):
    cases = {
        None: "unknown", -1.0: "micro", 1.99: "micro", 2.0: "minor", 3.99: "minor",
        4.0: "light", 5.0: "moderate", 6.0: "strong", 7.0: "major", 7.99: "major", 8.0: "great",
    }
    assert label(cases, "m double", C.severity_level) == list(cases.values())
    assert label([NAN], "m double", C.severity_level) == ["great"]


def test_latitude_edges(label):
    cases = [
        (None, 1.0, "Unknown"), (1.0, None, "Unknown"), (0.0, 10.0, "Unknown"),
        (10.0, 0.0, "Unknown"), (90.1, 1.0, "Unknown"), (1.0, 180.1, "Unknown"),
        (NAN, 1.0, "Unknown"), (60.1, 1.0, "Arctic"), (90.0, 1.0, "Arctic"),
        (60.0, 1.0, "Northern Temperate"), (23.5, 1.0, "Northern Temperate"),
        (23.4, 1.0, "Tropical"), (-23.5, 1.0, "Tropical"), (-23.6, 1.0, "Southern Temperate"),
        (-60.0, 1.0, "Southern Temperate"), (-60.1, 1.0, "Antarctic"),
    ]
    rows = [c[:2] for c in cases]
    assert label(rows, "a double, b double", C.latitude_band) == [c[2] for c in cases]


def test_zero_position_can_be_allowed(label):
    def band(a, b):
        return C.latitude_band(a, b, zero_is_missing=False)

    assert label([(0.0, 10.0)], "a double, b double", band) == ["Tropical"]


def test_keyword_class(label):
    cases = {"Large minor vent": "major", "SMALL": "minor", "Moderate": "moderate", "x": "unknown"}
    assert label(cases, "t string", C.keyword_class) == list(cases.values())
    assert label([None], "t string", C.keyword_class) == ["unknown"]


def test_value_and_year_categories(label):
    cases = {
        -0.1: "Negative", 0.0: "Zero", 99.99: "Low", 100.0: "Medium", 999.99: "Medium",
        1000.0: "High",
    }
    assert label(cases, "v double", C.value_category) == list(cases.values())
    years = {
        2017: "Early Period", 2018: "Mid Period", 2020: "Mid Period", 2021: "Recent Period",
    }
    assert label(years, "y int", C.year_category) == list(years.values())


def test_quality_flag_and_completeness(label):
    cases = [
        (None, "x", "Missing Value"), (-1.0, "x", "Negative Value"),
        (1.0, None, "Missing Indicator"), (-1.0, None, "Negative Value"), (1.0, "x", "Valid"),
    ]
    rows = [c[:2] for c in cases]
    assert label(rows, "v double, i string", C.quality_flag) == [c[2] for c in cases]
    rows = [("a", "b", 1, 1.0), (None, "b", 1, 1.0), ("a", "b", 1, None)]
    schema = "a string, b string, y int, v double"
    assert label(rows, schema, C.is_complete) == [True, False, False]


def test_every_double_gets_one_label(label):
    rng = random.Random(7)
    values = [rng.uniform(-1e3, 1e4) for _ in range(2000)] + [NAN, float("inf"), -float("inf")]
    names = {name for _, name in K.MAGNITUDE_STEPS} | {K.MAGNITUDE_TOP}
    assert set(label(values, "m double", C.severity_level)) <= names
    assert None not in label(values, "m double", C.value_category)
    pairs = [(rng.uniform(-100, 100), rng.uniform(-200, 200)) for _ in range(2000)]
    assert None not in label(pairs, "a double, b double", C.latitude_band)


def test_recency(label):
    cases = {10.0: "#ff0000", 10.01: "#ff6600", 30.0: "#ff6600", 60.0: "#ff9900", 60.01: "#00ff00"}
    assert label(cases, "a double", C.recency_class) == list(cases.values())


def test_style_lookup_default(label):
    def size(c):
        return C.style_lookup(c, K.SEVERITY_SIZE, K.SEVERITY_SIZE_DEFAULT)

    assert label(["low", "critical", "great", None], "s string", size) == [8, 30, 12, 12]


def test_numbers_from_text(label):
    cases = {
        "12": 12.0, " 12 ": 12.0, "1e3": 1000.0, "-4.5": -4.5, "1D": None, "2f": None,
        "3.d ": None, "0x1p3": None, "n/a": None, "": None, "inf": float("inf"),
    }
    assert label(cases, "t string", V.to_number) == list(cases.values())
    assert label([None], "t string", V.to_number) == [None]


def test_array_access(label):
    def ends(c):
        return F.struct(V.from_start(c, 1), V.from_end(c))

    got = label([([1.0, 2.0],), ([1.0],), ([],), (None,)], "a array<double>", ends)
    assert [tuple(r) for r in got] == [(2.0, 2.0), (None, 1.0), (None, None), (None, None)]


def test_rounding_like_arrays(label):
    got = label([2.25, 0.35, -2.25, None], "v double", lambda c: D.round_display(c, 1))
    assert got == [2.2, 0.4, -2.2, None]


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_exact_rounding_matches_python(label, digits):
    rng = random.Random(digits)
    values = [35.1235, 4.35, 2.675, 0.5, 1.5, -0.5, -2.5, 0.125, 1e17, 0.0]
    values += [rng.randrange(-1_800_000, 1_800_000) / 10_000 for _ in range(4000)]
    values += [rng.randrange(-4000, 4000) / 16 for _ in range(1000)]
    values += [rng.uniform(-180, 180) for _ in range(1000)]
    values += [sign * n / 20_000 for n in range(3000) for sign in (1, -1)]
    values += [n / 40 for n in range(2000)] + [rng.uniform(-1, 1) / 1000 for _ in range(1000)]
    got = label(values, "v double", lambda c: D.round_exact(c, digits))
    assert got == [round(v, digits) for v in values]
    text = label(values, "v double", lambda c: D.fixed(c, digits))
    expected = [f"{round(v, digits) + 0.0:.{digits}f}" for v in values]
    assert [float(t) for t in text] == [float(t) for t in expected]
    assert label([None, NAN], "v double", lambda c: D.fixed(c, digits)) == ["nan", "nan"]


def test_times(label):
    assert label([1_704_067_200_123], "t bigint", lambda c: V.iso_text(V.epoch_ms(c))) == [
        "2024-01-01T00:00:00.123000"
    ]
    now = F.lit("2024-01-01 01:00:00").cast("timestamp")
    age = label([1_704_067_200_000], "t bigint", lambda c: D.age_minutes(V.epoch_ms(c), now))
    assert age == [60.0]


def test_labels(label):
    ts = F.lit("2024-01-01 10:20:30").cast("timestamp")

    def text(m, p):
        return D.quake_label(m, p, ts, F.lit("minor"), F.lit(2.5))

    got = label([(4.35, "Here"), (None, None)], "m double, p string", text)
    assert got == [
        "M4.3 - Here<br>Time: 10:20:30<br>Severity: minor<br>Age: 2 min ago",
        "Mnan - None<br>Time: 10:20:30<br>Severity: minor<br>Age: 2 min ago",
    ]


def test_snapshot_names(label):
    names = ["s3/earthquakes_20240102_030405.json", "x/volcanoes_20240102_030405_7.json/part-0", "a"]
    assert label(names, "p string", D.snapshot_kind) == ["earthquakes", "volcanoes", ""]
    taken = datetime(2024, 1, 2, 3, 4, 5)
    assert label(names, "p string", D.snapshot_time) == [taken, taken, None]


def test_small_display_functions(label):
    assert label([1, 0, None], "f int", D.yes_no) == ["Yes", "No", "No"]
    assert label(["great", "x y"], "t string", D.title_case) == ["Great", "X Y"]
    title = label(["A"], "t string", lambda c: D.series_title(c, F.lit("B")))
    assert title == [" A - B (2015-2025)"]


def test_snapshot_names_of_the_last_part_only(label):
    paths = [
        "/lake/backup_20200101_000000/earthquakes_20240101_120000.json",
        "/lake/earthquakes_20240101_120000_7.json/part-0",
        "/lake/backup_20200101_000000/readme.txt",
    ]
    assert label(paths, "p string", D.snapshot_kind) == ["earthquakes", "earthquakes", ""]


def test_labels_without_a_time(spark):
    row = spark.sql("SELECT 4.5D m, 'here' p, cast(null as timestamp) t, 'high' s, cast(null as double) a")
    text = row.select(D.quake_label(row.m, row.p, row.t, row.s, row.a)).first()[0]
    assert text == "M4.5 - here<br>Time: None<br>Severity: high<br>Age: nan min ago"


def test_title_case_after_every_mark(label):
    texts = ["semi-strong o'clock", "ABC def", "", None, "élan 3rd"]
    assert label(texts, "t string", D.title_case) == ["Semi-Strong O'Clock", "Abc Def", "", None, "Élan 3Rd"]


def test_large_numbers_keep_their_fraction_until_there_is_none(label):
    values = [1.5e15 + 0.5, 2.0**51 + 0.25, 2.0**52 + 1, 1e300]
    assert label(values, "v double", lambda v: D.round_exact(v, 0)) == [1.5e15, 2.0**51, 2.0**52 + 1, 1e300]
