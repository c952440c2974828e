from __future__ import annotations

import json

from pyspark.sql import functions as F

from hazardlake import schemas as S
from hazardlake.operators import flatten as flat
from hazardlake.sources import feeds


def docs(spark, schema, *documents):
    df = spark.createDataFrame([(d,) for d in documents], "value string")
    return flat.parse_documents(df, schema)


def feature(time=1_704_067_200_000, coordinates=(10.0, 20.0, 5.0), **properties):
    geometry = {"coordinates": list(coordinates)} if coordinates is not None else {}
    return {"properties": {"id": "q", "mag": 3.5, "time": time, **properties}, "geometry": geometry}


def test_features_flatten(spark):
    document = json.dumps(
        {
            "features": [
                feature(),
                feature(coordinates=(1.0, 2.0)),
                feature(time=None),
                feature(coordinates=None),
                {"id": "outer", "properties": {"mag": 1}, "geometry": {"coordinates": []}},
            ]
        }
    )
    rows = flat.flatten_features(docs(spark, S.FEATURES_DOC, document, "{}", '{"features":[]}'))
    got = rows.withColumn("t", F.unix_millis("timestamp")).collect()
    assert len(got) == 5
    assert (got[0].longitude, got[0].latitude, got[0].depth) == (10.0, 20.0, 5.0)
    assert (got[1].longitude, got[1].latitude, got[1].depth) == (1.0, 2.0, None)
    assert got[2].t is None and got[0].t == 1_704_067_200_000
    assert (got[3].longitude, got[3].latitude, got[3].depth) == (0.0, 0.0, 0.0)
    assert (got[4].id, got[4].magnitude, got[4].latitude) == ("outer", 1.0, None)


def test_view_skips_and_defaults(spark):
    document = json.dumps(
        {
            "features": [
                {"properties": {"mag": 2.0}},
                {"geometry": {"coordinates": [1, 2, 3]}},
                {"properties": {}, "geometry": {"coordinates": [1, 2]}},
                {"properties": {"mag": 4.5, "place": "P", "time": 7}, "geometry": {}},
            ]
        }
    )
    got = flat.flatten_features_view(docs(spark, S.FEATURES_DOC, document))
    assert got.schema.fieldNames() == S.QUAKE_VIEW.fieldNames()
    assert [tuple(r) for r in got.collect()] == [
        (0.0, "Unknown", 0, 2.0, 1.0, 0.0),
        (4.5, "P", 7, 0.0, 0.0, 0.0),
    ]


def test_latest_geometry(spark):
    document = json.dumps(
        {
            "events": [
                {"id": "a", "title": "T", "geometry": [
                    {"date": "d1", "coordinates": [1, 2]}, {"date": "d2", "coordinates": [3, 4]}]},
                {"id": "b", "geometry": []},
                {"id": "c"},
                {"id": "d", "geometry": [{"date": "d3"}]},
            ]
        }
    )
    rows = flat.flatten_events_latest_geom(docs(spark, S.EVENTS_DOC, document))
    got = flat.classify_volcanoes(rows).collect()
    assert [(r.id, r.latitude, r.longitude, r.date, r.region) for r in got] == [
        ("a", 4.0, 3.0, "d2", "Tropical"),
        ("b", None, None, None, "Unknown"),
        ("c", None, None, None, "Unknown"),
        ("d", 0.0, 0.0, "d3", "Unknown"),
    ]


RESPONSE = [
    {"page": 1},
    [
        {"date": "2015", "value": 1.5, "indicator": {"id": "I", "value": "Own"}, "decimal": 1},
        {"date": "2016", "value": None},
        {"date": "2017", "value": 2.0, "source": {"value": "S"}, "unit": "u"},
    ],
]


def test_indicator_entries(spark):
    rows = spark.createDataFrame(
        [
            ("MX", "EN.POP.DNST", json.dumps(RESPONSE)),
            ("XX", "other", json.dumps(RESPONSE)),
            ("US", "I", '[{"page": 1}, null]'),
            ("US", "I", '[{"page": 1}]'),
        ],
        "country_code string, indicator_id string, value string",
    )
    entries = rows.withColumn("entries", flat.indicator_entries(F.col("value")))
    got = flat.flatten_indicators(entries)
    assert got.columns == S.INDICATOR_RAW.fieldNames()
    assert [tuple(r) for r in got.collect()] == [
        ("MX", "Mexico", "EN.POP.DNST", "Population Density", "Demographic", "2015", 1.5, "", "",
         1, "Own", "World Bank"),
        ("MX", "Mexico", "EN.POP.DNST", "Population Density", "Demographic", "2017", 2.0, "u", "",
         0, "Population Density", "S"),
        ("XX", "XX", "other", "other", "Other", "2015", 1.5, "", "", 1, "Own", "World Bank"),
        ("XX", "XX", "other", "other", "Other", "2017", 2.0, "u", "", 0, "other", "S"),
    ]


def test_pretty_printed_responses_are_read_whole(spark, folder):
    from pathlib import Path

    for code in ("1D", "MX", "1W"):
        place = Path(folder) / f"country_code={code}" / "indicator_id=I"
        place.mkdir(parents=True)
        (place / "r.json").write_text(json.dumps(RESPONSE, indent=2))
    got = flat.flatten_indicators(feeds.read_indicator_json(spark, folder)).collect()
    assert sorted({r.country_code for r in got}) == ["1D", "1W", "MX"] and len(got) == 6


def test_feeds_filter(spark, folder):
    from pathlib import Path

    quakes = {"features": [feature(), feature(mag=2.4), feature(time=1_703_900_000_000)]}
    (Path(folder) / "q").mkdir()
    (Path(folder) / "q" / "a.json").write_text(json.dumps(quakes, indent=1))
    end = F.timestamp_millis(F.lit(1_704_067_200_000))
    assert feeds.read_quake_feed(spark, f"{folder}/q", end).count() == 1
    events = {
        "events": [
            {"id": str(i), "category": c, "status": s}
            for i, (c, s) in enumerate(
                [("volcanoes", "open"), ("volcanoes", "closed"), ("wildfires", "open")]
            )
        ]
    }
    (Path(folder) / "v").mkdir()
    (Path(folder) / "v" / "a.json").write_text(json.dumps(events, indent=1))
    assert [r.id for r in feeds.read_volcano_feed(spark, f"{folder}/v").collect()] == ["0"]


def test_corrupt_documents(spark):
    good = json.dumps({"features": [feature()]})
    partial = json.dumps({"features": [feature(mag="xx"), feature()]})
    parsed = docs(spark, S.FEATURES_DOC, good, "{bad", "", partial, "{}", None)
    bad = {r.value: r.reason for r in flat.corrupt_documents(parsed, "features").collect()}
    assert bad == {"{bad": "unparseable", "": "unparseable", partial: "partial", None: "unparseable"}
    magnitudes = [r.magnitude for r in flat.flatten_features(parsed).collect()]
    assert magnitudes == [3.5, None, 3.5]
