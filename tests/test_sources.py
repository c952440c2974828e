from __future__ import annotations

import json
import os
import re
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hazardlake import schemas as S
from hazardlake.operators import quality as Q
from hazardlake.operators.order import expired_snapshots
from hazardlake.session import scratch_path
from hazardlake.sources import tables as T
from hazardlake.sources.feeds import read_quake_feed
from hazardlake.sources.topics import publish, read_messages, records_as_messages

ROWS = S.struct(region=S.STRING, severity_level=S.STRING, v=S.INT)


def sample(spark):
    rows = [("A", "x", 1), ("A", "y", 2), ("B", "x", 3), (None, "x", 4)]
    return T.rows_to_df(spark, rows, ROWS)


def test_write_modes(spark, folder):
    path = f"{folder}/t"
    T.write_table(sample(spark), path, files=1)
    assert len(list(Path(path).glob("*.parquet"))) == 1
    T.write_table(sample(spark), path)
    assert T.read_table(spark, path).count() == 4
    T.append_partitioned(sample(spark), f"{folder}/p")
    T.append_partitioned(sample(spark), f"{folder}/p")
    table = T.read_table(spark, f"{folder}/p")
    assert table.count() == 8
    plan = table.filter("region = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_a_repeated_run_replaces_itself_and_nothing_else(spark, folder):
    path = f"{folder}/runs"
    T.append_partitioned(sample(spark), path, run=1)
    T.append_partitioned(sample(spark), path, run=2)
    # the run is written again with fewer groups: what it no longer has goes
    T.append_partitioned(sample(spark).filter("region = 'A'"), path, run=2)
    table = T.read_table(spark, path)
    rows = sorted((r.run_id, r.region or "", r.severity_level, r.v) for r in table.collect())
    assert rows == [(1, "", "x", 4), (1, "A", "x", 1), (1, "A", "y", 2), (1, "B", "x", 3), (2, "A", "x", 1), (2, "A", "y", 2)]
    plan = table.filter("region = 'A' AND severity_level = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan
    opened = table.filter("region = 'B'").select("_metadata.file_path").distinct().collect()
    assert len(opened) == 1 and "run_id=1/region=B/severity_level=x" in opened[0].file_path
    with pytest.raises(ValueError, match="not a name of a run"):
        T.append_partitioned(sample(spark), path, run="../2")


def test_csv(spark, folder):
    T.export_csv(sample(spark), f"{folder}/c")
    back = T.read_csv(spark, f"{folder}/c", ROWS)
    assert sorted(map(str, back.collect())) == sorted(map(str, sample(spark).collect()))


def test_first_available(spark, folder):
    T.export_csv(sample(spark).limit(0), f"{folder}/empty")
    T.export_csv(sample(spark), f"{folder}/full")

    def reader(name):
        return lambda: T.read_csv(spark, f"{folder}/{name}", ROWS)

    chosen = T.read_first_available(spark, [reader("none"), reader("empty"), reader("full")], ROWS)
    assert chosen.count() == 0
    assert T.read_first_available(spark, [reader("none"), reader("full")], ROWS).count() == 4
    nothing = T.read_first_available(spark, [reader("none")], ROWS)
    assert nothing.count() == 0 and nothing.schema == ROWS

    def broken():
        return sample(spark).select("absent")

    with pytest.raises(AnalysisException):
        T.read_first_available(spark, [broken, reader("full")], ROWS)


def _document(*ids):
    return json.dumps({"features": [{"id": i} for i in ids]}, indent=2)


def test_latest_snapshot_of_files(spark, folder):
    for name, when in (("b_20240101_000000.json", 100), ("a_20240102_000000.json", 100),
                       ("z_20230101_000000.json", 50), ("newer.txt", 900)):
        path = Path(folder) / name
        path.write_text(_document(name))
        os.utime(path, (when, when))
    got = T.read_latest_snapshot(spark, folder, S.FEATURES_DOC)
    assert got.select("features.id").first()[0] == ["a_20240102_000000.json"]
    empty = T.read_latest_snapshot(spark, f"{folder}/none", S.FEATURES_DOC)
    assert empty.count() == 0 and empty.schema == S.FEATURES_DOC


def test_archive_keeps_whole_documents(spark, folder):
    old = spark.createDataFrame([(_document("old"),)], "value string")
    new = spark.createDataFrame([(_document("n1", "n2"),), (_document("n3"),)], "value string")
    T.archive_snapshot(old, folder, "earthquakes", datetime(2024, 1, 1), 0)
    T.archive_snapshot(new, folder, "earthquakes", datetime(2024, 1, 2), 1)
    T.archive_snapshot(new, folder, "earthquakes", datetime(2024, 1, 2), 1)
    got = T.read_latest_snapshot(spark, folder, S.FEATURES_DOC, multi_line=False)
    ids = [i for r in got.select("features.id").collect() for i in r[0]]
    assert sorted(ids) == ["n1", "n2", "n3"]


def test_retention_of_archived_snapshots(spark, folder):
    docs = spark.createDataFrame([(_document("a"),), (_document("b"),)], "value string")
    for day in range(1, 8):
        T.archive_snapshot(docs.repartition(2), f"{folder}/quakes", "earthquakes", datetime(2024, 1, day))
    T.archive_snapshot(docs, f"{folder}/volcanoes", "volcanoes", datetime(2024, 1, 1))
    snapshots = T.list_snapshots(spark, folder)
    assert snapshots.count() == 8
    expired = sorted(r.path.rsplit("/", 1)[1] for r in expired_snapshots(snapshots).collect())
    assert expired == ["earthquakes_20240101_000000_0.json", "earthquakes_20240102_000000_0.json"]
    assert Q.freshness(snapshots, F.lit("2024-01-07").cast("date")).first().ok


def test_latest_csv(spark, folder):
    T.write_table(sample(spark), f"{folder}/x")
    assert T.read_latest_csv(spark, f"{folder}/x", ROWS).count() == 0
    T.export_csv(sample(spark).coalesce(1), f"{folder}/x/y")
    assert T.read_latest_csv(spark, f"{folder}/x", ROWS).count() == 4


def test_compact(spark, folder):
    T.write_table(sample(spark).repartition(4), f"{folder}/loose")
    T.compact(spark, f"{folder}/loose", f"{folder}/tight")
    files = T.list_files(spark, f"{folder}/tight", "*.parquet")
    assert files.count() == 1 and T.read_table(spark, f"{folder}/tight").count() == 4
    with pytest.raises(ValueError):
        T.compact(spark, f"{folder}/loose", f"{folder}/loose/")


def test_listing_does_not_read_content(spark, folder):
    T.write_table(sample(spark), f"{folder}/t")
    files = T.list_files(spark, f"{folder}/t")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_messages(spark, folder):
    df = sample(spark)
    publish(records_as_messages(df, F.col("v").cast("string"), "k"), f"{folder}/topic")
    got = {r.message_id: json.loads(r.value) for r in read_messages(spark, f"{folder}/topic").collect()}
    assert got["1"] == {"region": "A", "severity_level": "x", "v": 1} and len(got) == 4


def test_scratch_follows_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    if configured:
        assert path.startswith(configured.rstrip("/") + "/")
    assert path != scratch_path(spark, "x")


# --- quality ---------------------------------------------------------------------------
def checks(spark, *oks):
    return spark.createDataFrame([(f"c{i}", ok) for i, ok in enumerate(oks)], "check_name string, ok boolean")


def test_reports(spark):
    mixed = checks(spark, True, False, None, True)
    assert tuple(Q.completeness(mixed).first()) == (2, 4, False)
    assert tuple(Q.quality_report(mixed).first()) == (2, 4, 0.5, "quality_issues")
    assert tuple(Q.quality_report(checks(spark, True)).first()) == (1, 1, 1.0, "quality_passed")
    named = Q.quality_report(mixed, "all_healthy", "issues_detected").first()
    assert named.status == "issues_detected"
    assert tuple(Q.tables_present(mixed).first()) == ("c0,c3", True)
    assert tuple(Q.tables_present(checks(spark, False)).first()) == ("", False)
    status = {r.check_name: r.status for r in Q.completeness_status(mixed).collect()}
    assert status == {"c0": "COMPLETE", "c1": "INCOMPLETE", "c2": "INCOMPLETE", "c3": "COMPLETE"}


def test_volume(spark, folder):
    T.write_table(sample(spark), f"{folder}/a", files=1)
    got = Q.volume_check(spark, {"a": f"{folder}/a", "b": f"{folder}/b"}).collect()
    assert [(r.layer, r.files, r.ok) for r in got] == [("a", 1, True), ("b", 0, False)]


def test_snapshot_checks(spark):
    rows = [("x/earthquakes_20240101_000000.json", 1), ("x/earthquakes_20240102_000000.json", 2)]
    files = spark.createDataFrame(rows, "path string, s bigint").withColumn(
        "modification_time", F.timestamp_seconds("s")
    )
    assert Q.snapshot_name_check(files, "earthquakes").first().ok
    assert not Q.snapshot_name_check(files, "volcanoes").first().ok
    assert Q.freshness(files, F.lit("2024-01-02").cast("date")).first().ok
    assert not Q.freshness(files, F.lit("2024-01-03").cast("date")).first().ok
    assert not Q.freshness(files.limit(0), F.lit("2024-01-03").cast("date")).first().ok


def test_schema_check(spark):
    df = spark.createDataFrame([("a", 1), (None, 99), ("z", None)], "s string, n int")
    expected = S.struct(s=S.STRING, n=S.LONG, absent=S.DOUBLE)
    got = Q.schema_check(df, expected, ranges={"n": (0, 10)}, domains={"s": ["a"]}).collect()
    assert [tuple(r) for r in got] == [
        ("s", "string", "string", True, 1, 1),
        ("n", "bigint", "int", False, 1, 1),
        ("absent", "double", None, False, 0, 0),
    ]


def test_csv_written_elsewhere(spark, folder):
    from pathlib import Path

    Path(folder, "a.csv").write_text('b,a\n"He said ""hi"", then left",1\n"two\nlines",2\n,3\n"",x\n')
    got = T.read_csv(spark, f"{folder}/a.csv", S.struct(a=S.LONG, b=S.STRING, c=S.STRING))
    rows = [tuple(r) for r in got.collect()]
    assert rows == [(1, 'He said "hi", then left', None), (2, "two\nlines", None), (3, None, None), (None, "", None)]


def test_responses_without_entries_are_named(spark, folder):
    from hazardlake.sources import feeds

    rows = [("A", "I", '[{"page":1},[{"value":1.0}]]'), ("B", "I", '[{"page":1},[{"val'), ("C", "I", '[{"message":"x"}]'), ("D", "I", "{bad")]
    df = spark.createDataFrame(rows, "country_code string, indicator_id string, value string")
    df.write.partitionBy("country_code", "indicator_id").text(f"{folder}/r")
    got = {r.country_code: r.reason for r in feeds.unreadable_indicators(spark, f"{folder}/r", multi_line=False).collect()}
    assert got == {"B": "unparseable", "C": "no entries", "D": "unparseable"}


def feed(key, ms):
    return json.dumps({"features": [{"properties": {"id": key, "mag": 5.0, "time": ms}, "geometry": {"coordinates": [1.0, 2.0, 3.0]}}]})


@pytest.mark.parametrize("dated_by", ["modified", "name"])
def test_documents_from_before_the_window_are_not_opened(spark, folder, dated_by):
    end = datetime(2024, 1, 20)
    hour = 3600
    stamp = lambda t: datetime.fromtimestamp(t, timezone.utc).strftime("%Y%m%d_%H%M%S")
    at = end.replace(tzinfo=timezone.utc).timestamp()
    # the old file would have an event within the window; the one without a date in its name is kept
    for name, landed, key in (("old", at - 26 * hour, "old"), ("edge", at - 24.5 * hour, "edge"), ("late", at + 9 * hour, "late")):
        path = Path(folder) / (f"{name}_{stamp(landed)}_0.json" if dated_by == "name" else f"{name}.json")
        path.write_text(feed(key, int(at - hour) * 1000))
        if dated_by == "modified":
            os.utime(path, (landed, landed))
    if dated_by == "name":
        (Path(folder) / "undated.json").write_text(feed("undated", int(at - hour) * 1000))
    found = read_quake_feed(spark, folder, F.lit(end), dated_by=dated_by)
    assert sorted(r.id for r in found.collect()) == ["edge", "late"] + ["undated"] * (dated_by == "name")
    scan = re.search(r"number of files read: (\d+)", metrics(found))
    assert int(scan.group(1)) == 2 + (dated_by == "name")
    every = read_quake_feed(spark, folder, F.lit(end), dated_by=None)
    assert len(every.collect()) == 3 + (dated_by == "name")


def metrics(df):
    """Names and values of the metrics of all nodes of a plan that has run."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        values = node.metrics().iterator()
        while values.hasNext():
            metric = values.next()._2()
            out.append(f"{metric.name().get()}: {metric.value()}")
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return "\n".join(out)


def test_csv_files_are_read_in_splits_by_their_own_headers(spark, folder):
    lines = [f'{k},"text, ""{k}""",{k / 2}' for k in range(2000)]
    (Path(folder) / "a.csv").write_text("\n".join(["number,word,share", *lines]) + "\n")
    (Path(folder) / "b with blank.csv").write_text("share,extra,number,extra\n0.5,x,-1,y\n,x,-2,\n")
    (Path(folder) / "c.csv").write_text('"word","number"\n"",-3\nNULL,-4\n')
    schema = S.struct(number=S.INT, word=S.STRING, share=S.DOUBLE)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = T.read_csv(spark, folder, schema, split=True)
        got = {r.number: (r.word, r.share) for r in split.collect()}
        assert split.count() == len(got) == 2004
        alone = T.read_csv(spark, f"{folder}/a.csv", schema, split=True)
        assert alone.rdd.getNumPartitions() >= 2 and alone.count() == 2000
        whole = T.read_csv(spark, f"{folder}/a.csv", schema)
        assert whole.rdd.getNumPartitions() == 1 and sorted(whole.collect()) == sorted(alone.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got[7] == ('text, "7"', 3.5) and got[-1] == (None, 0.5) and got[-2] == (None, None)
    assert got[-3] == ("", None) and got[-4] == ("NULL", None)


def test_only_partitions_of_small_files_are_rewritten(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN '01' WHEN id % 3 = 1 THEN 'b c' END AS region", "'x' AS level")
    T.write_table(rows, path, partition_by=["region", "level"])
    rows.filter("region = '01'").repartition(5).write.mode("append").partitionBy("region", "level").parquet(path)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    folders = T.compact_partitions(spark, path, ["region", "level"])
    assert [f.split("/")[-2:] for f in folders] == [["region=01", "level=x"]]
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    other = lambda files: {p: t for p, t in files.items() if "region=01" not in str(p)}
    assert other(before) == other(after) and len([p for p in after if "region=01" in str(p)]) == 1
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        got = T.read_table(spark, path).groupBy("region").count().collect()
    finally:
        spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")
    assert {r.region: r["count"] for r in got} == {"01": 2 * 1334, "b c": 1333, None: 1333}
    assert T.compact_partitions(spark, path, ["region", "level"]) == []
