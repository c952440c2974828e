from __future__ import annotations

import contextlib
import io
import json
import random
import re
import time
from collections import Counter
from pathlib import Path

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hazardlake.schemas import VOLCANO_GOLD
from hazardlake.sources.topics import publish, read_messages, read_stream
from hazardlake.streaming import hazards as H
from hazardlake.streaming.supervise import ProgressLog, supervise


def quake(key, mag=3.0, lat=10.0, tsunami=0, time=1_704_067_200_000):
    return {
        "properties": {"id": key, "mag": mag, "time": time, "tsunami": tsunami},
        "geometry": {"coordinates": [20.0, lat, 5.0]},
    }


def volcano(key, title, lat=10.0):
    return {"id": key, "title": title, "geometry": [{"date": "d", "coordinates": [20.0, lat]}]}


def send(spark, topic, documents, first=0):
    """One file, and with one file per trigger one batch, per document."""
    for i, document in enumerate(documents, first):
        value = document if isinstance(document, str) else json.dumps(document)
        df = spark.createDataFrame([(f"m{i}", "k", value)], "message_id string, key string, value string")
        publish(df.coalesce(1), topic)


def stream(spark, topic):
    return read_stream(spark, topic, maxFilesPerTrigger="1")


def run_silver(spark, folder, documents, hazard=H.QUAKE, **settings):
    send(spark, f"{folder}/bronze", documents)
    paths = {n: f"{folder}/{n}" for n in ("table", "topic", "quarantine")}
    queries = H.silver_stream(
        stream(spark, f"{folder}/bronze"), hazard, checkpoint=f"{folder}/c", trigger=H.ONCE,
        **{**paths, **settings},
    )
    for q in queries.values():
        q.awaitTermination()
    return paths


def documents():
    return [
        {"features": [quake("a", 3.0), quake("b", 8.5, 70.0, 1), quake("c", None, 0.0)]},
        {"features": [quake("d", 5.5), quake("e", 5.6)]},
        {"features": []},
    ]


def test_quake_silver(spark, folder):
    paths = run_silver(spark, folder, documents())
    rows = {r.id: r for r in spark.read.parquet(paths["table"]).collect()}
    assert {k: (r.region, r.severity_level) for k, r in rows.items()} == {
        "a": ("Tropical", "minor"), "b": ("Arctic", "great"), "c": ("Unknown", "unknown"),
        "d": ("Tropical", "moderate"), "e": ("Tropical", "moderate"),
    }
    assert {r.layer for r in rows.values()} == {"silver"}
    messages = read_messages(spark, paths["topic"])
    sizes = {r.message_id: len(json.loads(r.value)) for r in messages.collect()}
    assert sizes == {"m0": 3, "m1": 2}
    back = H.silver_records(messages, H.QUAKE)
    assert back.columns[1:] == H.QUAKE.silver.fieldNames()
    stored = spark.read.parquet(paths["table"])
    common = ["id", "timestamp", "magnitude", "latitude", "depth", "region", "severity_level"]
    assert sorted(map(str, back.select(common).collect())) == sorted(
        map(str, stored.select(common).collect())
    )


def test_topic_options_reach_the_sinks(spark, folder):
    settings = {"topic_format": "json", "topic_options": {"compression": "gzip"}}
    paths = run_silver(spark, folder, documents(), **settings)
    assert list(Path(paths["topic"]).glob("batch_id=*/*.json.gz"))
    silver = silver_messages(spark, documents(), H.QUAKE)
    run_gold(spark, f"{folder}/g", silver, H.QUAKE, topic=f"{folder}/goldtopic", **settings)
    assert list(Path(f"{folder}/goldtopic").glob("batch_id=*/*.json.gz"))
    assert read_messages(spark, f"{folder}/goldtopic", "json").count() == 2


def test_volcano_silver(spark, folder):
    docs = [{"events": [volcano("a", "Large one", -70.0), {"id": "b", "geometry": []}]}, "{}"]
    paths = run_silver(spark, folder, docs, H.VOLCANO)
    rows = {r.id: (r.region, r.severity_level) for r in spark.read.parquet(paths["table"]).collect()}
    assert rows == {"a": ("Antarctic", "major"), "b": ("Unknown", "unknown")}


def test_stream_equals_batch_and_resumes(spark, folder):
    run_silver(spark, folder, documents())
    send(spark, f"{folder}/bronze", [{"features": [quake("late")]}], first=10)
    queries = H.silver_stream(
        stream(spark, f"{folder}/bronze"), H.QUAKE, f"{folder}/table", f"{folder}/c", trigger=H.ONCE
    )
    queries["table"].awaitTermination()
    stored = spark.read.parquet(f"{folder}/table")
    batch = H.silver_rows(read_messages(spark, f"{folder}/bronze"), H.QUAKE)
    columns = [c for c in batch.columns if c != "processing_timestamp"]
    assert stored.count() == 6
    assert sorted(map(str, stored.select(columns).collect())) == sorted(
        map(str, batch.select(columns).collect())
    )


def test_quarantine(spark, folder):
    partial = json.dumps({"features": [quake("x", "xx"), quake("y")]})
    paths = run_silver(spark, folder, [documents()[0], "{bad", "", partial, "{}"])
    bad = spark.read.json(paths["quarantine"]).collect()
    assert sorted((r.message_id, r.reason) for r in bad) == [
        ("m1", "unparseable"), ("m2", "unparseable"), ("m3", "partial"),
    ]
    assert [r.value for r in bad if r.message_id == "m3"] == [partial]
    ids = {r.id: r.magnitude for r in spark.read.parquet(paths["table"]).collect()}
    assert set(ids) == {"a", "b", "c", "x", "y"} and ids["x"] is None


@pytest.mark.parametrize("dedup, rows", [(None, 2), ("1 day", 1)])
def test_repeated_events(spark, folder, dedup, rows):
    twice = [{"features": [quake("same")]}] * 2
    paths = run_silver(spark, folder, twice, dedup=dedup)
    assert spark.read.parquet(paths["table"]).count() == rows


def run_gold(spark, folder, silver, hazard, **settings):
    topic = f"{folder}/silver"
    for i, message in enumerate(silver):
        publish(message.coalesce(1), topic)
    started = H.gold_stream(
        stream(spark, topic), hazard, f"{folder}/gold", f"{folder}/cg", trigger=H.ONCE, **settings
    )
    for query in started.values():
        query.awaitTermination()


def silver_messages(spark, docs, hazard):
    for i, document in enumerate(docs):
        df = spark.createDataFrame(
            [(f"m{i}", "k", json.dumps(document))], "message_id string, key string, value string"
        )
        yield H.silver_messages(df, hazard)


def test_gold_per_message(spark, folder):
    run_gold(
        spark, folder, silver_messages(spark, documents(), H.QUAKE), H.QUAKE,
        topic=f"{folder}/goldtopic",
    )
    gold = spark.read.parquet(f"{folder}/gold")
    assert gold.select("batch_id").distinct().count() == 2
    got = {
        (r.message_id, r.region, r.severity_level): (r.earthquake_count, r.tsunami_count)
        for r in gold.collect()
    }
    assert got == {
        ("m0", "Tropical", "minor"): (1, 0), ("m0", "Arctic", "great"): (1, 1),
        ("m0", "Unknown", "unknown"): (1, 0), ("m1", "Tropical", "moderate"): (2, 0),
    }
    messages = read_messages(spark, f"{folder}/goldtopic").collect()
    published = {r.message_id: json.loads(r.value) for r in messages}
    assert {k: len(v) for k, v in published.items()} == {"m0": 3, "m1": 1}
    assert published["m1"][0]["avg_magnitude"] == pytest.approx(5.55)
    assert published["m1"][0]["data_type"] == "earthquake"


def test_gold_running(spark, folder):
    run_gold(spark, folder, silver_messages(spark, documents() * 2, H.QUAKE), H.QUAKE, mode="running")
    got = {
        (r.region, r.severity_level): r.earthquake_count
        for r in H.read_running(spark, f"{folder}/gold", H.QUAKE).collect()
    }
    assert got == {
        ("Tropical", "minor"): 2, ("Arctic", "great"): 2, ("Unknown", "unknown"): 2,
        ("Tropical", "moderate"): 4,
    }


def test_volcano_gold(spark, folder):
    docs = [
        {"events": [volcano("a", "Small x"), volcano("b", "Small w"), volcano("c", "Large")]},
        {"events": [volcano("d", "Small x")]},
    ]
    run_gold(spark, f"{folder}/per", silver_messages(spark, docs, H.VOLCANO), H.VOLCANO)
    got = {
        (r.message_id, r.severity_level): (r.volcano_count, r.volcano_titles)
        for r in spark.read.parquet(f"{folder}/per/gold").collect()
    }
    assert got == {
        ("m0", "minor"): (2, ["Small w", "Small x"]), ("m0", "major"): (1, ["Large"]),
        ("m1", "minor"): (1, ["Small x"]),
    }
    running = silver_messages(spark, docs, H.VOLCANO)
    run_gold(spark, f"{folder}/run", running, H.VOLCANO, mode="running")
    got = {
        (r.severity_level, r.part): (r.volcano_count, r.volcano_titles)
        for r in H.read_running(spark, f"{folder}/run/gold", H.VOLCANO).collect()
    }
    assert got == {
        ("minor", 0): (3, ["Small w", "Small x", "Small x"]), ("major", 0): (1, ["Large"]),
    }


def test_repeated_batch_replaces_itself(spark, folder):
    """A batch that runs again after a failure must not count twice."""
    silver = list(silver_messages(spark, documents(), H.QUAKE))
    seen = []
    original = H.write_table

    def failing(df, path, *args, **kwargs):
        original(df, path, *args, **kwargs)
        seen.append(path)
        if len(seen) == 1:
            raise RuntimeError("lost after the write")

    H.write_table = failing
    try:
        for message in silver:
            publish(message.coalesce(1), f"{folder}/silver")
        for _ in range(2):
            query = H.gold_stream(
                stream(spark, f"{folder}/silver"), H.QUAKE, f"{folder}/gold", f"{folder}/cg",
                trigger=H.ONCE,
            )["table"]
            try:
                query.awaitTermination()
            except Exception:
                assert len(seen) == 1
    finally:
        H.write_table = original
    assert seen[0] == seen[1]
    total = spark.read.parquet(f"{folder}/gold").agg(F.sum("earthquake_count")).first()[0]
    assert total == 5


def test_layers_by_name(spark, folder):
    send(spark, f"{folder}/bronze", documents())
    assert set(H.LAYERS) == {
        "bronze", "volcano-bronze", "silver", "volcano-silver", "gold", "volcano-gold",
    }
    with pytest.raises(ValueError, match="unknown layer"):
        H.start("tin", spark, f"{folder}/bronze")
    started = H.start(
        "bronze", spark, f"{folder}/bronze", table=f"{folder}/t", checkpoint=f"{folder}/c1",
        trigger=H.ONCE,
    )
    started["table"].awaitTermination()
    seen = []
    H.start(
        "gold", spark, f"{folder}/bronze", checkpoint=f"{folder}/c2", trigger=H.ONCE,
        handle=lambda batch, i: seen.append(batch.count()),
    ).awaitTermination()
    assert sum(seen) == 3 and spark.read.parquet(f"{folder}/t").count() == 5


def test_archive_stream(spark, folder):
    send(spark, f"{folder}/bronze", documents())
    H.archive_stream(
        stream(spark, f"{folder}/bronze"), f"{folder}/raw", "earthquakes", f"{folder}/c", H.ONCE
    ).awaitTermination()
    assert spark.read.text(f"{folder}/raw/*").count() == 3


def test_a_repeated_batch_is_archived_once(spark, folder, monkeypatch):
    send(spark, f"{folder}/bronze", documents()[:1])
    original, times = H.archive_snapshot, []

    def failing(df, path, kind, taken, batch):
        original(df, path, kind, taken, batch)
        times.append(taken)
        if len(times) == 1:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(H, "archive_snapshot", failing)
    for attempt in range(2):
        query = H.archive_stream(
            stream(spark, f"{folder}/bronze"), f"{folder}/raw", "earthquakes", f"{folder}/c", H.ONCE
        )
        try:
            query.awaitTermination()
        except Exception:
            assert attempt == 0
        time.sleep(1.1)
    assert len(times) == 2 and times[0] == times[1]
    assert len(list(Path(f"{folder}/raw").iterdir())) == 1


def test_nothing_is_lost_by_deduplication(spark, folder):
    nameless = [{"features": [quake(None, mag=float(i)) for i in range(5)]}]
    timeless = [{"features": [quake("t", time=None)]}] * 3
    day = 86_400_000
    on_time = [{"features": [quake("a"), quake("b", time=1_704_067_200_000 + 5 * day)]}]
    late = [{"features": [quake("a"), quake("c", time=1_704_067_200_000 + 5 * day)]}]
    paths = run_silver(
        spark, folder, nameless + timeless + on_time + late, dedup="1 day", late=f"{folder}/late"
    )
    ids = [r.id for r in spark.read.parquet(paths["table"]).collect()]
    assert sorted(map(str, ids)) == ["None"] * 5 + ["a", "b", "c"] + ["t"] * 3
    assert [r.id for r in spark.read.parquet(f"{folder}/late").collect()] == ["a"]


@pytest.mark.parametrize("size", [1, 3, 8])
def test_an_id_counts_again_after_the_span_in_batches_of_any_size(spark, folder, size):
    start, hour = 1_704_067_200_000, 3_600_000
    sent = [("a", 0), ("b", 0), ("a", 12), ("a", 24), ("a", 36), ("b", 40), ("a", 50), ("a", 61)]
    events = [quake(key, time=start + h * hour) for key, h in sent]
    documents = [{"features": events[i : i + size]} for i in range(0, len(events), size)]
    paths = run_silver(spark, folder, documents, dedup="1 day", late=f"{folder}/late")
    kept = spark.read.parquet(paths["table"]).select("id", F.unix_millis("timestamp").alias("ms")).collect()
    # 24 hours are within the span; 50 and 61 hours count or not by those that counted before
    assert sorted((r.id, (r.ms - start) // hour) for r in kept) == [("a", 0), ("a", 36), ("a", 61), ("b", 0), ("b", 40)]
    assert not Path(f"{folder}/late").exists()


def test_a_message_is_read_once_for_all_outputs(spark, folder):
    send(spark, f"{folder}/bronze", documents())
    started = H.silver_stream(
        stream(spark, f"{folder}/bronze"), H.QUAKE, f"{folder}/table", f"{folder}/c",
        topic=f"{folder}/topic", trigger=H.ONCE,
    )
    assert list(started) == ["table"]
    started["table"].awaitTermination()
    assert sum(p.numInputRows for p in started["table"].recentProgress) == 3


@pytest.mark.parametrize("hazard", [H.QUAKE, H.VOLCANO])
def test_running_totals_merge_what_batches_add(spark, folder, hazard):
    items = "features" if hazard is H.QUAKE else "events"

    def one(i):
        return quake(f"q{i}", lat=[10.0, 70.0][i % 2]) if hazard is H.QUAKE else volcano(f"v{i}", f"Large {i % 3}")

    docs = [{items: [one(i)]} for i in range(10)]
    run_gold(spark, folder, silver_messages(spark, docs, hazard), hazard, mode="running")
    parts = spark.read.parquet(f"{folder}/gold")
    assert sorted(r.batch_id for r in parts.collect()) == list(range(10))
    # nothing but the table and its own bookkeeping by Spark
    assert {p.name for p in Path(folder).iterdir()} == {"silver", "gold", "cg"}
    gold = H.read_running(spark, f"{folder}/gold", hazard)
    if hazard is H.QUAKE:
        assert {r.earthquake_count for r in gold.collect()} == {5}
    else:
        (row,) = gold.collect()
        assert row.volcano_count == 10 and sorted(row.volcano_titles) == sorted(f"Large {i % 3}" for i in range(10))
        assert set(gold.columns) == set(VOLCANO_GOLD.fieldNames())


def test_a_repeated_batch_adds_to_running_totals_once(spark, folder, monkeypatch):
    original, seen = H.write_table, []

    def failing(df, path, *args, **kwargs):
        original(df, path, *args, **kwargs)
        seen.append(path)
        if len(seen) == 2:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(H, "write_table", failing)
    for message in silver_messages(spark, documents() * 2, H.QUAKE):
        publish(message.coalesce(1), f"{folder}/silver")
    for attempt in range(2):
        query = H.gold_stream(
            stream(spark, f"{folder}/silver"), H.QUAKE, f"{folder}/gold", f"{folder}/cg", mode="running", trigger=H.ONCE
        )["table"]
        try:
            query.awaitTermination()
        except Exception:
            assert attempt == 0
    assert len(seen) > 2 and seen[1] == seen[2]
    got = {r.region: r.earthquake_count for r in H.read_running(spark, f"{folder}/gold", H.QUAKE).collect() if r.region != "Tropical"}
    assert got == {"Arctic": 2, "Unknown": 2}


@pytest.mark.parametrize("mode", ["silver", "per_batch", "running"])
def test_a_condition_on_the_region_opens_its_files_only(spark, folder, mode):
    if mode == "silver":
        table = run_silver(spark, folder, documents())["table"]
    else:
        run_gold(spark, folder, silver_messages(spark, documents(), H.QUAKE), H.QUAKE, mode=mode)
        table = f"{folder}/gold"
    arctic = spark.read.parquet(table).filter("region = 'Arctic' AND severity_level = 'great'")
    rows = arctic.collect()
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        arctic.explain("formatted")
    (filters,) = re.findall(r"PartitionFilters: \[(.*)\]", shown.getvalue())
    assert "region" in filters and "severity_level" in filters and len(rows) == 1
    files = {p for p in Path(table).rglob("*.parquet") if "region=Arctic/severity_level=great" in str(p)}
    opened = spark.read.parquet(table).filter("region = 'Arctic'").select("_metadata.file_path").distinct().collect()
    assert {Path(r.file_path.removeprefix("file:")) for r in opened} == files and len(files) == 1


def test_deduplication_goes_on_after_a_restart(spark, folder):
    """The ids that counted come back with the checkpoint; nothing else is written for them."""
    start, day = 1_704_067_200_000, 86_400_000
    sent = [[("a", 0), ("b", 0)], [("a", 0), ("c", 1)], [("a", 0), ("b", 1), ("a", 2)], [("c", 1), ("a", 2), ("b", 2)]]
    for i, portion in enumerate(sent):
        events = [quake(key, time=start + d * day) for key, d in portion]
        send(spark, f"{folder}/bronze", [{"features": events}], first=i)
        for q in H.silver_stream(
            stream(spark, f"{folder}/bronze"), H.QUAKE, f"{folder}/table", f"{folder}/c", dedup="36 hours",
            topic=f"{folder}/topic", trigger=H.ONCE,
        ).values():
            q.awaitTermination()
    kept = spark.read.parquet(f"{folder}/table").select("id", F.unix_millis("timestamp").alias("ms")).collect()
    assert sorted((r.id, (r.ms - start) // day) for r in kept) == [("a", 0), ("a", 2), ("b", 0), ("b", 2), ("c", 1)]
    assert {p.name for p in Path(folder).iterdir()} == {"bronze", "table", "topic", "c"}


@pytest.mark.parametrize("size", [4, 40])
def test_deduplication_does_not_depend_on_batches(spark, folder, size):
    """Shuffled re-sent snapshots: what is kept is the same for batches of any size."""
    rng = random.Random(size)
    start, hour = 1_704_067_200_000, 3_600_000
    events = [(f"e{k % 7}", 5 * k) for k in range(40)]
    order = [e for k in range(0, 40, 4) for e in rng.sample(events[max(0, k - 4) : k + 4], len(events[max(0, k - 4) : k + 4]))]
    docs = [quake(name, time=start + h * hour) for name, h in order]
    run_silver(
        spark, folder, [{"features": docs[i : i + size]} for i in range(0, len(docs), size)], dedup="3 days", late=f"{folder}/late"
    )
    kept = spark.read.parquet(f"{folder}/table").select("id", F.unix_millis("timestamp").alias("ms")).collect()
    want = {}
    for name, h in sorted(events):
        if all(abs(h - t) > 72 for t in want.setdefault(name, [])):
            want[name].append(h)
    assert sorted((r.id, (r.ms - start) // hour) for r in kept) == sorted((n, h) for n, hs in want.items() for h in hs)


class Seen:
    """A group's entry in a state store, and how often it was written."""

    def __init__(self):
        self.value, self.written, self.watermark = None, 0, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value, self.written = value, self.written + 1


def test_what_has_counted_costs_few_bytes_and_no_writing(spark):
    """An entry is read in every micro-batch; of ids that only come again nothing is written."""
    hour, seen = 3_600_000_000, Seen()
    count = H._count_once(24 * hour)

    def sent(ids, at):
        rows = [(f"id{i}", at, f"{i}", True) for i in ids]
        return sum(len(f) for f in count((0,), iter([pd.DataFrame(rows, columns=["id", "at", "row", "told"])]), seen))

    assert sent(range(20_000), 10 * hour) == 20_000 and seen.written == 1
    assert isinstance(seen.value[0], bytes) and len(seen.value[0]) < 20 * 20_000
    assert sent(range(5_000), 11 * hour) == 0 and seen.written == 1
    assert sent([7, 20_000], 35 * hour) == 2 and seen.written == 2
    assert sent([7, 20_000, 8], 36 * hour) == 1 and seen.written == 3
    size, seen.watermark = len(seen.value[0]), 36 * 3_600_000
    # what lies further than the span before the watermark goes, the rest still counts
    assert sent([8], 36 * hour) == 0 and seen.written == 4 and len(seen.value[0]) < size / 10
    assert sent([9], 35 * hour) == 1 and sent([9], 36 * hour) == 1


def test_files_and_state_do_not_grow_with_the_number_of_partitions(spark, folder):
    events = [quake(f"e{k}", mag=3.0 + k % 3, time=1_704_067_200_000 + k) for k in range(400)]
    late = [quake(f"e{k}", time=1_600_000_000_000) for k in range(3)]
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        paths = run_silver(spark, folder, [{"features": events}, {"features": late}], dedup="1 day", late=f"{folder}/late")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert spark.read.parquet(paths["table"]).count() == 400 and spark.read.parquet(f"{folder}/late").count() == 3
    groups = Counter(p.parent for p in Path(paths["table"]).rglob("*.parquet"))
    assert len(groups) > 1 and max(groups.values()) <= H.SHARES
    stores = [p for p in Path(f"{folder}/c/table/state/0").iterdir() if p.name.isdigit()]
    assert len(stores) == H.STATE_TASKS


def test_values_pass_the_state_unchanged(spark, folder):
    odd = quake("x", mag=-0.0, time=253_370_764_800_000)  # the year 9999
    odd["properties"] |= {"place": 'quo"ted \n \U0001f642', "sig": 2_147_483_647}
    paths = run_silver(spark, f"{folder}/a", [{"features": [odd]}], dedup="1 day")
    plain = run_silver(spark, f"{folder}/b", [{"features": [odd]}])
    rows = [spark.read.parquet(p["table"]).drop("processing_timestamp").first() for p in (paths, plain)]
    assert repr(rows[0]) == repr(rows[1])


def test_unreadable_silver_messages_are_kept(spark, folder):
    good = next(iter(silver_messages(spark, documents(), H.QUAKE)))
    bad = good.withColumn("value", F.lit("[{not json"))
    empty = good.withColumn("value", F.lit(" [ ] "))
    for mode in ("per_batch", "running"):
        run_gold(spark, f"{folder}/{mode}", [good, bad, empty], H.QUAKE, mode=mode)
        kept = spark.read.json(f"{folder}/{mode}/gold_quarantine").collect()
        assert [(r.value, r.reason) for r in kept] == [("[{not json", "unparseable")]


def test_a_failing_stream_is_started_again(spark, folder):
    send(spark, f"{folder}/bronze", documents())
    seen, failures, log = [], [], ProgressLog()

    def keep(batch, batch_id):
        seen.append((batch_id, batch.count()))
        if len(seen) in (2, 3):
            raise RuntimeError("gone")

    def start():
        return {"tail": H.tail_stream(stream(spark, f"{folder}/bronze"), f"{folder}/c", keep, H.ONCE)}

    spark.streams.addListener(log)
    try:
        waits = []
        count = supervise(start, wait_seconds=60, on_failure=lambda name, error: failures.append(name), sleep=waits.append)
        assert count == 2 and failures == ["tail"] * 2 and waits == [60, 60]
        assert log.wait_for("ended")
    finally:
        spark.streams.removeListener(log)
    # the batch that failed twice came a third time, all others once
    assert seen == [(0, 1), (1, 1), (1, 1), (1, 1), (2, 1)]
    rows = log.rows(spark).collect()
    assert [r.event for r in rows].count("failed") == 2 and [r.event for r in rows].count("ended") == 1
    assert sorted((r.batch_id, r.input_rows) for r in rows if r.event == "progress") == [(0, 1), (1, 1), (2, 1)]
    assert log.write(spark, f"{folder}/log") == len(rows) and log.rows(spark).count() == 0
    assert spark.read.parquet(f"{folder}/log").filter("event = 'failed' AND message LIKE '%gone%'").count() == 2


def test_too_many_failures_end_the_supervision(spark, folder):
    send(spark, f"{folder}/bronze", documents()[:1])

    def fail(batch, batch_id):
        raise RuntimeError("always")

    waits = []
    with pytest.raises(StreamingQueryException, match="always"):
        supervise(
            lambda: H.tail_stream(stream(spark, f"{folder}/bronze"), f"{folder}/c", fail, H.ONCE),
            attempts=2, sleep=waits.append,
        )
    assert waits == [60]


def test_backlog_is_taken_in_batches_of_bounded_size(spark, folder, monkeypatch):
    """What a task holds of a stream does not grow with what has landed."""
    send(spark, f"{folder}/topic", documents()[:2] * 3)
    largest = max(p.stat().st_size for p in Path(f"{folder}/topic").glob("*.parquet"))
    monkeypatch.setattr("hazardlake.sources.topics.BATCH_BYTES", 2 * largest)
    batches = []
    H.tail_stream(
        read_stream(spark, f"{folder}/topic"), f"{folder}/c", lambda b, i: batches.append(b.count()), H.ONCE
    ).awaitTermination()
    assert sum(batches) == 6 and max(batches) <= 2 < len(batches)


def test_topic_files_can_be_split(spark, folder):
    """One file of large messages has several row groups."""
    text = F.expr("array_join(transform(sequence(1, 400), i -> sha2(concat(id, '-', i), 256)), '')")
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("message_id"), F.lit("k").alias("key"), text.alias("value")
    )
    publish(rows.coalesce(1), f"{folder}/topic")
    (file,) = Path(f"{folder}/topic").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 1
    assert read_messages(spark, f"{folder}/topic").distinct().count() == 400
