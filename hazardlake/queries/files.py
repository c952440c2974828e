"""Queries that go through files: tables, CSV copies, landed documents and snapshots."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import schemas as S
from hazardlake.functions.display import snapshot_kind, snapshot_time
from hazardlake.operators import flatten as flat
from hazardlake.operators import order as O
from hazardlake.operators.flatten import classify_quakes
from hazardlake.plans import batch
from hazardlake.queries import sql
from hazardlake.queries.registry import query
from hazardlake.session import scratch_path
from hazardlake.sources import feeds, tables

_GROUPS = f"""WITH {sql.CLASSED} SELECT region, severity_level, COUNT(*) AS n,
    CAST(SUM(event_id) AS BIGINT) AS ids FROM classed GROUP BY region, severity_level"""


def _groups(df):
    return df.groupBy("region", "severity_level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")
    )


@query(_GROUPS)
def table_round_trip(spark, sf_dir):
    path = scratch_path(spark, "table")
    tables.write_table(classify_quakes(A.quakes(spark, sf_dir)), path)
    return _groups(tables.read_table(spark, path))


@query(_GROUPS)
def partitioned_append(spark, sf_dir):
    """Two appends to a partitioned table, one per half of the severities."""
    path = scratch_path(spark, "partitioned")
    rows = classify_quakes(A.quakes(spark, sf_dir))
    weak = F.col("severity_level").isin("micro", "unknown")
    tables.append_partitioned(rows.filter(weak), path)
    tables.append_partitioned(rows.filter(~weak), path)
    return _groups(tables.read_table(spark, path))


@query(_GROUPS)
def repeated_append(spark, sf_dir):
    """Two runs appended under their names, the first once more with other groups, then once more as it was."""
    path = scratch_path(spark, "repeated")
    rows = classify_quakes(A.quakes(spark, sf_dir))
    even = F.col("event_id") % 2 == 0
    for run, portion in (("even", rows.filter(even)), ("odd", rows.filter(~even))):
        tables.append_partitioned(portion, path, run=run)
    for portion in (rows.filter(even & (F.col("region") != "Tropical")), rows.filter(even)):
        tables.append_partitioned(portion, path, run="even")
    return _groups(tables.read_table(spark, path))


@query(_GROUPS)
def compacted_table(spark, sf_dir):
    source, target = scratch_path(spark, "loose"), scratch_path(spark, "compact")
    rows = classify_quakes(A.quakes(spark, sf_dir)).repartition("event_id")
    tables.write_table(rows, source)
    tables.compact(spark, source, target)
    return _groups(tables.read_table(spark, target))


@query(_GROUPS)
def compacted_partitions(spark, sf_dir):
    """Two partitions of many small files are rewritten in place, the others stay as they are."""
    path = scratch_path(spark, "partitions")
    rows = classify_quakes(A.quakes(spark, sf_dir))
    tables.append_partitioned(rows, path)
    loose = rows.filter("region = 'Tropical' AND severity_level IN ('minor', 'light')").repartition(6, "event_id")
    for folder in ("Tropical/severity_level=minor", "Tropical/severity_level=light"):
        level = folder.split("=")[1]
        part = loose.filter(F.col("severity_level") == level).drop("region", "severity_level")
        part.write.mode("overwrite").parquet(f"{path}/region={folder}")
    tables.compact_partitions(spark, path, ["region", "severity_level"])
    return _groups(tables.read_table(spark, path))


_CSV_TEXT = """CASE event_id % 5 WHEN 0 THEN 'He said "' || place || '", then left'
    WHEN 1 THEN 'line one' || chr(10) || place || chr(10) WHEN 2 THEN ''
    WHEN 3 THEN place || ', "" and \\' END"""


@query(f"WITH {sql.QUAKES} SELECT event_id, magnitude, {_CSV_TEXT} AS place, latitude FROM quakes")
def csv_round_trip(spark, sf_dir):
    """Text with quotes, commas and line breaks, the empty text, and null."""
    path = scratch_path(spark, "csv")
    key = F.col("event_id") % 5
    text = F.when(key == 0, F.concat(F.lit('He said "'), "place", F.lit('", then left')))
    text = text.when(key == 1, F.concat(F.lit("line one\n"), "place", F.lit("\n")))
    text = text.when(key == 2, "").when(key == 3, F.concat("place", F.lit(', "" and \\')))
    rows = A.quakes(spark, sf_dir).select("event_id", "magnitude", text.alias("place"), "latitude")
    tables.export_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query(f"WITH {sql.QUAKES} SELECT event_id, place, NULL::DOUBLE AS absent, magnitude FROM quakes")
def csv_other_order(spark, sf_dir):
    """Files whose columns stand in another order than the schema that reads them."""
    path = scratch_path(spark, "csv")
    rows = A.quakes(spark, sf_dir).select("event_id", "place", "magnitude")
    tables.export_csv(rows.select("magnitude", "event_id", "place"), path)
    schema = S.struct(event_id=S.LONG, place=S.STRING, absent=S.DOUBLE, magnitude=S.DOUBLE)
    return tables.read_csv(spark, path, schema)


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, place, CASE WHEN event_id % 2 = 0 THEN latitude END AS latitude,
    magnitude FROM quakes"""
)
def csv_split(spark, sf_dir):
    """Files with headers of their own, one without a column and all in another order, read in splits."""
    path = scratch_path(spark, "csv")
    rows = A.quakes(spark, sf_dir).select("event_id", "place", "magnitude", "latitude")
    even = F.col("event_id") % 2 == 0
    tables.export_csv(rows.filter(even).select("latitude", "magnitude", "event_id", "place"), f"{path}/part=0")
    tables.export_csv(rows.filter(~even).select("place", "event_id", "magnitude"), f"{path}/part=1")
    schema = S.struct(event_id=S.LONG, place=S.STRING, latitude=S.DOUBLE, magnitude=S.DOUBLE)
    return tables.read_csv(spark, path, schema, split=True)


@query(
    f"""WITH {sql.CLEAN} SELECT country_code, COUNT(*) AS n FROM clean GROUP BY country_code"""
)
def first_available(spark, sf_dir):
    """The bronze copy is not there, so the silver copy is read."""
    root = scratch_path(spark, "layers")
    layer = batch.silver(batch.bronze(A.panel(spark, sf_dir)))
    tables.export_csv(layer, f"{root}/silver")
    found = tables.read_first_available(
        spark,
        [
            lambda: tables.read_csv(spark, f"{root}/bronze", S.INDICATOR_BRONZE),
            lambda: tables.read_csv(spark, f"{root}/silver", S.INDICATOR_SILVER),
            lambda: tables.read_latest_csv(spark, f"{root}/gold", S.INDICATOR_GOLD),
        ],
        S.INDICATOR_BRONZE,
    )
    return found.groupBy("country_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql.PANEL} SELECT country_code, indicator_id, year, value FROM panel
    WHERE value IS NOT NULL AND NOT isnan(value)"""
)
def indicator_files(spark, sf_dir):
    path = scratch_path(spark, "responses")
    documents = A.indicator_documents(spark, sf_dir)
    documents.select("value", "country_code", "indicator_id").write.partitionBy(
        "country_code", "indicator_id"
    ).text(path)
    rows = flat.flatten_indicators(feeds.read_indicator_json(spark, path, multi_line=False))
    return rows.select("country_code", "indicator_id", "year", "value")


@query(
    f"""WITH {sql.PANEL} SELECT country_code, indicator_id, 'unparseable' AS reason, COUNT(*) AS n
    FROM (SELECT DISTINCT country_code, indicator_id, o_orderkey // {A.PAGE_SIZE} FROM panel)
    GROUP BY ALL"""
)
def bad_indicator_responses(spark, sf_dir):
    """Each response also comes cut off; those give no entries and are reported."""
    path = scratch_path(spark, "responses")
    documents = A.indicator_documents(spark, sf_dir).select("value", "country_code", "indicator_id")
    cut = documents.withColumn("value", F.expr("left(value, length(value) - 3)"))
    documents.unionByName(cut).write.partitionBy("country_code", "indicator_id").text(path)
    bad = feeds.unreadable_indicators(spark, path, multi_line=False)
    return bad.groupBy("country_code", "indicator_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH counts AS (SELECT COUNT(DISTINCT event_id // {A.DOCUMENT_SIZE}) AS bad, COUNT(*) AS good
    FROM events), feeds AS (SELECT unnest(['quakes', 'volcanoes']) AS feed, bad, good FROM counts)
    SELECT feed, 'unparseable' AS kind, bad AS n FROM feeds UNION ALL SELECT feed, 'good', good FROM feeds"""
)
def bad_landed_documents(spark, sf_dir):
    """Each landed document also comes broken: good records and reported documents."""
    feeds_of = {
        "quakes": (A.quake_documents, S.FEATURES_DOC, "features"),
        "volcanoes": (A.volcano_documents, S.EVENTS_DOC, "events"),
    }
    results = []
    for name, (documents, schema, items) in feeds_of.items():
        path = scratch_path(spark, name)
        values = documents(spark, sf_dir).select("value")
        broken = values.select(F.concat(F.lit("[{not json"), "value").alias("value"))
        values.unionByName(broken).write.text(path)
        bad = feeds.unreadable_documents(spark, path, schema, items, multi_line=False)
        good = feeds.read_documents(spark, path, schema, multi_line=False)
        records = good.select(F.explode(items)).agg(F.count(F.lit(1)).alias("n"))
        results.append(records.select(F.lit(name).alias("feed"), F.lit("good").alias("kind"), "n"))
        reasons = bad.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
        results.append(reasons.select(F.lit(name).alias("feed"), "kind", "n"))
    return reduce(DataFrame.unionByName, results)


@query(
    f"""WITH {sql.FLAT} SELECT id, time, magnitude FROM flat
    WHERE timestamp BETWEEN TIMESTAMP '2024-01-19 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
    AND magnitude >= 2.5"""
)
def quake_feed(spark, sf_dir):
    path = scratch_path(spark, "quakes")
    A.quake_documents(spark, sf_dir).select("value").write.text(path)
    end = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    rows = feeds.read_quake_feed(spark, path, end, multi_line=False)
    return rows.select("id", F.unix_millis("timestamp").alias("time"), "magnitude")


@query(
    f"""WITH {sql.FLAT} SELECT id, time, magnitude FROM flat
    WHERE timestamp BETWEEN TIMESTAMP '2024-01-19 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
    AND magnitude >= 2.5"""
)
def quake_feed_snapshots(spark, sf_dir):
    """Two archived snapshots hold the same events; the one from before the window is not opened."""
    path = scratch_path(spark, "archive")
    documents = A.quake_documents(spark, sf_dir)
    for day in (10, 20):
        tables.archive_snapshot(documents, path, "earthquakes", datetime(2024, 1, day, 1))
    end = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    rows = feeds.read_quake_feed(spark, f"{path}/*", end, multi_line=False, dated_by="name")
    return rows.select("id", F.unix_millis("timestamp").alias("time"), "magnitude")


@query(
    f"""WITH {sql.VOLCANOES} SELECT id, title, latitude, longitude, date FROM volcanoes
    WHERE category = 'volcanoes' AND status = 'open'"""
)
def volcano_feed(spark, sf_dir):
    path = scratch_path(spark, "volcanoes")
    A.volcano_documents(spark, sf_dir).select("value").write.text(path)
    rows = feeds.read_volcano_feed(spark, path, multi_line=False)
    return rows.select("id", "title", "latitude", "longitude", "date")


@query(f"WITH {sql.FLAT} SELECT id, magnitude FROM flat")
def latest_snapshot(spark, sf_dir):
    """Two archived snapshots; the one taken last holds the full documents."""
    folder = scratch_path(spark, "archive")
    documents = A.quake_documents(spark, sf_dir)
    first = documents.withColumn("value", F.lit('{"features":[]}'))
    tables.archive_snapshot(first, folder, "earthquakes", datetime(2024, 1, 30, 12))
    tables.archive_snapshot(documents, folder, "earthquakes", datetime(2024, 1, 30, 13))
    newest = tables.read_latest_snapshot(spark, folder, S.FEATURES_DOC, multi_line=False)
    return flat.flatten_features(newest, "features").select("id", "magnitude")


@query(
    f"""WITH {sql.CLEAN}, layers AS (
    SELECT unnest(['bronze', 'silver', 'gold']) AS layer FROM clean)
    SELECT layer, COUNT(*) AS records FROM layers GROUP BY layer"""
)
def run_batch(spark, sf_dir):
    root = scratch_path(spark, "batch")
    paths = {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "gold")}
    return batch.run_batch(spark, A.panel(spark, sf_dir), paths)


@query(
    f"""WITH {sql.LISTING}, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY prefix
    ORDER BY modification_time DESC, path) AS rank FROM listing)
    SELECT prefix, path, event_id FROM ranked WHERE rank > 5"""
)
def expired_snapshots(spark, sf_dir):
    files = O.expired_snapshots(A.listing(spark, sf_dir))
    return files.select("prefix", "path", "event_id")


@query(
    f"""WITH {sql.LISTING} SELECT prefix, path FROM listing
    WHERE modification_time < {sql.NOW} - INTERVAL 168 HOURS"""
)
def expired_by_age(spark, sf_dir):
    now = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    return O.expired_by_age(A.listing(spark, sf_dir), now).select("prefix", "path")


@query(
    f"""WITH {sql.LISTING} SELECT event_id, prefix AS kind,
    strftime(modification_time, '%Y-%m-%d %H:%M:%S') AS taken FROM listing"""
)
def snapshot_names(spark, sf_dir):
    path = F.col("path")
    taken = F.date_format(snapshot_time(path), "yyyy-MM-dd HH:mm:ss")
    return A.listing(spark, sf_dir).select(
        "event_id", snapshot_kind(path).alias("kind"), taken.alias("taken")
    )
