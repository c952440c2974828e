"""Queries over quake records: classes, statistics, views and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import constants as K
from hazardlake.functions import classify as C
from hazardlake.functions import convert as V
from hazardlake.functions import display as D
from hazardlake.operators import aggregate as G
from hazardlake.operators import clean as R
from hazardlake.operators import order as O
from hazardlake.operators.flatten import classify_quakes, classify_volcanoes, volcano_fields
from hazardlake.plans import views
from hazardlake.queries import sql
from hazardlake.queries.registry import query

NOW = "2024-01-31 00:00:00"


def now():
    return F.to_timestamp(F.lit(NOW))


def classed(spark, sf_dir):
    return classify_quakes(A.quakes(spark, sf_dir))


@query(f"WITH {sql.CLASSED} SELECT severity_level, COUNT(*) AS n FROM classed GROUP BY ALL")
def severity_counts(spark, sf_dir):
    return classed(spark, sf_dir).groupBy("severity_level").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {sql.CLASSED} SELECT region, COUNT(*) AS n FROM classed GROUP BY ALL")
def region_counts(spark, sf_dir):
    return classed(spark, sf_dir).groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql.CLASSED} SELECT region, severity_level, round(AVG(magnitude), 6) AS avg_magnitude,
    round(AVG(depth), 6) AS avg_depth FROM classed GROUP BY region, severity_level"""
)
def event_averages(spark, sf_dir):
    """The plain averages of the statistics."""
    stats = G.event_stats(classed(spark, sf_dir))
    rounded = [F.round(c, 6).alias(c) for c in ("avg_magnitude", "avg_depth")]
    return stats.select("region", "severity_level", *rounded)


@query(
    f"""WITH {sql.CLASSED} SELECT region, severity_level, COUNT(*) AS earthquake_count,
    {sql.exact_mean("magnitude", 5)} AS avg_magnitude, MAX(magnitude) AS max_magnitude,
    MIN(magnitude) AS min_magnitude, {sql.exact_mean("depth", 5)} AS avg_depth,
    CAST(SUM(tsunami) AS BIGINT) AS tsunami_count FROM classed GROUP BY region, severity_level"""
)
def event_stats(spark, sf_dir):
    return G.event_stats(classed(spark, sf_dir), exact_scale=5)


_PLAT, _PLON = sql.position("p_partkey")
_PARTS = f"""parts AS (SELECT p_partkey, p_name AS title, {_PLAT} AS latitude, {_PLON} AS longitude
    FROM part), titled AS (SELECT *, {sql.title_severity("title")} AS severity_level,
    {sql.band("latitude", "longitude")} AS region FROM parts)"""


@query(f"WITH {_PARTS} SELECT p_partkey, title, severity_level, region FROM titled")
def title_severity(spark, sf_dir):
    parts = classify_volcanoes(A.part_events(spark, sf_dir))
    return parts.select("p_partkey", "title", "severity_level", "region")


def _titles_sql(per_row: int) -> str:
    return f"""WITH {_PARTS}, counted AS (
        SELECT region, severity_level, title, COUNT(*) AS copies FROM titled GROUP BY ALL),
    totals AS (SELECT region, severity_level,
        CAST(CEIL(SUM(copies)::DOUBLE / {per_row}) AS BIGINT) AS parts FROM counted GROUP BY ALL),
    pieces AS (SELECT region, severity_level, title, piece,
        LEAST({per_row}, copies - piece * {per_row}) AS copies
        FROM (SELECT *, unnest(range((copies - 1) // {per_row} + 1)) AS piece FROM counted)),
    dealt AS (SELECT p.*, CAST('0x' || substr(md5(title || '#' || piece), 1, 8) AS BIGINT) % parts
        AS part FROM pieces p JOIN totals USING (region, severity_level))
    SELECT region, severity_level, part,
        CAST(SUM(SUM(copies)) OVER (PARTITION BY region, severity_level) AS BIGINT) AS volcano_count,
        CAST(SUM(copies) AS BIGINT) AS part_count,
        array_to_string(list_sort(flatten(list(list_transform(range(copies), lambda i: title)))),
        '|') AS titles FROM dealt GROUP BY region, severity_level, part"""


def _titles(spark, sf_dir, per_row):
    titled = classify_volcanoes(A.part_events(spark, sf_dir))
    packed = G.event_titles(titled, per_row=per_row)
    return packed.select(
        "region",
        "severity_level",
        "part",
        "volcano_count",
        "part_count",
        F.array_join("volcano_titles", "|").alias("titles"),
    )


@query(_titles_sql(G.TITLES_PER_ROW))
def event_titles(spark, sf_dir):
    return _titles(spark, sf_dir, G.TITLES_PER_ROW)


@query(_titles_sql(7))
def event_titles_in_parts(spark, sf_dir):
    """The same lists cut into short rows, as happens to a hot group."""
    return _titles(spark, sf_dir, 7)


@query(
    f"""WITH {sql.CLASSED}, recent AS (SELECT * FROM classed ORDER BY timestamp DESC, id LIMIT 20),
    aged AS (SELECT *, CAST(epoch_ms({sql.NOW}) - time AS DOUBLE) / 60000 AS age FROM recent)
    SELECT event_id, time, magnitude, age, CASE WHEN age <= 10 THEN '#ff0000'
    WHEN age <= 30 THEN '#ff6600' WHEN age <= 60 THEN '#ff9900' ELSE '#00ff00' END AS colour
    FROM aged"""
)
def recent_events(spark, sf_dir):
    recent = O.recent_events(classed(spark, sf_dir))
    age = D.age_minutes(F.col("timestamp"), now())
    return recent.select(
        "event_id", "time", "magnitude", age.alias("age"), C.recency_class(age).alias("colour")
    )


@query(
    f"""WITH {sql.QUAKES}, aged AS (
    SELECT event_id, CAST(epoch_ms(TIMESTAMP '2024-01-15 12:00:00') - time AS DOUBLE) / 60000 AS age
    FROM quakes)
    SELECT event_id, age, CASE WHEN age <= 10 THEN '#ff0000' WHEN age <= 30 THEN '#ff6600'
    WHEN age <= 60 THEN '#ff9900' ELSE '#00ff00' END AS colour FROM aged"""
)
def recency(spark, sf_dir):
    middle = F.to_timestamp(F.lit("2024-01-15 12:00:00"))
    age = D.age_minutes(F.col("timestamp"), middle)
    return A.quakes(spark, sf_dir).select(
        "event_id", age.alias("age"), C.recency_class(age).alias("colour")
    )


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, time, magnitude FROM quakes
    WHERE timestamp BETWEEN TIMESTAMP '2024-01-19 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
    AND magnitude >= 2.5"""
)
def feed_window(spark, sf_dir):
    end = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    return R.feed_window(A.quakes(spark, sf_dir), end).select("event_id", "time", "magnitude")


_DETAIL = f"""{sql.CLASSED}, detail AS (
    SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp,
    round_even(magnitude * 10, 0) / 10 AS magnitude, place,
    round_even(depth * 10, 0) / 10 AS depth,
    upper(severity_level[1]) || severity_level[2:] AS severity_level, region, status, significance,
    'None' AS alert, CASE WHEN tsunami = 1 THEN 'Yes' ELSE 'No' END AS tsunami,
    CAST(format('{{:.3f}}', latitude) AS DOUBLE) AS latitude,
    CAST(format('{{:.3f}}', longitude) AS DOUBLE) AS longitude FROM classed)"""


@query(f"WITH {_DETAIL} SELECT * FROM detail")
def detail_table(spark, sf_dir):
    return views.detail_table(classed(spark, sf_dir))


@query(
    f"""WITH {_DETAIL.replace("upper(severity_level[1]) || severity_level[2:] AS severity_level",
    "CASE event_id % 5 WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' ELSE 'Minor' END AS severity_level")},
    flagged AS (SELECT concat_ws(',',
    CASE WHEN severity_level = 'Critical' THEN 'critical' END,
    CASE WHEN severity_level = 'High' THEN 'high' END,
    CASE WHEN magnitude >= 5 THEN 'strong' END,
    CASE WHEN tsunami = 'Yes' THEN 'tsunami' END) AS highlights FROM detail)
    SELECT highlights, COUNT(*) AS n FROM flagged GROUP BY highlights"""
)
def highlight_flags(spark, sf_dir):
    """Two fifths of the events get the severities that are highlighted."""
    key = F.col("event_id") % 5
    severity = F.when(key == 0, "critical").when(key == 1, "high").otherwise("minor")
    rows = classed(spark, sf_dir).withColumn("severity_level", severity)
    flagged = R.highlight_flags(views.detail_rows(rows))
    names = F.array_join("highlights", ",").alias("highlights")
    return flagged.groupBy(names).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {sql.CLASSED}, {sql.VOLCANOES},
    recent AS (SELECT * FROM classed ORDER BY timestamp DESC, id LIMIT 20),
    aged AS (SELECT *, CAST(epoch_ms({sql.NOW}) - time AS DOUBLE) / 60000 AS age FROM recent)
    SELECT 'quake' AS kind, latitude, longitude,
    CASE severity_level WHEN 'low' THEN 8 WHEN 'moderate' THEN 15 WHEN 'high' THEN 22
        WHEN 'critical' THEN 30 ELSE 12 END AS size,
    CASE WHEN age <= 10 THEN '#ff0000' WHEN age <= 30 THEN '#ff6600'
        WHEN age <= 60 THEN '#ff9900' ELSE '#00ff00' END AS colour,
    0.7::DOUBLE AS opacity,
    'M' || COALESCE(format('{{:.1f}}', magnitude), 'nan') || ' - ' || place || '<br>Time: '
        || strftime(timestamp, '%H:%M:%S') || '<br>Severity: ' || severity_level
        || '<br>Age: ' || format('{{:.0f}}', age) || ' min ago' AS label
    FROM aged WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    UNION ALL
    SELECT 'volcano', latitude, longitude, 12, '#FF8C00', 0.8::DOUBLE,
    'Volcano: ' || title || '<br>Date: ' || date || '<br>Location: '
        || format('{{:.2f}}', latitude) || ', ' || format('{{:.2f}}', longitude)
    FROM volcanoes WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""
)
def map_features(spark, sf_dir):
    items = A.volcano_items(spark, sf_dir)
    fields = volcano_fields(F.col("item"))
    volcanoes = items.select(*[c.alias(n) for n, c in fields.items()])
    return views.map_features(classed(spark, sf_dir), volcanoes, now())


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || '.'
    || lpad(CAST(time % 1000 AS VARCHAR), 3, '0') || '000' AS iso,
    strftime(timestamp, '%Y-%m-%d') AS day, strftime(timestamp, '%H:%M:%S') AS clock,
    strftime(timestamp, '%Y%m%d_%H%M%S') AS stamp FROM quakes"""
)
def event_times(spark, sf_dir):
    ts = V.epoch_ms(F.col("time"))
    return A.quakes(spark, sf_dir).select(
        "event_id",
        V.iso_text(ts).alias("iso"),
        D.fmt_ts(ts, "yyyy-MM-dd").alias("day"),
        D.fmt_ts(ts, "HH:mm:ss").alias("clock"),
        D.fmt_ts(ts, "yyyyMMdd_HHmmss").alias("stamp"),
    )


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, round_even(magnitude * 10, 0) / 10 AS magnitude_1,
    CAST(format('{{:.3f}}', magnitude) AS DOUBLE) AS magnitude_3,
    CAST(format('{{:.0f}}', latitude) AS DOUBLE) AS latitude_0 FROM quakes"""
)
def rounding(spark, sf_dir):
    return A.quakes(spark, sf_dir).select(
        "event_id",
        D.round_display(F.col("magnitude"), 1).alias("magnitude_1"),
        D.round_exact(F.col("magnitude"), 3).alias("magnitude_3"),
        D.round_exact(F.col("latitude"), 0).alias("latitude_0"),
    )


@query(
    f"""WITH {sql.CLASSED} SELECT event_id,
    CASE severity_level WHEN 'moderate' THEN 15 ELSE 12 END AS size,
    CASE event_id % 7 WHEN 0 THEN 30 WHEN 1 THEN 22 WHEN 4 THEN 8 ELSE 12 END AS word_size,
    CASE event_id % 7 WHEN 0 THEN '#800000' WHEN 1 THEN '#cc0000' WHEN 2 THEN '#ff6600'
        WHEN 4 THEN '#00ff00' ELSE '#cccccc' END AS colour,
    CASE WHEN tsunami = 1 THEN 'Yes' ELSE 'No' END AS tsunami,
    upper(severity_level[1]) || severity_level[2:] AS severity FROM classed"""
)
def styles(spark, sf_dir):
    """All five severity words of the map, one that is none, and null, in turn."""
    severity = F.col("severity_level")
    words = F.array(*[F.lit(w) for w in ("critical", "high", "medium", "unknown", "low", "other", None)])
    word = F.get(words, F.col("event_id") % 7)
    return classed(spark, sf_dir).select(
        "event_id",
        C.style_lookup(word, K.SEVERITY_SIZE, K.SEVERITY_SIZE_DEFAULT).alias("word_size"),
        C.style_lookup(severity, K.SEVERITY_SIZE, K.SEVERITY_SIZE_DEFAULT).alias("size"),
        C.style_lookup(word, K.SEVERITY_COLOUR, K.SEVERITY_COLOUR_DEFAULT).alias("colour"),
        D.yes_no(F.col("tsunami")).alias("tsunami"),
        D.title_case(severity).alias("severity"),
    )


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, 'M' || COALESCE(format('{{:.1f}}', magnitude), 'nan') || ' - ' || place
    AS label, place || ' (Region)' AS region_label FROM quakes"""
)
def labels(spark, sf_dir):
    return A.quakes(spark, sf_dir).select(
        "event_id",
        F.concat(
            F.lit("M"), D.fixed(F.col("magnitude"), 1), F.lit(" - "), F.col("place")
        ).alias("label"),
        D.region_label(F.col("place")).alias("region_label"),
    )


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, longitude AS first_item, latitude AS second_item,
    depth AS third_item, depth AS last_item FROM quakes"""
)
def array_items(spark, sf_dir):
    position = F.array("longitude", "latitude", "depth")
    return A.quakes(spark, sf_dir).select(
        "event_id",
        V.from_start(position, 0).alias("first_item"),
        V.from_start(position, 1).alias("second_item"),
        V.from_start(position, 2).alias("third_item"),
        V.from_end(position).alias("last_item"),
    )


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, time, magnitude, place FROM quakes"""
)
def json_round_trip(spark, sf_dir):
    text = V.encode("event_id", "time", "magnitude", "place")
    layout = "event_id BIGINT, time BIGINT, magnitude DOUBLE, place STRING, _corrupt_record STRING"
    return (
        A.quakes(spark, sf_dir)
        .select(V.decode(text, layout).alias("r"))
        .select("r.event_id", "r.time", "r.magnitude", "r.place")
    )


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, latitude, longitude FROM quakes
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""
)
def require_position(spark, sf_dir):
    return R.require_position(A.quakes(spark, sf_dir)).select("event_id", "latitude", "longitude")


@query(
    """SELECT p_partkey, p_name AS title FROM part WHERE lower(p_name) LIKE '%ring%'
    OR lower(p_name) LIKE '%gear%' OR lower(p_name) LIKE '%bolt%'"""
)
def title_filter(spark, sf_dir):
    parts = R.title_contains_any(A.part_events(spark, sf_dir), "title", ["ring", "gear", "bolt"])
    return parts.select("p_partkey", "title")


@query(
    f"""WITH {sql.VOLCANOES} SELECT event_id, title FROM volcanoes
    WHERE lower(title) LIKE '%eruption%' OR lower(title) LIKE '%volcanic%'
    OR lower(title) LIKE '%volcano%'"""
)
def eruption_titles(spark, sf_dir):
    items = A.volcano_items(spark, sf_dir).select("event_id", F.col("item.title").alias("title"))
    return R.title_contains_any(items)


@query(
    f"""WITH {sql.CLASSED} SELECT event_id, magnitude, region FROM classed
    WHERE magnitude >= 3 AND region = 'Tropical'"""
)
def filter_rows(spark, sf_dir):
    rows = R.filter_rows(classed(spark, sf_dir), "magnitude >= 3 AND region = 'Tropical'")
    return rows.select("event_id", "magnitude", "region")


@query(f"WITH {sql.QUAKES} SELECT event_id, place, depth, magnitude FROM quakes")
def sort_rows(spark, sf_dir):
    order = [("place", "asc"), ("depth", "desc"), ("event_id", "asc")]
    return O.sort_rows(A.quakes(spark, sf_dir), order).select(
        "event_id", "place", "depth", "magnitude"
    )


@query(f"WITH {sql.QUAKES} SELECT event_id, time FROM quakes")
def newest_first(spark, sf_dir):
    return O.newest_first(A.quakes(spark, sf_dir), tie="event_id").select("event_id", "time")


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, place, magnitude FROM quakes
    ORDER BY magnitude DESC NULLS LAST, event_id LIMIT 15 OFFSET 30"""
)
def page(spark, sf_dir):
    rows = A.quakes(spark, sf_dir).select("event_id", "place", "magnitude")
    return O.page(rows, [("magnitude", "desc"), ("event_id", "asc")], number=2, size=15)


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, place, magnitude FROM quakes
    ORDER BY magnitude DESC NULLS LAST, event_id LIMIT 15 OFFSET 30"""
)
def page_after(spark, sf_dir):
    """The third page again, from the last row of the second."""
    rows = A.quakes(spark, sf_dir).select("event_id", "place", "magnitude")
    order = [("magnitude", "desc"), ("event_id", "asc")]
    second = O.page(rows, order, number=1, size=15).collect()
    # behind a page that is not full there is nothing
    return O.page_after(rows, order, second[-1].asDict(), size=15) if len(second) == 15 else rows.limit(0)


@query(f"WITH {sql.QUAKES} SELECT event_id, place FROM quakes ORDER BY event_id LIMIT 10")
def preview(spark, sf_dir):
    rows = A.quakes(spark, sf_dir).select("event_id", "place")
    return O.preview(rows.orderBy("event_id"))


@query(
    f"""WITH {sql.QUAKES} SELECT event_id, 'N/A' AS alert, place, 'None' AS felt FROM quakes"""
)
def select_with_defaults(spark, sf_dir):
    defaults = {"event_id": None, "alert": "N/A", "place": K.BAND_UNKNOWN, "felt": "None"}
    return R.select_with_defaults(A.quakes(spark, sf_dir), defaults)
