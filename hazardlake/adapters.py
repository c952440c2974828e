"""The supplied tables seen as this domain's inputs.

The tables hold no nulls, zeros or unreadable text, so the adapters put some in, by
key, to reach every branch of the operators. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Features per document; event ids are unique, so this bounds every group built below.
DOCUMENT_SIZE = 100
# Orders per response page; order keys are unique.
PAGE_SIZE = 2000

# Titles of volcano events by event type.
TITLES = {
    "click": "Minor volcanic unrest",
    "error": "Major volcano eruption",
    "purchase": "Moderate lava flow",
    "signup": "Etna volcano",
    "view": "Large lava flow",
}
# Indicator names and categories by order status; P has no category.
STATUS_LABELS = {"F": "Filled orders", "O": "Open orders", "P": "Pending orders"}
STATUS_CATEGORIES = {"F": "Economic", "O": "Demographic"}
# Names of aggregates by supplied region name.
REGION_NAMES = {
    "AFRICA": "Sub-Saharan Africa",
    "AMERICA": "Latin America",
    "ASIA": "East Asia",
    "EUROPE": "European Union",
    "MIDDLE EAST": "Middle East",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _position(key: Column, shift: int | Column = 0) -> tuple[Column, Column]:
    step = F.lit(shift) if isinstance(shift, int) else shift
    lat = ((key * 37 + step * 11) % 1900).cast("double") / 10 - 95
    lon = ((key * 53 + step * 7) % 3700).cast("double") / 10 - 185
    return lat, lon


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as flat quake records; ``k`` in the properties is the depth."""
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    lat, lon = _position(key)
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        key.cast("string").alias("id"),
        ts.alias("timestamp"),
        F.unix_millis(ts).alias("time"),
        F.when(key % 97 != 0, F.col("value") / 40).alias("magnitude"),
        F.concat(F.lit("Zone "), F.col("user_id").cast("string")).alias("place"),
        F.when(key % 211 == 0, None)
        .when(key % 199 == 0, F.lit(0.0))
        .otherwise(lat)
        .alias("latitude"),
        lon.alias("longitude"),
        F.get_json_object("props", "$.k").cast("double").alias("depth"),
        F.when(F.col("user_id") % 5 == 0, 1).otherwise(0).alias("tsunami"),
        F.col("user_id").cast("int").alias("significance"),
        F.col("event_type").alias("status"),
        F.concat(F.lit("Quake, "), F.col("event_type")).alias("title"),
    )


def _documents(items: DataFrame, name: str, key: str) -> DataFrame:
    """``(message_id, key, value)`` documents of up to DOCUMENT_SIZE items."""
    grouped = items.groupBy(F.expr(f"event_id div {DOCUMENT_SIZE}").alias("doc_id")).agg(
        F.collect_list("item").alias(name)
    )
    return grouped.select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.lit(key).alias("key"),
        F.to_json(F.struct(name)).alias("value"),
    )


def quake_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature collections; some features lack a depth, some the whole geometry."""
    rows = quakes(spark, sf_dir)
    key = F.col("event_id")
    flat_position = F.array("longitude", "latitude")
    position = F.array("longitude", "latitude", "depth")
    geometry = F.when(
        key % 17 != 0,
        F.struct(F.when(key % 13 == 0, flat_position).otherwise(position).alias("coordinates")),
    )
    item = F.struct(
        F.struct(
            "id",
            F.col("magnitude").alias("mag"),
            "place",
            "time",
            "status",
            "tsunami",
            F.col("significance").alias("sig"),
            "title",
        ).alias("properties"),
        geometry.alias("geometry"),
    )
    return _documents(rows.select("event_id", item.alias("item")), "features", "earthquake")


def volcano_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a geometry history of none to three positions."""
    events = table(spark, sf_dir, "events")
    key = F.col("event_id")
    titles = F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair])

    def geometry(step: Column) -> Column:
        lat, lon = _position(key, step)
        date = F.concat(F.lit("2024-02-0"), step.cast("string"))
        return F.struct(date.alias("date"), F.array(lon, lat).alias("coordinates"))

    steps = F.slice(F.array(*[F.lit(i) for i in (1, 2, 3)]), F.lit(1), (key % 4).cast("int"))
    item = F.struct(
        key.cast("string").alias("id"),
        F.concat_ws(" ", titles[F.col("event_type")], F.col("user_id").cast("string")).alias(
            "title"
        ),
        F.col("props").alias("description"),
        F.when(F.col("event_type") == "purchase", "wildfires")
        .otherwise("volcanoes")
        .alias("category"),
        F.when(F.col("user_id") % 4 == 0, "closed").otherwise("open").alias("status"),
        F.transform(steps, geometry).alias("geometry"),
    )
    return events.select("event_id", item.alias("item"))


def volcano_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(volcano_items(spark, sf_dir), "events", "volcano")


def part_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as titled events with a position."""
    lat, lon = _position(F.col("p_partkey"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("title"), lat.alias("latitude"), lon.alias("longitude")
    )


def country_code(nation_key: Column) -> Column:
    first, second = F.lit(65) + nation_key, F.lit(65) + (nation_key * 7) % 26
    return F.concat(F.char(first), F.char(second))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation as raw indicator observations, year as text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    labels = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    categories = F.create_map(*[F.lit(x) for pair in STATUS_CATEGORIES.items() for x in pair])
    return rows.select(
        key,
        country_code(F.col("n_nationkey")).alias("country_code"),
        F.col("n_name").alias("country_name"),
        status.alias("indicator_id"),
        F.coalesce(F.try_element_at(labels, status), status).alias("indicator_name"),
        F.coalesce(F.try_element_at(categories, status), F.lit("Other")).alias(
            "indicator_category"
        ),
        F.when(key % 79 == 0, "n/a")
        .otherwise((F.year("o_orderdate") * 2 - 1976).cast("string"))
        .alias("year"),
        F.when(key % 89 == 0, None)
        .when(key % 83 == 0, F.lit(float("nan")))
        .when(key % 101 == 0, F.lit(0.0))
        .otherwise(F.col("c_acctbal"))
        .alias("value"),
        F.lit("").alias("unit"),
        F.col("o_orderpriority").alias("obs_status"),
        F.lit("0").alias("decimal"),
        F.concat(F.lit("Balance of status "), status).alias("indicator_description"),
        F.lit("World Bank").alias("source"),
    )


def indicator_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-element responses of up to PAGE_SIZE entries per entity and indicator.

    Some entries have no value, some no indicator block; none has a source.
    """
    rows = panel(spark, sf_dir)
    key = F.col("o_orderkey")
    entry = F.struct(
        F.col("year").alias("date"),
        F.when(~F.isnan("value"), F.col("value")).alias("value"),
        F.col("obs_status"),
        F.when(
            key % 7 != 0,
            F.struct(
                F.col("indicator_id").alias("id"), F.col("indicator_description").alias("value")
            ),
        ).alias("indicator"),
    )
    number = F.expr(f"o_orderkey div {PAGE_SIZE}")
    pages = rows.groupBy("country_code", "indicator_id", number.alias("page_id")).agg(
        F.collect_list(entry).alias("entries"), F.count(F.lit(1)).alias("n")
    )
    meta = F.to_json(F.struct(F.col("page_id").alias("page"), F.col("n").alias("total")))
    value = F.concat(F.lit("["), meta, F.lit(","), F.to_json("entries"), F.lit("]"))
    return pages.select("country_code", "indicator_id", "page_id", value.alias("value"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per customer: its nation, and its region as an aggregate."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    names = F.create_map(*[F.lit(x) for pair in REGION_NAMES.items() for x in pair])
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    nation = F.struct(
        country_code(F.col("n_nationkey")).alias("country_code"),
        F.col("n_name").alias("country_name"),
    )
    region = F.struct(
        F.concat(F.lit("R0"), F.col("r_regionkey").cast("string")).alias("country_code"),
        F.coalesce(F.try_element_at(names, F.col("r_name")), F.col("r_name")).alias(
            "country_name"
        ),
    )
    return joined.select("c_custkey", F.inline(F.array(nation, region)))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file listing: one snapshot file per event, by event type.

    The event id in the path keeps paths unique, as they are in a real listing.
    """
    ts = F.col("ts").cast("timestamp")
    stamp = F.date_format(ts, "yyyyMMdd_HHmmss")
    prefix = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        prefix.alias("prefix"),
        F.concat(
            F.col("event_id").cast("string"), F.lit("/"), prefix, F.lit("_"), stamp, F.lit(".json")
        ).alias("path"),
        ts.alias("modification_time"),
    )
