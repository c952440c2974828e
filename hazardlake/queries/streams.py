"""Stream queries: documents of the tables go through topics until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import adapters as A
from hazardlake import schemas as S
from hazardlake.operators import flatten as flat
from hazardlake.operators import aggregate as G
from hazardlake.operators.aggregate import GROUP
from hazardlake.queries import sql
from hazardlake.queries.registry import query
from hazardlake.session import scratch_path
from hazardlake.sources.feeds import read_documents
from hazardlake.sources.tables import run_folder, write_table
from hazardlake.sources.topics import publish, read_messages, read_stream, records_as_messages
from hazardlake.streaming import hazards as H
from hazardlake.streaming.supervise import ProgressLog, supervise

_QUAKE_SILVER = f"""WITH {sql.FLAT} SELECT region, severity_level, COUNT(*) AS n,
    CAST(SUM(event_id) AS BIGINT) AS ids, COUNT(depth) AS depths FROM flat GROUP BY 1, 2"""
_QUAKE_STATS = f"""COUNT(*) AS earthquake_count, {sql.exact_mean("magnitude", 5)} AS avg_magnitude,
    MAX(magnitude) AS max_magnitude, MIN(magnitude) AS min_magnitude,
    {sql.exact_mean("depth", 5)} AS avg_depth, CAST(SUM(tsunami) AS BIGINT) AS tsunami_count,
    'gold' AS layer, '1.0' AS analytics_version, 'earthquake' AS data_type"""
_DOC = f"CAST(event_id // {A.DOCUMENT_SIZE} AS VARCHAR)"


def _landed(spark, documents):
    topic = scratch_path(spark, "topic")
    publish(documents, topic)
    return topic


def _silver_groups(rows):
    return rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("id").cast("bigint")).alias("ids"),
        F.count("depth").alias("depths"),
    )


def _silver(spark, documents, hazard, *outputs, dedup=None):
    """Documents through the silver stream; paths of the table and the other outputs."""
    root = scratch_path(spark, "silver")
    paths = {name: f"{root}/{name}" for name in ("table", *outputs)}
    messages = read_stream(spark, _landed(spark, documents))
    started = H.silver_stream(
        messages, hazard, checkpoint=f"{root}/checkpoint", dedup=dedup, trigger=H.ONCE, **paths
    )
    for running in started.values():
        running.awaitTermination()
    return paths


@query(_QUAKE_SILVER)
def stream_quake_silver(spark, sf_dir):
    paths = _silver(spark, A.quake_documents(spark, sf_dir), H.QUAKE)
    return _silver_groups(spark.read.parquet(paths["table"]))


@query(
    f"""WITH {sql.VOLCANOES} SELECT region, severity_level, COUNT(*) AS n,
    CAST(SUM(event_id) AS BIGINT) AS ids, COUNT(date) AS dates FROM volcanoes GROUP BY 1, 2"""
)
def stream_volcano_silver(spark, sf_dir):
    paths = _silver(spark, A.volcano_documents(spark, sf_dir), H.VOLCANO)
    return (
        spark.read.parquet(paths["table"])
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("id").cast("bigint")).alias("ids"),
            F.count("date").alias("dates"),
        )
    )


@query(_QUAKE_SILVER)
def stream_silver_topic(spark, sf_dir):
    """The records as they are published to the silver topic."""
    paths = _silver(spark, A.quake_documents(spark, sf_dir), H.QUAKE, "topic")
    return _silver_groups(H.silver_records(read_messages(spark, paths["topic"]), H.QUAKE))


def _gold(spark, documents, hazard, topic=False, **settings):
    """Silver messages of the documents through the gold stream; paths of its outputs."""
    silver = _landed(spark, H.silver_messages(documents, hazard))
    root = scratch_path(spark, "gold")
    started = H.gold_stream(
        read_stream(spark, silver, maxFilesPerTrigger="4"),
        hazard,
        f"{root}/table",
        f"{root}/checkpoint",
        topic=f"{root}/topic" if topic else None,
        trigger=H.ONCE,
        **settings,
    )
    for running in started.values():
        running.awaitTermination()
    return root


@query(
    f"""WITH {sql.FLAT} SELECT {_DOC} AS message_id, region, severity_level, {_QUAKE_STATS}
    FROM flat GROUP BY 1, 2, 3"""
)
def stream_quake_gold(spark, sf_dir):
    root = _gold(spark, A.quake_documents(spark, sf_dir), H.QUAKE, exact_scale=5)
    gold = spark.read.parquet(f"{root}/table")
    return gold.drop("batch_id", "analytics_timestamp")


@query(f"WITH {sql.FLAT} SELECT region, severity_level, {_QUAKE_STATS} FROM flat GROUP BY 1, 2")
def stream_quake_gold_running(spark, sf_dir):
    documents = A.quake_documents(spark, sf_dir)
    root = _gold(spark, documents, H.QUAKE, mode="running", exact_scale=5)
    return H.read_running(spark, f"{root}/table", H.QUAKE).drop("analytics_timestamp")


_TITLES = """COUNT(*) AS volcano_count, array_to_string(list_sort(list(title)), '|') AS titles"""


@query(
    f"""WITH {sql.VOLCANOES} SELECT {_DOC} AS message_id, region, severity_level, {_TITLES}
    FROM volcanoes GROUP BY 1, 2, 3"""
)
def stream_volcano_gold(spark, sf_dir):
    root = _gold(spark, A.volcano_documents(spark, sf_dir), H.VOLCANO)
    return spark.read.parquet(f"{root}/table").select(
        "message_id",
        *GROUP,
        "volcano_count",
        F.array_join("volcano_titles", "|").alias("titles"),
    )


@query(
    f"""WITH {sql.VOLCANOES} SELECT region, severity_level, title, COUNT(*) AS copies
    FROM volcanoes GROUP BY 1, 2, 3"""
)
def stream_volcano_gold_running(spark, sf_dir):
    """The running title lists, taken apart again; long lists come in several rows."""
    documents = A.volcano_documents(spark, sf_dir)
    root = _gold(spark, documents, H.VOLCANO, mode="running")
    gold = H.read_running(spark, f"{root}/table", H.VOLCANO, per_row=200)
    titles = gold.select(*GROUP, F.explode("volcano_titles").alias("title"))
    return titles.groupBy(*GROUP, "title").agg(F.count(F.lit(1)).alias("copies"))


@query(
    f"""WITH {sql.FLAT}, groups AS (SELECT {_DOC} AS message_id, region, severity_level,
    COUNT(*) AS n FROM flat GROUP BY 1, 2, 3) SELECT message_id, COUNT(*) AS n_groups,
    CAST(SUM(n) AS BIGINT) AS n_events FROM groups GROUP BY 1"""
)
def stream_gold_topic(spark, sf_dir):
    """The groups as they are published to the gold topic, one message per document."""
    root = _gold(spark, A.quake_documents(spark, sf_dir), H.QUAKE, topic=True)
    layout = "ARRAY<STRUCT<region: STRING, severity_level: STRING, earthquake_count: BIGINT>>"
    messages = read_messages(spark, f"{root}/topic")
    groups = messages.select("message_id", F.inline(F.from_json("value", layout)))
    return groups.groupBy("message_id").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("earthquake_count").alias("n_events")
    )


@query("SELECT CAST(event_id AS VARCHAR) AS message_id, event_type FROM events")
def publish_records(spark, sf_dir):
    """One message per record, read back as a stream."""
    rows = A.table(spark, sf_dir, "events").select("event_id", "event_type")
    topic = _landed(spark, records_as_messages(rows, F.col("event_id").cast("string"), "event"))
    kind = F.get_json_object("value", "$.event_type").alias("event_type")
    return read_messages(spark, topic).select("message_id", kind)


@query(
    """SELECT 'once' AS kind, COUNT(*) AS n FROM events
    UNION ALL SELECT 'without id', COUNT(*) FROM events
    UNION ALL SELECT 'without time', COUNT(*) FROM events
    UNION ALL SELECT 'late', COUNT(*) FROM events"""
)
def stream_deduplicated(spark, sf_dir):
    """Every document is sent twice, and once each without ids, without times, and long after.

    The span covers all events but the last kind, so each id counts once; nothing is lost.
    """
    documents = A.quake_documents(spark, sf_dir)

    def changed(tag, old, new):
        return documents.withColumns(
            {
                "message_id": F.concat("message_id", F.lit(f"-{tag}")),
                "value": F.regexp_replace("value", old, new),
            }
        )

    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "silver")
    first = documents.unionByName(changed("again", "^", "")).unionByName(changed("idless", '"id":', '"no":'))
    # one run each, so that the last documents come after the others
    for sent in (
        first.unionByName(changed("timeless", '"time":', '"when":')),
        changed("late", r'"id":"?(\d+)"?', '"id":"late-$1"').withColumn(
            "value", F.regexp_replace("value", r'"time":1[67]', '"time":15')
        ),
    ):
        publish(sent, topic)
        started = H.silver_stream(
            read_stream(spark, topic), H.QUAKE, f"{root}/table", f"{root}/checkpoint",
            dedup="60 days", late=f"{root}/late", trigger=H.ONCE,
        )
        for running in started.values():
            running.awaitTermination()
    kind = F.when(F.col("id").isNull(), "without id").when(F.col("timestamp").isNull(), "without time")
    kept = spark.read.parquet(f"{root}/table").select(kind.otherwise("once").alias("kind"))
    late = spark.read.parquet(f"{root}/late").select(F.lit("late").alias("kind"))
    return kept.unionByName(late).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT 'good' AS kind, COUNT(*) AS n FROM events
    UNION ALL SELECT 'unparseable', COUNT(DISTINCT event_id // {A.DOCUMENT_SIZE}) FROM events"""
)
def stream_bad_silver(spark, sf_dir):
    """Each silver message also comes cut off; those end up in the quarantine of the gold stream."""
    silver = H.silver_messages(A.quake_documents(spark, sf_dir), H.QUAKE)
    broken = silver.withColumn("value", F.concat(F.lit("[{not json"), "value"))
    topic, root = _landed(spark, silver.unionByName(broken)), scratch_path(spark, "gold")
    H.gold_stream(
        read_stream(spark, topic), H.QUAKE, f"{root}/table", f"{root}/checkpoint", trigger=H.ONCE
    )["table"].awaitTermination()
    good = spark.read.parquet(f"{root}/table").agg(F.sum("earthquake_count").alias("n"))
    bad = spark.read.schema("reason STRING").json(f"{root}/table_quarantine")
    return good.select(F.lit("good").alias("kind"), "n").unionByName(
        bad.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    f"""WITH {sql.FLAT}, wide AS (SELECT DISTINCT {_DOC} AS message_id FROM flat)
    SELECT 'records' AS output, COUNT(*) AS n FROM flat
    UNION ALL SELECT 'messages', COUNT(*) FROM wide UNION ALL SELECT 'bad', COUNT(*) FROM wide"""
)
def stream_all_outputs(spark, sf_dir):
    """Table, topic and quarantine out of one reading of the topic."""
    documents = A.quake_documents(spark, sf_dir)
    broken = documents.withColumn("value", F.concat(F.lit("{bad "), "value"))
    paths = _silver(spark, documents.unionByName(broken), H.QUAKE, "topic", "quarantine")
    counts = {
        "records": spark.read.parquet(paths["table"]),
        "messages": read_messages(spark, paths["topic"]),
        "bad": spark.read.schema("reason STRING").json(paths["quarantine"]),
    }
    return G.layer_counts(counts).select(F.col("layer").alias("output"), F.col("records").alias("n"))


@query(
    f"""SELECT DISTINCT {_DOC} || '-bad' AS message_id, 'unparseable' AS reason FROM events"""
)
def stream_quarantine(spark, sf_dir):
    """Each document also comes as one that is no JSON; those end up in the quarantine."""
    documents = A.quake_documents(spark, sf_dir)
    broken = documents.withColumns(
        {
            "message_id": F.concat("message_id", F.lit("-bad")),
            "value": F.concat(F.lit("{bad "), "value"),
        }
    )
    paths = _silver(spark, documents.unionByName(broken), H.QUAKE, "quarantine")
    bad = spark.read.schema("message_id STRING, reason STRING").json(paths["quarantine"])
    return bad.select("message_id", "reason")


@query("SELECT COUNT(*) AS messages, CAST(SUM(n) AS BIGINT) AS features FROM "
       f"(SELECT COUNT(*) AS n FROM events GROUP BY event_id // {A.DOCUMENT_SIZE})")
def stream_tail(spark, sf_dir):
    """Messages handed over batch by batch, sized, and kept."""
    topic = _landed(spark, A.quake_documents(spark, sf_dir))
    root = scratch_path(spark, "tail")

    def keep(batch, batch_id):
        sizes = F.size(F.from_json("value", "features ARRAY<STRUCT<id: STRING>>")["features"])
        batch.select("message_id", sizes.alias("n")).write.mode("overwrite").parquet(
            f"{root}/out/batch_id={batch_id}"
        )

    H.start(
        "gold", spark, topic, checkpoint=f"{root}/checkpoint", handle=keep, trigger=H.ONCE
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("n").alias("features")
    )


@query(
    f"""WITH {sql.FLAT} SELECT region, severity_level, COUNT(*) AS n FROM flat GROUP BY 1, 2
    UNION ALL SELECT 'failures', '', 1
    UNION ALL SELECT 'messages in the log', '', COUNT(DISTINCT {_DOC}) FROM flat"""
)
def stream_supervised(spark, sf_dir):
    """A stream whose first attempt fails after its write is started again and counts nothing twice."""
    topic = _landed(spark, A.quake_documents(spark, sf_dir))
    root = scratch_path(spark, "supervised")
    attempts = []
    log = ProgressLog()

    def keep(batch, batch_id):
        rows = H.silver_rows(batch, H.QUAKE)
        write_table(rows, run_folder(f"{root}/table", batch_id, H.BATCH), partition_by=GROUP)
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost after the write")

    def start():
        messages = read_stream(spark, topic)
        return H.tail_stream(messages, f"{root}/checkpoint", keep, H.ONCE)

    spark.streams.addListener(log)
    try:
        failures = supervise(start, wait_seconds=0.1, attempts=3)
        log.wait_for("ended")
    finally:
        spark.streams.removeListener(log)
    seen = log.rows(spark).filter("event = 'progress'").agg(F.sum("input_rows").alias("n"))
    groups = spark.read.parquet(f"{root}/table").groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    known = spark.range(1).select(F.lit("failures").alias("region"), F.lit("").alias("severity_level"), F.lit(failures).cast("bigint").alias("n"))
    counted = seen.select(F.lit("messages in the log").alias("region"), F.lit("").alias("severity_level"), "n")
    return groups.unionByName(known).unionByName(counted)


@query(f"WITH {sql.FLAT} SELECT id, magnitude FROM flat")
def stream_archive(spark, sf_dir):
    topic = _landed(spark, A.quake_documents(spark, sf_dir))
    root = scratch_path(spark, "archived")
    H.archive_stream(
        read_stream(spark, topic), f"{root}/raw", "earthquakes", f"{root}/checkpoint", H.ONCE
    ).awaitTermination()
    documents = read_documents(spark, f"{root}/raw/*", S.FEATURES_DOC, multi_line=False)
    return flat.flatten_features(documents, "features").select("id", "magnitude")
