"""Streams from raw hazard documents to silver and gold."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from hazardlake import constants as K
from hazardlake import schemas as S
from hazardlake.operators import flatten as flat
from hazardlake.operators.aggregate import (
    GROUP,
    count_titles,
    TITLES_PER_ROW,
    document_titles,
    event_parts,
    event_stats,
    merge_event_parts,
    pack_titles,
)
from hazardlake.operators.project import add_analytics_meta, processing_meta
from hazardlake.sources.tables import (
    archive_snapshot,
    read_first_available,
    read_table,
    run_folder,
    write_table,
)
from hazardlake.schemas import TIMESTAMP, struct
from hazardlake.sources.topics import FILES, as_message, publish, read_stream

Trigger = Mapping[str, object]
POLL: Trigger = {"processingTime": K.POLL_INTERVAL}
ONCE: Trigger = {"availableNow": True}


@dataclass(frozen=True)
class Hazard:
    """What differs between the two event kinds."""

    name: str
    document: StructType
    items: str
    fields: flat.Fields
    classes: Callable
    silver: StructType
    time: Callable[[], Column]


QUAKE = Hazard(
    "earthquake",
    S.FEATURES_DOC,
    "features",
    flat.quake_fields,
    flat.quake_classes,
    S.QUAKE_SILVER,
    lambda: F.col("timestamp"),
)
VOLCANO = Hazard(
    "volcano",
    S.EVENTS_DOC,
    "events",
    flat.volcano_fields,
    flat.volcano_classes,
    S.VOLCANO_SILVER,
    lambda: F.col("date").try_cast("timestamp"),
)


# --- transformations, the same for batch and stream -----------------------------------
def parse(messages: DataFrame, hazard: Hazard) -> DataFrame:
    return flat.parse_documents(messages, hazard.document)


def silver_rows(messages: DataFrame, hazard: Hazard, now: Column | None = None) -> DataFrame:
    """Classified records of all documents, with the id of the message they came in."""
    return _rows(parse(messages, hazard), hazard, now)


def _rows(parsed: DataFrame, hazard: Hazard, now: Column | None) -> DataFrame:
    rows = flat.flatten(parsed, f"doc.{hazard.items}", hazard.fields, "message_id")
    classes = hazard.classes({name: F.col(name) for name in rows.columns})
    meta = processing_meta(now=now)
    wide = rows.select("*", *[c.alias(n) for n, c in classes.items()], *meta)
    return wide.select("message_id", *hazard.silver.fieldNames())


def silver_messages(messages: DataFrame, hazard: Hazard, now: Column | None = None) -> DataFrame:
    """One silver message per document: the JSON array of its records.

    Built inside the row, so no document is regrouped. Documents without records send
    nothing.
    """
    return _messages(parse(messages, hazard), hazard, now)


def _messages(parsed: DataFrame, hazard: Hazard, now: Column | None) -> DataFrame:
    def extra(record):
        meta = processing_meta(now=now)
        names = ["processing_timestamp", "layer", "processing_version"]
        return {**hazard.classes(record), **dict(zip(names, meta))}

    items = F.col(f"doc.{hazard.items}")
    names = hazard.silver.fieldNames()
    value = F.to_json(flat.records_array(items, hazard.fields, extra, names))
    return parsed.filter(F.size(items) > 0).select(
        *as_message(F.col("message_id"), f"{hazard.name}-silver", value)
    )


def quarantined(messages: DataFrame, hazard: Hazard) -> DataFrame:
    """Documents that could not be read in full, unchanged, with the reason."""
    return _bad_documents(parse(messages, hazard), hazard)


def _bad_documents(parsed: DataFrame, hazard: Hazard) -> DataFrame:
    bad = flat.corrupt_documents(parsed, hazard.items)
    return bad.select("message_id", "key", "value", "reason")


def _silver_array(hazard: Hazard) -> Column:
    return F.from_json("value", f"ARRAY<{hazard.silver.simpleString()}>")


def silver_records(messages: DataFrame, hazard: Hazard) -> DataFrame:
    """Records of silver messages, with the id of their message."""
    return flat.items_of(messages, _silver_array(hazard), "message_id").select("message_id", "_item.*")


def unreadable_records(messages: DataFrame, hazard: Hazard) -> DataFrame:
    """Silver messages that give no record although they are not an empty array."""
    records = messages.select(
        "message_id", "key", "value", F.explode(F.array(_silver_array(hazard))).alias("_records")
    )
    empty = F.coalesce(F.col("value").rlike(r"^\s*\[\s*\]\s*$"), F.lit(False))
    usable = F.coalesce(F.exists("_records", lambda r: r.isNotNull()), F.lit(False))
    return records.filter(~usable & ~empty).select(
        "message_id", "key", "value", F.lit("unparseable").alias("reason")
    )


def gold_per_message(
    messages: DataFrame,
    hazard: Hazard,
    exact_scale: int | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Statistics of each silver message on its own, by region and severity."""
    records = silver_records(messages, hazard)
    keys = ["message_id", *GROUP]
    if hazard is QUAKE:
        stats = event_stats(records, keys, exact_scale=exact_scale)
    else:
        stats = document_titles(records, keys)
    return add_analytics_meta(stats, hazard.name, now=now)


def gold_messages(gold: DataFrame, hazard: Hazard) -> DataFrame:
    """One gold message per silver message: its groups as a JSON array of objects.

    At most one group per region and severity, so the array has a fixed bound.
    """
    record = F.struct(*[c for c in gold.columns if c != "message_id"])
    grouped = gold.groupBy("message_id").agg(F.to_json(F.collect_list(record)).alias("_value"))
    return grouped.select(
        *as_message(F.col("message_id"), f"{hazard.name}-gold", F.col("_value"))
    )


# --- streaming queries ----------------------------------------------------------------
def _each_batch(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger,
    mode: str = "append",
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(handle)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


#: Column, and name of folders, of the number of a micro-batch.
BATCH = "batch_id"


def _batch_folder(path: str, batch_id: int) -> str:
    """Each batch has its folder and replaces it when it runs again after a failure."""
    return run_folder(path, batch_id, BATCH)


def _add(rows: DataFrame, table: str, batch_id: int, fmt: str = "parquet", shares: int | None = None) -> None:
    """Rows of a batch into a table partitioned by region and severity, once however often it runs."""
    write_table(rows, _batch_folder(table, batch_id), partition_by=GROUP, fmt=fmt, shares=shares)


def _beside(path: str, name: str) -> str:
    return f"{path.rstrip('/')}_{name}"


def _publish_batch(out, topic, fmt, batch_id, options) -> None:
    if fmt == "kafka":
        publish(out, topic, "kafka", **options)
    else:
        publish(out, _batch_folder(topic, batch_id), fmt, "overwrite", **options)


def _keep_bad(bad: DataFrame, quarantine: str, batch_id: int) -> None:
    if not bad.isEmpty():
        bad.write.mode("overwrite").json(_batch_folder(quarantine, batch_id))


#: Groups of ids, each one entry of the state store.
ID_GROUPS = 256
#: Tasks of a query with state, at most: each opens and commits a store in every micro-batch, however little it has.
STATE_TASKS = 32
#: Tasks that share a region and severity of a micro-batch, at most, and so its files.
SHARES = 2
_FIRST, _LAST = datetime(1700, 1, 1), datetime(2200, 1, 1)
_SEEN = "seen binary"
_COUNTED = "row string, late boolean"
_TIMES = pa.schema([("id", pa.string()), ("at", pa.int64())])


@contextmanager
def _tasks_at_most(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries started here have no more shuffle partitions; they keep the number in their checkpoint."""
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(min(int(usual), most)))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def _count_once(gap: int):
    """Rows of a group of ids that count, given the times that counted before, as the state has them.

    Only the ids of the batch become Python objects; what else the state has stays in its arrays. They lie in
    the store as one compressed Arrow batch, as each is read and written in every micro-batch.
    """

    # nested, so that workers need not import this module
    def packed(times: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, times.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(times.combine_chunks())
        return sink.getvalue().to_pybytes()

    def unpacked(seen: bytes) -> pa.Table:
        return pa.ipc.open_stream(pa.py_buffer(bytes(seen))).read_all()

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # before the second batch there is no watermark and nothing can be late
        horizon = state.getCurrentWatermarkMs() * 1000 or None
        seen = unpacked(state.get[0]) if state.exists else _TIMES.empty_table()
        live = seen
        if horizon is not None:
            live = seen.filter(pc.greater_equal(seen["at"], pa.scalar(max(horizon - gap, -(1 << 63)), pa.int64())))
        waiting = {}
        for frame in frames:
            late = frame["told"] & (frame["at"] < horizon) if horizon is not None else frame["told"] & False
            done = frame[late | ~frame["told"]]
            if len(done):
                yield pd.DataFrame({"row": done["row"], "late": late[done.index]})
            for name, at, row in frame.loc[frame["told"] & ~late, ["id", "at", "row"]].itertuples(index=False):
                waiting[name, at] = min(row, waiting.get((name, at), row))
        known = defaultdict(list)
        if waiting and len(live):
            again = live.filter(pc.is_in(live["id"], value_set=pa.array({name for name, _ in waiting}, pa.string())))
            for name, at in zip(again["id"].to_pylist(), again["at"].to_pylist(), strict=True):
                known[name].append(at)
        counted = []
        for name, at in sorted(waiting):
            if all(abs(at - t) > gap for t in known[name]):
                known[name].append(at)
                counted.append((name, at))
        if counted or len(live) < len(seen):
            new = pa.table([[name for name, _ in counted], [at for _, at in counted]], schema=_TIMES)
            state.update((packed(pa.concat_tables([live, new])),))
        if counted:
            yield pd.DataFrame({"row": [waiting[one] for one in counted], "late": False})

    return run


def deduplicated(rows: DataFrame, span: str, time: Column, groups: int = ID_GROUPS) -> DataFrame:
    """Streamed rows of which an ``id`` counts once within a time span, and ``late`` beside them.

    Of the times of an id, in order, each counts that is further than the span from every one that
    counted, whatever batches they come in. The times that counted are state of the query: they
    lie in Spark's state store, one entry for a group of ids, are restored with its
    checkpoint, and go once the watermark has passed them by the span, so the state is as
    large as the ids of two spans. Of rows that agree in id and time one stays. Rows without an id or a
    time cannot be told apart and all stay. Events older than the watermark (the newest event of earlier batches,
    less the span) may have counted before: they come out with ``late`` set, all of them.
    """
    spark = rows.sparkSession
    gap = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {span}"))).first()[0]
    # the row is one text while it is outside the JVM; times are numbers in it, to the microsecond. Its names are
    # short, as they are much of it, and in the order of the columns' names, so texts compare as with those
    times = [f.name for f in rows.schema if isinstance(f.dataType, TimestampType)]
    short = {c: f"{i:0{len(str(len(rows.columns)))}}" for i, c in enumerate(sorted(rows.columns))}
    flat_type = StructType([StructField(short[f.name], LongType() if f.name in times else f.dataType) for f in rows.schema])
    told = F.col("id").isNotNull() & F.col("_time").isNotNull()
    text = F.to_json(F.struct(*[(F.unix_micros(c) if c in times else F.col(c)).alias(short[c]) for c in rows.columns]))
    keyed = rows.withColumns({"_time": time, "_row": text}).select(
        F.col("_row").alias("row"),
        # pandas has no times beyond these; the watermark does not need them
        F.when(told, F.greatest(F.least("_time", F.lit(_LAST)), F.lit(_FIRST))).alias("_time"),
        "id",
        F.coalesce(F.unix_micros("_time"), F.lit(0).cast("bigint")).alias("at"),
        told.alias("told"),
        F.pmod(F.when(told, F.xxhash64("id")).otherwise(F.xxhash64("_row")), F.lit(groups)).alias("lot"),
    )
    grouped = keyed.withWatermark("_time", span).groupBy("lot")
    out = grouped.applyInPandasWithState(_count_once(gap), _COUNTED, _SEEN, "append", GroupStateTimeout.NoTimeout)
    back = out.select(F.from_json("row", flat_type).alias("r"), "late")
    fields = {c: F.col("r")[short[c]] for c in rows.columns}
    return back.select(*[(F.timestamp_micros(f) if c in times else f).alias(c) for c, f in fields.items()], "late")


def silver_stream(
    messages: DataFrame,
    hazard: Hazard,
    table: str,
    checkpoint: str,
    topic: str | None = None,
    quarantine: str | None = None,
    dedup: str | None = None,
    late: str | None = None,
    trigger: Trigger = POLL,
    topic_format: str = FILES,
    topic_options: Mapping[str, str] | None = None,
    table_format: str = "parquet",
    now: Column | None = None,
) -> dict[str, StreamingQuery]:
    """Documents to the silver table, the quarantine and, if asked, the silver topic.

    One query reads and parses each document once for all outputs. The table is partitioned by
    batch, region and severity; topic and quarantine have a folder for each batch. A batch
    that runs again replaces what it wrote; its rows are rebalanced, so its files are few. Kafka
    output is at least once.

    What cannot be read goes to ``quarantine`` (by default ``<table>_quarantine``). Re-sent
    events are all kept, unless ``dedup`` gives the time span within which an id counts
    once (see ``deduplicated``); events later than that span then go to ``late`` (by default
    ``<table>_late``). As that table is all that comes out of a query with state, topic and
    quarantine then have a query of their own, ``documents``.
    """
    quarantine = quarantine or _beside(table, "quarantine")
    late = late or _beside(table, "late")

    def outputs(parsed: DataFrame, batch_id: int) -> None:
        if topic:
            sent = _messages(parsed, hazard, now)
            _publish_batch(sent, topic, topic_format, batch_id, topic_options or {})
        _keep_bad(_bad_documents(parsed, hazard), quarantine, batch_id)

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch, hazard).persist()
        if not parsed.isEmpty():
            if not dedup:
                _add(_rows(parsed, hazard, now), table, batch_id, table_format)
            outputs(parsed, batch_id)
        parsed.unpersist()

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if not batch.isEmpty():
            # planned without adaptive execution, as is all of a query with state
            _add(batch.filter("NOT late").drop("late"), table, batch_id, table_format, shares=SHARES)
            behind = batch.filter("late").drop("late")
            if not behind.isEmpty():
                write_table(behind, _batch_folder(late, batch_id), fmt=table_format)
        batch.unpersist()

    if not dedup:
        return {"table": _each_batch(messages, handle, f"{checkpoint}/table", trigger)}
    counted = deduplicated(silver_rows(messages, hazard, now), dedup, hazard.time())
    with _tasks_at_most(messages.sparkSession, STATE_TASKS):
        kept = _each_batch(counted, keep, f"{checkpoint}/table", trigger)
    return {"table": kept, "documents": _each_batch(messages, handle, f"{checkpoint}/documents", trigger)}


def gold_stream(
    messages: DataFrame,
    hazard: Hazard,
    table: str,
    checkpoint: str,
    topic: str | None = None,
    mode: str = "per_batch",
    quarantine: str | None = None,
    trigger: Trigger = POLL,
    topic_format: str = FILES,
    topic_options: Mapping[str, str] | None = None,
    exact_scale: int | None = None,
    now: Column | None = None,
) -> dict[str, StreamingQuery]:
    """Silver messages to gold statistics, and unreadable ones to the quarantine.

    ``per_batch`` writes the groups of every message, never merged across messages.
    ``running`` writes what the records of each batch add to the totals over all messages, in
    parts that merge; ``read_running`` gives the totals. No state is kept: a title costs a row
    in the batches it occurs in, nothing in memory. Both tables are partitioned by batch,
    region and severity, and a batch that is repeated after a failure replaces its rows.
    """
    quarantine = quarantine or _beside(table, "quarantine")
    if mode not in ("per_batch", "running"):
        raise ValueError(f"unknown mode: {mode}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if not batch.isEmpty():
            if mode == "running":
                _add(running_parts(batch, hazard, exact_scale, now), table, batch_id)
            else:
                gold = gold_per_message(batch, hazard, exact_scale, now)
                if topic:
                    gold = gold.persist()
                _add(gold, table, batch_id)
                if topic:
                    sent = gold_messages(gold, hazard)
                    _publish_batch(sent, topic, topic_format, batch_id, topic_options or {})
                    gold.unpersist()
            _keep_bad(unreadable_records(batch, hazard), quarantine, batch_id)
        batch.unpersist()

    return {"table": _each_batch(messages, handle, checkpoint, trigger)}


def running_parts(
    messages: DataFrame, hazard: Hazard, exact_scale: int | None = None, now: Column | None = None
) -> DataFrame:
    """What silver messages add to the running totals: sums of statistics, or copies of titles."""
    records = silver_records(messages, hazard)
    parts = event_parts(records, exact_scale=exact_scale) if hazard is QUAKE else count_titles(records)
    return add_analytics_meta(parts, hazard.name, now=now)


_META = ("layer", "analytics_version", "data_type")


def merge_running(parts: DataFrame, hazard: Hazard, per_row: int = TITLES_PER_ROW) -> DataFrame:
    """Totals out of running parts, with the time of the last part of each group."""
    meta = [F.max(c).alias(c) for c in ("analytics_timestamp", *_META)]
    if hazard is QUAKE:
        return merge_event_parts(parts, GROUP, *meta)
    counted = parts.groupBy(*GROUP, "title").agg(F.sum("copies").alias("copies"))
    lists = pack_titles(counted, per_row=per_row)
    newest = parts.groupBy(*GROUP).agg(*meta)
    # at most one row for each region and severity
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"m.{k}")) for k in GROUP])
    columns = [f"m.{c}" for c in ("analytics_timestamp", *_META)]
    return lists.alias("l").join(F.broadcast(newest.alias("m")), same).select("l.*", *columns)


def read_running(
    spark: SparkSession, table: str, hazard: Hazard, per_row: int = TITLES_PER_ROW
) -> DataFrame:
    """Totals of a table written by a running gold stream: one aggregation over its parts."""
    return merge_running(read_table(spark, table).drop(BATCH), hazard, per_row)


def archive_stream(
    messages: DataFrame, folder: str, kind: str, checkpoint: str, trigger: Trigger = POLL
) -> StreamingQuery:
    """Keep every raw document as a snapshot of its batch.

    The time in a snapshot's name is noted before the first attempt, so that a batch that
    runs again replaces its snapshot instead of leaving a second one.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        note = _batch_folder(_beside(checkpoint, "taken"), batch_id)
        layout = struct(taken=TIMESTAMP)
        noted = read_first_available(spark, [lambda: spark.read.schema(layout).parquet(note)], layout)
        noted = noted.collect()
        if noted:
            taken = noted[0].taken
        else:
            taken = datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)
            row = spark.range(1).select(F.lit(taken.isoformat()).cast("timestamp").alias("taken"))
            write_table(row, note, files=1)
        archive_snapshot(batch, folder, kind, taken, batch_id)

    return _each_batch(messages, handle, checkpoint, trigger)


def tail_stream(
    messages: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None] | None = None,
    trigger: Trigger = POLL,
) -> StreamingQuery:
    """Show each message on the console, or hand each batch to a function."""
    if handle:
        return _each_batch(messages, handle, checkpoint, trigger)
    writer = messages.writeStream.format("console").option("truncate", False)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _layer(hazard: Hazard, step: str):
    def run(spark, source, fmt, options, **settings):
        messages = read_stream(spark, source, fmt, **options)
        if step == "bronze":
            return silver_stream(messages, hazard, **settings)
        if step == "silver":
            return gold_stream(messages, hazard, **settings)
        return tail_stream(messages, **settings)

    return run


LAYERS = {
    "bronze": _layer(QUAKE, "bronze"),
    "volcano-bronze": _layer(VOLCANO, "bronze"),
    "silver": _layer(QUAKE, "silver"),
    "volcano-silver": _layer(VOLCANO, "silver"),
    "gold": _layer(QUAKE, "gold"),
    "volcano-gold": _layer(VOLCANO, "gold"),
}


def start(
    layer: str,
    spark: SparkSession,
    source: str,
    fmt: str = FILES,
    options: Mapping[str, str] | None = None,
    **settings,
):
    """Start the stream that consumes a layer's topic."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}; one of {', '.join(LAYERS)}")
    return LAYERS[layer](spark, source, fmt, options or {}, **settings)
