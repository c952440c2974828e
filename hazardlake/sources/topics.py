"""Topics of JSON messages, on Kafka or as folders of files.

Files are Parquet by default: the values are compressed, and a JSON value does not have to
be escaped into, and parsed out of, another JSON line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.schemas import MESSAGE

FILES = "parquet"
#: Bytes of landed files that a micro-batch takes; a larger backlog is several of them. Messages are about ten
#: times as large in memory, beside what is parsed out of them.
BATCH_BYTES = 64 << 20
#: Bytes of a row group of landed messages, compressed. A file is split at row groups, and a reader holds the
#: values of up to 4096 rows of one: with the usual size, hundreds of megabytes of whole documents.
GROUP_BYTES = 2 << 20


def _kafka_messages(df: DataFrame) -> DataFrame:
    return df.select(
        F.concat_ws("/", "topic", "partition", "offset").alias("message_id"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def read_stream(spark: SparkSession, topic: str, fmt: str = FILES, **options: str) -> DataFrame:
    """Messages of a topic from the earliest on, as ``(message_id, key, value)``.

    ``topic`` is a topic name for Kafka and a folder otherwise. Progress is kept in the
    checkpoint of the query that reads the stream. A micro-batch of a folder takes files of
    ``BATCH_BYTES`` unless the options say how much, so what its tasks hold does not grow with the
    backlog; for Kafka ``maxOffsetsPerTrigger`` says it, in messages.
    """
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", topic)
        reader = reader.option("startingOffsets", "earliest").options(**options)
        return _kafka_messages(reader.load())
    if not {"maxfilespertrigger", "maxbytespertrigger"} & {name.lower() for name in options}:
        options["maxBytesPerTrigger"] = str(BATCH_BYTES)
    return spark.readStream.schema(MESSAGE).options(**options).format(fmt).load(topic)


def read_messages(spark: SparkSession, topic: str, fmt: str = FILES) -> DataFrame:
    """The messages of a file-backed topic as a batch."""
    return spark.read.schema(MESSAGE).format(fmt).load(topic)


def as_message(message_id: Column, key: str, value: Column) -> list[Column]:
    return [message_id.alias("message_id"), F.lit(key).alias("key"), value.alias("value")]


def records_as_messages(df: DataFrame, message_id: Column, key: str) -> DataFrame:
    """One message per row, its value the row as a JSON object."""
    record = F.to_json(F.struct(*df.columns))
    return df.select(*as_message(message_id, key, record))


def publish(
    df: DataFrame, topic: str, fmt: str = FILES, mode: str = "append", **options: str
) -> None:
    """Write ``(message_id, key, value)`` rows to a topic."""
    if fmt == "kafka":
        df.select("key", "value").write.format("kafka").option("topic", topic).options(
            **options
        ).save()
    else:
        if fmt == "parquet":
            options = {"parquet.block.size": str(GROUP_BYTES)} | options
        df.select("message_id", "key", "value").write.format(fmt).mode(mode).options(
            **options
        ).save(topic)
