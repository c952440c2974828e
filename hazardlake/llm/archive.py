"""A content-addressed web archive: payloads once by digest, exact record headers apart.

``write_archive`` lays down two tables. ``payloads`` has each distinct payload once, by its
SHA-256; ``records`` has one row for each record with its exact header lines, which name the
digest. ``read_records`` puts them together again through joins, and ``original_records`` gives
the records as they stand in a WARC file.

* Of records with equal payloads the first is a ``response``, the others are ``revisit`` records
  that refer to it. Only digests and ids meet in the grouping that finds the first.
* A payload that stands once is written by the task that read it. Those that may stand more than
  once move only where a filter of fixed size takes the row for the first of its digest, so the
  copies of a large group never move.
* Rows meet what belongs to their digest at one of ``SALTS`` copies of it: a payload that a third
  of all records share is not one task's.
* Digests are strong and verified: copies must agree with the first in length and in a second
  hash when they are written, and readers hash the stored bytes again. A difference fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm.common import SALTS, maybe_in, spread_join, stored
from hazardlake.session import scratch_path

#: Payloads of fewer bytes are stored once too, but their records never refer to others.
LEAST = 100
#: Date of records that bring none.
DATE = "1970-01-01T00:00:00Z"
#: Profile of revisit records with an identical payload digest (fixed value of the format).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_END = "\r\n"


def _uuid(text: Column) -> Column:
    """A record id that depends on nothing but the text."""
    hexed = F.sha2(text, 256)
    parts = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _safe(value: Column) -> Column:
    """A header value without line ends."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\r\n]+", " ")


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """Id of the record of a page; rows that agree in all three have the same."""
    return _uuid(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("none")), digest, _safe(url)))


def headers(page_id, url, kind, refers_to, refers_url, digest, size, date: str = DATE) -> tuple[Column, Column]:
    """The header lines of a record, and those of the response in its block."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_END))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}"),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", size.cast("string")),
        F.lit(_END),
    )
    revisit = kind == "revisit"
    block = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(size)
    warc = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", record_id(page_id, url, digest)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _safe(url)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", record_id(refers_to, refers_url, digest)),
                line("WARC-Refers-To-Target-URI", _safe(refers_url)),
                line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(_END),
    )
    return warc, http


def _field(name: str) -> Column:
    """The value of a header line, null if there is none."""
    found = F.regexp_extract("warc", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.col("warc").contains(f"{_END}{name}: "), found)


def _by_digest(rows: DataFrame, by: DataFrame, key: str, *spread: str) -> DataFrame:
    return spread_join(rows, by, [key], F.pmod(F.xxhash64(*spread), F.lit(SALTS)))


def _must(condition: Column, value: Column, message: str, what: Column) -> Column:
    return F.when(condition, value).otherwise(F.raise_error(F.concat(F.lit(message), F.coalesce(what, F.lit("none")))))


def write_archive(pages: DataFrame, folder: str, *, payload: str = "html", least: int = LEAST, date: str = DATE) -> None:
    """Write the records of ``pages`` (``page_id``, ``url`` and a payload column) below the new ``folder``.

    Payloads are the text in UTF-8, as its bytes stand (null is empty). Of equal payloads of at
    least ``least`` bytes, the one of the smallest ``page_id`` is the response and the others
    revisit it; rows that repeat that ``page_id`` with it are responses as well. A null
    ``page_id`` comes after all others; where all are null all are responses. Smaller payloads
    are all responses, stored once. ``url`` may be null. The columns other than the payload stay
    with their record in ``row``, whatever their names. An empty table gives an empty archive.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != payload])
    ids = [F.col("page_id").cast("long").alias("page_id"), F.sha2(body, 256).alias("digest")]
    described = pages.select(
        row.alias("row"),
        *ids,
        F.col("url").cast("string").alias("url"),
        F.octet_length(body).cast("long").alias("size"),
        F.xxhash64(body).alias("second"),
    )
    listed = stored(described, "listed")

    ranked = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    same = (
        listed.groupBy("digest")
        .agg(
            F.count("*").alias("copies"),
            F.min("page_id").alias("first"),
            F.min_by("url", ranked).alias("first_url"),
            F.min(F.struct("size", "second")).alias("low"),
            F.max(F.struct("size", "second")).alias("high"),
        )
        .filter("copies > 1")
        .select("digest", _must(F.col("low") == F.col("high"), F.col("first"), "two payloads of digest ", F.col("digest")).alias("first"), "first_url")
    )
    same = stored(same, "same")

    # what the filter takes for a copy and is none counts as the first of its digest
    key = lambda *c: F.xxhash64(*c).alias("key")
    copied = maybe_in(same.select(key("digest")))(key("digest"))
    taken = listed.filter(copied).select("digest", "page_id").join(same, "digest", "left_anti")
    firsts = same.select(key("digest", "first")).unionByName(taken.select(key("digest", "page_id")))
    first = maybe_in(firsts)(key("digest", "page_id"))
    bodies = pages.select(*ids, body.alias("payload")).withColumn("copied", copied)
    alone = bodies.filter("NOT copied").select("digest", "payload")
    moved = bodies.filter("copied").filter(first).join(same.select("digest", "first"), "digest", "left")
    real = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    once = moved.filter(real).select("digest", "payload").dropDuplicates(["digest"])
    alone.unionByName(once).write.option("compression", "zstd").parquet(f"{folder}/payloads")

    marked = listed.withColumn("copied", copied)
    met = _by_digest(marked.filter("copied"), same, "digest", "page_id", "url")
    none = {"first": F.lit(None).cast("long"), "first_url": F.lit(None).cast("string")}
    every = met.unionByName(marked.filter("NOT copied").withColumns(none))
    again = F.col("first").isNotNull() & (F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = every.withColumn("kind", F.when(again, "revisit").otherwise("response"))
    warc, http = headers(*(F.col(c) for c in ("page_id", "url", "kind", "first", "first_url", "digest", "size")), date)
    records = typed.select("row", "page_id", warc.alias("warc"), http.alias("http"))
    records.write.option("compression", "zstd").parquet(f"{folder}/records")


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Stored payloads, hashed again."""
    rows = spark.read.parquet(f"{folder}/payloads")
    real = F.sha2("payload", 256)
    return rows.select(_must(real == F.col("digest"), real, "damaged payload ", F.col("digest")).alias("digest"), "payload")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/records").select(
        "row",
        "page_id",
        _field("WARC-Type").alias("kind"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Refers-To").alias("refers_to_id"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha256:(.*)$", 1).alias("digest"),
        "warc",
        "http",
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(row, page_id, kind, record_id, refers_to, digest, size, warc, http)`` of every record of an archive.

    All of it is read from the header lines, but ``digest`` and ``size``, which are those of the
    stored bytes, and ``refers_to``, the ``page_id`` of the record that a revisit names. A record
    whose payload or whose response is missing fails the job. No payload moves.
    """
    records = _records(spark, folder)
    sizes = _payloads(spark, folder).select("digest", F.octet_length("payload").cast("long").alias("size"))
    sized = _by_digest(records, sizes, "digest", "record_id")
    size = _must(F.col("size").isNotNull(), F.col("size"), "no payload ", F.col("digest"))
    answers = records.filter("kind = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    revisits = sized.filter("kind = 'revisit'")
    named = _by_digest(revisits, answers.distinct(), "refers_to_id", "record_id")
    refers_to = _must(F.col("refers_to").isNotNull(), F.col("refers_to"), "no response ", F.col("refers_to_id"))
    others = sized.filter("kind <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    every = others.unionByName(named.withColumn("refers_to", refers_to).select(*others.columns))
    return every.select("row", "page_id", "kind", "record_id", "refers_to", "digest", size.alias("size"), "warc", "http")


def original_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(row, record)``: the bytes of each record as they stand in a WARC file.

    A response gets its payload back from the store, a revisit has none. Concatenated in any
    order, plain or each as a gzip member, the records are a WARC file.
    """
    records = _records(spark, folder)
    whole = _by_digest(records.filter("kind <> 'revisit'"), _payloads(spark, folder), "digest", "record_id")
    payload = _must(F.col("payload").isNotNull(), F.col("payload"), "no payload ", F.col("digest"))
    head = F.concat("warc", "http").cast("binary")
    end = F.lit(2 * _END).cast("binary")
    answered = whole.select("row", F.concat(head, payload, end).alias("record"))
    return answered.unionByName(records.filter("kind = 'revisit'").select("row", F.concat(head, end).alias("record")))


def archived(pages: DataFrame, *, payload: str = "html") -> DataFrame:
    """``read_records`` of an archive written to the shared folder."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "archive")
    write_archive(pages, folder, payload=payload)
    return read_records(spark, folder)
