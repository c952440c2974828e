"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes says where a text may be cut. Chunk lengths are normalised:
up to ``NORMAL`` bytes a cut needs four times rarer hashes, beyond it four times more frequent ones.
Since a cut depends on nothing but the bytes before it, an insertion changes the chunks around
it only. The fingerprint is the set of chunk digests, each with its chunk's length; how much
of the smaller set's length the other one holds is the likeness.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.common import BYTE_VALUES, slices, span_hashes, texts_of, width

SHORTEST, NORMAL, LONGEST = 16, 64, 256
_BITS = NORMAL.bit_length() - 1
_WINDOW = 32

#: One 32-bit value for each byte; the zero byte has none, so padding does not reach a text.
_GEAR = (BYTE_VALUES >> np.uint64(32)).astype(np.uint32)
_GEAR[0] = 0


def _gear(data: np.ndarray) -> np.ndarray:
    """Sum of the gear values of the last 32 bytes, each shifted by its distance."""
    h = _GEAR[data]
    width = 1
    while width < _WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def fingerprint_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the sorted distinct chunks: a 48-bit digest and, in the low 16 bits, the length."""
    data = np.frombuffer(b"".join(t + bytes(_WINDOW) for t in texts), np.uint8)
    if not len(data):
        return []
    h = _gear(data)
    # a cut stands after the byte whose hash has these top bits zero
    loose = np.flatnonzero(h < np.uint32(1 << (32 - _BITS + 2))) + 1
    strict = (loose[h[loose - 1] < np.uint32(1 << (32 - _BITS - 2))]).tolist()
    loose = loose.tolist()
    starts, ends, counts, begin = [], [], [], 0
    for text in texts:
        at, stop, before = begin, begin + len(text), len(starts)
        while at < stop:
            end = min(at + LONGEST, stop)
            k = bisect_left(strict, at + SHORTEST)
            if k < len(strict) and strict[k] < at + NORMAL:
                end = min(end, strict[k])
            else:
                k = bisect_left(loose, at + NORMAL)
                if k < len(loose):
                    end = min(end, loose[k])
            starts.append(at)
            ends.append(end)
            at = end
        counts.append(len(starts) - before)
        begin = stop + _WINDOW
    first, last = np.array(starts, np.int64), np.array(ends, np.int64)
    packed = (span_hashes(data, first, last) & np.uint64(~0xFFFF & (1 << 64) - 1)) | (last - first).astype(np.uint64)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    return [np.unique(packed[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def as_text(chunks: np.ndarray) -> str:
    """A fingerprint as a string, 16 hex digits for each chunk."""
    return chunks.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Length of the common chunks against that of the smaller set; 1 for two empty sets, else 0 for an empty one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    weigh = lambda x: int((x & np.uint64(0xFFFF)).sum())
    return weigh(np.intersect1d(a, b, assume_unique=True)) / min(weigh(a), weigh(b))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``(row, fingerprint)`` for each row of ``docs``, from whole texts.

    Equal texts have equal fingerprints; that of a null or empty text is the empty string.
    Repeated rows get the same fingerprint, an empty table gives an empty result.
    """
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [as_text(s) for s in fingerprint_sets(texts_of(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], names=["row", "fingerprint"])

    shape = T.StructType([T.StructField("row", whole.schema["row"].dataType), T.StructField("fingerprint", T.StringType())])
    return whole.mapInArrow(run, shape)


_RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_RESULT.names)


def _compare(keys: list, texts: list[str], after: list[str]) -> list[tuple]:
    """Results for texts and their next texts, most of which are the text behind it."""
    edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, after, strict=True)]
    known: dict[str, np.ndarray] = {}
    whole = list(dict.fromkeys([*texts, *after]))
    known.update(zip(whole, fingerprint_sets([t.encode() for t in whole]), strict=True))
    changed = fingerprint_sets([t.encode() for t in edited])
    return [
        (
            key, len(text), hashlib.sha256(e.encode()).hexdigest(), as_text(known[text]), as_text(c),
            likeness(known[text], c), likeness(known[text], known[n]),
        )
        for key, text, e, c, n in zip(keys, texts, edited, changed, after, strict=True)
    ]


def _run_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ranges, each with the first text of the next range behind its rows."""
    last = None
    for batch in slices(batches):
        keys, texts, after = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "behind"))
        for key, text, behind in zip(*columns, strict=True):
            if last is not None:
                keys.append(last[0])
                texts.append(last[1])
                after.append(text)
            last = None if behind else (key, text)
        yield _batch(_compare(keys, texts, after))


def against_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts, of edited texts, and how alike both and those of neighbours are.

    The edited text replaces the last third (rounded down, in code points) of a text by the
    first as many code points of the next document, by descending ``doc_id``; the first comes
    after the last, and a lone document is its own next. The ids alone are put into ranges first;
    then one shuffle brings the texts of a range together with a copy of the first text of the
    next range.

    A null text counts as empty. Null ids come last, equal ids in the order of their texts.
    An empty table gives an empty result.
    """
    lowest = F.lit(-(1 << 63))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), lowest).alias("key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # ids are few bytes: without a number, adaptive execution would make one range of them
    ranges = (
        texts.select("key")
        .repartitionByRange(width(docs), F.desc("key"))
        .groupBy(F.spark_partition_id())
        .agg(F.max("key"))
    )
    # as many numbers as ranges, and every range begins with one
    firsts = np.array(sorted(r[1] for r in ranges.collect()), np.int64)
    count = len(firsts)
    if not count:
        return docs.sparkSession.createDataFrame([], _RESULT)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        # ranges are numbered in the order of their rows, from the largest key on
        return pd.Series((count - 1 - np.searchsorted(firsts, keys.to_numpy(), "left")).astype(np.int32))

    rows = texts.withColumn("range", range_of("key")).withColumn("behind", F.lit(False))
    heads = (
        texts.join(F.broadcast(docs.sparkSession.createDataFrame([(int(f),) for f in firsts], "key long")), "key", "left_semi")
        .groupBy("key")
        .agg(F.min("text").alias("text"))
        .select(
            F.lit(None).cast("long").alias("doc_id"),
            "key",
            "text",
            F.pmod(range_of("key") - 1, F.lit(count)).alias("range"),
            F.lit(True).alias("behind"),
        )
    )
    return (
        rows.unionByName(heads)
        .repartitionByRange("range")
        .sortWithinPartitions("range", "behind", F.desc("key"), "text")
        .select("doc_id", "text", "behind")
        .mapInArrow(_run_in_order, _RESULT)
    )
