"""Helpers shared by the operators: Arrow slices, span hashes, tables in the shared folder."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.session import scratch_path

#: Maps the bytes A-Z to a-z and leaves every other byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: The Mersenne prime that span and prefix hashes are taken modulo, and their base.
PRIME = (1 << 61) - 1
BASE = 0x1E3779B97F4A7C15


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finalizer of a 64-bit hash (uint64 in, uint64 out)."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A 64-bit value for every byte, made by rule.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fold(x: np.ndarray) -> np.ndarray:
    """Any uint64 modulo the prime."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def shifted(x: np.ndarray, bits: int) -> np.ndarray:
    """``x`` times a power of two modulo the prime: its 61 bits turned round."""
    return ((x << np.uint64(bits)) & np.uint64(PRIME)) | (x >> np.uint64(61 - bits))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from halves of 32 bits."""
    low = np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> np.uint64(32), a & low, b >> np.uint64(32), b & low
    middle = fold(a1 * b0 + a0 * b1)
    # 2 ** 64 is 8 modulo the prime
    return fold(fold(a1 * b1 * np.uint64(8)) + shifted(middle, 32) + fold(a0 * b0))


def powers_of(base: int, n: int) -> np.ndarray:
    """The powers of a number modulo the prime, from the zeroth on."""
    out = np.ones(n, np.uint64)
    known = 1
    while known < n:
        step = np.uint64(pow(base, known, PRIME))
        more = min(known, n - known)
        out[known : known + more] = product(out[:more], step)
        known += more
    return out


#: Bits of the limbs that powers are kept in, so that sums over 2 ** 35 bytes do not overflow.
_LIMB = 21


class _Powers:
    """Limbs of the powers of the base, and the powers of its inverse, grown on demand."""

    limbs = np.zeros((3, 0), np.uint64)
    down = np.zeros(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.down) < n:
            size = max(n, 1 << 16)
            up = powers_of(BASE, size)
            cls.limbs = np.stack([(up >> np.uint64(_LIMB * k)) & np.uint64((1 << _LIMB) - 1) for k in range(3)])
            cls.down = powers_of(pow(BASE, -1, PRIME), size)
        return cls.limbs[:, :n], cls.down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, the same for equal spans wherever they stand.

    A polynomial modulo a prime of 61 bits: two different spans of ``n`` bytes agree for at most ``n`` of
    all bases. (Modulo 2 ** 64 there are texts that agree for every base.)
    """
    n = len(data)
    limbs, down = _Powers.to(n + 1)
    values = data.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(starts), np.uint64)
    sums, terms = np.zeros(n + 1, np.uint64), np.empty(n, np.uint64)
    for k in range(3):
        np.multiply(values, limbs[k, :n], out=terms)
        np.cumsum(terms, out=sums[1:])
        total = fold(total + shifted(fold(sums[ends] - sums[starts]), _LIMB * k))
    return mix(product(total, down[starts]) + ((ends - starts).astype(np.uint64) << np.uint64(61)), 0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches with about ``size`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]


def crc_part(value, parts: int) -> int:
    """crc32 of a value as text, modulo ``parts``; nulls count as the empty text."""
    return zlib.crc32(b"" if value is None else str(value).encode()) % parts


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends, executors may go.

    Tables below ``folder`` can be removed together once nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{folder}/{label}-{uuid.uuid4().hex}" if folder else scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes and rows of the batches that go to Python.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2048


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches end at ``BATCH_BYTES`` and ``BATCH_ROWS``, if they did not end before.

    Texts make batches of 10000 rows large, and the JVM and the Python worker of every task hold
    some of them at once; a Python filter makes the JVM hold the whole rows of its batch, however
    little of them it sees. Only memory depends on it, no result does.
    """
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


#: Bits of the filter that ``maybe_in`` broadcasts, 8 MB whatever the data.
FILTER_BITS = 1 << 26


def bits_of(slots: DataFrame, bits: int) -> np.ndarray:
    """One bit for each slot (one long column, below ``bits``), 64 to a word; no longer than ``bits``."""
    slot = F.col(slots.columns[0])
    words = (
        slots.select(F.floor(slot / 64).cast("int").alias("word"), F.expr("1L").alias("one"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("mask"))
        .toArrow()
    )
    masks = np.zeros((bits + 63) // 64, np.int64)
    masks[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return masks


def is_set(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether the bits of the slots are set, as ``bits_of`` made them."""
    return (bits[slots >> 6] >> (slots & 63)) & 1 == 1


def _bit_test(shared: Broadcast) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def test(slots: pd.Series) -> pd.Series:
        return pd.Series(is_set(shared.value, slots.to_numpy()))

    return test


def bit_set(slots: DataFrame, bits: int) -> Callable[[Column], Column]:
    """A test whether a slot is among ``slots``, as ``bits_of`` takes them."""
    return _bit_test(slots.sparkSession.sparkContext.broadcast(bits_of(slots, bits)))


def slot_of(column: Column) -> Column:
    """Where an id stands in the filter of ``id_bits``."""
    return F.pmod(F.xxhash64(column.cast("long")), F.lit(FILTER_BITS))


def id_bits(ids: DataFrame) -> Broadcast:
    """The filter of ``maybe_in``, for functions that test the slots of their own rows.

    A task that runs two Python functions, one on the rows of the other, has two workers, with
    all that they hold: such a test inside the function that needs it saves one.
    """
    return ids.sparkSession.sparkContext.broadcast(bits_of(ids.select(slot_of(F.col(ids.columns[0]))), FILTER_BITS))


def maybe_in(ids: DataFrame, bits: Broadcast | None = None) -> Callable[[Column], Column]:
    """A test of an id column: false where the id is surely not among ``ids`` (one column).

    Rows that fail it need not move for a join with ``ids``. The ids set bits of a filter of
    fixed size; where there are more of them than bits, it lets everything pass and the join
    decides alone. Only the ids' hashes go to Python, not the rows. ``bits`` is their filter, if
    it is there already.
    """
    test = _bit_test(bits or id_bits(ids))
    return lambda column: test(slot_of(column))


#: Copies of what belongs to one key that rows of that key are dealt to.
SALTS = 64


def spread_join(rows: DataFrame, by: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """``rows`` left-joined with ``by`` on ``keys``: what belongs to a key is sent to each salt that its rows have."""
    salted = rows.withColumn("_salt", salt)
    sent = salted.select(*keys, "_salt").distinct().join(by, keys)
    return salted.join(sent, [*keys, "_salt"], "left").drop("_salt")


def width(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
