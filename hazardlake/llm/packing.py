"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest length is cut into full sequences and a rest. Rests and
shorter documents are placed in descending order, each into the open bin that it leaves with the
least free room. If none has room, the bin opened is the one of least cost: the lengths are weighed jointly
by what a bin of each would hold of the pieces still to come, its padding and a fixed cost
a sequence. In the end every bin shrinks to the smallest permitted length that holds its contents.

Each task packs its own partition, so nothing is shuffled and no task depends on another.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Permitted sequence lengths, and the cost of a sequence beside its length, both in tokens.
LENGTHS = (256, 512, 1024, 2048, 4096)
OVERHEAD = 16


class _Rooms:
    """Open bins by free room: the tightest one that fits is found in a few word operations."""

    def __init__(self, largest: int):
        self.bins = [[] for _ in range(largest + 1)]
        self.bits = 0

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self.bits |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        """The bin of least room among those with ``size`` at least, and its room."""
        fitting = self.bits >> size
        if not fitting:
            return None
        room = size + (fitting & -fitting).bit_length() - 1
        number = self.bins[room].pop()
        if not self.bins[room]:
            self.bits &= ~(1 << room)
        return number, room


def best_opening(size: int, waiting: np.ndarray, lengths: tuple[int, ...], overhead: int) -> int:
    """The length of least cost for a new bin that begins with a piece of ``size``.

    ``waiting[s]`` counts pieces of size ``s`` still to come, none larger than ``size``. A bin of
    each length is filled greedily with them on trial; its cost is what it takes up and the
    overhead, for each token that it holds.
    """
    best, least = lengths[-1], np.inf
    for length in lengths:
        if length < size:
            continue
        room, held, counts = length - size, size, {}
        top = min(room, size)
        while room > 0 and top > 0:
            some = np.flatnonzero(waiting[1 : top + 1])
            while len(some) and counts.get(int(some[-1]) + 1, 0) >= waiting[some[-1] + 1]:
                some = some[:-1]
            if not len(some):
                break
            piece = int(some[-1]) + 1
            number = min(room // piece, int(waiting[piece]) - counts.get(piece, 0))
            counts[piece] = counts.get(piece, 0) + number
            room -= number * piece
            held += number * piece
            top = min(room, piece - 1)
        taken = lengths[bisect_left(lengths, held)]
        cost = (taken + overhead) / held
        if cost < least - 1e-12:
            best, least = length, cost
    return best


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the final length of each bin.

    ``sizes`` are between 1 and the largest length, in descending order.
    """
    waiting = np.bincount(sizes, minlength=lengths[-1] + 1)
    rooms = _Rooms(lengths[-1])
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    capacity, filled = [], []
    for k, size in enumerate(sizes.tolist()):
        waiting[size] -= 1
        found = rooms.take(size)
        if found is None:
            number, room = len(capacity), best_opening(size, waiting, lengths, overhead)
            capacity.append(room)
            filled.append(0)
        else:
            number, room = found
        bins[k], offsets[k] = number, filled[number]
        filled[number] += size
        if room > size:
            rooms.put(room - size, number)
    return bins, offsets, [lengths[bisect_left(lengths, f)] for f in filled]


_SHAPE = "doc_id long, piece int, start long, n_tokens int, bin_id long, bin_size int, bin_offset int"


def packed(docs: DataFrame, size: Column, *, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> DataFrame:
    """``(doc_id, piece, start, n_tokens, bin_id, bin_size, bin_offset)``, one row for each piece.

    ``size`` counts the tokens of a document. Piece ``piece`` holds its tokens from ``start`` on
    and stands in sequence ``bin_id``, which has ``bin_size`` tokens, from ``bin_offset`` on.
    Pieces of a document cover it without gaps, those of a bin do not overlap, and the bins of
    a partition have no equal ids. A partition's documents are taken in the order of size,
    ``doc_id`` and arrival.

    A document without tokens (null or negative size) has no piece. A null ``doc_id`` stays null;
    repeated rows are packed each. Other columns are ignored, an empty table gives an empty result.
    """
    lengths = tuple(sorted(set(lengths)))
    largest = lengths[-1]
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(size.cast("long"), F.lit(0)).alias("size")).filter(
        "size > 0"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables).sort_by([("size", "descending"), ("doc_id", "ascending")])
        ids = table.column("doc_id").combine_chunks()
        sizes = table.column("size").to_numpy()
        full, rest = sizes // largest, sizes % largest
        # full pieces are bins of their own
        owner = np.repeat(np.arange(len(sizes)), full)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
        first = TaskContext.get().partitionId() << 40
        some = np.flatnonzero(rest)
        some = some[np.argsort(-rest[some], kind="stable")]
        bins, offsets, final = pack(rest[some], lengths, overhead)
        n = len(owner)
        rows = np.concatenate((owner, some))
        columns = [
            ids.take(pa.array(rows)),
            pa.array(np.concatenate((number, full[some])), pa.int32()),
            pa.array(np.concatenate((number * largest, full[some] * largest))),
            pa.array(np.concatenate((np.full(n, largest), rest[some])), pa.int32()),
            pa.array(first + np.concatenate((np.arange(n), n + bins))),
            pa.array(np.concatenate((np.full(n, largest), np.array(final, np.int64)[bins])), pa.int32()),
            pa.array(np.concatenate((np.zeros(n, np.int64), offsets)), pa.int32()),
        ]
        yield from pa.Table.from_arrays(
            columns, names=["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset"]
        ).to_batches(50_000)

    return sized.mapInArrow(run, _SHAPE)


def word_count(text: Column) -> Column:
    """Words between white space: the tokens of the registered queries. A null text has none."""
    return F.size(F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"\s+"), lambda w: w != ""))
