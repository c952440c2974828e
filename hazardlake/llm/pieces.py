"""Encoding and decoding with merge-type piece vocabularies.

A text is cut into segments that no piece crosses: each begins with a run of word-start marks.
In a segment, adjacent symbols are merged in the order of an agenda, best score first and
leftmost among equals, until no adjacent pair is a piece; what is not in the vocabulary falls
back to bytes. Every distinct segment of an Arrow slice is worked once: short ones all at once
as arrays, one agenda step for each of them at a time, long ones with a heap.

The vocabulary comes from a model file whose path is a parameter; its bytes are broadcast.
``check`` compares the result with the sentencepiece library in the same Arrow batches.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.common import slices, span_hashes, texts_of

MARK = "▁"
_MARK = ord(MARK)
_CODES = 0x110000
_NONE = np.int32(2**31 - 1)
#: Segments up to this length are worked as arrays of one of these widths.
WIDTHS = (4, 8, 12, 16, 24, 40)
#: A worker forgets the segments of earlier slices when it has this many.
REMEMBERED = 600_000


class Vocabulary:
    """Pieces, merges and the library's own processor of one model."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.library
        n = len(sp)
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        if any(sp.is_unused(i) for i in range(n)) or not any(sp.is_byte(i) for i in range(n)):
            raise ValueError("vocabularies with unused pieces or without byte pieces are not supported")
        names = {sp.id_to_piece(i): i for i in range(n) if i not in special}
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("pieces that hold a word start after other characters are not supported")
        self.bytes = np.zeros(256, np.int32)
        for b in range(256):
            self.bytes[b] = sp.piece_to_id(f"<0x{b:02X}>")
        # characters that occur in pieces only get symbols above all ids
        symbols = dict(names)
        for p in names:
            for c in p:
                symbols.setdefault(c, n + len(symbols))
        self.limit = n
        #: symbol of each character; those unknown are -2 less their code
        self.symbol = -2 - np.arange(_CODES, dtype=np.int32)
        self.code_of = np.zeros(n + 2 * len(symbols), np.int32)
        for p, s in symbols.items():
            if len(p) == 1:
                self.symbol[ord(p)] = s
                self.code_of[s] = ord(p)
        scores = sorted({sp.get_score(i) for i in names.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        merges = {}
        for p, i in names.items():
            for cut in range(1, len(p)):
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    merges[(left << 32) | right] = (rank[sp.get_score(i)], i)
        self.merges = merges
        self._table(merges)
        self._forget()
        for probe in ("", "  a  b ", "A b\tc\n", "é x́ ① \U0001f642", f"{MARK}a {MARK}"):
            if probe and self.encode([probe], "texts")[0].tolist() != sp.encode(probe):
                raise ValueError("the model's normalisation is not supported")

    def _table(self, merges: dict) -> None:
        """Open addressing over the merges."""
        bits = max(10, int(len(merges) * 12).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        self.made = np.full(1 << bits, -1, np.int32)
        keys = np.fromiter(merges, np.int64, len(merges))
        for key, at in zip(keys.tolist(), self._slot(keys).tolist(), strict=True):
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at] = key
            self.ranks[at], self.made[at] = merges[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; negative symbols merge with nothing."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        found = self.keys[at]
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            todo = todo[(found != keys[todo]) & (found != -1)]
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], _NONE), self.made[at]

    def _merge_all(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols, padded with -1, after all merges."""
        out = symbols.copy()
        n, width = symbols.shape
        rows = np.arange(n)
        columns = np.arange(width)
        ranks, made = self.look_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks, made = ranks.reshape(n, width - 1), made.reshape(n, width - 1)
        while True:
            at = ranks.argmin(1)
            line = np.arange(len(rows))
            going = ranks[line, at] < _NONE
            if not going.all():
                out[rows[~going]] = symbols[~going]
                rows, symbols, ranks, made, at = (x[going] for x in (rows, symbols, ranks, made, at))
                line = np.arange(len(rows))
            if not len(rows):
                return out
            new = made[line, at]
            take = columns + (columns > at[:, None])
            padded = np.concatenate((symbols, np.full((len(rows), 1), -1, np.int32)), 1)
            symbols = np.take_along_axis(padded, take, 1)
            symbols[line, at] = new
            short = take[:, : width - 1]
            ranks = np.take_along_axis(np.concatenate((ranks, np.full((len(rows), 1), _NONE, np.int32)), 1), short, 1)
            made = np.take_along_axis(np.concatenate((made, np.full((len(rows), 1), -1, np.int32)), 1), short, 1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1], made[left, at[left] - 1] = self.look_up(symbols[left, at[left] - 1], new[left])
            right = np.flatnonzero(at < width - 1)
            ranks[right, at[right]], made[right, at[right]] = self.look_up(new[right], symbols[right, at[right] + 1])

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """One segment, by a heap of adjacent pairs and links between the symbols that are left."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []

        def offer(left: int, right: int) -> None:
            a, b = symbols[left], symbols[right]
            if a >= 0 and b >= 0:
                found = self.merges.get((a << 32) | b)
                if found:
                    heapq.heappush(agenda, (found[0], left, right, a, b, found[1]))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, left, right, a, b, new = heapq.heappop(agenda)
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue
            symbols[left], symbols[right] = new, -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s != -1]

    def _ids(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols without padding, and how many each symbol gave."""
        plain = (symbols >= 0) & (symbols < self.limit)
        codes = np.where(symbols < 0, -2 - symbols, self.code_of[np.maximum(symbols, 0)])
        counts = np.where(plain, 1, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))
        out = np.repeat(symbols, counts)
        if not plain.all():
            ends = np.cumsum(counts)
            for k in np.flatnonzero(~plain):
                raw = chr(codes[k]).encode("utf-8", "surrogatepass")
                out[ends[k] - len(raw) : ends[k]] = self.bytes[list(raw)]
        return out, counts

    def encode(self, texts: list[str], check: str = "") -> list[np.ndarray]:
        """Ids of each text without begin or end."""
        if not texts:
            return []
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        if len(self.seen) > REMEMBERED:
            self._forget()
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(m) for m in marked), np.int64, len(marked))
        begin = np.cumsum(lengths) - lengths
        if not len(codes):
            return [np.zeros(0, np.int32) for _ in texts]
        mark = codes == _MARK
        cut = mark.copy()
        cut[1:] &= ~mark[:-1]
        cut[begin[lengths > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(codes))
        hashes = span_hashes(codes.view(np.uint8), starts * 4, ends * 4)
        distinct, where, segment = np.unique(hashes, return_index=True, return_inverse=True)
        same = _equal_spans(codes, starts, ends - starts, codes, starts[where][segment], (ends - starts)[where][segment])
        at = np.searchsorted(self.seen, distinct)
        new = np.ones(len(distinct), bool) if not len(self.seen) else self.seen[np.minimum(at, len(self.seen) - 1)] != distinct
        old, known = where[~new], at[~new]
        same = same and _equal_spans(
            codes, starts[old], (ends - starts)[old], self.seen_codes, self.seen_starts[known], self.seen_lengths[known]
        )
        if not same:
            # two segments of one hash: every segment is worked for itself
            found, each = self._segments(codes, starts, ends)
            if check == "segments":
                self._compare(codes, starts, ends, found, each)
            tokens, done = found, np.cumsum(each)
        else:
            if new.any():
                fresh = where[new]
                found, sizes = self._segments(codes, starts[fresh], ends[fresh])
                if check == "segments":
                    self._compare(codes, starts[fresh], ends[fresh], found, sizes)
                self._remember(distinct[new], found, sizes, codes, starts[fresh], (ends - starts)[fresh])
                at = np.searchsorted(self.seen, distinct)
            ids, offsets = self.seen_ids, self.seen_offsets[at]
            each = self.seen_counts[at][segment]
            done = np.cumsum(each)
            tokens = ids[np.repeat(offsets[segment] - (done - each), each) + np.arange(done[-1])]
        # first segment of each text
        at = np.searchsorted(starts, begin)
        bounds = np.append(np.concatenate(([0], done))[at], len(tokens))
        out = [tokens[a:b] if n else tokens[:0] for a, b, n in zip(bounds[:-1], bounds[1:], lengths, strict=True)]
        if check == "texts":
            for text, own, other in zip(texts, out, self.library.encode(texts, num_threads=1), strict=True):
                if own.tolist() != other:
                    raise ValueError(f"differs from the library: {text[:200]!r}")
        return out

    def _forget(self) -> None:
        self.seen = np.zeros(0, np.uint64)
        self.seen_offsets = self.seen_counts = np.zeros(0, np.int64)
        self.seen_ids = np.zeros(0, np.int32)
        self.seen_codes = np.zeros(0, np.uint32)
        self.seen_starts = self.seen_lengths = np.zeros(0, np.int64)

    def _remember(self, hashes, ids, counts, codes, starts, lengths) -> None:
        """Add worked segments, with their characters, to those of earlier slices."""
        seen = np.concatenate((self.seen, hashes))
        order = np.argsort(seen, kind="stable")  # two sorted runs
        offsets = np.concatenate((self.seen_offsets, len(self.seen_ids) + np.cumsum(counts) - counts))
        self.seen, self.seen_offsets = seen[order], offsets[order]
        self.seen_counts = np.concatenate((self.seen_counts, counts))[order]
        self.seen_ids = np.concatenate((self.seen_ids, ids))
        first = len(self.seen_codes) + np.cumsum(lengths) - lengths
        self.seen_starts = np.concatenate((self.seen_starts, first))[order]
        self.seen_lengths = np.concatenate((self.seen_lengths, lengths))[order]
        self.seen_codes = np.concatenate((self.seen_codes, codes[_inside(starts, lengths)]))

    def _segments(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments in their order, flat, and the number of ids of each."""
        size = ends - starts
        places, parts = [], []
        low = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((size > low) & (size <= width))
            low = width
            # bounded blocks keep the arrays of a step small
            for some in np.array_split(chosen, max(1, len(chosen) // 50_000)):
                if len(some):
                    grid = starts[some][:, None] + np.arange(width)
                    inside = grid < ends[some][:, None]
                    symbols = np.where(inside, self.symbol[codes[np.minimum(grid, len(codes) - 1)]], np.int32(-1))
                    merged = self._merge_all(symbols)
                    kept = merged != -1
                    parts.append(merged[kept])
                    places.append(np.repeat(some, kept.sum(1)))
        for k in np.flatnonzero(size > WIDTHS[-1]):
            merged = self._merge_long(self.symbol[codes[starts[k] : ends[k]]].tolist())
            parts.append(np.array(merged, np.int32))
            places.append(np.full(len(merged), k))
        place = np.concatenate(places)
        symbols = np.concatenate(parts)[np.argsort(place, kind="stable")]
        place.sort(kind="stable")
        ids, counts = self._ids(symbols)
        return ids, np.bincount(place, counts, len(starts)).astype(np.int64)

    def _compare(self, codes, starts, ends, ids, counts) -> None:
        """The library on every distinct segment, many in one text; it puts the first mark itself."""
        bounds = np.concatenate(([0], np.cumsum(counts)))
        pure = codes[ends - 1] == _MARK  # marks only: these would run into the next segment
        size = ends - starts
        some = np.flatnonzero(~pure)
        groups = [some[k : k + 100] for k in range(0, len(some), 100)] + [np.array([k]) for k in np.flatnonzero(pure)]
        texts, own = [], []
        for group in groups:
            total = size[group]
            offset = np.repeat(starts[group] - (np.cumsum(total) - total), total) + np.arange(total.sum())
            text = codes[offset].tobytes().decode("utf-32-le", "surrogatepass")[1:]
            if text:  # a text of nothing has no mark
                texts.append(text)
                each = counts[group]
                at = np.repeat(bounds[group] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                own.append(ids[at].tolist())
        for text, ours, other in zip(texts, own, self.library.encode(texts, num_threads=1), strict=True):
            if ours != other:
                raise ValueError(f"differs from the library: {text[:200]!r}")


def _inside(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of the spans, one span behind the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _equal_spans(codes, starts, lengths, others, other_starts, other_lengths) -> bool:
    """Whether each span of ``codes`` is the same as its one of ``others``."""
    if not np.array_equal(lengths, other_lengths):
        return False
    return np.array_equal(codes[_inside(starts, lengths)], others[_inside(other_starts, lengths)])


@cache
def _vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def encode_texts(
    docs: DataFrame, model: str, *, check: str = "segments", round_trip: bool = False, keep: Sequence[str] | None = None
) -> DataFrame:
    """``(row, ids)`` for each row of ``docs``: the columns in ``keep`` (all by default) as they were, and the ids
    with an end id.

    ``model`` is a path to a model file on the driver. ``check`` is ``"segments"`` (every
    distinct segment of a slice is also encoded by the library), ``"texts"`` (every text is) or
    empty; a difference fails the job. With ``round_trip`` a column ``decoded`` holds what the
    library's decoder makes of the ids. A null or empty text has the end id only and decodes to
    the empty text; bytes that are no UTF-8 count as U+FFFD. Repeated rows are encoded each; an
    empty table gives an empty result.
    """
    with open(model, "rb") as f:
        proto = docs.sparkSession.sparkContext.broadcast(f.read())
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col("text").cast("string").alias("text")
    )
    fields = [T.StructField("row", whole.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if round_trip:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(proto.value)
        end = np.array([vocabulary.library.eos_id()], np.int32)
        for batch in slices(batches, size=2 << 20):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch)]
            ids = [np.concatenate((i, end)) for i in vocabulary.encode(texts, check)]
            columns = [batch.column("row"), pa.array(ids, pa.list_(pa.int32()))]
            if round_trip:
                columns.append(pa.array([vocabulary.library.decode(i.tolist()) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return whole.mapInArrow(run, T.StructType(fields))


def decode_ids(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the library's decoding of the ids; null stays null."""
    with open(model, "rb") as f:
        proto = encoded.sparkSession.sparkContext.broadcast(f.read())
    whole = encoded.select(F.struct(*[F.col(f"`{c}`") for c in encoded.columns]).alias("row"), F.col(ids).alias("ids"))
    shape = T.StructType([T.StructField("row", whole.schema["row"].dataType), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _vocabulary(proto.value).library
        for batch in batches:
            texts = [None if i is None else library.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "decoded"])

    return whole.mapInArrow(run, shape).select("row.*", "decoded")
