"""Removal of passages that repeat across documents, by hashes of sentence runs.

A span is a run of consecutive sentences that has ``sentences`` sentences and ``least`` words,
or else ``enough`` words. Hashed are from every sentence the shortest span that starts there, and
the shortest one that ends there: together those within any span cover all of it, so what they
remove is what all spans would. They are joined over the whole table. Whatever a repeated span
covers is removed, except where it stands first: in the document of least ``doc_id``, at its
first place there.

Sentences end in the marks of many scripts. Where a script does not put spaces between words, two
characters count as a word, and of a longer string than words are, six.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.common import LOWER, id_bits, is_set, maybe_in, mix, slices, slot_of, small_batches, span_hashes, stored, texts_of

SENTENCES = 3
LEAST = 20
ENOUGH = 45

#: Marks that end a sentence without white space behind them, and brackets and quotes that may close it.
MARKS = (
    "\u0589\u061d-\u061f\u06d4\u0700-\u0702\u07f9\u0964\u0965\u0f0d-\u0f12\u104a\u104b\u1362\u1367\u1368\u166e\u1735\u1736"
    "\u17d4\u17d5\u1803\u1809\u1944\u1945\u1aa8-\u1aab\u1b5a\u1b5b\u1b5e\u1b5f\u1c3b\u1c3c\u1c7e\u1c7f\u203c\u203d\u2047-\u2049"
    "\u2e2e\u2e3c\u3002\ua4ff\ua60e\ua60f\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9\uaa5d-\uaa5f\uaaf0\uaaf1\uabeb"
    "\ufe12\ufe15\ufe16\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61\U000104a0\U00011047\U00011048\U000110be-\U000110c1"
)
CLOSING = "\u00bb\u2019\u201d\u3009\u300b\u300d\u300f\u3011\u3015\u3017\uff09\uff3d\uff63"
#: Line and paragraph ends besides the line feed.
LINES = "\u0085\u2028\u2029"
#: Scripts that put spaces behind clauses only.
CLAUSES = "\u0e01-\u0eff"
#: Scripts that do not put spaces between words.
UNSPACED = CLAUSES + "\u0f00-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u3040-\u312f\u31a0-\u31ff\u3400-\u9fff\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
#: Characters of such a script that count as a word, and of a string too long for a word.
PER_WORD, PER_LONG_WORD, LONG_WORD = 2, 6, 40

#: A sentence ends after marks followed by white space, and at a line's end.
_END = re.compile(rb"[.!?]+\s+|\n\s*")
#: The same in any script.
_ANY_END = re.compile(
    rf"[.!?]+[ \t-\r]+|\n[ \t-\r]*|[{MARKS}][{MARKS}.!?]*[{CLOSING}]*[ \t-\r\u3000]*|[{LINES}][ \t-\r{LINES}]*|(?<=[{CLAUSES}])[ \t-\r]+"
)
_UNSPACED = re.compile(f"[{UNSPACED}]")
_OTHER_ENDS = re.compile(f"[{MARKS}{LINES}{CLAUSES}]")
_STEP = np.uint64(0xD1342543DE82EF95)
#: Bytes of text that a worker looks at together.
SLICE = 1 << 18


def sentences_of(text: bytes) -> list[int]:
    """Where sentences end; each begins where the one before ends, white space belongs to it."""
    wide = None if text.isascii() else text.decode(errors="surrogateescape")
    if wide and _OTHER_ENDS.search(wide):
        ends, at = [], 0
        for m in _ANY_END.finditer(wide):
            size = len(wide[at : m.end()].encode(errors="surrogateescape"))
            ends.append(size + (ends[-1] if ends else 0))
            at = m.end()
    else:
        ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


def words_in(found: list[bytes]) -> int:
    """Length in words of strings between white space; where words are not spaced, characters count."""
    n = 0
    for string in found:
        wide = string.decode(errors="surrogateescape")
        dense = len(_UNSPACED.findall(wide))
        rest = len(wide) - dense
        n += max(1, dense // PER_WORD + (rest // PER_LONG_WORD if rest > LONG_WORD else min(rest, 1)))
    return n


class Spans:
    """Spans of a slice of documents, as arrays over all its sentences."""

    def __init__(self, texts: list[bytes], sentences: int, least: int, enough: int):
        self.ends = [sentences_of(t) if t else [] for t in texts]
        self.first = np.concatenate(([0], np.cumsum([len(e) for e in self.ends]))).astype(np.int64)
        plain, words = [], []
        for text, ends in zip(texts, self.ends, strict=True):
            low, at = text.translate(LOWER), 0
            dense = not text.isascii() and _UNSPACED.search(text.decode(errors="surrogateescape"))
            for end in ends:
                found = low[at:end].split()
                plain.append(b" ".join(found))
                odd = dense or max(map(len, found), default=0) > LONG_WORD
                words.append(words_in(found) if odd else len(found))
                at = end
        n = len(plain)
        lengths = np.fromiter((len(p) for p in plain), np.int64, n)
        starts = np.cumsum(lengths) - lengths
        own = span_hashes(np.frombuffer(b"".join(plain), np.uint8), starts, starts + lengths)
        total = np.concatenate(([0], np.cumsum(np.array(words, np.int64))))
        index = np.arange(n)
        document = np.repeat(np.arange(len(texts)), np.diff(self.first))
        # the shortest span from each sentence on, and the shortest one up to it
        to = np.minimum(
            np.maximum(index + sentences, np.searchsorted(total, total[:-1] + least, "left")),
            np.searchsorted(total, total[:-1] + enough, "left"),
        )
        back = np.maximum(
            np.minimum(index + 1 - sentences, np.searchsorted(total, total[1:] - least, "right") - 1),
            np.searchsorted(total, total[1:] - enough, "right") - 1,
        )
        whole = to <= self.first[1:][document] if n else np.zeros(0, bool)
        ended = back >= self.first[:-1][document] if n else np.zeros(0, bool)
        # those that are both count once
        ended[ended] = to[back[ended]] != index[ended] + 1
        start = np.concatenate((index[whole], back[ended]))
        stop = np.concatenate((to[whole], index[ended] + 1))
        order = np.argsort(start, kind="stable")
        self.start, self.stop = start[order], stop[order]
        self.bounds = np.searchsorted(self.start, self.first, "left")
        power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _STEP, np.uint64))))
        inverse = np.cumprod(
            np.concatenate((np.ones(1, np.uint64), np.full(n, pow(int(_STEP), -1, 1 << 64), np.uint64)))
        )
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(own * power[:n])))
        runs = (sums[self.stop] - sums[self.start]) * inverse[self.start] + (self.stop - self.start).astype(np.uint64)
        self.hashes = mix(runs).view(np.int64)

    def of(self, document: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First sentence, end and hash of the spans of one document, by first sentence."""
        at = slice(self.bounds[document], self.bounds[document + 1])
        return self.start[at] - self.first[document], self.stop[at] - self.first[document], self.hashes[at]


def _first_places(hashes: np.ndarray) -> np.ndarray:
    """True where a hash occurs for the first time."""
    first = np.zeros(len(hashes), bool)
    first[np.unique(hashes, return_index=True)[1]] = True
    return first


def _emitter(sentences: int, least: int, enough: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            spans = Spans(texts_of(batch), sentences, least, enough)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            hashes = [np.unique(spans.of(k)[2]) for k in range(batch.num_rows)]
            counts = [len(h) for h in hashes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes)), pa.array(np.repeat(ids, counts))], names=["span", "id"]
            )

    return run


def _cutter(sentences: int, least: int, enough: int):
    def cut(text: bytes, ends: list[int], spans, repeated) -> tuple[bytes, int]:
        starts, stops, hashes = spans
        gone = ~_first_places(hashes)
        if repeated is not None:
            gone |= np.isin(hashes, repeated)
        if not gone.any():
            return text, 0
        change = np.zeros(len(ends) + 1, np.int64)
        np.add.at(change, starts[gone], 1)
        np.add.at(change, stops[gone], -1)
        covered = np.cumsum(change)[:-1] > 0
        kept, at = [], 0
        for end, out in zip(ends, covered, strict=True):
            if not out:
                kept.append(text[at:end])
            at = end
        return b"".join(kept), int(covered.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            texts = texts_of(batch)
            spans = Spans(texts, sentences, least, enough)
            repeated = batch.column("repeated").to_pylist()
            done = [
                cut(t, spans.ends[k], spans.of(k), r and np.array(r, np.int64))
                for k, (t, r) in enumerate(zip(texts, repeated, strict=True))
            ]
            nulls = batch.column("text").is_null().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    # bytes as they stand, whether they are UTF-8 or not
                    pa.array([None if n else t for n, (t, _) in zip(nulls, done, strict=True)], pa.binary()).view(pa.string()),
                    pa.array([len(e) for e in spans.ends], pa.int32()),
                    pa.array([c for _, c in done], pa.int32()),
                ],
                names=["row", "kept_text", "sentences", "removed"],
            )

    return run


def without_repeats(
    docs: DataFrame, *, sentences: int = SENTENCES, least: int = LEAST, enough: int = ENOUGH
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``: one row ``(row, kept_text, sentences, removed)`` each.

    ``row`` holds all columns as they were, ``kept_text`` the text that remains, ``sentences``
    and ``removed`` the number of sentences before and of those cut out. A text without a
    repeated span stays byte for byte. Sentences are compared after lower-casing A-Z and
    joining words by single spaces. Thai and Lao text also ends at white space, which stands behind
    clauses there.

    A null text stays null and an empty one empty, both with no sentence. A text shorter than a
    span has none and stays. Of equal spans the least ``doc_id`` has the first; for a null ``doc_id``
    stands a number above 2**62 made of the text. Rows that share a ``doc_id`` count as one document and are not
    repeats of each other, but a span that repeats within a text is cut there. An empty table
    gives an empty result.
    """
    small_batches(docs.sparkSession)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(
            F.col("doc_id").cast("long"), F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
        ).alias("id"),
    )
    spans = stored(
        whole.select("id", "text").mapInArrow(_emitter(sentences, least, enough), "span long, id long"), "spans"
    )
    firsts = (
        spans.groupBy("span")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .filter("low < high")
        .select("span", "low")
    )
    later = stored(
        spans.join(firsts, "span")
        .filter("id > low")
        .groupBy("id")
        .agg(F.collect_set("span").alias("repeated")),
        "repeats",
    )
    shape = T.StructType(
        [
            T.StructField("row", whole.schema["row"].dataType),
            T.StructField("kept_text", T.StringType()),
            T.StructField("sentences", T.IntegerType()),
            T.StructField("removed", T.IntegerType()),
        ]
    )
    # texts without a span that an earlier document has stay where they are
    ids = later.select("id")
    bits = id_bits(ids)
    some = maybe_in(ids, bits)(F.col("id"))
    moved = stored(whole.filter(some).join(later, "id", "left").select("row", "text", "repeated"), "moved")
    others = whole.select("row", "text", slot_of(F.col("id")).alias("slot"))
    cutter = _cutter(sentences, least, enough)

    def staying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.filter(pa.array(~is_set(bits.value, batch.column("slot").to_numpy())))
                none = pa.nulls(rows.num_rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([rows.column("row"), rows.column("text"), none], names=["row", "text", "repeated"])

        return cutter(chosen())

    return others.mapInArrow(staying, shape).unionByName(moved.mapInArrow(cutter, shape))
