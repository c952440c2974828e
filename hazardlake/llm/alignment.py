"""Alignment of two tokenizers over a corpus, with external spill counting of the pairs that end together.

Each text is encoded with a byte-level vocabulary (A) and a piece vocabulary (B). Where tokens of
both end at the same byte, an A-B pair is linked; how often each pair is linked in the corpus
says which A token stands for a B token.

* One pass over the texts encodes slices of a few megabytes. A slice's distinct (pair, document)
  records, sorted side-major (B, then A, then document), are cut by a radix of B and packed as
  zstd runs, which go to the shared folder: the spill. What a task holds is bounded by its slice.
* Runs of one radix are dealt to groups of about ``GROUP_BYTES``, more groups for a radix with a
  frequent token, so that no id is one task's alone. A k-way heap merge of a group's runs counts
  its pairs in side-major order; only pairs and their totals move for it, no document.
* Counts of the groups add up per pair, and the highest count of each B is known: a table no
  longer than the vocabulary.
* The counts return to the groups that hold their pairs. A second pass over the runs streams the
  contributions back: for each document of a slice the links that are their side's maximum, and
  the counts of all links.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from hazardlake.llm.common import slices, stored, texts_of

#: Bytes of text in a slice, and runs that a slice is cut into.
SLICE_BYTES = 2 << 20
RADIXES = 16
#: Packed bytes that a group of runs has on average.
GROUP_BYTES = 8 << 20

#: How a byte-level vocabulary splits texts before its merges (fixed value, as in its file).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _settled() -> np.ndarray:
    """Code points whose class has not changed since Unicode 3.2, so that every library splits them alike."""
    old = unicodedata.ucd_3_2_0
    out = np.zeros(0x110000, bool)
    for c in map(chr, range(0x110000)):
        kind = unicodedata.category(c)
        out[ord(c)] = kind == old.category(c) and kind not in ("Cn", "Cs", "Cc", "Co")
    out[[9, 10, 11, 12, 13]] = True
    return out


class ByteLevel:
    """Encoder of a byte-level vocabulary.

    Texts of settled characters go through merge ranks built from the vocabulary's own file; any
    other text goes through the library that the file is made for.
    """

    def __init__(self, model: bytes):
        self.library = Tokenizer.from_str(model.decode())
        self.library.encode_special_tokens = True
        described = json.loads(model)
        special = {t["content"] for t in described["added_tokens"]}
        letters = _byte_letters()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (1 + max(vocabulary.values()))
        for piece, i in vocabulary.items():
            self.pieces[i] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
        merges = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        made = [vocabulary["".join(m)] for m in merges]
        self.ranks = None
        # ranks say the same as merges only if ids rise in the order of the merges
        if all(a < b for a, b in zip(made, made[1:], strict=False)):
            ranks = {p: i for i, p in enumerate(self.pieces) if p.decode("utf-8", "replace") not in special}
            self.ranks = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.settled = _settled()

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        others = []
        for k, text in enumerate(texts):
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            if self.ranks is not None and self.settled[codes].all():
                out[k] = self.ranks.encode_ordinary(text)
            else:
                others.append(k)
        found = self.library.encode_batch([texts[k] for k in others], add_special_tokens=False) if others else []
        for k, one in zip(others, found, strict=True):
            out[k] = one.ids
        return out


class PieceLevel:
    """Encoder of a piece vocabulary, with the bytes of each piece."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = []
        for i in range(len(self.library)):
            piece = self.library.id_to_piece(i)
            whole = bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()
            self.pieces.append(whole)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


def _pack(*columns: np.ndarray) -> bytes:
    """Integer columns as one zstd frame, bytes of equal weight side by side."""
    planes = [np.ascontiguousarray(c.astype("<i8")).view(np.uint8).reshape(-1, 8).T for c in columns]
    head = np.array([len(c) for c in columns], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(
        len(columns).to_bytes(8, "little") + head + b"".join(p.tobytes() for p in planes)
    )


def _unpack(frame: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(frame)
    n = int.from_bytes(raw[:8], "little")
    sizes = np.frombuffer(raw, "<i8", n, 8).tolist()
    at, out = 8 + 8 * n, []
    for size in sizes:
        planes = np.frombuffer(raw, np.uint8, 8 * size, at).reshape(8, size)
        out.append(np.ascontiguousarray(planes.T).view("<i8").ravel())
        at += 8 * size
    return out


class Aligner:
    """Both encoders, and what a slice of texts gives."""

    def __init__(self, byte_model: bytes, piece_model: bytes):
        self.a, self.b = ByteLevel(byte_model), PieceLevel(piece_model)
        self.sizes = [np.array([len(p) for p in side.pieces], np.int64) for side in (self.a, self.b)]
        self.limit = len(self.a.pieces)
        n, m = self.limit, len(self.b.pieces)
        names = lambda count, end: [b"%d%s" % (i, end) for i in range(count)]
        #: an id's digits with what follows it: within a group or at its end, of A and of B
        self.written = names(n, b",") + names(n, b"|") + names(m, b",") + names(m, b";")
        self.first_b = 2 * n

    def tokens(self, raws: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides of each text; none where one of them does not keep the text's bytes."""
        none = np.zeros(0, np.int64)
        texts, places = [], []
        for k, raw in enumerate(raws):
            if raw:
                try:
                    texts.append(raw.decode())
                    places.append(k)
                except UnicodeDecodeError:
                    pass
        a, b = [none] * len(raws), [none] * len(raws)
        found = zip(places, self.a.encode([" " + t for t in texts]), self.b.encode(texts), strict=True) if texts else ()
        for k, left, right in found:
            whole = b" " + raws[k]
            if all(
                b"".join(map(side.pieces.__getitem__, ids)) == whole and all(map(side.pieces.__getitem__, ids))
                for side, ids in ((self.a, left), (self.b, right))
            ):
                a[k], b[k] = np.array(left, np.int64), np.array(right, np.int64)
        return a, b

    def align(self, raws: list[bytes]) -> dict[str, np.ndarray | list]:
        """Per text the numbers of tokens and groups and the groups written out; per link its ids and text."""
        a, b = self.tokens(raws)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        a, b = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in (a, b))
        doc = np.repeat(np.arange(len(raws)), n_a)
        # texts stand one behind the other with the same bytes on both sides, so their ends meet
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        at = np.searchsorted(ends_b, ends_a)
        met = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a if len(b) else np.zeros(0, bool)
        last_a, last_b = np.flatnonzero(met), at[met]
        # where each token stands when groups are written one behind the other, A before B
        group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
        before_b = np.concatenate(([0], last_b + 1))
        codes = np.zeros(len(a) + len(b), np.int64)
        ends = np.zeros(len(a), np.int64)
        ends[last_a] = self.limit
        codes[np.arange(len(a)) + before_b[group_a]] = a + ends
        ends = np.zeros(len(b), np.int64)
        ends[last_b] = len(self.b.pieces)
        codes[np.arange(len(b)) + last_a[group_b] + 1 if len(b) else []] = self.first_b + b + ends
        written, place = [], 0
        for n in (n_a + n_b).tolist():
            written.append(b"".join(map(self.written.__getitem__, codes[place : place + n].tolist()))[:-1])
            place += n
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(doc[last_a], minlength=len(raws)),
            "written": written,
            "a": a[last_a],
            "b": b[last_b],
            "doc": doc[last_a],
        }

    def runs(self, found: dict, radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
        """``(radix, pairs, records)`` of a slice: its links, sorted side-major and packed."""
        docs = max(1, len(found["n_a"]))
        whole, counts = np.unique((found["b"] * self.limit + found["a"]) * docs + found["doc"], return_counts=True)
        pair, doc = whole // docs, whole % docs
        radix = (pair // self.limit) % radixes
        for r in np.unique(radix).tolist():
            mine = radix == r
            pairs, n = pair[mine], counts[mine]
            first = np.flatnonzero(np.diff(pairs, prepend=-1))
            held = np.diff(first, append=len(pairs))
            yield (
                r,
                _pack(np.diff(pairs[first], prepend=0), np.add.reduceat(n, first)),
                _pack(held, doc[mine], n),
            )


@cache
def _aligner(byte_model: bytes, piece_model: bytes) -> Aligner:
    return Aligner(byte_model, piece_model)


def _spilled(docs: DataFrame, models, radixes: int, slice_bytes: int, text: str, keep, written: bool) -> DataFrame:
    """Rows of documents (with their slice and place in it) and rows of runs, in one stored table."""
    kept = [F.col(f"`{c}`") for c in keep] or [F.lit(True).alias("kept")]  # a struct needs a field
    source = docs.select(F.struct(*kept).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    longs = ["slice", "at", "n_a", "n_b", "n_groups"]
    fields = [T.StructField("row", source.schema["row"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in longs]
    fields += [T.StructField("groups_sha256", T.StringType()), T.StructField("groups", T.StringType())]
    fields += [T.StructField("radix", T.IntegerType())]
    fields += [T.StructField(c, T.BinaryType()) for c in ("pairs", "records")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*models.value)
        for k, batch in enumerate(slices(batches, size=slice_bytes)):
            number = (TaskContext.get().partitionId() << 32) + k
            found = aligner.align(texts_of(batch))
            n = batch.num_rows
            groups = [g.decode() for g in found["written"]]
            columns = {
                "row": batch.column("row"),
                "slice": pa.array(np.full(n, number)),
                "at": pa.array(np.arange(n)),
                **{c: pa.array(found[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups")},
                "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                "groups": pa.array(groups if written else [None] * n, pa.string()),
                "radix": pa.nulls(n, pa.int32()),
                "pairs": pa.nulls(n, pa.binary()),
                "records": pa.nulls(n, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
            made = list(aligner.runs(found, radixes))
            none = {c: pa.nulls(len(made), columns[c].type) for c in names}
            none |= {
                "slice": pa.array(np.full(len(made), number)),
                "radix": pa.array([r for r, _, _ in made], pa.int32()),
                "pairs": pa.array([p for _, p, _ in made], pa.binary()),
                "records": pa.array([d for _, _, d in made], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([none[c] for c in names], names=names)

    return stored(source.mapInArrow(run, T.StructType(fields)), "runs")


def _grouped(runs: DataFrame, group_bytes: int) -> DataFrame:
    """The runs with a column ``part``: as many parts for a radix as its packed bytes ask for."""
    weights = runs.groupBy("radix").agg(F.sum(F.octet_length("pairs") + F.octet_length("records")).alias("bytes"))
    parts = {r.radix: math.ceil(r.bytes / group_bytes) for r in weights.collect()}  # one row a radix
    many = F.coalesce(*[F.when(F.col("radix") == r, n) for r, n in parts.items()], F.lit(1))
    return runs.withColumn("part", F.pmod(F.xxhash64("slice"), many).cast("int"))


def _count(table: pa.Table) -> pa.Table:
    """Totals of a group's pairs by a heap merge of its runs."""

    def stream(frame: bytes) -> Iterator[tuple[int, int]]:
        steps, totals = _unpack(frame)
        return zip(np.cumsum(steps).tolist(), totals.tolist(), strict=True)

    pairs, counts = [], []
    for pair, same in groupby(heapq.merge(*map(stream, table.column("pairs").to_pylist())), key=lambda x: x[0]):
        pairs.append(pair)
        counts.append(sum(n for _, n in same))
    n = len(pairs)
    return pa.table(
        {
            "radix": pa.array([table.column("radix")[0].as_py()] * n, pa.int32()),
            "part": pa.array([table.column("part")[0].as_py()] * n, pa.int32()),
            "pair": pa.array(pairs, pa.int64()),
            "n": pa.array(counts, pa.int64()),
        }
    )


_CONTRIBUTED = "slice long, at array<int>, best array<long>, total array<long>"


def _contribute(runs: pa.Table, counted: pa.Table) -> pa.Table:
    """What each run adds to the documents of its slice, given the counts of the pairs it holds."""
    pairs = counted.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs = pairs[order]
    counts = counted.column("n").to_numpy()[order]
    best = counted.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    out = {"slice": [], "at": [], "best": [], "total": []}
    for number, frame, records in zip(*(runs.column(c).to_pylist() for c in ("slice", "pairs", "records")), strict=True):
        steps, _ = _unpack(frame)
        held, doc, n = _unpack(records)
        where = np.repeat(np.searchsorted(pairs, np.cumsum(steps)), held)
        docs, at = np.unique(doc, return_inverse=True)
        sums = np.zeros((2, len(docs)), np.int64)
        np.add.at(sums[0], at, best[where] * n)
        np.add.at(sums[1], at, counts[where] * n)
        for name, value in zip(out, (number, docs.astype(np.int32), *sums), strict=True):
            out[name].append(value)
    kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})


def _models(spark, byte_model: str, piece_model: str):
    """Both vocabulary files, of fixed size, for every task."""
    parts = []
    for path in (byte_model, piece_model):
        with open(path, "rb") as f:
            parts.append(f.read())
    ids = Tokenizer.from_str(parts[0].decode()).get_vocab(with_added_tokens=True).values()
    return spark.sparkContext.broadcast(tuple(parts)), 1 + max(ids)


def _counted(runs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Counts of the pairs of each group of runs, stored; and of all groups with their side's highest."""
    keys = ["radix", "part"]
    some = runs.select(*keys, "pairs").groupBy(*keys).applyInArrow(_count, "radix int, part int, pair long, n long")
    some = stored(some, "counts")
    totals = some.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("side", F.expr(f"pair div {limit}"))
    totals = stored(totals, "totals")
    # a row for each id of the piece vocabulary at most
    most = totals.groupBy("side").agg(F.max("n").alias("most"))
    return some, totals.join(F.broadcast(most), "side").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def pair_counts(
    docs: DataFrame, byte_model: str, piece_model: str, *, text: str = "text", radixes: int = RADIXES, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``(a, b, n, best)``: how often each pair of ids ends together in the corpus, and whether that is ``b``'s highest.

    Texts that have no tokens by ``align`` add nothing; an empty table has no pairs.
    """
    models, limit = _models(docs.sparkSession, byte_model, piece_model)
    rows = _spilled(docs, models, radixes, SLICE_BYTES, text, [], False)
    _, totals = _counted(_grouped(rows.filter("radix is not null"), group_bytes), limit)
    return totals.select((F.col("pair") % limit).alias("a"), F.expr(f"pair div {limit}").alias("b"), "n", "best")


def align(
    docs: DataFrame,
    byte_model: str,
    piece_model: str,
    *,
    text: str = "text",
    keep: Sequence[str] | None = None,
    groups: bool = False,
    radixes: int = RADIXES,
    slice_bytes: int = SLICE_BYTES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups)``, a row for each row of ``docs``.

    ``row`` holds the columns named in ``keep`` (all by default), so no name clashes. The byte
    vocabulary encodes a space and the text, the piece vocabulary the text. ``groups`` (null
    unless asked for) lists, between the places where tokens of both end, the ids of A and of B
    as ``a1,a2|b1;a3|b2,b3``. A link is a pair of tokens that end together: one for each group,
    as every token has bytes. ``n_best`` counts the links whose pair is as frequent in the corpus
    as any pair of its B id (ties all count), ``count_sum`` adds the counts of the pairs over the
    links.

    Null and empty texts, texts that are not UTF-8 and those whose tokens do not give back a
    space and the text have no tokens: zeros, and an empty digest and list. Repeated rows count
    as often as they stand there. Long texts are slices of their own. An empty table gives an
    empty result.
    """
    models, limit = _models(docs.sparkSession, byte_model, piece_model)
    rows = _spilled(docs, models, radixes, slice_bytes, text, keep or docs.columns, groups)
    runs = _grouped(rows.filter("radix is not null").select("slice", "radix", "pairs", "records"), group_bytes)
    some, totals = _counted(runs, limit)
    keys = ["radix", "part"]
    returned = some.select(*keys, "pair").join(totals, "pair")
    added = runs.groupBy(*keys).cogroup(returned.groupBy(*keys)).applyInArrow(_contribute, _CONTRIBUTED)
    each = added.select("slice", F.explode(F.arrays_zip("at", "best", "total")).alias("x"))
    sums = each.groupBy("slice", F.col("x.at").cast("long").alias("at")).agg(
        F.sum("x.best").alias("n_best"), F.sum("x.total").alias("count_sum")
    )
    found = rows.filter("radix is null").drop("radix", "pairs", "records").join(sums, ["slice", "at"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.select(
        "row", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256", "groups"
    )
