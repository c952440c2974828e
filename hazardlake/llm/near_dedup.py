"""Near-duplicate groups by bottom-k sketches of one hash function.

Every text becomes the set of its word shingles, each shingle one 64-bit hash. A sketch keeps
the ``k`` smallest hashes of a set; a set of up to ``k`` is its own sketch. The retained values
form inverted lists, and texts that meet in a list are candidates; the union of two sketches
estimates their similarity, and the full sets decide.

* Equal sets are one class before anything else, so exact copies cost one row.
* How many retained values a pair shares at least follows from the sizes of its sets: exactly
  where the sketches are whole sets, and otherwise but for ``deviations`` standard deviations
  of the hypergeometric count (six: a chance below 1e-8 for a pair right at the threshold).
  So the pair meets in the lists of the first few values of both sketches, in any common
  order, and what is left of both sketches from there on is at least as long. Both conditions
  are part of the join. The order puts frequent values last: how often each value stands among
  the first ones is counted exactly, and the most frequent ones, as many as a filter of fixed size
  tells apart, make five levels. So boilerplate stays out of the lists, at any size.
* Seeds come first: texts that agree in two of their four smallest values are compared with one
  text of each such list. That links nearly all copies with a few pairs for each text.
* What is linked is one component, named by one of its texts, and a list with a single component
  is finished without any pair. In the others texts of different components are compared: all
  of short lists, and of longer ones with growing numbers of pivots (32 times as many each
  round) until none is left. New links join the names of components, not all links again.
* Pairs are verified in blocks of texts that occur together, cut into tiles of bounded size: the
  set of a text is sent to its block once, however many pairs it stands in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.common import LOWER, bits_of, maybe_in, mix, slices, small_batches, span_hashes, stored, texts_of
from hazardlake.llm.graph import components
from hazardlake.session import scratch_path
from hazardlake.sources.tables import remove

SHINGLE = 5
SIMILARITY = 0.75
SKETCH = 256
DEVIATIONS = 6.0
#: Values of a sketch that the estimate of a pair looks at, and bits of each.
GLANCE = 128
#: Values that a level of frequent ones may hold, bits of its filter, and the least frequent of them.
FREQUENT = 1 << 20
BITS = 1 << 24
OFTEN = 4
#: Bits of the filter of values that several sketches retain, and the bits of a value that are counted.
SEVERAL = 1 << 27
KEY = (1 << 40) - 1
#: How many times as frequent each level is as the first.
LEVELS = (1, 4, 16, 64, 256)
#: Which of the smallest values of a sketch make a seed together.
SEEDS = ((0, 1), (2, 3), (0, 2), (1, 3))
#: Lists up to this size are compared at once; pivots of longer ones, and how their number grows.
SMALL = 256
GROWTH = 32
#: Bytes of text that a worker makes sets of at a time.
SLICE = 1 << 18
#: Pairs of lists that a worker looks at in one step, and pairs of a tile.
PAIRS = 1 << 18
#: Shingles of the sets that meet in one tile, twice over.
TILE = 1 << 20
#: A sketch that holds any set whole.
WHOLE = 1 << 30


def shingle_sets(texts: list[bytes], words: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text."""
    plain = [b" ".join(t.translate(LOWER).split()) for t in texts]
    data = np.frombuffer(b"\n".join(plain), np.uint8)
    lengths = np.fromiter((len(p) for p in plain), np.int64, len(plain))
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    cuts = np.flatnonzero(data == 32)
    first = np.searchsorted(cuts, offsets[:-1])
    last = np.searchsorted(cuts, offsets[:-1] + lengths)
    starts, ends, counts = [], [], []
    for at, size, i, j in zip(offsets.tolist(), lengths.tolist(), first.tolist(), last.tolist(), strict=False):
        inner = cuts[i:j]
        n = len(inner) + 1 - (size == 0)
        if n < words:
            starts.append(np.array([at] if n else [], np.int64))
            ends.append(np.array([at + size] if n else [], np.int64))
        else:
            starts.append(np.concatenate(([at], inner[: n - words] + 1)))
            ends.append(np.concatenate((inner[words - 1 :], [at + size])))
        counts.append(len(starts[-1]))
    if not starts:
        return
    hashes = span_hashes(data, np.concatenate(starts), np.concatenate(ends)).view(np.int64)
    at = 0
    for n in counts:
        yield np.unique(hashes[at : at + n])
        at += n


def set_key(values: np.ndarray) -> int | None:
    """64 bits that stand for a set of hashes; None for the empty set."""
    if not len(values):
        return None
    v = values.view(np.uint64)
    with np.errstate(over="ignore"):
        both = np.array([mix(v, 11).sum(), np.bitwise_xor.reduce(mix(v, 23))], np.uint64)
        return int((mix(both[:1], len(v)) ^ both[1:]).view(np.int64)[0])


_KEYS = "doc_id long, text_hash long, n_shingles long, cls long, sketch array<long>, seeds array<long>"


def _keyed(words: int, k: int):
    """Rows (doc_id, n_shingles, cls) of the documents, with their sketches and seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            sets = list(shingle_sets(texts_of(batch), words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([s[:k] for s in sets], pa.list_(pa.int64())),
                    pa.array([_seeds(s) if len(s) else s for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "cls", "sketch", "seeds"],
            )

    return run


def _kept(n: int, k: int, similarity: float, deviations: float) -> int:
    """Of how many values of the sketch of ``n`` shingles a similar set has at least one, in any order."""
    return min(n, k) - int(_least(np.array([n]), k, similarity, deviations)[0]) + 1


def _least(n: np.ndarray, k: int, similarity: float, deviations: float) -> np.ndarray:
    """Retained values that a text of ``n`` shingles shares with any text as similar as asked."""
    exact = np.ceil(n * similarity - 1e-9)
    widest = np.maximum(n / similarity, 1)
    spread = k * similarity * (1 - similarity) * np.maximum(0, 1 - k / widest)
    guess = np.floor(k * similarity - deviations * np.sqrt(spread))
    return np.maximum(1, np.where(widest <= k, exact, np.minimum(exact, guess))).astype(np.int64)


def _shared(n, m, k: int, similarity: float, deviations: float):
    """Retained values that texts of ``n`` and ``m`` shingles share if they are similar enough."""
    met = (n + m) * F.lit(similarity / (1 + similarity))
    most = F.greatest(n, m)
    part = met / most
    spread = part * (1 - part) * k * (1 - F.lit(float(k)) / most)
    return F.when(most <= k, F.ceil(met - 1e-9)).otherwise(
        F.floor(part * k - deviations * F.sqrt(F.greatest(spread, F.lit(0.0))))
    )


def _seeds(values: np.ndarray) -> np.ndarray:
    """One value for each pair of small values that a seed is made of; a lone value is a pair with itself."""
    v = values[:4].view(np.uint64)
    chosen = [(i, j) for i, j in SEEDS if j < len(v)] or [(0, 0)]
    with np.errstate(over="ignore"):
        return np.array([mix(v[i : i + 1], 31) + mix(v[j : j + 1], 37) for i, j in chosen], np.uint64).ravel().view(np.int64)


def _poster(k: int, similarity: float, deviations: float, filters):
    """Sketches to the postings of their first values, frequent ones last.

    Values that surely no other sketch retains need no list. The filter of the others has a fixed size:
    the more values there are, the more of the rest pass, for the join of the lists to drop.
    """

    def among(bits: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
        slot = v & (size - 1)
        return (bits[slot >> 6] >> (slot & 63)) & 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, several = filters.value
        for batch in batches:
            values, classes, sizes, rests = [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("cls", "n_shingles")), batch.column("sketch"), strict=True)
            for name, n, sketch in rows:
                v = sketch.values.to_numpy()
                kept = _kept(n, k, similarity, deviations)
                level = sum((among(m, v, BITS) for m in levels), np.zeros(len(v), np.int64))
                first = v[np.lexsort((v, level))[:kept]]
                met = np.flatnonzero(among(several, first, SEVERAL))
                values.append(first[met])
                classes.append(np.full(len(met), name, np.int64))
                sizes.append(np.full(len(met), n, np.int64))
                rests.append(len(v) - met)
            if values:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (values, classes, sizes, rests)], names=["value", "cls", "n", "rest"]
                )

    return run


def _counted(values: DataFrame, folder: str) -> DataFrame:
    """How many sketches retain each value that several do; values go by their low bits, which tell them apart but for few."""
    key = F.col("value").bitwiseAND(F.lit(KEY)).alias("key")
    return stored(values.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1"), "counts", folder)


def _filter(counts: DataFrame, bits: int) -> np.ndarray:
    return bits_of(counts.select(F.pmod(F.col("key"), F.lit(bits))), bits)


def _levels(counts: DataFrame) -> list[np.ndarray]:
    """Filters of the values that many sketches retain, each level rarer than the next."""
    # one row for each power of two
    tally = {r.power: r["count"] for r in counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()}
    least = OFTEN.bit_length() - 1
    while sum(n for power, n in tally.items() if power >= least) > FREQUENT:
        least += 1
    return [_filter(counts.filter(F.col("n") >= (1 << least) * times), BITS) for times in LEVELS]


def _setter(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            sets = [s for s in shingle_sets(texts_of(batch), words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                names=["cls", "n", "items"],
            )

    return run


_TILE = ["block", "row", "column"]


def _blocks(pairs: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """Pairs with the tile that they are compared in.

    A block is named by the least text that a pair's ends meet in any pair, so texts of one group of
    copies mostly share one block, and each set is sent to it once instead of once for each pair. Blocks
    of more than ``TILE`` shingles, or of more pairs than ``PAIRS``, are cut into tiles by both ends.
    """
    ends = pairs.select(F.col("pivot").alias("cls"), F.col("member").alias("other")).unionByName(
        pairs.select(F.col("member").alias("cls"), F.col("pivot").alias("other"))
    )
    lows = ends.groupBy("cls").agg(F.min("other").alias("low")).withColumn("low", F.least("low", "cls"))
    lows = stored(lows.join(sets.select("cls", "n"), "cls"), "lows", folder)
    named = pairs
    for end in ("pivot", "member"):
        named = named.join(lows.select(*(F.col(c).alias(f"{end}_{c}") for c in lows.columns)), F.col(end) == F.col(f"{end}_cls"))
    block = F.least("pivot_low", "member_low").alias("block")
    named = stored(named.select(block, "pivot", "member", "pivot_n", "member_n"), "named", folder)

    held = named.select(
        "block",
        F.explode(F.array(*(F.struct(F.col(e).alias("cls"), F.col(f"{e}_n").alias("n")) for e in ("pivot", "member")))).alias("end"),
    )
    weights = held.distinct().groupBy("block").agg(F.sum("end.n").alias("shingles"))
    counts = named.groupBy("block").agg(F.count("*").alias("pairs"))
    tiles = F.ceil(F.greatest(F.col("shingles") / TILE, F.sqrt(F.col("pairs") / PAIRS)))
    large = weights.join(counts, "block").select("block", tiles.alias("tiles")).filter("tiles > 1")
    large = stored(large, "large", folder)
    part = lambda end: F.pmod(F.xxhash64(end), F.coalesce("tiles", F.lit(1)))
    return named.join(large, "block", "left").select(
        "block", part("pivot").alias("row"), part("member").alias("column"), "pivot", "member"
    )


def _similar(a: np.ndarray, b: np.ndarray, similarity: float, deviations: float, glance: int) -> bool:
    """Whether two sorted sets are similar enough: their union sketch first, then the sets, in integers.

    The union sketch is the ``glance`` smallest values of both; those in both, counted against its
    size, estimate the similarity. There is no margin where it holds both sets whole, and without a
    glance the sets decide alone.
    """
    if glance:
        least = np.union1d(a[:glance], b[:glance])
        margin = 1.0 if len(least) <= glance and max(len(a), len(b)) <= glance else deviations * (similarity * (1 - similarity) * glance) ** 0.5 + 1
        least = least[:glance]
        met = len(least) and np.isin(least, a[:glance]) & np.isin(least, b[:glance])
        if np.sum(met) < len(least) * similarity - margin:
            return False
    hundred = round(similarity * 100)
    met = len(np.intersect1d(a, b, assume_unique=True))
    return met * (100 + hundred) >= (len(a) + len(b)) * hundred


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float, deviations: float, glance: int, folder: str) -> DataFrame:
    """Pairs whose full sets are similar enough, as edges ``(a, b)``; tiles of pairs meet their sets."""
    tiled = _blocks(pairs, sets, folder)
    tile = [f"to_{c}" for c in _TILE]
    ends = tiled.select(*(F.col(c).alias(f"to_{c}") for c in _TILE), F.explode(F.array("pivot", "member")).alias("cls")).distinct()
    carried = ends.join(sets.select("cls", "items"), "cls")

    def compare(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        items = dict(zip(sets.column("cls").to_pylist(), (x.values.to_numpy() for x in sets.column("items")), strict=True))
        ends = zip(pairs.column("pivot").to_pylist(), pairs.column("member").to_pylist(), strict=True)
        near = [(min(p, m), max(p, m)) for p, m in ends if _similar(items[p], items[m], similarity, deviations, glance)]
        return pa.table([pa.array([e[i] for e in near], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return tiled.groupBy(*_TILE).cogroup(carried.groupBy(*tile)).applyInArrow(compare, "a long, b long")


def near_groups(
    docs: DataFrame,
    *,
    words: int = SHINGLE,
    similarity: float = SIMILARITY,
    k: int = SKETCH,
    deviations: float = DEVIATIONS,
    exact: bool = False,
) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id, kept)``, one row for each row of ``docs``.

    Documents are linked when their shingle sets reach the similarity (Jaccard, in hundredths,
    confirmed on the full sets of 61-bit polynomial hashes); ``text_hash`` is the text's ``xxhash64``,
    which tells rows of one ``doc_id`` apart; ``component_id`` is the least ``doc_id`` that
    links reach and ``kept`` says whether it is the row's own. Texts are compared after
    lower-casing A-Z, words are split at ASCII white space, and a text of fewer words than a
    shingle is one shingle. ``exact`` takes whole sets as sketches and rules no pair out by
    an estimate, for those who cannot live with the chance that ``deviations`` leave.

    Null, empty and blank texts have no shingle, are linked with nothing and are kept. Rows
    that repeat a ``doc_id`` with the same text are the same document and are kept or dropped
    together; a null ``doc_id`` is never the least of a group, and a group of nulls is kept.
    Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if exact:
        k = WHOLE
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = texts.withColumn("text_hash", F.xxhash64("text"))
    folder = scratch_path(spark, "near")
    rows = stored(hashed.mapInArrow(_keyed(words, k), _KEYS), "classes", folder)
    keyed = stored(rows.drop("sketch", "seeds"), "keyed")
    classes = keyed.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"))

    counts = _counted(rows.filter("cls IS NOT NULL").select(F.explode("sketch").alias("value")), folder)
    filters = _levels(counts), _filter(counts, SEVERAL)
    poster = _poster(k, similarity, deviations, spark.sparkContext.broadcast(filters))
    sketches = rows.filter("cls IS NOT NULL").select("cls", "n_shingles", "sketch")
    postings = stored(sketches.mapInArrow(poster, "value long, cls long, n long, rest long"), "postings", folder)
    shared = (
        postings.groupBy("value").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low < high").select("value")
    )
    lists = stored(postings.join(shared, "value", "left_semi").dropDuplicates(["value", "cls"]), "lists", folder)

    glance = 0 if exact else min(GLANCE, k)
    # ids that stand in several rows
    again = stored(keyed.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again")), "again", folder)
    repeated = not again.isEmpty()

    def linked(pairs: DataFrame) -> DataFrame:
        """Edges of the pairs that are similar."""
        ends = pairs.select(F.explode(F.array("pivot", "member")).alias("cls")).distinct()
        wanted = stored(ends.join(classes, "cls").select(F.col("least").alias("wanted")).distinct(), "wanted", folder)
        some = texts.filter(maybe_in(wanted)(F.col("doc_id"))).join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
        # one Python function a task: the test of ids is one, the setter is another
        part = scratch_path(spark, "near")
        some = stored(some, "texts", part)
        setter, schema = _setter(words), "cls long, n int, items array<long>"
        if repeated:
            same = F.col("doc_id").eqNullSafe(F.col("again"))
            twice = some.join(again, same, "left_semi").mapInArrow(setter, schema).dropDuplicates(["cls"])
            sets = some.join(again, same, "left_anti").mapInArrow(setter, schema).unionByName(twice)
        else:
            sets = some.mapInArrow(setter, schema)
        sets = stored(sets, "sets", folder)
        remove(spark, part)
        return stored(_verified(pairs, sets, similarity, deviations, glance, folder), "links", folder)

    labels = _joined(None, linked(_seed_pairs(rows, similarity, folder)), folder)
    chance = GROWTH
    while True:
        marked = _marked(lists, labels, chance, folder)
        if marked.isEmpty():
            break
        pairs = _candidates(marked, k, similarity, deviations, folder)
        labels = _joined(labels, linked(pairs), folder)
        # a pivot has been compared with its whole list
        lists = marked.filter("NOT pivot").select("value", "cls", "n", "rest")
        chance *= GROWTH

    labels = stored(labels, "labels")
    # what the links came from is not read any more
    remove(spark, folder)
    labelled = classes.join(labels, classes.cls == labels.node, "left").select(
        "cls", "least", F.coalesce("label", "cls").alias("label")
    )
    lowest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = labelled.join(lowest, "label").select("cls", "component_id")
    return (
        keyed.join(groups, "cls", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _seed_pairs(rows: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Each text with the least one of its seeds' lists; no list is expanded."""
    seeds = rows.filter("cls IS NOT NULL").select(F.explode("seeds").alias("value"), "cls", F.col("n_shingles").alias("n")).distinct()
    lows = seeds.groupBy("value").agg(F.min(F.struct("cls", "n")).alias("low"), F.max("cls").alias("high"))
    lows = lows.filter("low.cls < high").select("value", "low")
    near = F.least("n", "low.n") >= F.greatest("n", "low.n") * F.lit(similarity) - 1e-9
    met = seeds.join(lows, "value").filter((F.col("cls") != F.col("low.cls")) & near)
    return stored(met.select(F.col("low.cls").alias("pivot"), F.col("cls").alias("member")).distinct(), "pairs", folder)


def _joined(labels: DataFrame | None, edges: DataFrame, folder: str) -> DataFrame:
    """``(node, label)`` of all texts that are linked with others, after more links."""
    if labels is None:
        return stored(components(edges, folder), "labels", folder)
    if edges.isEmpty():
        return labels
    # links between components: names in place of their texts
    names = {}
    named = edges
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        named = named.join(of, end, "left")
        names[end] = F.coalesce(f"{end}_label", end)
    between = named.select(F.least(*names.values()).alias("a"), F.greatest(*names.values()).alias("b")).filter("a < b")
    moved = stored(components(between, folder), "moved", folder).select(F.col("node").alias("old"), F.col("label").alias("new"))
    known = labels.join(moved, labels.label == moved.old, "left").select("node", F.coalesce("new", "label").alias("label"))
    fresh = moved.join(labels, moved.old == labels.node, "left_anti").select(F.col("old").alias("node"), F.col("new").alias("label"))
    return stored(known.unionByName(fresh), "labels", folder)


def _marked(lists: DataFrame, labels: DataFrame, chance: int, folder: str) -> DataFrame:
    """Members of the lists that hold several components, with their pivots marked.

    A pivot is the least member, every member of a short list, and about ``chance`` members of a
    long one; the same classes in all their lists, as far as list sizes allow.
    """
    named = lists.join(labels, lists.cls == labels.node, "left").select(
        "value", "cls", "n", "rest", F.coalesce("label", "cls").alias("label")
    )
    sizes = (
        named.groupBy("value")
        .agg(
            F.count("*").alias("members"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min("cls").alias("first"),
        )
        .filter("low < high")
        .drop("low", "high")
    )
    lot = F.pmod(F.xxhash64("cls"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    pivot = (F.col("cls") == F.col("first")) | (F.col("members") <= SMALL) | (lot * F.col("members") < float(chance))
    return stored(named.join(sizes, "value").withColumn("pivot", pivot), "marked", folder)


def _short(similarity: float, need):
    """Pairs of the members of short lists; rows come in the order of the lists' first members.

    What members of different components have in common, they have in many lists that mostly begin with
    the same member: so a pair comes out about once.
    """

    def pairs_of(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        value, size = columns["value"], len(columns["value"])
        new = np.ones(size, bool)
        new[1:] = (value[1:] != value[:-1]) | (columns["first"][1:] != columns["first"][:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], size)[np.cumsum(new) - 1]
        found = np.zeros((0, 2), np.int64)
        at = 0
        while at < size:
            # so many rows that their pairs fit into memory
            counts = np.cumsum(ends[at:] - np.arange(at, size) - 1)
            to = at + max(1, int(np.searchsorted(counts, PAIRS, "right")))
            later = ends[at:to] - np.arange(at, to) - 1
            left = np.repeat(np.arange(at, to), later)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)
            n, m = columns["n"][left], columns["n"][right]
            fits = (columns["label"][left] != columns["label"][right]) & (np.minimum(n, m) >= np.maximum(n, m) * similarity - 1e-9)
            left, right, n, m = left[fits], right[fits], n[fits], m[fits]
            fits = np.minimum(columns["rest"][left], columns["rest"][right]) >= need(n, m)
            ends_of = np.stack((columns["cls"][left[fits]], columns["cls"][right[fits]]), 1)
            found = np.unique(np.concatenate((found, np.sort(ends_of, 1))), axis=0)
            at = to
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["pivot", "member"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            if held is not None:
                columns = {c: np.concatenate((held[c], x)) for c, x in columns.items()}
            # lists of the last first member may go on
            cut = int(np.flatnonzero(columns["first"] != columns["first"][-1])[-1:].sum()) + 1 if (columns["first"] != columns["first"][-1]).any() else 0
            held = {c: x[cut:] for c, x in columns.items()}
            if cut:
                yield pairs_of({c: x[:cut] for c, x in columns.items()})
        if held is not None:
            yield pairs_of(held)

    return run


def _needed(n: np.ndarray, m: np.ndarray, k: int, similarity: float, deviations: float) -> np.ndarray:
    """``_shared`` of arrays."""
    met = (n + m) * (similarity / (1 + similarity))
    most = np.maximum(n, m)
    part = met / most
    spread = np.maximum(0, part * (1 - part) * k * (1 - k / most))
    with np.errstate(invalid="ignore"):
        return np.where(most <= k, np.ceil(met - 1e-9), np.floor(part * k - deviations * np.sqrt(spread)))


def _candidates(marked: DataFrame, k: int, similarity: float, deviations: float, folder: str) -> DataFrame:
    """Pairs ``(pivot, member)`` of different components that may be similar enough."""
    short = marked.filter(F.col("members") <= SMALL).select("first", "value", "cls", "n", "rest", "label")
    need = lambda n, m: _needed(n, m, k, similarity, deviations)
    dealt = short.repartition("first").sortWithinPartitions("first", "value", "cls")
    short = dealt.mapInArrow(_short(similarity, need), "pivot long, member long")

    long = marked.filter(F.col("members") > SMALL)
    chosen = long.filter("pivot").select("value", *(F.col(c).alias(f"p_{c}") for c in ("cls", "n", "rest", "label")))
    least = _shared(F.col("n"), F.col("p_n"), k, similarity, deviations)
    members = long.select(F.col("value").alias("at"), "cls", "n", "rest", "label", "pivot")
    met = members.join(
        chosen,
        (F.col("at") == F.col("value"))
        & (F.col("label") != F.col("p_label"))
        & (~F.col("pivot") | (F.col("cls") > F.col("p_cls")))
        & (F.least("n", "p_n") >= F.greatest("n", "p_n") * F.lit(similarity) - 1e-9)
        & (F.col("rest") >= least)
        & (F.col("p_rest") >= least),
    )
    pairs = short.unionByName(met.select(F.col("p_cls").alias("pivot"), F.col("cls").alias("member")))
    return stored(pairs.distinct(), "pairs", folder)
