"""Prefix trie of conversations: what they share at their start, counted once.

A node is a sequence of first turns; the conversations that start with it are its members.

* A turn becomes two 60-bit parts of its SHA-256 and its length; no text moves. Turns are sorted by
  range and numbered there, with what a conversation has in earlier ranges added afterwards, so
  that one conversation may lie in many tasks. The digest of a prefix is a polynomial of its
  turns modulo a prime of 61 bits, twice: digests of parts put together give that of the whole.
* A count-min sketch counts the prefix digests: two rows of cells, sized by the number of prefixes
  up to ``WIDEST``. A cell that was hit once proves a singleton, and everything behind it in its
  conversation is one as well: such tails become nodes on the spot. All that tasks need is one
  bit a cell. Only prefixes that may be shared are shuffled and grouped exactly.
* Sums over subtrees need no walk. The nodes whose smallest member is a conversation are the end
  of its path, so each conversation carries what it owns to all nodes it is a member of, and a
  running sum gives the owner's own share. Groups add up before they move.
* Children look up their parent, and members their conversation, at salted copies. The ids that
  end at one node are sorted by range, joined to long strings there, and hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.llm.common import BASE, PRIME, SALTS, bit_set, fold, powers_of, product, shifted, spread_join, stored, width

#: Cells of each of the two rows of the sketch: eight for a prefix, at most this many (16 MB of bits).
WIDEST = 1 << 27
#: Depths of a conversation that meet one copy of what belongs to it.
STRETCH = 1024
#: Ids of one node that are joined to one string.
LISTED = 1 << 15

_NODE = ["depth", "d1", "d2"]
_NOTHING = hashlib.sha256(b"").hexdigest()


def _sorted(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Rows in ranges of the order, as many as shuffle partitions, and in order within them."""
    return rows.repartitionByRange(width(rows), *order).sortWithinPartitions(*order)


def _starts(ids: np.ndarray) -> np.ndarray:
    """For each row the first row of its run of equal ids."""
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))


def running_sum(rows: DataFrame, key: str, value: str, order: list[Column | str], name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` (long) over the rows of their key up to them, in the order given.

    Each range sums for itself; a key that continues from earlier ranges gets their sums added.
    A key may fill any number of ranges. No value may be null.
    """
    source = rows.select("*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, total = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(key).to_numpy()
            sums = np.cumsum(batch.column(value).to_numpy())
            before = sums - batch.column(value).to_numpy()
            sums = sums - before[_starts(ids)]
            if ids[0] == last:
                sums[ids == last] += total
            last, total = ids[-1], sums[-1]
            more = [pa.array(np.full(n, part)), pa.array(np.arange(at, at + n)), pa.array(sums)]
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "_part", "_at", name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    found = stored(_sorted(source, key, *order).mapInArrow(run, f"{fields}, _part long, _at long, `{name}` long"), "running")
    carried = []
    last, total = None, 0
    for part, first, end in _ends(found, key, name):
        total = total if first == last else 0
        if first == last:
            carried.append((part, first, total))
        total = end[1] + (total if end[0] == first else 0)
        last = end[0]
    if not carried:
        return found.drop("_part", "_at")
    # a row for each range at most
    spark = rows.sparkSession
    more = F.broadcast(spark.createDataFrame(carried, f"_part long, `{key}` long, _more long"))
    return (
        found.join(more, ["_part", key], "left")
        .withColumn(name, F.col(name) + F.coalesce("_more", F.lit(0).cast("long")))
        .select(*source.columns, name)
    )


def _ends(found: DataFrame, key: str, *values: str) -> list[tuple]:
    """``(part, first key, (last key, values of the last row))`` of each range that has rows, in order."""
    rows = found.groupBy("_part").agg(
        F.min(F.struct("_at", key)).alias("first"), F.max(F.struct("_at", key, *values)).alias("last")
    )
    return sorted((r["_part"], r.first[key], tuple(r["last"][v] for v in (key, *values))) for r in rows.collect())


def _turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, idx, v1, v2, size)``: turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    hexed = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    part = lambda at: F.conv(F.substring(hexed, at, 15), 16, 10).cast("long")
    rows = conversations.filter("`conv_id` IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        part(1).alias("v1"),
        part(16).alias("v2"),
        F.length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
        # so that equal rows need not lie in one range
        F.monotonically_increasing_id().alias("lot"),
    )
    numbered = running_sum(rows, "conv_id", "one", [F.col("turn").asc_nulls_first(), "v1", "v2", "lot"], "idx")
    return numbered.select("conv_id", "idx", "v1", "v2", "size")


def own_turns(turns: DataFrame) -> DataFrame:
    """Conversations as they are."""
    return turns.withColumn("kind", F.lit(1))


def borrowed_openings(turns: DataFrame, family: int = 100, longest: int = 6) -> DataFrame:
    """Conversations that take their first turns from the head of their family.

    The head of ``c`` is ``c - c % family``; its first ``h`` turns (all if it has fewer, none if
    there is no such conversation) replace the first ``h`` of ``c``, where ``h`` is the crc32 of
    ``c`` in decimal modulo ``longest``.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    heads = turns.filter((F.col("conv_id") % family == 0) & (F.col("idx") < longest))
    heads = heads.select(F.col("conv_id").alias("head"), "idx", "v1", "v2", "size")
    convs = turns.select("conv_id").distinct().withColumn("head", F.col("conv_id") - F.col("conv_id") % family)
    openings = convs.join(heads, "head").filter(F.col("idx") <= taken).select(*turns.columns, F.lit(0).alias("kind"))
    return openings.unionByName(turns.filter(F.col("idx") > taken).withColumn("kind", F.lit(1)))


def _chain(values: np.ndarray, at: np.ndarray, starts: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Digest of each prefix within its run: sums of value times power, modulo the prime."""
    terms = product(values.astype(np.uint64), powers[at])
    low = np.uint64((1 << 31) - 1)
    out = np.zeros(len(terms), np.uint64)
    for part, bits in ((terms & low, 0), (terms >> np.uint64(31), 31)):
        sums = np.cumsum(part)
        out = fold(out + shifted(fold(sums - (sums - part)[starts]), bits))
    return out


_PREFIX = "conv_id long, depth long, d1 long, d2 long, p1 long, p2 long, size long, last boolean, _part long, _at long"


def _prefixes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """``(conv_id, depth, d1, d2, p1, p2, size, last)``: every prefix of every conversation, the empty one too.

    ``d1, d2`` are its digest, ``p1, p2`` that of the prefix before it, ``size`` the length of its
    last turn, and ``last`` says that the conversation ends there.
    """
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("idx"), *[F.lit(0).cast("long").alias(c) for c in ("v1", "v2", "size")], F.lit(-1).alias("kind"))
    ordered = _sorted(roots.unionByName(rows), "conv_id", "kind", "idx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        state = (None, 0, np.uint64(0), np.uint64(0))  # conversation, turns so far, digest
        powers = powers_of(BASE, 1 << 12)
        held = None

        def block(columns, last):
            names = [f.split(" ")[0] for f in _PREFIX.split(", ")]
            arrays = {**columns, "last": last, "_part": np.full(len(last), part)}
            return pa.RecordBatch.from_arrays([pa.array(arrays[c]) for c in names], names=names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").to_numpy()
            starts = _starts(ids)
            turn = (batch.column("kind").to_numpy() >= 0).astype(np.int64)
            sums = np.cumsum(turn)
            depth = sums - (sums - turn)[starts]
            same = ids == state[0] if state[0] is not None else np.zeros(n, bool)
            depth[same] += state[1]
            if depth.max() >= len(powers):
                powers = powers_of(BASE, 2 * int(depth.max()))
            columns = {"conv_id": ids, "depth": depth, "size": batch.column("size").to_numpy(), "_at": np.arange(row, row + n)}
            ends = []
            for lane, value in enumerate(("v1", "v2")):
                values = batch.column(value).to_numpy()
                digest = _chain(values, depth, starts, powers)
                digest[same] = fold(digest[same] + state[2 + lane])
                before = np.zeros(n, np.uint64)
                before[1:] = digest[:-1]
                before[starts == np.arange(n)] = 0
                if same[0]:
                    before[0] = state[2 + lane]
                columns[f"d{lane + 1}"], columns[f"p{lane + 1}"] = digest.astype(np.int64), before.astype(np.int64)
                ends.append(digest[-1])
            state = (ids[-1], int(depth[-1]), *ends)
            row += n
            if held is not None:
                yield block(held, held["conv_id"] != ids[0])
            if n > 1:
                yield block({c: x[:-1] for c, x in columns.items()}, ids[:-1] != ids[1:])
            held = {c: x[-1:] for c, x in columns.items()}
        if held is not None:
            yield block(held, np.ones(1, bool))

    found = stored(ordered.mapInArrow(run, _PREFIX), "prefixes")
    # what a conversation has in earlier ranges, and where it goes on in the next
    carried, going_on = {}, set()
    ends = _ends(found, "conv_id", "depth", "d1", "d2")
    whole = None
    for k, (part, first, end) in enumerate(ends):
        if whole is not None and whole[0] == first:
            carried[part] = whole
            going_on.add(ends[k - 1][0])
            if end[0] == first:
                step = pow(BASE, whole[1], PRIME)
                end = (first, whole[1] + end[1], *((c + step * d) % PRIME for c, d in zip(whole[2:], end[2:], strict=True)))
        whole = end
    if not carried:
        return found.drop("_part", "_at")
    tails = {part: end[0] for part, _, end in ends}

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False).copy() for c in batch.schema.names}
            for part in np.unique(columns["_part"]).tolist():
                mine = columns["_part"] == part
                if part in carried:
                    conv, depth, *digests = carried[part]
                    some = mine & (columns["conv_id"] == conv)
                    step = np.uint64(pow(BASE, depth, PRIME))
                    columns["depth"][some] += depth
                    for lane, c in enumerate(digests, 1):
                        for name in (f"d{lane}", f"p{lane}"):
                            moved = fold(product(columns[name][some].astype(np.uint64), step) + np.uint64(c))
                            columns[name][some] = moved.astype(np.int64)
                if part in going_on:
                    columns["last"] &= ~(mine & (columns["conv_id"] == tails[part]))
            yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in batch.schema.names], names=batch.schema.names)

    return found.mapInArrow(join, _PREFIX).drop("_part", "_at")


def _screened(prefixes: DataFrame) -> DataFrame:
    """Prefixes with ``maybe`` (may be shared) and ``parent_maybe``, by the count-min sketch."""
    n = prefixes.count()
    cells = min(WIDEST, max(1 << 12, 1 << (8 * n).bit_length()))

    def cell(row: int, depth: Column, *digest: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(row), depth, *digest), F.lit(cells)) + F.lit(row * cells)

    own = [cell(row, F.col("depth"), "d1", "d2") for row in (0, 1)]
    above = [cell(row, F.col("depth") - 1, "p1", "p2") for row in (0, 1)]
    counts = prefixes.filter("depth > 0").select(F.explode(F.array(*own)).alias("cell")).groupBy("cell").count()
    hit = bit_set(counts.filter("count > 1").select("cell"), 2 * cells)
    flags = {
        "maybe": F.when(F.col("depth") == 0, True).otherwise(hit(own[0]) & hit(own[1])),
        "parent_maybe": F.when(F.col("depth") < 2, True).otherwise(hit(above[0]) & hit(above[1])),
    }
    return stored(prefixes.withColumns(flags), "screened")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, d1, d2, ends_sha256)``: SHA-256 of the ids that end at each node, ascending, joined by commas."""
    schema = "depth long, d1 long, d2 long, first long, ids string"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in _NODE]
            ids = batch.column("conv_id").to_numpy()
            new = np.ones(len(ids), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            at = np.flatnonzero(new | (np.arange(len(ids)) % LISTED == 0))
            to = np.append(at[1:], len(ids))
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(at, to, strict=True)]
            columns = [*(pa.array(k[at]) for k in keys), pa.array(ids[at]), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(columns, names=[*_NODE, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def done():
            return pa.RecordBatch.from_pylist([dict(zip([*_NODE, "ends_sha256"], (*node, digest.hexdigest()), strict=True))])

        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
                if key == node:
                    digest.update(b"," + ids.encode())
                else:
                    if node:
                        yield done()
                    node, digest = key, hashlib.sha256(ids.encode())
        if node:
            yield done()

    texts = _sorted(ends.select(*_NODE, "conv_id"), *_NODE, "conv_id").mapInArrow(listed, schema)
    dealt = texts.repartition(width(ends), *_NODE).sortWithinPartitions(*_NODE, "first")
    return dealt.mapInArrow(hashed, "depth long, d1 long, d2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rebuild: Callable[[DataFrame], DataFrame] = own_turns) -> DataFrame:
    """A row for each node of the trie of ``conversations`` (``conv_id, turn, role, text``).

    Columns: ``conv_id`` (smallest member), ``depth`` (turns, 0 for the root), ``parent_conv_id``
    (smallest member of the parent, null for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the subtree, members less
    one times code points of the node's last text), ``ends_sha256`` (of the decimal ids of the
    members that end there, ascending, joined by commas). ``conv_id`` and ``depth`` name a node.

    Turns are equal if role and text are. They are ordered by ``turn``, null first; equal turn
    numbers by the digest of role and text, and repeated rows are repeated turns. A null role or
    text is empty. Rows without a ``conv_id`` take no part. ``rebuild`` may change what turns the
    conversations have (see ``borrowed_openings``); a conversation that is left without turns is a
    member of the root and ends there. Other columns are ignored, whatever their names. An empty
    table has no nodes.
    """
    turns = _turns(conversations)
    convs = turns.select("conv_id").distinct()
    rows = _screened(_prefixes(convs, rebuild(turns)))
    shared, tails = rows.filter("maybe"), rows.filter("NOT maybe")

    nodes = stored(
        shared.groupBy(*_NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.count_if("last").alias("n_ends"),
            F.max(F.when(F.col("last"), F.col("conv_id"))).alias("end"),
            *[F.first(c).alias(c) for c in ("p1", "p2", "size")],
        ),
        "nodes",
    )
    up = (F.col("depth") - 1).alias("up")
    heads = tails.filter("parent_maybe").select("conv_id", "depth", "p1", "p2", up)
    children = nodes.filter("depth > 0").select("conv_id", "depth", "p1", "p2", up).unionByName(heads)
    counted = children.groupBy(F.col("up").alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    whole = nodes.join(counted, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    whole = whole.withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
    whole = stored(running_sum(whole, "conv_id", "saved", ["depth"], "upto"), "whole")

    # what each conversation owns: the leaf it is the smallest member of, and its nodes' savings
    owned = whole.select("conv_id", (F.col("n_children") == 0).cast("long").alias("leaf"), "saved")
    alone = tails.filter("last").select("conv_id", F.lit(1).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    owns = stored(owned.unionByName(alone).groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("owned")), "owns")
    stretch = F.floor(F.col("depth") / STRETCH)
    members = spread_join(shared.select(*_NODE, "conv_id"), owns, ["conv_id"], stretch)
    sums = members.groupBy(*_NODE).agg(
        F.sum(F.coalesce("leaf", F.lit(0).cast("long"))).alias("n_leaves"), F.sum(F.coalesce("owned", F.lit(0).cast("long"))).alias("all_owned")
    )
    mine = spread_join(whole.join(sums, _NODE), owns.drop("leaf"), ["conv_id"], stretch)
    # of the owner's savings those from this depth on belong to the subtree
    saved_tokens = F.col("all_owned") - (F.col("upto") - F.col("saved"))

    parents = nodes.select(F.col("depth").alias("up"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent"))
    found = spread_join(children, parents, ["up", "p1", "p2"], F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)))
    # a parent that was proven a singleton has the same conversation
    found = found.select("conv_id", "depth", F.coalesce("parent", "conv_id").alias("parent_conv_id"))
    several = _end_digests(shared.filter("last").join(nodes.filter("n_ends > 1").select(*_NODE), _NODE, "left_semi"))
    one = F.sha2(F.col("end").cast("string"), 256)
    digest = F.when(F.col("n_ends") == 0, F.lit(_NOTHING)).when(F.col("n_ends") == 1, one).otherwise(F.col("ends_sha256"))
    exact = mine.join(several, _NODE, "left").select(
        "conv_id", "depth", "n_convs", "n_children", "n_leaves", saved_tokens.alias("saved_tokens"), digest.alias("ends_sha256")
    )
    ended = F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_NOTHING))
    single = lambda n: F.lit(n).cast("long")
    local = tails.select(
        "conv_id",
        "depth",
        "parent_maybe",
        single(1).alias("n_convs"),
        F.when(F.col("last"), single(0)).otherwise(single(1)).alias("n_children"),
        single(1).alias("n_leaves"),
        single(0).alias("saved_tokens"),
        ended.alias("ends_sha256"),
    )
    plain = local.filter("NOT parent_maybe").withColumn("parent_conv_id", F.col("conv_id")).drop("parent_maybe")
    looked = exact.unionByName(local.filter("parent_maybe").drop("parent_maybe")).join(found, ["conv_id", "depth"], "left")
    return looked.unionByName(plain).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
