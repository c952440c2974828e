"""Approximate nearest neighbours: one navigable small-world graph for each shard.

Equal vectors are one entry with its least ids. Entries are dealt by hash to shards of about
``SHARD`` entries, and each shard builds its layered graph, kept as flat arrays: the
neighbours of entry ``i`` on a layer stand at ``i * width``, -1 where there is none. Blocks of
queries meet every shard, and the shards' answers are merged by their exact cosine.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.llm.common import stored

#: Entries of a shard and queries of a block, on average.
SHARD = 8192
BLOCK = 1024
WIDTH = 12
#: Near nodes that the links of a node are chosen from, and nodes that are joined at a time.
FOUND_BUILD = 48
JOINED = 512
BREADTH_SEARCH = 160


def _spread(units: np.ndarray, scores: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """For rows of nodes (-1 for none, best first): near ones, but none that is nearer to a chosen one than
    to the row's centre; then the nearest of the rest."""
    n, width = nodes.shape
    near = units[np.maximum(nodes, 0)]
    among = near @ near.transpose(0, 2, 1)
    there = nodes >= 0
    blocked = np.full((n, width), -2.0)
    kept = np.zeros((n, width), bool)
    for k in range(width):
        take = there[:, k] & (kept.sum(1) < most) & (blocked[:, k] < scores[:, k])
        kept[:, k] = take
        blocked = np.where(take[:, None], np.maximum(blocked, among[:, k]), blocked)
    # chosen ones first, then others in their order, then nothing
    order = np.argsort(np.where(kept, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(nodes, order, 1)


def _join(units: np.ndarray, members: np.ndarray, done: int, upto: int, links: np.ndarray, found: int) -> None:
    """Link ``members[done:upto]`` with near ones of ``members[:upto]``, both ways."""
    known = units[members[:upto]]
    some = min(found, upto - 1)
    for first in range(done, upto, JOINED):
        at = np.arange(first, min(first + JOINED, upto))
        scores = units[members[at]] @ known.T
        scores[np.arange(len(at)), at] = -3.0
        near = np.argpartition(-scores, some - 1, axis=1)[:, :some]
        near = np.sort(near, axis=1)  # ties in order of the nodes
        order = np.argsort(-np.take_along_axis(scores, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        chosen = _spread(units, np.take_along_axis(scores, near, 1), members[near], WIDTH)
        links[members[at], : chosen.shape[1]] = chosen
    new = members[done:upto]
    ends = links[new][:, :WIDTH]
    target, source = ends.ravel(), np.repeat(new, ends.shape[1])
    source, target = source[target >= 0], target[target >= 0]
    # what a node has already and what comes to it, once each, best first
    own = np.unique(target)
    have = links[own]
    target = np.concatenate((target, np.repeat(own, have.shape[1])))
    source = np.concatenate((source, have.ravel()))
    target, source = target[source >= 0], source[source >= 0]
    pairs = np.unique(target.astype(np.int64) * len(units) + source)
    target, source = pairs // len(units), pairs % len(units)
    scores = np.einsum("ij,ij->i", units[target], units[source])
    order = np.lexsort((source, -scores, target))
    target, source, scores = target[order], source[order], scores[order]
    start = np.searchsorted(target, own)
    place = np.arange(len(target)) - start[np.searchsorted(own, target)]
    # of a node that very many come to, the nearest ones compete
    width = min(int(place.max()) + 1, 3 * links.shape[1])
    inside = place < width
    nodes, values = np.full((len(own), width), -1), np.full((len(own), width), -3.0)
    row = np.searchsorted(own, target[inside])
    nodes[row, place[inside]], values[row, place[inside]] = source[inside], scores[inside]
    for first in range(0, len(own), JOINED):
        rows = slice(first, first + JOINED)
        chosen = _spread(units, values[rows], nodes[rows], links.shape[1])
        links[own[rows]] = -1
        links[own[rows], : chosen.shape[1]] = chosen


class Graph:
    """Layered graph over unit vectors; the lowest layer has twice the width."""

    def __init__(self, units: np.ndarray, levels: np.ndarray, layers: list[np.ndarray], entry: int):
        self.units, self.levels, self.layers, self.entry = units, levels, layers, entry
        self.mark = np.zeros(len(units), np.int64)
        self.round = 0

    @classmethod
    def build(cls, units: np.ndarray, lots: np.ndarray, found: int = FOUND_BUILD) -> Graph:
        """``lots`` in (0, 1] draw the levels, so that a repeated task builds the same graph.

        Nodes come in rounds, each as many as all before it. Every node of a round is linked with
        near ones among those so far, by one product of matrices for a block of nodes, and they with
        it: so early nodes keep the long links that later walks begin with.
        """
        levels = np.minimum((-np.log(lots) / np.log(WIDTH)).astype(np.int64), 8)
        layers = []
        for layer in range(int(levels.max()) + 1):
            members = np.flatnonzero(levels >= layer)
            links = np.full((len(units), WIDTH * (2 if layer == 0 else 1)), -1, np.int32)
            done = 1
            while done < len(members):
                upto = min(2 * done, len(members))
                _join(units, members, done, upto, links, found)
                done = upto
            layers.append(links)
        return cls(units, levels, layers, int(np.argmax(levels)))

    def _walk(self, vector: np.ndarray, at: list[tuple[float, int]], breadth: int, layer: int) -> list[tuple[float, int]]:
        """Up to ``breadth`` nearest nodes that a best-first walk from ``at`` meets."""
        self.round += 1
        mark, stamp, links, units = self.mark, self.round, self.layers[layer], self.units
        best = list(at)
        heapq.heapify(best)
        todo = [(-s, n) for s, n in at]
        heapq.heapify(todo)
        for _, n in at:
            mark[n] = stamp
        while todo:
            score, node = heapq.heappop(todo)
            if len(best) >= breadth and -score < best[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[mark[near] != stamp]
            if not len(near):
                continue
            mark[near] = stamp
            for s, n in zip((units[near] @ vector).tolist(), near.tolist(), strict=True):
                if len(best) < breadth:
                    heapq.heappush(best, (s, n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, n))
                else:
                    continue
                heapq.heappush(todo, (-s, n))
        return best

    def search(self, vector: np.ndarray, k: int, breadth: int = BREADTH_SEARCH) -> list[int]:
        """The nearest nodes that a walk meets, twice ``k`` of them; of all nodes if it meets too few."""
        at = [(float(vector @ self.units[self.entry]), self.entry)]
        for layer in range(len(self.layers) - 1, 0, -1):
            at = self._walk(vector, at, 1, layer)
        at = self._walk(vector, at, max(breadth, 2 * k), 0)
        if len(at) < min(2 * k, len(self.units)):
            at = list(zip((self.units @ vector).tolist(), range(len(self.units)), strict=True))
        return [n for _, n in heapq.nlargest(2 * k, at)]


def _units(vectors: np.ndarray) -> np.ndarray:
    # the largest component first, so that no square overflows or vanishes
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


_INDEX = (
    "dimension int, shard int, entries array<long>, ids array<array<long>>, vectors array<double>, "
    "levels array<int>, layers array<array<int>>, start int"
)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    # the order in which rows arrive may differ from run to run, the graph must not
    group = group.sort_values("entry", kind="stable")
    vectors = np.array(group["vector"].tolist(), np.float64)
    entries = group["entry"].to_numpy()
    lots = ((entries.view(np.uint64) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    graph = Graph.build(_units(vectors), lots)
    row = {
        "dimension": int(group["dimension"].iloc[0]),
        "shard": int(group["shard"].iloc[0]),
        "entries": entries,
        "ids": group["ids"].tolist(),
        "vectors": vectors.ravel(),
        "levels": graph.levels.astype(np.int32),
        "layers": [layer.ravel() for layer in graph.layers],
        "start": graph.entry,
    }
    return pd.DataFrame([row])


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector, dimension)``, distinct, of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        # both zeros are one value, so that equal vectors are equal arrays
        .withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
        .filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .withColumn("dimension", F.size("vector"))
        .withColumn("entry", F.xxhash64("vector"))
        .distinct()
    )


def build_index(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row of flat arrays for each shard; ``rows`` are those of :func:`usable`.

    An entry keeps the least ``k + 1`` of the ids that share its vector; a query that is one of
    them still has ``k`` others, so no further id can be among its nearest.
    """
    place = Window.partitionBy("entry", "vector").orderBy("vec_id")
    entries = stored(
        rows.withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= k + 1)
        .groupBy("entry", "vector", "dimension")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids")),
        "entries",
    )
    sizes = entries.groupBy("dimension").agg(F.ceil(F.count("*") / shard).alias("shards"))
    dealt = entries.join(sizes, "dimension").withColumn(
        "shard", F.pmod(F.xxhash64("entry", F.lit(1)), F.col("shards")).cast("int")
    )
    # a shard is much work for few bytes: adaptive execution would put many of them into one task
    total = sizes.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0]
    alone = dealt.drop("shards").repartition(max(1, int(total)), "dimension", "shard")
    return stored(alone.groupBy("dimension", "shard").applyInPandas(_build, _INDEX), "index")


_FOUND = "query long, vec_id long, score double"


def _answer(k: int, breadth: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                vectors = np.asarray(row.vectors).reshape(-1, row.dimension)
                units = _units(vectors)
                layers = [np.asarray(layer).reshape(len(units), -1) for layer in row.layers]
                graph = Graph(units, np.asarray(row.levels), layers, row.start)
                wanted = np.array([list(v) for v in row.query_vectors], np.float64)
                out = []
                for name, vector, unit in zip(row.queries, wanted, _units(wanted), strict=True):
                    found = graph.search(unit, k, breadth)
                    near = vectors[found]
                    scores = (near @ vector) / (np.linalg.norm(near, axis=1) * np.linalg.norm(vector))
                    # an overflow or a vanished product is settled by the unit vectors
                    scores = np.where(np.isfinite(scores), scores, units[found] @ unit)
                    for n, score in zip(found, scores.tolist(), strict=True):
                        out.extend((name, i, score) for i in row.ids[n])
                yield pd.DataFrame(out, columns=["query", "vec_id", "score"])

    return run


def search(
    rows: DataFrame, index: DataFrame, queries: DataFrame, k: int, *, block: int = BLOCK, breadth: int = BREADTH_SEARCH
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each id of ``queries`` its ``k`` nearest other ids."""
    asked = queries.select("entry", "vector", "dimension").distinct()
    blocks = max(1, -(-asked.count() // block))
    grouped = (
        asked.withColumn("block", F.pmod(F.xxhash64("entry", F.lit(2)), F.lit(blocks)))
        .groupBy("dimension", "block")
        .agg(F.collect_list(F.struct("entry", "vector")).alias("q"))
        .select("dimension", F.col("q.entry").alias("queries"), F.col("q.vector").alias("query_vectors"))
    )
    shards = index.select("dimension", "shard").distinct()
    found = (
        grouped.join(shards, "dimension")
        .join(index, ["dimension", "shard"])
        .mapInPandas(_answer(k, breadth), _FOUND)
    )
    merged = (
        found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
        .filter(F.col("place") <= k + 1)
        .drop("place")
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
        .join(merged, "query")
        .filter("vec_id <> query_id")
        # an id that has several vectors counts with its best
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_neighbours(vectors: DataFrame, chosen, k: int = 5) -> DataFrame:
    """The ``k`` nearest other rows by cosine for each row where the condition ``chosen`` on ``vec_id`` holds.

    ``vectors`` has ``vec_id`` and ``embedding``. Rows with a null id, and vectors that are null,
    empty, zero or hold a null or non-finite component take no part. A query meets vectors of
    its own length only. Ties go to the least ``vec_id``; a query with fewer candidates gets
    all. Repeated rows count once, and an id that has several vectors counts with its best score. Other columns are ignored; an empty table gives an empty result.
    """
    rows = usable(vectors)
    index = build_index(rows, k)
    return search(rows, index, rows.filter(chosen), k)
