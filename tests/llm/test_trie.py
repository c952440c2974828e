"""The prefix trie against SQL and a plain trie."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import data
import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from hazardlake.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, d1 string, idx string, kind string, `odd name.` int"
EXTRA = ("a", "b", "c", "d", 1)


def sequences(rows):
    """Turns of each conversation in order; ties by the digest of role and text."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            pair = ((role or ""), (text or ""))
            tie = hashlib.sha256(f"{len(pair[0].encode())}:".encode() + "".join(pair).encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), tie[:30], pair))
    return {c: [p for _, _, p in sorted(t)] for c, t in turns.items()}


def borrowed(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = int(np.fix(c / 100)) * 100
        out[c] = turns.get(head, [])[:h] + own[h:]
    return out


def plain(turns):
    """Nodes by a dictionary of all prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        for d in range(len(turns[c]) + 1):
            members[tuple(turns[c][:d])].append(c)
        ends[tuple(turns[c])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
    return sorted(
        (
            m[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(m),
            len(kids[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows, parts=3):
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA).repartition(parts)


def test_op12_equals_sql(spark):
    name = "op12_prefix_trie"
    assert compare(spark, connect(data.SF), name, queries.QUERIES[name], queries.ORACLES[name], data.SF) == ""


def test_op12_equals_dictionaries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{data.SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op12_prefix_trie"](spark, data.SF)) == plain(borrowed(sequences(rows)))


def random_rows(seed, convs, texts, longest):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(-7, convs):
        for k in range(rng.integers(1, longest)):
            rows.append((c * 3, k, ["user", "assistant", None][k % 3], f"text {rng.integers(texts)} \U0001f642"))
    return rows


@pytest.mark.parametrize("rebuild, plainly", [(trie.own_turns, lambda t: t), (trie.borrowed_openings, borrowed)])
@pytest.mark.parametrize("seed, convs, texts, longest", [(1, 60, 2, 9), (2, 120, 1, 6), (3, 30, 50, 12)])
def test_random_conversations(spark, rebuild, plainly, seed, convs, texts, longest):
    rows = random_rows(seed, convs, texts, longest)
    assert found(trie.prefix_trie(frame(spark, rows), rebuild)) == plain(plainly(sequences(rows)))


def test_odd_conversations(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "user", ""),
        (1, 0, "user", ""),
        (2, None, "", ""),
        (2, 5, "user", None),
        (3, 1, "user", "tie b"),
        (3, 1, "user", "tie a"),
        (4, 1, "us", "ertie a"),
        (None, 1, "user", "nobody's"),
        (None, None, None, None),
        (-100, 0, "user", "below zero"),
        (-101, 0, "user", "below zero"),
        (5, 0, "user", "long " * 100_000),
    ]
    for rebuild, plainly in ((trie.own_turns, lambda t: t), (trie.borrowed_openings, borrowed)):
        assert found(trie.prefix_trie(frame(spark, rows), rebuild)) == plain(plainly(sequences(rows)))
    assert trie.prefix_trie(frame(spark, rows).limit(0)).count() == 0
    assert trie.prefix_trie(frame(spark, rows).filter("conv_id IS NULL")).count() == 0


def test_one_conversation_over_all_ranges(spark):
    # most rows belong to two conversations of one beginning, and to repeated turns
    rows = [(7, k, "user", f"t{k}") for k in range(3000)] + [(9, k, "user", f"t{k}") for k in range(2500)]
    rows += [(8, 0, "user", "same")] * 1500 + [(c, 0, "user", "t0") for c in range(10, 40)]
    got = trie.prefix_trie(frame(spark, rows)).select("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens").collect()
    assert len(got) == 1 + 3000 + 1500
    by = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    saved = [(len(f"t{k}") if k < 2500 else 0) for k in range(3000)]
    assert by[7, 0] == (33, 2, 2, sum(saved) + 30 * 2)
    assert by[7, 1] == (32, 1, 1, sum(saved) + 30 * 2)
    assert by[7, 2] == (2, 1, 1, sum(saved[1:])) and by[7, 2500] == (2, 1, 1, 5) and by[7, 2501] == (1, 1, 1, 0)
    assert by[7, 3000] == (1, 0, 1, 0) and by[8, 1] == (1, 1, 1, 0) and by[8, 1500] == (1, 0, 1, 0)


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "LISTED", 7)
    rows = [(c, 0, "user", "hello") for c in range(-50, 400)] + [(500, 0, "user", "hello"), (500, 1, "user", "more")]
    assert found(trie.prefix_trie(frame(spark, rows))) == plain(sequences(rows))


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(trie, "WIDEST", 64)
    rows = random_rows(5, 80, 4, 10)
    assert found(trie.prefix_trie(frame(spark, rows))) == plain(sequences(rows))


def test_running_sum_over_ranges(spark):
    rng = np.random.default_rng(8)
    rows = [(int(k), i, int(v)) for i, (k, v) in enumerate(zip(rng.integers(0, 4, 900), rng.integers(-9, 99, 900), strict=True))]
    got = trie.running_sum(spark.createDataFrame(rows, "k long, i long, v long").repartition(5), "k", "v", ["i"], "upto").collect()
    totals, want = defaultdict(int), {}
    for k, i, v in rows:
        totals[k] += v
        want[i] = totals[k]
    assert {r.i: r.upto for r in got} == want


def test_only_shared_prefixes_are_grouped(spark):
    rows = [(c, k, "user", f"{c} {k}") for c in range(300) for k in range(10)] + [(c + 1000, 0, "user", "same") for c in range(20)]
    turns = trie._turns(frame(spark, rows))
    screened = trie._screened(trie._prefixes(turns.select("conv_id").distinct(), trie.own_turns(turns)))
    maybe = screened.filter("maybe AND depth > 0")
    assert maybe.filter(F.col("conv_id") >= 1000).count() == 20 and maybe.filter(F.col("conv_id") < 1000).count() < 150
