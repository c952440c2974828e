"""Nearest neighbours, components, the pipeline, and how the subpackage is attached."""

from __future__ import annotations

import ast
import subprocess
import sys
from pathlib import Path

import data
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from hazardlake.llm import graph, neighbours, queries
from hazardlake.llm.span_dedup import without_repeats

ROOT = Path(__file__).resolve().parents[2]


def brute(rows, query, k):
    """Ids and scores of the nearest others, ties by id."""
    vector = np.array(dict(rows)[query])
    scored = [
        (-float(vector @ np.array(v) / np.linalg.norm(vector) / np.linalg.norm(v)), i) for i, v in rows if i != query
    ]
    return [i for _, i in sorted(scored)[:k]]


def test_op9_recall(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{data.SF}/embeddings.parquet").collect()]
    got = {}
    for r in queries.QUERIES["op9_nearest_neighbours"](spark, data.SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i, _ in rows if i % 50 == 0}
    met = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and sorted(found, key=lambda f: (-f[2], f[1])) == found
        met += len({f[1] for f in found} & set(brute(rows, q, 5)))
        a = np.array(dict(rows)[q])
        for _, i, score in found:
            b = np.array(dict(rows)[i])
            assert score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
    assert met >= 0.9 * 5 * len(got)


def test_an_id_of_several_vectors_comes_once(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (2, [1.0, 0.05])]
    got = neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 50).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 2), (2, 1)]


def test_graphs_reach_every_cluster():
    """Tight clusters far from each other: walks end in the right one."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16))
    vectors = np.concatenate([c + 0.01 * rng.normal(size=(50, 16)) for c in centres])
    units = neighbours._units(vectors[rng.permutation(len(vectors))])
    graph = neighbours.Graph.build(units, (rng.integers(0, 2**53, len(units)) + 1) / 2.0**53)
    assert all((links.max() < len(units)) and not (links == np.arange(len(units))[:, None]).any() for links in graph.layers)
    near = np.argsort(-(units @ units[:200].T), axis=0)[:6].T
    met = [len(set(graph.search(units[q], 6)[:6]) & set(near[q].tolist())) for q in range(200)]
    assert sum(met) >= 0.95 * 6 * 200


def test_a_walk_that_meets_too_few_looks_at_all():
    units = neighbours._units(np.random.default_rng(1).normal(size=(30, 4)))
    graph = neighbours.Graph.build(units, np.full(30, 0.5))
    graph.layers[0][:] = -1
    assert graph.search(units[3], 5) == np.argsort(-(units @ units[3]), kind="stable")[:10].tolist()


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 24)))]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    index = neighbours.build_index(vectors, 5, shard=400)
    assert index.count() == 4
    got = neighbours.search(vectors, index, vectors.filter("vec_id % 30 = 0"), 5, block=20).collect()
    met = sum(r.vec_id in brute(rows, r.query_id, 5) for r in got)
    assert len(got) == 250 and met >= 0.95 * 250


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(20)]
    rows += [(20, [0.0, 1.0]), (21, [1.0, 1.0]), (22, [2.0, 0.0]), (22, [2.0, 0.0]), (23, [-1.0, -0.0])]
    rows += [(30, None), (31, []), (32, [0.0, 0.0]), (33, [float("nan"), 1.0]), (34, [float("inf"), 1.0]), (35, [None, 1.0]), (None, [1.0, 0.0])]
    rows += [(40, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("entry", F.lit("x")).withColumn("score", F.lit(1))
    got = {}
    for r in neighbours.nearest_neighbours(frame, F.col("vec_id").isin(0, 3, 20, 30, 32, 40)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    got = {q: [f[1:] for f in sorted(v)] for q, v in got.items()}
    assert set(got) == {0, 3, 20}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[3]] == [0, 1, 2, 4, 5]
    assert got[20][0][0] == 21 and [i for i, _ in got[20][1:]] == [0, 1, 2, 3]
    nothing = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert neighbours.nearest_neighbours(nothing, F.lit(True)).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (200, 202)]
    found = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in range(200, 203)}}


def test_pipeline_stage_by_stage(spark):
    docs = data.documents(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "substring_dedup", "pii", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, data.SF).cache()
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        rows = {r.doc_id: r for r in after.collect()}
        given = {r.doc_id: r for r in before.collect()}
        assert set(rows) <= set(given) and len(rows) == after.count()
        assert all(r.n_chars == len(r.text) for r in rows.values())
        if name == "toxicity":
            score = {r.doc_id: r.score for r in queries.QUERIES["op7_toxicity"](spark, data.SF).collect()}
            assert set(rows) == {i for i in given if score[i] < 0.3}
        if name == "near_dedup":
            component, _ = data.near_components([(i, r.text) for i, r in given.items()])
            assert set(rows) == {i for i, c in component.items() if i == c}
        if name == "substring_dedup":
            cut = data.cut_repeats([(i, r.text) for i, r in given.items()])
            assert {i: r.text for i, r in rows.items()} == {i: t for i, t in cut.items() if t.strip() or t == given[i].text}
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, data.SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in before.collect() if r.text.split()}
    whole = corpus_pipeline.run(spark, data.SF)
    assert whole.agg(F.sum("n_tokens")).first() == packed.agg(F.sum("n_tokens")).first()


def test_stages_take_odd_rows_and_nothing(spark, hostile, nothing):
    near, cut, pii, pack = (f for _, f in corpus_pipeline.STAGES[1:])
    for stage in (near, cut, pii):
        after = stage(spark, hostile, data.SF)
        assert after.schema.simpleString() == hostile.schema.simpleString()
        assert stage(spark, nothing, data.SF).count() == 0
    kept = near(spark, hostile, data.SF).select("doc_id", "text").collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 0, 1, 2, 3, 4, 4, 6, 8, 9, 10]
    toxic = corpus_pipeline.STAGES[0][1]
    assert toxic(spark, hostile, data.SF).count() == len(data.ROWS)
    assert toxic(spark, nothing, data.SF).count() == pack(spark, nothing, data.SF).count() == 0


def test_rows_of_one_id_are_dropped_by_text(spark):
    same = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, same, "a"), (2, same, "b"), (2, "another text of its own", "c"), (None, same, "d"), (None, "lone", "e")], "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, data.SF).collect()
    assert sorted(r.source for r in kept) == ["a", "c", "e"]


def test_a_document_of_repeats_only_goes(spark):
    passage = "Here begins a passage of some length. " + " ".join(f"word{k}" for k in range(30)) + ". It ends at this place now. "
    docs = spark.createDataFrame([(1, passage, 1), (2, passage, 1), (3, "", 0), (4, None, 0)], "doc_id long, text string, n_chars int")
    kept = corpus_pipeline.cut_repeats(spark, docs, data.SF).collect()
    assert sorted((r.doc_id, r.n_chars) for r in kept if r.doc_id != 4) == [(1, len(passage)), (3, 0)] and len(kept) == 3
    assert without_repeats(docs).count() == 4


def test_queries_are_registered():
    found = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert "pipeline" in found and set(entry.oracle_sql()) <= set(found)


def test_the_rest_does_not_need_the_subpackage(tmp_path):
    """A copy of the repository without these folders still imports."""
    import shutil

    shutil.copytree(ROOT / "hazardlake", tmp_path / "hazardlake", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and e.oracle_sql() and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "hazardlake").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any(n.startswith("hazardlake.llm") for n in names), path


def test_op2_equals_sql(spark):
    from oracle import compare, connect

    name = "op2_near_duplicates"
    assert compare(spark, connect(data.SF), name, queries.QUERIES[name], queries.ORACLES[name], data.SF) == ""
