"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from hazardlake.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR) == ""


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and "earthquake_count" in result.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


BATCH = [n for n in QUERIES if not n.startswith("stream")]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_no_plan_pairs_everything_or_leaves_the_jvm(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for name in BATCH:
            frame = QUERIES[name](spark, SF_DIR)
            plan = frame._jdf.queryExecution().executedPlan().toString()
            for operator in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "InPandas"):
                assert operator not in plan, (name, operator)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0]


def test_ranking_prunes_before_the_shuffle(spark):
    plan = executed(spark, "expired_snapshots")
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_shared_aggregates_are_computed_once(spark):
    for name in ("event_titles", "first_entities"):
        assert "ReusedExchange" in executed(spark, name)


def test_top_k_and_column_pruning(spark):
    plan = executed(spark, "page")
    assert "TakeOrderedAndProject" in plan or "GlobalLimit" in plan
    plan = executed(spark, "severity_counts")
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in executed(
        spark, "select_indicator"
    )


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    """The JVM never compiles a method of more than 8000 bytes; it would stay interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in BATCH:
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                QUERIES[name](spark, SF_DIR).explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
            assert max(sizes, default=0) < 8000, name
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_layer_of_one_file_is_written_without_a_shuffle(spark, monkeypatch):
    from hazardlake.queries import QUERIES, quality

    plans, write = {}, quality.write_table

    def spied(rows, path, files):
        plans[files] = rows._jdf.queryExecution().executedPlan().toString()
        write(rows, path, files=files)

    monkeypatch.setattr(quality, "write_table", spied)
    rows = {r.layer: (r.files, r.ok) for r in QUERIES["volume_check"](spark, "/root/testdata/sf0.001").collect()}
    assert rows == {"events": (3, True), "orders": (1, True), "absent": (0, False)}
    assert "Exchange" not in plans[1]
