"""How plans grow: what a task, a worker or the driver holds must not follow the tables' size."""

from __future__ import annotations

import tracemalloc

from pyspark.sql import functions as F

from graphloom.functions import redaction as D
from graphloom.operators import graph as G, relational as R
from graphloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counted_references_groups_where_it_joins(spark):
    got = plan(QUERIES["counted_references"](spark, SF))
    assert "Broadcast" not in got and got.count("Exchange hashpartitioning") == 2


def test_spread_join_tasks_follow_rows_and_keep_duplicates(spark):
    left, right = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id") % 1000).alias("a")), spark.range(6000).select((F.col("id") % 1500).alias("b"), "id")
    joined = R.spread_join(left, right, "a", "b", rows=100)
    assert "hashpartitioning(a" in plan(joined) and ", 90)" in plan(joined)
    assert joined.count() == 2999 * 4 and joined.where("a <> b").isEmpty()


def test_redaction_takes_few_texts_at_once(spark):
    got = plan(QUERIES["redact_documents"](spark, SF)) + plan(QUERIES["anonymise"](spark, SF))
    assert got.count("BatchEvalPython") == 2 and "ArrowEvalPython" not in got


def test_spelled_addresses_take_memory_near_the_text():
    text = "日本語 the text says that nothing hides​ here. " * 20_000 + "mail jd﻿oe[at]cern.ch​ now"
    tracemalloc.start()
    got = D.without_spelled(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == text.replace("jd﻿oe[at]cern.ch", "")
    assert most < 20 * len(text)


def test_reachable_broadcasts_only_few_nodes(spark, monkeypatch):
    plans, frame = [], type(spark.range(0))
    keep = frame.checkpoint

    def recorded(df, *args):
        out = keep(df, *args)
        plans.append(plan(df))
        return out

    monkeypatch.setattr(frame, "checkpoint", recorded)
    wide = 2 * G._BROADCAST_ROWS
    ids = spark.range(1, wide + 1)
    edges = ids.selectExpr("'n0' src", "'n' || id dst").unionByName(ids.selectExpr("'n' || id src", f"'n' || (id + {wide}) dst")).unionByName(ids.selectExpr("'n' || id src", "'n0' dst"))
    got = G.reachable(edges, spark.range(1).selectExpr("'n0' node_id"))
    assert {r.depth: r["count"] for r in got.groupBy("depth").count().collect()} == {0: 1, 1: wide, 2: wide}
    assert ["Broadcast" in p for p in plans] == [False, True, False, False]
