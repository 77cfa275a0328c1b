"""Enrichers: functions from the graph to derived edges, with what they read, emit and need declared.

``apply`` runs one where its inputs changed: what it emits is narrowed to declared
triples, and only edges that are not there yet are new.
"""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from graphloom.operators import graph as G
from graphloom.operators.relational import allowed_edges

#: Parents whose chunks' references they inherit, and what may be referred to.
PARENTS = ("jira_issue", "documentation_page", "forum_thread", "meeting_minutes", "document")
TARGETS = ("site", "jira_issue", "infrastructure_service", "cmssw_release", "global_tag", "dataset", "workflow", "run")


@dataclass(frozen=True)
class Enricher:
    """A named derivation over (nodes, edges)."""

    name: str
    reads_subtypes: tuple[str, ...]
    reads_edge_types: tuple[str, ...]
    emits: tuple[tuple[str, str, str], ...]  # src subtype, edge type, dst subtype
    derive: Callable[[DataFrame, DataFrame], DataFrame]

    def apply(self, nodes: DataFrame, edges: DataFrame) -> DataFrame:
        """New edges (src, dst, edge_type, weight) of the declared triples."""
        spark = nodes.sparkSession
        subtype = nodes.select("node_id", "subtype").distinct()
        found = self.derive(nodes.where(F.col("subtype").isin(*self.reads_subtypes)), edges.where(F.col("edge_type").isin(*self.reads_edge_types)))
        typed = found.join(subtype.select(F.col("node_id").alias("src"), F.col("subtype").alias("src_subtype")), "src").join(subtype.select(F.col("node_id").alias("dst"), F.col("subtype").alias("dst_subtype")), "dst")
        triples = spark.createDataFrame(list(self.emits), "src_subtype string, edge_type string, dst_subtype string")
        return G.without_existing(allowed_edges(typed, triples), edges, ["src", "dst", "edge_type"]).select("src", "dst", "edge_type", "weight")


def _inherit(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    chunks = nodes.where("subtype = 'document_chunk'").select(F.col("node_id").alias("child"))
    contains = edges.where("edge_type = 'contains'").select(F.col("src").alias("parent"), F.col("dst").alias("child")).join(chunks, "child", "left_semi")
    references = edges.where("edge_type = 'references'").select(F.col("src").alias("child"), F.col("dst").alias("target"))
    rolled = G.roll_up(contains, references).where("parent <> target")
    return rolled.select(F.col("parent").alias("src"), F.col("target").alias("dst"), F.lit("references").alias("edge_type"), F.col("via").alias("weight"))


def _affects(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    counted = edges.where("edge_type = 'references'").join(nodes.where("subtype = 'jira_issue'").select(F.col("node_id").alias("src")), "src", "left_semi")
    return counted.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")).select("src", "dst", F.lit("affects").alias("edge_type"), "weight")


CHUNK_ROLLUP = Enricher("chunk_reference_rollup", (*PARENTS, "document_chunk", *TARGETS), ("contains", "references"), tuple((p, "references", t) for p in PARENTS for t in TARGETS), _inherit)
AFFECTS = Enricher("affects_from_references", ("jira_issue", "site", "infrastructure_service"), ("references",), (("jira_issue", "affects", "site"), ("jira_issue", "affects", "infrastructure_service")), _affects)


def undeclared(schema: set[str], enrichers: tuple[Enricher, ...]) -> list[str]:
    """Subtypes that enrichers name and the schema does not declare."""
    named = {s for e in enrichers for s in (*e.reads_subtypes, *[x for a, _, b in e.emits for x in (a, b)])}
    return sorted(named - schema)


def tool(spec: str) -> Callable:
    """The function that ``module:function`` names; anything that is no such function is refused."""
    module, _, name = spec.partition(":")
    try:
        found = getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as error:
        raise ValueError(f"{spec} names no function") from error
    if not callable(found):
        raise ValueError(f"{spec} names no function")
    return found


def parameters(spec: str) -> list[str]:
    """The parameters that a tool takes."""
    return list(inspect.signature(tool(spec)).parameters)
