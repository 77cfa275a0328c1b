"""Graph operators over edge tables (src, dst, edge_type): roll-ups, closures, expansion, stitching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: What a round may broadcast of nodes.
_BROADCAST_ROWS = 10_000


def edge_id(src: str | Column, edge_type: Column, dst: str | Column) -> Column:
    """The id of a derived edge: a hash of what identifies it."""
    return F.xxhash64(src, edge_type, dst)


def without_existing(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates that are not there yet."""
    return candidates.join(existing.select(*keys).distinct(), keys, "left_anti")


def roll_up(contains: DataFrame, references: DataFrame) -> DataFrame:
    """Edges of children inherited by parents: (parent, child) and (child, target).

    Returns parent, target and how many distinct children refer to the target.
    """
    joined = contains.join(references, "child")
    return joined.groupBy("parent", "target").agg(F.count_distinct("child").alias("via"))


def two_hop_roll_up(parents: DataFrame, children: DataFrame, references: DataFrame) -> DataFrame:
    """Targets reached through documents and through their chunks, with the documents' ids.

    ``parents`` (parent, document), ``children`` (document, chunk), ``references``
    (holder, target), where a holder is a document or a chunk.
    """
    held = parents.select("parent", "document", F.col("document").alias("holder"))
    held = held.unionByName(parents.join(children, "document").select("parent", "document", F.col("chunk").alias("holder")))
    found = held.join(references, "holder")
    return found.groupBy("parent", "target").agg(F.count_distinct("holder").alias("holders"), F.array_sort(F.collect_set("document")).alias("documents"))


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """node_id and depth of everything reached from the seeds over (src, dst), each node once.

    One join a depth; visited nodes are left out, so cycles end.  Each round is
    checkpointed, which cuts the lineage where the cluster keeps its checkpoints, and
    counted: only a round of few nodes is broadcast, so the driver holds no more as graphs grow.
    Found and visited nodes meet in a grouping, as an anti-join would be pushed down to all edges.
    """
    spark = edges.sparkSession
    keep = (lambda df: df.checkpoint()) if spark.sparkContext.getCheckpointDir() else (lambda df: df.persist())
    visited = frontier = keep(seeds.select("node_id").distinct().withColumn("depth", F.lit(0)))
    depth = 0
    while (max_depth is None or depth < max_depth) and (new := frontier.count()):
        depth += 1
        last = F.broadcast(frontier) if new <= _BROADCAST_ROWS else frontier.hint("merge")
        found = last.join(edges, frontier["node_id"] == edges["src"]).select(F.col("dst").alias("node_id"), F.lit(True).alias("_new"))
        met = found.unionByName(visited.select("node_id", F.lit(False).alias("_new"))).groupBy("node_id").agg(F.bool_and("_new").alias("_new"))
        frontier = keep(met.where("_new").select("node_id", F.lit(depth).alias("depth")))
        visited = visited.unionByName(frontier)
    return visited


def ancestors_kept(parents: DataFrame, seeds: DataFrame, max_depth: int = 50) -> DataFrame:
    """node and depth of what lies below the seeds in a table of (node, parent), each node once, at its least depth."""
    edges = parents.where("parent is not null").select(F.col("parent").alias("src"), F.col("node").alias("dst"))
    return reachable(edges, seeds.select(F.col("node").alias("node_id")), max_depth).select(F.col("node_id").alias("node"), "depth")


def expand(edges: DataFrame, nodes: DataFrame, path: list[tuple[str, str]]) -> DataFrame:
    """Follow a typed path from nodes: steps of (edge_type, 'out' or 'in'); start and end ids."""
    at = nodes.select(F.col("node_id").alias("start"), F.col("node_id").alias("end"))
    for edge_type, direction in path:
        here, there = ("src", "dst") if direction == "out" else ("dst", "src")
        step = edges.where(F.col("edge_type") == edge_type).select(F.col(here).alias("end"), F.col(there).alias("_to"))
        at = at.join(step, "end").select("start", F.col("_to").alias("end")).distinct()
    return at


def neighbourhood(edges: DataFrame, node_id: str) -> DataFrame:
    """Volume around a node: edges by type and direction."""
    out = edges.where(F.col("src") == node_id).select("edge_type", F.lit("out").alias("direction"))
    into = edges.where(F.col("dst") == node_id).select("edge_type", F.lit("in").alias("direction"))
    return out.unionByName(into).groupBy("edge_type", "direction").count()


def chunks(df: DataFrame, key: str, text: str, size: int = 4000, overlap: int = 200) -> DataFrame:
    """Overlapping windows of a text, stripped, blank ones left out: key, idx, char_offset, char_end, chunk.

    A window begins every ``size - overlap`` characters until one reaches the end; the
    offset is that of the stripped chunk in the text.  A text's chunks are one array of
    its own row, so numbering them shuffles nothing and no chunk carries the whole text.
    """
    from graphloom.functions.text import lstrip, no_nul, strip

    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length(text) - overlap - 1), F.lit(step))
    cut = F.transform(starts, lambda o: F.struct(o.alias("o"), F.substring(F.col(text), o + 1, F.lit(size)).alias("w")))
    stripped = F.transform(cut, lambda c: F.struct((c["o"] + F.length(c["w"]) - F.length(lstrip(c["w"]))).alias("at"), no_nul(strip(c["w"])).alias("chunk")))
    windows = df.where(F.length(text) > 0).select(key, F.posexplode(F.filter(stripped, lambda c: c["chunk"] != "")).alias("idx", "_c"))
    return windows.select(key, "idx", F.col("_c.at").alias("char_offset"), (F.col("_c.at") + F.length("_c.chunk")).alias("char_end"), F.col("_c.chunk").alias("chunk"))


def stitch(chunked: DataFrame, key: str) -> DataFrame:
    """The text of each key from its chunks, without what neighbours repeat."""
    over = Window.partitionBy(key).orderBy("char_offset")
    before = F.coalesce(F.lag("char_end").over(over), F.lit(0))
    parts = chunked.withColumn("_before", before).withColumn("_part", F.substring("chunk", F.greatest(F.lit(1), F.col("_before") - F.col("char_offset") + 1), F.length("chunk")))
    listed = F.array_sort(F.collect_list(F.struct("char_offset", "_part")))
    return parts.groupBy(key).agg(F.array_join(F.transform(listed, lambda p: p["_part"]), "").alias("text"))


def chunk_id(parent: Column, idx: Column, text: Column, separator: str = "\0") -> Column:
    """A chunk's content-derived id."""
    from graphloom.functions.text import digest16

    return F.concat(F.lit("chunk:"), digest16(F.concat(parent, F.lit(separator), idx.cast("string"), F.lit(separator), text)))
