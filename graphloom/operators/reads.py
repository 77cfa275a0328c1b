"""Read operators over nodes (node_id, subtype, attrs) and edges (src, dst, edge_type): filters, paging, inspection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from graphloom.functions.scalars import version_key
from graphloom.operators import graph as G


def attr(name: str) -> Column:
    return F.try_element_at("attrs", F.lit(name))


def like_any(nodes: DataFrame, names: list[str], pattern: str) -> DataFrame:
    """Nodes of which one of the named attributes fits a pattern (``%``, ``_``), case aside."""
    hit = F.lit(False)
    for name in names:
        hit = hit | F.coalesce(attr(name).ilike(pattern), F.lit(False))
    return nodes.where(hit)


#: Tests that a typed filter may name.
TESTS = {
    "eq": lambda c, v: c == v, "ne": lambda c, v: c != v, "lt": lambda c, v: c < v, "le": lambda c, v: c <= v, "gt": lambda c, v: c > v, "ge": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v), "prefix": lambda c, v: c.startswith(v), "null": lambda c, v: c.isNull() if v else c.isNotNull(),
}


def typed_filter(nodes: DataFrame, declared: dict[str, str], tests: list[tuple[str, str, object]]) -> DataFrame:
    """Nodes that pass all tests (attribute, test, value); only declared attributes may be named, each has a type.

    Text that is not of its attribute's type fails every test but ``null``.
    """
    keep = F.lit(True)
    for name, test, value in tests:
        if name not in declared or test not in TESTS:
            raise ValueError(f"no filter {test} on {name}")
        keep = keep & F.coalesce(TESTS[test](attr(name).try_cast(declared[name]), value), F.lit(False))
    return nodes.where(keep)


def newest(df: DataFrame, order: Column, n: int) -> DataFrame:
    """The ``n`` rows that come last in an order, last first."""
    return df.orderBy(order.desc()).limit(n)


def newest_releases(releases: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest releases by version: a bounded tail of the version order."""
    return newest(releases, version_key(F.col("label")), n)


def chunks_of(nodes: DataFrame, edges: DataFrame, parent: str, n: int = 12) -> DataFrame:
    """The first ``n`` chunks of a node in reading order: by index, else offset, then id."""
    held = edges.where((F.col("src") == parent) & (F.col("edge_type") == "contains")).select(F.col("dst").alias("node_id"), F.try_element_at("attrs", F.lit("chunk_index")).alias("_i"))
    rows = held.join(nodes.where("subtype = 'document_chunk'"), "node_id")
    at = F.coalesce(F.col("_i").try_cast("long"), attr("char_offset").try_cast("long"), F.lit(0))
    return rows.select("node_id", at.alias("at"), attr("text").alias("text")).orderBy("at", "node_id").limit(n)


def parents_of(nodes: DataFrame, edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """chunk, parent and the parent's subtype, of the given chunks (node_id)."""
    up = edges.where("edge_type = 'contains'").join(chunks.select(F.col("node_id").alias("dst")), "dst", "left_semi")
    return up.join(nodes.select(F.col("node_id").alias("src"), "subtype"), "src").select(F.col("dst").alias("chunk"), F.col("src").alias("parent"), "subtype")


def recent(df: DataFrame, when: str, tie: str, n: int) -> DataFrame:
    """The ``n`` most recent rows, those without a time last."""
    return df.orderBy(F.col(when).desc_nulls_last(), tie).limit(n)


def text_page(chunks: DataFrame, after: tuple[int, str] | None, budget: int) -> DataFrame:
    """The next chunks of one text after a continuation (char_offset, chunk_id), as many as fit ``budget`` letters, one at least.

    ``continues`` is the last row's own place: hand it on for the page that follows.
    """
    rows = chunks if after is None else chunks.where((F.col("char_offset") > after[0]) | ((F.col("char_offset") == after[0]) & (F.col("chunk_id") > after[1])))
    over = Window.orderBy("char_offset", "chunk_id")  # the chunks of one text
    sized = rows.withColumn("_sum", F.sum(F.length("text")).over(over)).withColumn("_k", F.row_number().over(over))
    return sized.where((F.col("_sum") <= budget) | (F.col("_k") == 1)).select("chunk_id", "char_offset", "text", F.struct("char_offset", "chunk_id").alias("continues"))


def inspect_graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Counts of nodes by subtype and of edges by type."""
    a = nodes.groupBy(F.lit("node").alias("what"), F.col("subtype").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(edges.groupBy(F.lit("edge").alias("what"), F.col("edge_type").alias("kind")).agg(F.count(F.lit(1)).alias("n")))


def inspect_subtype(nodes: DataFrame, subtype: str) -> DataFrame:
    """Attributes of a subtype's nodes: how many nodes have each."""
    return nodes.where(F.col("subtype") == subtype).select(F.explode(F.map_keys("attrs")).alias("attr")).groupBy("attr").agg(F.count(F.lit(1)).alias("n"))


def inspect_text(nodes: DataFrame, edges: DataFrame, parent: str) -> DataFrame:
    """The whole text of a node from its chunks, what neighbours repeat cut out."""
    held = edges.where((F.col("src") == parent) & (F.col("edge_type") == "contains")).select(F.col("src").alias("parent"), F.col("dst").alias("node_id"))
    rows = held.join(nodes, "node_id").select("parent", attr("char_offset").cast("long").alias("char_offset"), attr("char_end").cast("long").alias("char_end"), attr("text").alias("chunk"))
    return G.stitch(rows, "parent")


def roll_up_scores(scored: DataFrame, contains: DataFrame, k: int) -> DataFrame:
    """Records by the best score of their passages (node_id, score), with that passage and how many scored: top ``k``."""
    of = scored.join(contains.select(F.col("dst").alias("node_id"), F.col("src").alias("record")), "node_id")
    best = F.max(F.struct("score", "node_id")).alias("b")
    return of.groupBy("record").agg(best, F.count(F.lit(1)).alias("passages")).select("record", F.col("b.score").alias("score"), F.col("b.node_id").alias("passage"), "passages").orderBy(F.desc("score"), "record").limit(k)


def first_tag(commits: DataFrame, tags: DataFrame, max_depth: int = 100_000) -> DataFrame:
    """The first tag (by rank) whose history holds each commit: commits (commit, parent), tags (tag, commit, rank).

    Ranks move from tags to the commits before them, the least rank stays; a round looks
    only at commits whose rank became less, so history is walked once for most.
    """
    spark = commits.sparkSession
    keep = (lambda df: df.checkpoint()) if spark.sparkContext.getCheckpointDir() else (lambda df: df.persist())
    best = keep(tags.groupBy("commit").agg(F.min("rank").alias("rank")))
    frontier = best
    for _ in range(max_depth):
        moved = frontier.join(commits.where("parent is not null"), "commit").groupBy(F.col("parent").alias("commit")).agg(F.min("rank").alias("rank"))
        frontier = keep(moved.join(best.select("commit", F.col("rank").alias("_had")), "commit", "left").where("_had is null or rank < _had").select("commit", "rank"))
        if frontier.isEmpty():
            break
        best = keep(best.unionByName(frontier).groupBy("commit").agg(F.min("rank").alias("rank")))
    return best.join(tags.groupBy("rank").agg(F.min("tag").alias("tag")), "rank").select("commit", "tag")


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Facts that the two sides do not share, each with its side and how often more it occurs there; none if they are equal."""
    columns = left.columns
    counted = left.select(*columns, F.lit(1).alias("_d")).unionByName(right.select(*columns, F.lit(-1).alias("_d")))
    return counted.groupBy(*columns).agg(F.sum("_d").alias("_d")).where("_d <> 0").select(*columns, F.when(F.col("_d") > 0, "left").otherwise("right").alias("side"), F.abs("_d").alias("more"))


def coverage(df: DataFrame, carries: Column, share: float = 0.95) -> DataFrame:
    """How many records carry a signature, their share, and whether it suffices; no records do not."""
    counted = df.agg(F.count(F.lit(1)).alias("records"), F.count_if(carries).alias("carrying"))
    enough = (F.col("records") > 0) & (F.col("carrying") >= F.col("records") * share)
    return counted.select("records", "carrying", F.round(F.try_divide("carrying", "records"), 6).alias("share"), enough.alias("accepted"))


def composite(df: DataFrame, keys: list[str], after: tuple | None, size: int, *aggregates: Column) -> DataFrame:
    """A page of a composite aggregation: the next ``size`` groups after a key, in key order, with their aggregates."""
    from graphloom.operators.relational import page_after

    if after is not None:  # groups at or before the key are pruned before they are aggregated
        df = df.where(F.col(keys[0]) >= after[0])
    return page_after(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("doc_count"), *aggregates), keys, after, size)
