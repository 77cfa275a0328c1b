"""Joins, order-sensitive deduplication and aggregations over typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: int) -> DataFrame:
    """Rows of ``points`` within [low, high] of ``ranges``, as an equi-join on buckets of ``width``.

    A range is exploded into the buckets that it touches, a point falls into one; the
    exact bounds are tested after the join.  Nothing is broadcast or crossed.
    """
    at = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    here = points.withColumn("_bucket", F.floor(F.col(point) / width))
    return here.join(at, "_bucket").where(F.col(point).between(F.col(low), F.col(high))).drop("_bucket")


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, rows: int = 250_000) -> DataFrame:
    """Inner join of two stored tables on a key, dealt out by it so that a task has about ``rows`` rows.

    Both are counted, and the number of tasks follows the count: what one task sorts, or
    groups by keys that begin with this one, stays the same as the tables grow.  Nothing
    is broadcast, and such a grouping needs no further shuffle.
    """
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, -(-(left.count() + right.count()) // rows))
    a, b = left.repartition(tasks, left_key), right.repartition(tasks, right_key)
    return a.join(b.hint("merge"), F.col(left_key) == F.col(right_key))


def link(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, edge_type: str, left_id: str = "node_id", right_id: str = "node_id") -> DataFrame:
    """A declared cross-link: an edge for every pair of nodes whose keys agree, never to itself."""
    a = left.select(F.col(left_id).alias("src"), left_key.alias("_key")).where("_key is not null and _key <> ''")
    b = right.select(F.col(right_id).alias("dst"), right_key.alias("_key"))
    return a.join(b, "_key").where("src <> dst").select("src", "dst", F.lit(edge_type).alias("edge_type")).distinct()


def allowed_edges(edges: DataFrame, narrowings: DataFrame, accept: bool = True) -> DataFrame:
    """Edges whose (edge_type, src_subtype, dst_subtype) is declared, or those whose is not."""
    return edges.join(narrowings, ["edge_type", "src_subtype", "dst_subtype"], "left_semi" if accept else "left_anti")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in a declared order: an aggregation, so a hot key is combined early.

    The order must be total for one answer; ties beyond it fall to the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = df.withColumn("_order", F.struct(*order, *rest))
    return ranked.groupBy(*keys).agg(F.min_by(F.struct(*rest), "_order").alias("_row")).select(*keys, "_row.*").select(*df.columns)


def unique_only(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that lead to exactly one value; ambiguous keys resolve to nothing."""
    return df.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_most")).where(F.col(value) == F.col("_most")).drop("_most")


def consecutive_pairs(df: DataFrame, group: list[str], order: list[Column], value: str, rank: str) -> DataFrame:
    """(previous, next) of each group in order, skipping steps of equal rank."""
    over = Window.partitionBy(*group).orderBy(*order)
    stepped = df.withColumn("_value", F.lag(value).over(over)).withColumn("_rank", F.lag(rank).over(over))
    return stepped.where(F.col("_rank").isNotNull() & (F.col("_rank") != F.col(rank))).select(*group, F.col("_value").alias("previous"), F.col(value).alias("next"))


def terms(df: DataFrame, keys: list[str], top_n: int, within: list[str] | None = None) -> DataFrame:
    """The ``top_n`` values by count (ties by key), with the count of all rows outside them.

    With ``within``, the top of each outer group.  Counting is partial before any
    shuffle; only distinct values meet in a window.
    """
    within = within or []
    counts = df.groupBy(*within, *keys).agg(F.count(F.lit(1)).alias("doc_count"))
    order = Window.partitionBy(*within).orderBy(F.desc("doc_count"), *keys)
    whole = Window.partitionBy(*within)
    ranked = counts.withColumn("_rank", F.row_number().over(order)).withColumn("_total", F.sum("doc_count").over(whole)).where(F.col("_rank") <= top_n)
    return ranked.withColumn("sum_other_doc_count", F.col("_total") - F.sum("doc_count").over(whole)).drop("_rank", "_total")


def page_after(df: DataFrame, keys: list[str], after: tuple | None, size: int) -> DataFrame:
    """A keyset page: the next ``size`` keys after the given one, in key order."""
    if after is not None:
        later = F.lit(False)
        for k in range(len(keys)):
            same = F.lit(True)
            for j in range(k):
                same = same & (F.col(keys[j]) == after[j])
            later = later | (same & (F.col(keys[k]) > after[k]))
        df = df.where(later)
    return df.orderBy(*keys).limit(size)


def availability(df: DataFrame, key: str, status: str, ok: str, warning: str, critical: str) -> DataFrame:
    """Status counts, share of OK in percent, and its class: 90 and 70 are the bounds.

    The class follows the share before rounding; a group without tests is UNKNOWN.
    """
    count = lambda value: F.count_if(F.col(status) == value)
    total = F.count(F.col(status))
    share = F.try_divide(count(ok) * 100.0, total)
    label = F.when(share >= 90, "OK").when(share >= 70, "WARNING").when(share.isNotNull(), "CRITICAL").otherwise("UNKNOWN")
    return df.groupBy(key).agg(
        total.alias("total_tests"), count(ok).alias("ok_count"), count(warning).alias("warning_count"), count(critical).alias("critical_count"),
        F.round(share, 2).alias("availability_pct"), label.alias("status"),
    )


def merge_weighted(df: DataFrame, keys: list[str], weight: str, mean: str, total: str) -> DataFrame:
    """Partial records merged: totals add, means weigh by their counts, zero weight gives 0."""
    weighted = F.try_divide(F.sum(F.col(mean) * F.col(weight)), F.sum(weight))
    return df.groupBy(*keys).agg(F.sum(weight).alias(weight), F.sum(total).alias(total), F.coalesce(weighted, F.lit(0.0)).alias(mean))


def merge_maps(df: DataFrame, keys: list[str], counts: str) -> DataFrame:
    """Maps of counts added by key, through one row per entry."""
    entries = df.select(*keys, F.explode(counts).alias("_k", "_v")).groupBy(*keys, "_k").agg(F.sum("_v").alias("_v"))
    return entries.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias(counts))


def latest_nested(periods: Column) -> Column:
    """The value under the greatest key of the greatest key of a nested map (string order)."""
    year = F.array_max(F.map_keys(periods))
    quarters = F.try_element_at(periods, year)
    return F.try_element_at(quarters, F.array_max(F.map_keys(quarters)))


def union_sets(df: DataFrame, key: str, firsts: dict[str, str], sets: list[str], order: Column) -> DataFrame:
    """Rows of one key merged: scalars from the first row, the named columns as sorted sets."""
    ones = [F.min_by(c, order).alias(a) for c, a in firsts.items()]
    return df.groupBy(key).agg(*ones, *[F.array_sort(F.collect_set(c)).alias(c) for c in sets])


def missing_required(df: DataFrame, column: str, required: list[str]) -> DataFrame:
    """Each required value with its count, zero where there is none."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in required], f"{column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"), (F.col("n").isNull()).alias("violated"))
