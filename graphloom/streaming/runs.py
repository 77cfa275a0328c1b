"""Incremental runs: completed scope, retraction, progress, change probes; event-time extras.

A run may retract what it did not see only if it completed its scope.  The verdict is
one expression over the run's counters, so it is computed, never assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Modes in which a reader may claim a completed scope.
SCOPE_MODES = ("scope_complete", "reconcile", "release_new", "release_unchanged")
#: Of these, the ones in which a reference catalogue runs; it retracts nothing then.
RELEASE_MODES = ("release_new", "release_unchanged")
#: More changed nodes than this make an incremental run a full one.
FULL_RUN_ABOVE = 10_000


def scope_completed(mode: str, records: Column, skipped: Column, truncated: Column, partial: Column, retracts: bool = True) -> Column:
    """Whether a run claims its scope: right mode, records, none skipped, none cut off.

    A source that does not retract (``retracts`` false) claims none; a reference
    catalogue does so by ``retracts=mode not in RELEASE_MODES``.
    """
    return F.lit(retracts and mode in SCOPE_MODES) & (records > 0) & (skipped == 0) & ~truncated & ~partial


def health(records: DataFrame, skip: Column, mode: str, truncated: bool = False, partial: bool = False) -> DataFrame:
    """One row of a run's counters, its status and its scope verdict."""
    counted = records.agg(F.count_if(~skip).alias("record_count"), F.count_if(skip).alias("skipped_count"))
    status = F.when(F.col("record_count") == 0, "empty").when(F.lit(partial) | (F.col("skipped_count") > 0), "partial").otherwise("ok")
    scope = scope_completed(mode, F.col("record_count"), F.col("skipped_count"), F.lit(truncated), F.lit(partial))
    return counted.select("*", F.lit(mode).alias("mode"), status.alias("status"), scope.alias("completed_scope"))


def retracted(previous: DataFrame, current: DataFrame, key: str, completed: bool) -> DataFrame:
    """Keys that a completed run no longer emits; none if the scope was not completed."""
    if not completed:
        return previous.select(key).where(F.lit(False))
    return previous.select(key).distinct().join(current.select(key), key, "left_anti")


def changed(previous: DataFrame, current: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that are new or whose fingerprint differs from the progress of the run before."""
    print_ = F.sha2(F.to_json(F.struct(*sorted(columns))), 256)
    seen = previous.select(key, print_.alias("fingerprint"))
    return current.withColumn("fingerprint", print_).join(seen, [key, "fingerprint"], "left_anti")


def content_probe(files: DataFrame, settings: str) -> DataFrame:
    """One token over (path, bytes) of a binaryFile scan and the settings, in path order."""
    each = files.select(F.struct("path", F.sha2("content", 256).alias("digest")).alias("p"))
    return each.agg(F.sha2(F.concat_ws("|", F.lit(settings), F.to_json(F.array_sort(F.collect_list("p")))), 256).alias("probe"))


def dirty_scope(dirty: DataFrame, new_edges: DataFrame) -> DataFrame:
    """Nodes to look at again: changed ones and the ends of new edges."""
    ends = new_edges.select(F.explode(F.array("src", "dst")).alias("node_id"))
    return dirty.select("node_id").unionByName(ends).distinct()


def is_full_run(scope: DataFrame, above: int = FULL_RUN_ABOVE) -> bool:
    """Whether the scope is too large to be worth an incremental run; counts no further."""
    return scope.limit(above + 1).count() > above


def upsert(current: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of both, the later row of a key wins."""
    rest = [c for c in current.columns if c != key]
    both = current.unionByName(batch)
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(key, "_row.*").select(*current.columns)


def event_windows(events: DataFrame, length: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts and sums by time window and event type: batch and stream alike (an extra)."""
    if late:
        events = events.withWatermark("ts", late)
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """A row for each run of a user's events with no pause of ``gap`` (an extra)."""
    if late:
        events = events.withWatermark("ts", late)
    grouped = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return grouped.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


# -- incremental -------------------------------------------------------------------------


def needs_work(node_facts: DataFrame, edge_facts: DataFrame, node_mark: int, edge_mark: int, subtypes: tuple[str, ...], edge_types: tuple[str, ...] = ("contains", "references")) -> DataFrame:
    """One row: whether facts past the watermarks touch the subtypes or edge types, and the new watermarks.

    Facts up to a watermark are pruned by the scan's statistics on ``fact_id``; the new
    watermarks are the greatest ids of all.
    """
    fresh = lambda facts, mark, test: facts.agg(F.bool_or((F.col("fact_id") > mark) & test).alias("work"), F.max("fact_id").alias("mark"))
    a = fresh(node_facts, node_mark, F.col("subtype").isin(*subtypes)).select(F.col("work").alias("_n"), F.col("mark").alias("node_mark"))
    b = fresh(edge_facts, edge_mark, F.col("edge_type").isin(*edge_types)).select(F.col("work").alias("_e"), F.col("mark").alias("edge_mark"))
    work = F.coalesce("_n", F.lit(False)) | F.coalesce("_e", F.lit(False))
    return a.join(F.broadcast(b)).select(work.alias("work"), F.coalesce("node_mark", F.lit(node_mark)).alias("node_mark"), F.coalesce("edge_mark", F.lit(edge_mark)).alias("edge_mark"))


def incremental_scope(dirty: DataFrame, edge_facts: DataFrame, edge_mark: int, edge_types: tuple[str, ...], prefix: str = "", above: int = FULL_RUN_ABOVE) -> DataFrame | None:
    """Nodes to look at again, by a prefix of their ids; None where they are so many that everything is."""
    fresh = edge_facts.where((F.col("fact_id") > edge_mark) & F.col("edge_type").isin(*edge_types))
    scope = dirty_scope(dirty, fresh).where(F.col("node_id").startswith(prefix))
    return None if is_full_run(scope, above) else scope


def cursor(files: DataFrame) -> DataFrame:
    """One row: the cursor of a run, a digest over path and content of the files that it read (binaryFile), in path order.

    Files are the exports of one source, so their number is small; contents never leave their rows.
    """
    each = files.select(F.struct("path", F.sha2("content", 256).alias("digest")).alias("p"))
    listed = F.transform(F.array_sort(F.collect_list("p")), lambda p: F.concat_ws("\n", p["path"], p["digest"]))
    return each.agg(F.sha2(F.array_join(listed, "\n"), 256).alias("input_content_sha256"))


def probe(files: DataFrame, settings: str, run_id: str) -> DataFrame:
    """One row: a token that changes with the files and the settings; without files always a fresh one, so a live read runs."""
    return cursor(files).join(F.broadcast(files.agg(F.count(F.lit(1)).alias("_n")))).select(
        F.when(F.col("_n") > 0, F.sha2(F.concat_ws("|", F.lit(settings), "input_content_sha256"), 256)).otherwise(F.concat(F.lit("live:"), F.lit(run_id))).alias("token")
    )


def as_of(facts: DataFrame, generation: int) -> DataFrame:
    """Rows of a pinned generation: made by then and not retired by then (added_in, retired_in)."""
    return facts.where((F.col("added_in") <= generation) & (F.col("retired_in").isNull() | (F.col("retired_in") > generation)))


# -- verdicts ----------------------------------------------------------------------------


def capped(df: DataFrame, order: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` rows in order, and one row (kept, left_out, truncated): what was cut forbids a scope claim."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    kept = F.least("n", F.lit(most))
    return df.orderBy(*order).limit(most), counted.select(kept.alias("kept"), (F.col("n") - kept).alias("left_out"), (F.col("n") > most).alias("truncated"))


def count_verdict(counted: DataFrame, expected: Column, strict: bool = False) -> DataFrame:
    """status and completed_scope of counters (record_count, skipped_count) against the exporter's own count.

    A null expectation is no check; a different count is ``endpoint_failed``: what was
    read is emitted, or with ``strict`` the rows' emission is refused.
    """
    differs = expected.isNotNull() & (expected != F.col("record_count"))
    status = F.when(differs, "endpoint_failed").when(F.col("record_count") == 0, "cache_missing").when(F.col("skipped_count") > 0, "endpoint_failed").otherwise("ok")
    return counted.select("*", status.alias("status"), (~differs & (F.col("record_count") > 0) & (F.col("skipped_count") == 0)).alias("completed_scope"), (~differs | F.lit(not strict)).alias("emits"))


def snapshot_verdict(counts: DataFrame) -> DataFrame:
    """status and completed_scope of a tree's counters: found, missing_seeds, unreadable, empty, capped.

    No topic read is ``cache_missing``; a missing seed, an unreadable file, or more blank
    topics than tolerated is ``endpoint_failed``; a cap alone is ``ok`` without a scope.
    """
    files = F.col("found") + F.col("capped") + F.col("empty")
    tolerated = F.col("empty") <= F.greatest(F.lit(10), F.floor(files / 1000))
    problem = (F.col("missing_seeds") > 0) | (F.col("unreadable") > 0) | ~tolerated
    status = F.when(F.col("found") == 0, "cache_missing").when(problem, "endpoint_failed").otherwise("ok")
    return counts.select("*", status.alias("status"), ((F.col("found") > 0) & ~problem & (F.col("capped") == 0)).alias("completed_scope"))


def merged_quality(reports: DataFrame) -> DataFrame:
    """Quality reports of several responses as one: flags by or, failed shards added, the names of cut aggregations united."""
    return reports.agg(
        F.coalesce(F.bool_or("timed_out"), F.lit(False)).alias("timed_out"), F.coalesce(F.bool_or("terminated_early"), F.lit(False)).alias("terminated_early"),
        F.coalesce(F.sum("failed_shards"), F.lit(0)).cast("long").alias("failed_shards"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("truncated")))).alias("truncated"),
    )
