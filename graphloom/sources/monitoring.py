"""Monitoring responses and infrastructure exports to typed rows, nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.functions.scalars import dataset_label, rse_site, safe_part
from graphloom.functions.text import storage_site
from graphloom.operators.relational import latest_nested
from graphloom.sources.projections import edges, nodes, prefixed, together

_BUCKETS = "struct<buckets array<struct<key string, doc_count bigint>>>"
_VALUE = "struct<value double>"
#: Seconds of a status bin and bins of a day.
BIN, BINS = 900, 96


def _responses(rows: DataFrame, column: str, aggregation: str, schema: str) -> DataFrame:
    """The buckets of a named aggregation of every response of a payload."""
    whole = f"struct<responses array<struct<aggregations struct<{aggregation} struct<buckets array<{schema}>>>>>>"
    each = rows.select(F.from_json(column, whole).alias("p")).select(F.posexplode("p.responses").alias("_response", "r"))
    return each.select("_response", F.posexplode(F.col(f"r.aggregations.{aggregation}.buckets")).alias("_at", "b"))


def counts(buckets: Column) -> Column:
    """Terms buckets as a map of counts."""
    return F.map_from_entries(F.transform(F.coalesce(buckets, F.array()), lambda b: F.struct(b["key"], b["doc_count"])))


def count_of(mapped: str, key: str) -> Column:
    return F.coalesce(F.try_element_at(mapped, F.lit(key)), F.lit(0))


def compute_rows(responses: DataFrame, snapshot_date: str, column: str = "payload") -> DataFrame:
    """Jobs, hours and queues of each site; a job total of null or zero falls back to the bucket's count."""
    schema = f"struct<key string, doc_count bigint, total_jobs {_VALUE}, total_core_hrs {_VALUE}, total_cpu_time_hrs {_VALUE}, avg_queue_hrs {_VALUE}, by_status {_BUCKETS}, by_job_type {_BUCKETS}, by_error {_BUCKETS}>"
    rows = _responses(responses, column, "sites", schema).where(F.trim("b.key") != "")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return rows.select(
        F.trim("b.key").alias("site"), F.lit(snapshot_date).alias("snapshot_date"),
        F.coalesce(F.nullif(F.col("b.total_jobs.value").cast("long"), F.lit(0)), F.col("b.doc_count"), F.lit(0)).alias("total_jobs"),
        zero("b.total_core_hrs.value").alias("core_hours"), zero("b.total_cpu_time_hrs.value").alias("cpu_time_hours"), F.col("b.avg_queue_hrs.value").alias("avg_queue_hours"),
        counts(F.col("b.by_status.buckets")).alias("status_breakdown"), counts(F.col("b.by_job_type.buckets")).alias("job_type_breakdown"), counts(F.col("b.by_error.buckets")).alias("error_breakdown"),
    ).withColumns({
        "jobs_running": count_of("status_breakdown", "Running"), "jobs_idle": count_of("status_breakdown", "Idle"), "jobs_held": count_of("status_breakdown", "Held"),
        "cpu_efficiency": F.try_divide("cpu_time_hours", "core_hours"),
    })


def transfer_rows(responses: DataFrame, snapshot_date: str, column: str = "payload") -> DataFrame:
    """Transfers between sites: counts, bytes, mean seconds, first activity, failure reasons.

    Several storage elements of a site merge: counts, bytes and reasons add, the mean
    weighs by counts, the first activity that is not empty stays.  A lone record keeps
    its mean even without counts; merged ones without counts have 0.
    """
    inner = f"struct<key string, by_event_type {_BUCKETS}, bytes_total {_VALUE}, avg_duration {_VALUE}, top_activity {_BUCKETS}, failure_reasons {_BUCKETS}>"
    source = _responses(responses, column, "by_src_rse", f"struct<key string, by_dst_rse struct<buckets array<{inner}>>>")
    pairs = source.select("_response", "_at", storage_site(F.col("b.key")).alias("src_site"), F.posexplode("b.by_dst_rse.buckets").alias("_to", "d"))
    rows = pairs.select(
        "src_site", storage_site(F.col("d.key")).alias("dst_site"), F.struct("_response", "_at", "_to").alias("_order"), counts(F.col("d.by_event_type.buckets")).alias("events"),
        F.coalesce(F.col("d.bytes_total.value").cast("long"), F.lit(0)).alias("bytes"), F.coalesce("d.avg_duration.value", F.lit(0.0)).alias("mean"),
        F.nullif(F.coalesce(F.try_element_at("d.top_activity.buckets", F.lit(1))["key"], F.lit("")), F.lit("")).alias("activity"), counts(F.col("d.failure_reasons.buckets")).alias("reasons"),
    ).where("src_site <> '' and dst_site <> ''")
    rows = rows.withColumns({"done": count_of("events", "transfer-done"), "failed": count_of("events", "transfer-failed")}).withColumn("weight", F.col("done") + F.col("failed"))
    keys = ["src_site", "dst_site"]
    merged = rows.groupBy(*keys).agg(
        F.sum("done").alias("done_count"), F.sum("failed").alias("failed_count"), F.sum("bytes").alias("bytes_total"),
        F.when(F.count(F.lit(1)) == 1, F.min("mean")).otherwise(F.coalesce(F.try_divide(F.sum(F.col("mean") * F.col("weight")), F.sum("weight")), F.lit(0.0))).alias("avg_duration_s"),
        F.coalesce(F.min_by("activity", F.when(F.col("activity").isNotNull(), F.col("_order"))), F.lit("")).alias("top_activity"),
    )
    each = rows.select(*keys, F.explode("reasons").alias("k", "v")).groupBy(*keys, "k").agg(F.sum("v").alias("v"))
    reasons = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("failure_reasons"))
    out = merged.join(reasons, keys, "left").withColumn("failure_reasons", F.coalesce("failure_reasons", F.create_map().cast("map<string,bigint>")))
    return out.withColumn("snapshot_date", F.lit(snapshot_date)).withColumn("failure_rate", F.try_divide("failed_count", F.col("done_count") + F.col("failed_count")))


def dataset_rows(responses: DataFrame, excluded: tuple[str, ...] = (), column: str = "payload") -> DataFrame:
    """Datasets with the sorted storage elements and sites of their replicas; excluded names are dropped."""
    schema = f"struct<key struct<dataset string>, doc_count bigint, replicas {_BUCKETS}>"
    rows = _responses(responses, column, "datasets", schema).select(F.col("b.key.dataset").alias("dataset"), F.transform("b.replicas.buckets", lambda r: r["key"]).alias("elements"))
    for part in excluded:
        rows = rows.where(~F.contains("dataset", F.lit(part)))
    sites = F.array_sort(F.array_distinct(F.transform("elements", storage_site)))
    return rows.select("dataset", F.array_sort(F.array_distinct("elements")).alias("replica_rses"), sites.alias("replica_sites"))


def availability_facts(availability: DataFrame, snapshot_date: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots of sites' test results, hosted by their sites."""
    snapshot = F.concat(F.lit("monitoring_snapshot:sam:"), "site", F.lit(f":{snapshot_date}"))
    made = nodes(availability, snapshot, "monitoring_snapshot", "site", "status", "availability_pct", "total_tests", snapshot_date=F.lit(snapshot_date))
    return made, edges(availability, prefixed("site", "site"), snapshot, "hosts")


def compute_facts(compute: DataFrame, snapshot_date: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots of sites' jobs, hosted by their sites."""
    snapshot = F.concat(F.lit("monitoring_snapshot:condor:"), "site", F.lit(f":{snapshot_date}"))
    names = ("site", "total_jobs", "core_hours", "cpu_time_hours", "jobs_running", "jobs_idle", "jobs_held", "cpu_efficiency")
    made = nodes(compute, snapshot, "monitoring_snapshot", *names, snapshot_date=F.lit(snapshot_date), status_breakdown=F.to_json("status_breakdown"))
    return made, edges(compute, prefixed("site", "site"), snapshot, "hosts")


def transfer_facts(transfers: DataFrame, snapshot_date: str) -> tuple[DataFrame, DataFrame]:
    """Transfer jobs, hosted by the sites at both ends, and who sends to whom."""
    job = F.concat_ws(":", F.lit("transfer_job:rucio"), safe_part(F.col("src_site")), safe_part(F.col("dst_site")), F.lit(snapshot_date))
    ends = F.explode(F.array(F.struct(F.col("src_site").alias("site"), F.lit("transfer_source").alias("role")), F.struct(F.col("dst_site").alias("site"), F.lit("transfer_destination").alias("role")))).alias("_e")
    held = transfers.select(job.alias("job"), ends).select("job", "_e.site", "_e.role")
    return (
        nodes(transfers, job, "transfer_job", "src_site", "dst_site", "done_count", "failed_count", "bytes_total", "top_activity"),
        together(edges(held, prefixed("site", "site"), F.col("job"), "hosts", role=F.col("role")), edges(transfers, prefixed("site", "src_site"), prefixed("site", "dst_site"), "transfers_to", snapshot_date=F.lit(snapshot_date))),
    )


def replica_facts(datasets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Datasets, the sites and the storage elements that host a replica."""
    of_site = datasets.select("dataset", F.explode("replica_sites").alias("at"))
    of_rse = datasets.select("dataset", F.explode("replica_rses").alias("at"))
    me = prefixed("dataset", "dataset")
    return (
        nodes(datasets, me, "dataset", "dataset", label=dataset_label(F.col("dataset")), replica_rses=F.array_join("replica_rses", ","), replica_sites=F.array_join("replica_sites", ",")),
        together(edges(of_site, prefixed("site", "at"), me, "hosts", relationship=F.lit("dataset_replica")), edges(of_rse, prefixed("se", "at"), me, "hosts", relationship=F.lit("dataset_replica_rse"))),
    )


def monitoring_facts(availability: DataFrame, transfers: DataFrame, datasets: DataFrame, snapshot_date: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots, transfer jobs and datasets together; the links between sites and datasets alone."""
    snapshot = F.concat(F.lit("monitoring_snapshot:sam:"), "site", F.lit(f":{snapshot_date}"))
    job = F.concat_ws(":", F.lit("transfer_job:rucio"), "src_site", "dst_site", F.lit(snapshot_date))
    hosted = datasets.select("dataset", F.explode("replica_sites").alias("site"))
    return (
        together(
            nodes(availability, snapshot, "monitoring_snapshot", "site", "status", "availability_pct", "total_tests"),
            nodes(transfers, job, "transfer_job", "src_site", "dst_site", "done_count", "failed_count", "bytes_total", "top_activity"),
            nodes(datasets, prefixed("dataset", "dataset"), "dataset", "dataset"),
        ),
        together(
            edges(availability, snapshot, prefixed("site", "site"), "monitors"),
            edges(transfers, prefixed("site", "src_site"), prefixed("site", "dst_site"), "transfers_to", done=F.col("done_count")),
            edges(hosted, prefixed("site", "site"), prefixed("dataset", "dataset"), "hosts"),
        ),
    )


def quality(responses: DataFrame, column: str = "payload") -> DataFrame:
    """Whether any response timed out, failed in a shard or left terms out, and how many terms: one row."""
    schema = "struct<responses array<struct<timed_out boolean, _shards struct<failed bigint>, error string, hits struct<total struct<value bigint, relation string>>>>>"
    each = responses.select(F.from_json(column, schema).alias("p"), F.regexp_extract_all(column, F.lit(r'"sum_other_doc_count"\s*:\s*(\d+)'), F.lit(1)).alias("others")).select(F.explode_outer("p.responses").alias("r"), "others")
    left_out = F.aggregate(F.transform("others", lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return each.agg(
        F.coalesce(F.bool_or("r.timed_out"), F.lit(False)).alias("timed_out"), F.coalesce(F.sum("r._shards.failed"), F.lit(0)).alias("failed_shards"),
        F.bool_or(F.col("r.error").isNotNull()).alias("errored"), F.max(left_out).alias("outside_terms"),
    ).withColumn("partial", F.col("timed_out") | F.col("errored") | (F.col("failed_shards") > 0) | (F.col("outside_terms") > 0))


# -- flat caches -------------------------------------------------------------------------


def _field(name: str, *more: str) -> Column:
    return F.coalesce(*[F.nullif(F.get_json_object("raw", f"$.{n}"), F.lit("")) for n in (name, *more)])


def _whole(name: str) -> Column:
    return F.coalesce(_field(name).try_cast("double").cast("long"), F.lit(0))


def cached_availability(rows: DataFrame, today: str) -> DataFrame:
    """Availability records of a flat cache (raw); a date that is not given is ``today``."""
    counts_ = [_whole(c).alias(c) for c in ("total_tests", "ok_count", "warning_count", "critical_count", "unknown_count")]
    share = F.coalesce(_field("availability_pct").try_cast("double"), F.lit(0.0))
    return rows.where(_field("site").isNotNull()).select(_field("site").alias("site"), F.coalesce(_field("snapshot_date", "date"), F.lit(today)).alias("snapshot_date"), share.alias("availability_pct"), F.coalesce(_field("status"), F.lit("UNKNOWN")).alias("status"), *counts_)


def cached_transfers(rows: DataFrame, today: str) -> DataFrame:
    """Transfer records of a flat cache (raw), those of one pair of sites and day merged.

    Counts and bytes add, the mean weighs by counts, the first activity stays; a lone
    record keeps its mean.
    """
    each = rows.select(
        "input_pos", rse_site(F.coalesce(_field("src_site", "src_rse"), F.lit("None"))).alias("src_site"), rse_site(F.coalesce(_field("dst_site", "dst_rse"), F.lit("None"))).alias("dst_site"), F.coalesce(_field("snapshot_date", "date"), F.lit(today)).alias("snapshot_date"),
        _whole("done_count").alias("done"), _whole("failed_count").alias("failed"), _whole("bytes_total").alias("bytes"), F.coalesce(_field("avg_duration_s").try_cast("double"), F.lit(0.0)).alias("mean"), _field("top_activity").alias("activity"),
    )
    weight = F.col("done") + F.col("failed")
    mean = F.when(F.count(F.lit(1)) == 1, F.min("mean")).otherwise(F.coalesce(F.try_divide(F.sum(F.col("mean") * weight), F.sum(weight)), F.lit(0.0)))
    first = F.coalesce(F.min_by("activity", F.when(F.col("activity").isNotNull(), F.col("input_pos"))), F.lit(""))
    return each.groupBy("src_site", "dst_site", "snapshot_date").agg(F.sum("done").alias("done_count"), F.sum("failed").alias("failed_count"), F.sum("bytes").alias("bytes_total"), mean.alias("avg_duration_s"), first.alias("top_activity"))


def cached_replicas(rows: DataFrame) -> DataFrame:
    """dataset, storage elements and sites of a flat cache (raw); without elements, sites stand for them."""
    texts = lambda n: F.filter(F.coalesce(F.from_json(_field(n), "array<string>"), F.array().cast("array<string>")), lambda x: x != "")
    made = lambda c, f: F.array_sort(F.array_distinct(F.transform(c, f)))
    given, sites = made(texts("replica_rses"), safe_part), texts("replica_sites")
    rses = F.when(F.size(given) > 0, given).otherwise(made(sites, safe_part))
    return rows.select(_field("dataset").alias("dataset"), rses.alias("replica_rses"), made(F.concat(sites, rses), rse_site).alias("replica_sites"))


# -- infrastructure ----------------------------------------------------------------------


def site_facts(sites: DataFrame, facilities: DataFrame, storage: DataFrame, compute: DataFrame, duties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facilities, sites, endpoints and operators from exports keyed by name (name, item).

    Sites of a facility and of an endpoint must be known; a duty names its site by title
    or name, unknown ones and repeats are dropped.
    """
    known = sites.select(F.col("name").alias("site"))
    held = facilities.select("name", F.explode("item.cmssites").alias("site")).join(known, "site", "left_semi")
    inside = sites.select("name", F.explode(F.map_keys("item.computeunits")).alias("unit"))
    placed = storage.select("name", F.col("item.site.name").alias("site")).join(known, "site", "left_semi")
    titles = sites.select(F.explode(F.array(F.nullif("item.sitedb_title", F.lit("")), F.col("name"))).alias("title"), F.col("name").alias("site")).where("title is not null")
    titles = titles.groupBy("title").agg(F.max_by("site", F.struct(F.col("title") == F.col("site"), "site")).alias("site"))
    duty = duties.where("user <> '' and title <> ''").join(titles, "title").select("user", "site", "role").distinct()
    tier = F.concat(F.lit("T"), F.coalesce("item.tier_level", F.lit(0)).cast("string"))
    return (
        together(
            nodes(facilities, prefixed("facility", "name"), "facility", country=F.col("item.country")),
            nodes(sites, prefixed("site", "name"), "site", tier_level=tier, status=F.col("item.status"), sitedb_title=F.coalesce(F.nullif("item.sitedb_title", F.lit("")), "name")),
            nodes(storage, prefixed("se", "name"), "storage_endpoint", state=F.col("item.state")),
            nodes(compute, prefixed("ce", "name"), "compute_endpoint", state=F.col("item.state")),
            nodes(duty.select("user").distinct(), prefixed("op", "user"), "operator", "user"),
        ),
        together(
            edges(held, prefixed("facility", "name"), prefixed("site", "site"), "contains"),
            edges(inside, prefixed("site", "name"), prefixed("ce", "unit"), "contains"),
            edges(placed, prefixed("site", "site"), prefixed("se", "name"), "contains"),
            edges(duty, prefixed("op", "user"), prefixed("site", "site"), "responsible_for", role=F.col("role")),
        ),
    )


def federation_facts(services: DataFrame, members: DataFrame, federations: DataFrame, vo: str = "cms") -> tuple[DataFrame, DataFrame]:
    """Services and federations of a VO, through the sites that resource sites stand for.

    ``members`` is (rcsite, site, vo_name); a federation has vos, rcsites and pledges.
    """
    mine = members.where(F.lower("vo_name") == vo).select("rcsite", "site").distinct()
    of = federations.where(F.array_contains("vos", vo))
    belongs = of.select("name", F.explode("rcsites").alias("rcsite")).join(mine, "rcsite").select("name", "site").distinct()
    serving = services.join(mine, "rcsite").select("name", "site").distinct()
    latest = latest_nested(F.col("pledges"))
    return (
        together(
            nodes(services.join(mine.select("rcsite").distinct(), "rcsite", "left_semi"), prefixed("svc", "name"), "infrastructure_service", "endpoint"),
            nodes(of, prefixed("fed", "name"), "federation", "name", pledge_cpu=F.try_element_at(latest, F.lit(vo))["CPU"], pledge_year=F.array_max(F.map_keys("pledges"))),
        ),
        together(edges(serving, prefixed("site", "site"), prefixed("svc", "name"), "contains"), edges(belongs, prefixed("site", "site"), prefixed("fed", "name"), "member_of")),
    )


def current_letter(letters: Column, time: Column, standing: Column) -> Column:
    """A metric's letter at a time of day: the latest evaluated bin, or for a standing one the bin of now."""
    now = F.least(F.lit(BINS - 1), F.floor(time % 86_400 / BIN)).cast("int")
    each = F.split(letters, "")
    evaluated = F.filter(F.slice(each, F.lit(1), now + 1), lambda x: (x != "u") & (x != ""))
    here = F.coalesce(F.nullif(F.try_element_at(each, now + 1), F.lit("")), F.lit("u"))
    return F.when(standing, here).otherwise(F.coalesce(F.try_element_at(evaluated, F.lit(-1)), F.lit("u")))
