"""Typed records to nodes (node_id, subtype, attrs) and edges (src, dst, edge_type, attrs).

``attrs`` is a map of text values; empty values are left out.  Input tables carry the
columns that their readers emit; ``input_pos`` orders rows where the first one wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from graphloom.functions.text import digest16, slug
from graphloom.operators.relational import first_by

#: The order of data tiers in a processing chain; unknown tiers come last.
TIERS = {
    "GEN": 0, "LHE": 0, "GEN-SIM": 1, "SIM": 1, "RAW": 2, "DIGI": 2, "DIGI-RECO": 3, "RECO": 3,
    "AOD": 4, "AODSIM": 4, "MINIAOD": 5, "MINIAODSIM": 5, "NANOAOD": 6, "NANOAODSIM": 6,
}
UNKNOWN_TIER = 99
#: Words of a link type and the kind that the first of them present makes it.
LINK_WORDS = (("gantt", "gantt"), ("sub-task", "child"), ("child", "child"), ("parent", "child"), ("block", "blocks"), ("clon", "clones"), ("dupl", "duplicates"))
#: Link kinds, the most specific first.
LINK_KINDS = ("child", "blocks", "duplicates", "clones", "gantt", "relates")


def attrs(*names: str, **named: Column) -> Column:
    """A map of the named columns, without null and empty values."""
    pairs = [(n, F.col(n).cast("string")) for n in names] + [(n, c.cast("string")) for n, c in named.items()]
    built = F.create_map(*[x for n, c in pairs for x in (F.lit(n), c)]) if pairs else F.create_map().cast("map<string,string>")
    return F.map_filter(built, lambda _, v: F.coalesce(v != "", F.lit(False)))


def nodes(df: DataFrame, node_id: Column, subtype: str, *names: str, **named: Column) -> DataFrame:
    return df.select(node_id.alias("node_id"), F.lit(subtype).alias("subtype"), attrs(*names, **named).alias("attrs"))


def edges(df: DataFrame, src: Column, dst: Column, edge_type: str, **named: Column) -> DataFrame:
    return df.select(src.alias("src"), dst.alias("dst"), F.lit(edge_type).alias("edge_type"), attrs(**named).alias("attrs"))


def together(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def prefixed(prefix: str, column: str) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.col(column))


# -- releases ----------------------------------------------------------------------------

_VERSION = r"^CMSSW_(\d+)_(\d+)_(\d+)(?:_(.*)|([a-z]+\d+))?$"
_SERIES = r"^CMSSW_(\d+)_(\d+)_(?:[A-Za-z0-9]+_)*X(?:_[A-Za-z0-9]+)*$"


def _suffix(label: Column) -> Column:
    return F.concat(F.regexp_extract(label, _VERSION, 4), F.regexp_extract(label, _VERSION, 5))


def release_kind(label: Column) -> Column:
    """What a label says of its release: release, patch, pre-release, series and so on."""
    suffix = F.lower(_suffix(label))
    of_version = (
        F.when(suffix == "", "release").when(suffix.startswith("pre"), "pre-release").when(suffix.startswith("hltpatch"), "hlt-patch").when(suffix.startswith("patch"), "patch").otherwise("variant")
    )
    return F.when(label.rlike(_VERSION), of_version).when(label.rlike(_SERIES), "integration-series").otherwise("unrecognized")


def previous_release(label: Column) -> Column:
    """The release that a label follows: one less of its last number, or its base; null at the start."""
    major, minor, patch = (F.regexp_extract(label, _VERSION, k) for k in (1, 2, 3))
    base = F.concat_ws("_", F.lit("CMSSW"), major, minor, patch)
    suffix = _suffix(label)
    kind, number = F.regexp_extract(suffix, r"^(patch|pre|hltpatch)(\d+)$", 1), F.regexp_extract(suffix, r"^(patch|pre|hltpatch)(\d+)$", 2).try_cast("long")
    numbered = F.when(number > 1, F.concat(base, F.lit("_"), kind, (number - 1).cast("string"))).when(kind != "pre", base)
    plain = F.when(patch.try_cast("long") > 0, F.concat_ws("_", F.lit("CMSSW"), major, minor, (patch.try_cast("long") - 1).cast("string")))
    return F.when(label.rlike(_VERSION), F.when(suffix == "", plain).when(kind != "", numbered).otherwise(base))


def release_facts(releases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Releases, their families, membership and the releases that they supersede (if known)."""
    label = F.col("label")
    major, minor = F.regexp_extract(label, r"^CMSSW_(\d+)_(\d+)_", 1), F.regexp_extract(label, r"^CMSSW_(\d+)_(\d+)_", 2)
    rows = releases.withColumns({"kind": release_kind(label), "before": previous_release(label), "family": F.concat_ws("_", F.lit("CMSSW"), major, minor)})
    concrete = rows.where(label.rlike(_VERSION))
    families = concrete.select("family").distinct()
    known = releases.select(F.col("label").alias("before"))
    follows = rows.join(known, "before", "left_semi")
    return (
        together(
            nodes(rows, prefixed("cmssw_release", "label"), "cmssw_release", "label", "state", release_type=F.col("type"), release_kind=F.col("kind"), architecture=F.array_join("architecture", ",")),
            nodes(families, prefixed("cmssw_release_family", "family"), "cmssw_release", "family"),
        ),
        together(
            edges(follows, prefixed("cmssw_release", "label"), prefixed("cmssw_release", "before"), "supersedes"),
            edges(concrete, prefixed("cmssw_release_family", "family"), prefixed("cmssw_release", "label"), "contains"),
        ),
    )


# -- datasets, workflows, tags -----------------------------------------------------------


def tier_order(tier: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in TIERS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, tier), F.lit(UNKNOWN_TIER))


def era(processed: Column) -> Column:
    return F.substring_index(processed, "-", 1)


def campaign(processed: Column) -> Column:
    found = F.regexp_extract(processed, r"^([A-Za-z]+\d{4}[A-Za-z]*)", 1)
    return F.when(found != "", found).otherwise(era(processed))


def dataset_facts(datasets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Datasets, and each tier of a campaign hung on the tier before it."""
    rows = datasets.withColumns({"era": era(F.col("processed_dataset")), "campaign": campaign(F.col("processed_dataset")), "_tier": tier_order(F.col("data_tier"))})
    over = Window.partitionBy("primary_dataset", "campaign").orderBy("_tier", "input_pos")
    chain = rows.withColumns({"_dst": F.lag("dataset_name").over(over), "_dst_tier": F.lag("data_tier").over(over), "_dst_order": F.lag("_tier").over(over)})
    chain = chain.where("_dst is not null and _dst_order <> _tier")
    return (
        nodes(rows, prefixed("dataset", "dataset_name"), "dataset", "data_tier", "primary_dataset", "era", "campaign", "total_files", "total_events"),
        edges(chain, prefixed("dataset", "dataset_name"), prefixed("dataset", "_dst"), "derives_from", relationship=F.lit("tier_chain"), src_tier=F.col("data_tier"), dst_tier=F.col("_dst_tier")),
    )


def workflow_facts(workflows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Workflows, the datasets that they name (once each), and what they consume, produce and need."""
    made = workflows.select("workflow_name", F.explode("output_datasets").alias("dataset"))
    used = workflows.where("input_dataset <> ''").select("workflow_name", F.col("input_dataset").alias("dataset"))
    named = made.select("dataset").unionByName(used.select("dataset")).distinct()
    me = prefixed("workflow", "workflow_name")
    return (
        together(nodes(workflows, me, "workflow", "workflow_name", "status", "campaign", "priority"), nodes(named, prefixed("dataset", "dataset"), "dataset", "dataset")),
        together(
            edges(used, me, prefixed("dataset", "dataset"), "consumes"),
            edges(made, me, prefixed("dataset", "dataset"), "produces"),
            edges(workflows.where("cmssw_version <> ''"), me, prefixed("cmssw_release", "cmssw_version"), "depends_on"),
        ),
    )


def tag_facts(tags: DataFrame, releases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Global tags, stubs of releases that only they name, what they supersede and depend on."""
    from graphloom.functions.text import previous_version

    rows = tags.withColumn("before", previous_version(F.col("name")))
    known = tags.select(F.col("name").alias("before")).distinct()
    stubs = tags.where("release <> ''").select(F.col("release").alias("label")).distinct().join(releases.select("label"), "label", "left_anti")
    me = prefixed("global_tag", "name")
    return (
        together(nodes(rows, me, "global_tag", "name", "release", "scenario"), nodes(stubs, prefixed("cmssw_release", "label"), "cmssw_release", "label", referenced_only=F.lit("true"))),
        together(
            edges(rows.join(known, "before", "left_semi"), me, prefixed("global_tag", "before"), "supersedes"),
            edges(rows.where("release <> ''"), me, prefixed("cmssw_release", "release"), "depends_on"),
        ),
    )


# -- operations --------------------------------------------------------------------------


def downtime_facts(downtimes: DataFrame, sites: DataFrame, services: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One node an outage (rows of one id merged) and an edge to each known site and host."""
    from graphloom.functions.text import host_of

    merged = downtimes.groupBy("downtime_id").agg(
        *[F.min_by(c, "input_pos").alias(c) for c in ("classification", "severity", "description", "start_date", "end_date", "hosted_by")],
        F.array_sort(F.collect_set(F.nullif("service_type", F.lit("")))).alias("services"), F.array_sort(F.collect_set(F.nullif("hostname", F.lit("")))).alias("hosts"),
    )
    first = first_by(services.withColumn("host", host_of(F.col("endpoint"))).select("host", "name", "input_pos"), ["host"], F.col("input_pos")).select("host", "name")
    hit = merged.select("downtime_id", F.explode("hosts").alias("h")).withColumn("host", host_of(F.col("h"))).join(first, "host").select("downtime_id", "name").distinct()
    at = merged.join(sites.select(F.col("name").alias("hosted_by")), "hosted_by", "left_semi")
    me = F.concat(F.lit("downtime:"), F.col("downtime_id").cast("string"))
    return (
        nodes(merged, me, "downtime", "classification", "severity", "description", "start_date", "end_date", affected_services=F.array_join("services", ",")),
        together(edges(at, me, prefixed("site", "hosted_by"), "affects"), edges(hit, me, prefixed("svc", "name"), "affects")),
    )


def certification_facts(certificates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Certifications, the first and last run of each, and the datasets that they name."""
    group = F.regexp_extract("cert_name", r"((?:Collisions|Cosmics|HI|Interfills)\w*?\d{2,4})(?:_|$)", 1)
    digits = F.regexp_extract(group, r"(\d{4}|\d{2})$", 1)
    year = F.when(F.length(digits) == 4, digits.try_cast("int")).when(F.length(digits) == 2, 2000 + digits.try_cast("int"))
    rows = certificates.withColumns({"group": F.when(group != "", group).otherwise(F.col("cert_name")), "year": year})
    ends = rows.where("size(run_range) = 2").select("cert_name", F.explode(F.array_distinct("run_range")).alias("run"))
    named = rows.select("cert_name", F.explode("datasets").alias("dataset"))
    run = F.concat(F.lit("run:"), F.col("run").cast("string"))
    me = prefixed("data_certification", "cert_name")
    return (
        together(
            nodes(rows, me, "data_certification", "cert_name", "group", "year", run_min=F.array_min("run_range"), run_max=F.array_max("run_range")),
            nodes(ends.select("run").distinct(), run, "run", "run"),
            nodes(named.select("dataset").distinct(), prefixed("dataset", "dataset"), "dataset", "dataset"),
        ),
        together(edges(ends, me, run, "recorded_during"), edges(named.distinct(), me, prefixed("dataset", "dataset"), "references")),
    )


# -- issues and pages --------------------------------------------------------------------


def person_id(name: Column) -> Column:
    """A person's id from the lower-cased, trimmed name."""
    return F.concat(F.lit("person:"), digest16(F.lower(F.trim(name))))


def link_kind(link_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for word, kind in reversed(LINK_WORDS):
        out = F.when(F.contains(F.lower(link_type), F.lit(word)), kind).otherwise(out)
    return F.coalesce(out, F.lit("relates"))


def issue_facts(issues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Issues and people; who is assigned and who reported; links between known issues.

    Of several links of one ordered pair the strongest kind names the edge.
    """
    roles = issues.select("key", F.expr("stack(2, 'assigned_to', assignee, 'reported_by', reporter) as (edge_type, person)")).where("trim(person) <> ''")
    people = roles.groupBy(person_id(F.col("person")).alias("node_id")).agg(F.min("person").alias("name"))
    links = issues.select("key", F.explode("typed_links").alias("l")).select("key", F.col("l.key").alias("other"), F.col("l.type").alias("type")).where("key <> other")
    links = links.join(issues.select(F.col("key").alias("other")), "other", "left_semi").withColumn("kind", link_kind(F.col("type")))
    strength = F.array_position(F.array(*map(F.lit, LINK_KINDS)), F.col("kind"))
    pairs = links.groupBy("key", "other").agg(F.min_by("kind", strength).alias("kind"), F.array_join(F.array_sort(F.collect_set("type")), "; ").alias("types"))
    me = prefixed("jira", "key")
    return (
        together(nodes(issues, me, "jira_issue", "key", "summary", "status", "priority", "project"), nodes(people, F.col("node_id"), "person", "name")),
        together(
            roles.select(me.alias("src"), person_id(F.col("person")).alias("dst"), "edge_type", F.create_map().cast("map<string,string>").alias("attrs")),
            edges(pairs, me, prefixed("jira", "other"), "linked_to", link_kind=F.col("kind"), link_type=F.col("types")),
        ),
    )


def page_id(repo: Column, path: Column, url: Column, make=slug) -> Column:
    """A page's id: its repository and path where known, made safe by ``make``, else a digest of its URL."""
    placed = F.concat(F.lit("documentation_page:"), make(repo), F.lit(":"), make(path))
    return F.when((repo != "") & (path != ""), placed).otherwise(F.concat(F.lit("documentation_page:"), digest16(url)))


def page_facts(pages: DataFrame, make=slug) -> tuple[DataFrame, DataFrame]:
    """Pages (the first of a URL wins), their repositories and what these contain.

    ``make`` is the function by which names become parts of ids; readers of exports keep
    case, dots and dashes (``scalars.safe_slug``).
    """
    rows = first_by(pages, ["url"], F.col("input_pos"))
    me = page_id(F.col("source_repo"), F.col("path"), F.col("url"), make)
    repos = rows.where("source_repo <> ''").select("source_repo").distinct()
    repo = F.concat(F.lit("software_repository:"), make(F.col("source_repo")))
    return (
        together(nodes(rows, me, "documentation_page", "title", "url", "site_name"), nodes(repos, repo, "software_repository", "source_repo")),
        edges(rows.where("source_repo <> ''"), repo, me, "contains"),
    )
