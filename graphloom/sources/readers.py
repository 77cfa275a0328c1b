"""Readers: from an export to nodes, edges, health and the verdict on its scope.

A reader names its profile and what it emits; ``run`` reads its export, counts what it
skips, projects the rest and says whether the scope is complete, so that a later step may
retract what is missing.  An export that cannot be used gives no facts and no scope.
Records may be handed in (``records``), which takes the place of the file.
"""

from __future__ import annotations

import inspect
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graphloom.functions import scalars as X, text as T, wiki as W
from graphloom.operators.relational import first_by
from graphloom.sources import caches as C, monitoring as M, projections as P, records as R
from graphloom.streaming import runs

NODES, EDGES = "node_id string, subtype string, attrs map<string,string>", "src string, dst string, edge_type string, attrs map<string,string>"


@dataclass
class Run:
    """What a run gives: facts, and one row of health (record_count, skipped_count, status, completed_scope, reason)."""

    nodes: DataFrame
    edges: DataFrame
    health: DataFrame


def pick(*names: str, raw: str = "raw") -> Column:
    """The first spelling of a field that holds anything, empty if none does."""
    return F.coalesce(*[F.nullif(F.get_json_object(raw, f"$.{n}"), F.lit("")) for n in names], F.lit(""))


def number(*names: str) -> Column:
    return F.coalesce(F.nullif(pick(*names), F.lit("")).try_cast("double").cast("long"), F.lit(0))


def listed(*names: str) -> Column:
    """A list of texts; one text is a list of one."""
    value = pick(*names)
    many = F.from_json(value, "array<string>")
    return F.filter(F.when(value.startswith("["), many).when(value != "", F.array(value)).otherwise(F.array().cast("array<string>")), lambda v: v != "")


def once(rows: DataFrame) -> DataFrame:
    """Rows that several projections read, worked out once: checkpointed where the cluster keeps checkpoints."""
    return rows.checkpoint() if rows.sparkSession.sparkContext.getCheckpointDir() else rows.persist()


def against(health: DataFrame, expected: int | None) -> DataFrame:
    """Health held against the exporter's own count: another count is a failed endpoint without a scope."""
    if expected is None:
        return health
    differs = F.col("record_count") != expected
    return health.withColumn("status", F.when(differs, "endpoint_failed").otherwise(F.col("status"))).withColumn("completed_scope", F.col("completed_scope") & ~differs)


class Reader:
    """One kind of export.  Subclasses say how a record is read (``record``) and projected (``facts``)."""

    name, profile, probe = "", "discovery_crawl", "content_hash"
    emits: tuple[str, ...] = ()

    def __init__(self, records_path: str | None = None, records: list | None = None):
        self.records_path, self.given = records_path, records

    @classmethod
    def configured(cls, **params) -> "Reader":
        """A reader of registry parameters; one that it does not take is refused."""
        known = set(inspect.signature(cls.__init__).parameters) - {"self"}
        if unknown := sorted(set(params) - known):
            raise ValueError(f"{cls.name} takes no {', '.join(unknown)}")
        return cls(**params)

    def raw(self, spark: SparkSession) -> DataFrame:
        """input_pos and raw of every item of the export."""
        if self.given is not None:
            return C.rows_of_text(spark.createDataFrame([(json.dumps(self.given, ensure_ascii=False),)], "value string"))
        if not self.records_path:
            raise C.CacheUnusable("cache_missing", f"{self.name} has no export")
        return C.json_rows(spark, self.records_path)

    def record(self, raw: DataFrame) -> DataFrame:
        """Typed records with ``skip`` for items that cannot be used."""
        raise NotImplementedError

    def facts(self, spark: SparkSession, good: DataFrame) -> tuple[DataFrame, DataFrame]:
        raise NotImplementedError

    def _unusable(self, spark: SparkSession, error: C.CacheUnusable, mode: str) -> DataFrame:
        return spark.createDataFrame([(0, 0, mode, error.status, False, str(error))], "record_count long, skipped_count long, mode string, status string, completed_scope boolean, reason string")

    def _health(self, rows: DataFrame, mode: str) -> DataFrame:
        counted = runs.health(rows, F.coalesce(F.col("skip"), F.lit(True)), mode)
        if self.profile == "reference_catalog" and mode in runs.RELEASE_MODES:
            counted = counted.withColumn("completed_scope", F.lit(False))
        status = F.when(F.col("record_count") == 0, "cache_missing").when(F.col("skipped_count") > 0, "endpoint_failed").otherwise("ok")
        reason = F.concat(F.col("record_count").cast("string"), F.lit(f" {self.name} records, "), F.col("skipped_count").cast("string"), F.lit(" skipped"))
        return counted.withColumn("status", status).withColumn("reason", reason)

    def preflight(self, spark: SparkSession, mode: str = "scope_complete") -> DataFrame:
        """The verdict that ``run`` would reach, without facts."""
        try:
            return self._health(self.record(self.raw(spark)), mode)
        except C.CacheUnusable as error:
            return self._unusable(spark, error, mode)

    def change_probe(self, spark: SparkSession, run_id: str = "") -> DataFrame:
        """One row: a token that changes with the export."""
        if self.given is not None or not self.records_path:
            return self.raw(spark).agg(X.records_digest(F.coalesce("raw", F.lit(""))).alias("token"))
        return runs.probe(spark.read.format("binaryFile").load(self.records_path), self.name, run_id)

    def run(self, spark: SparkSession, mode: str = "scope_complete") -> Run:
        try:
            rows = once(self.record(self.raw(spark)))
            health = self._health(rows, mode)
        except C.CacheUnusable as error:
            return Run(spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES), self._unusable(spark, error, mode))
        nodes, edges = self.facts(spark, rows.where("not skip").drop("skip"))
        return Run(nodes, edges, health)

    def known(self, spark: SparkSession, names: list[str] | None, column: str = "name") -> DataFrame:
        return spark.createDataFrame([(n,) for n in names or []], f"{column} string")


class Releases(Reader):
    name, profile, emits = "cmssw", "reference_catalog", ("cmssw_release",)

    def record(self, raw):
        label = pick("label")
        return raw.select("input_pos", label.alias("label"), pick("type", "xml_type").alias("type"), pick("state").alias("state"), listed("architecture").alias("architecture"), (~label.rlike(r"^CMSSW_\d+_\d+_")).alias("skip"))

    def facts(self, spark, good):
        return P.release_facts(first_by(good, ["label"], F.col("input_pos")))


class GlobalTags(Reader):
    name, profile, emits = "conddb", "reference_catalog", ("global_tag", "cmssw_release")

    def __init__(self, records_path=None, records=None, releases: list[str] | None = None):
        super().__init__(records_path, records)
        self.releases = releases

    def record(self, raw):
        name = F.trim(pick("name", "tag_name"))
        return raw.select("input_pos", name.alias("name"), pick("release").alias("release"), pick("scenario").alias("scenario"), (name == "").alias("skip"))

    def facts(self, spark, good):
        return P.tag_facts(good, self.known(spark, self.releases, "label"))


class Datasets(Reader):
    name, profile, emits = "dbs", "reference_catalog", ("dataset",)

    def record(self, raw):
        name = F.trim(pick("dataset_name", "dataset"))
        return raw.select(
            "input_pos", name.alias("dataset_name"), pick("data_tier", "data_tier_name").alias("data_tier"), pick("primary_dataset", "primary_ds_name").alias("primary_dataset"), pick("processed_dataset", "processed_ds_name").alias("processed_dataset"),
            number("total_files", "nfiles").alias("total_files"), number("total_events", "nevents").alias("total_events"), (name == "").alias("skip"),
        )

    def facts(self, spark, good):
        return P.dataset_facts(good)


class Repositories(Reader):
    """Repositories that the configuration names: a literal source."""

    name, profile, emits = "github_repos", "reference_catalog", ("software_repository", "repo")

    def __init__(self, repos: list[str]):
        if not repos:
            raise ValueError("name at least one repository")
        super().__init__(records=[{"slug": r} for r in repos])

    def record(self, raw):
        return raw.select("input_pos", pick("slug").alias("slug"), (pick("slug") == "").alias("skip"))

    def facts(self, spark, good):
        return R.repo_facts(good)


class Certifications(Reader):
    name, emits = "dqm", ("data_certification", "run", "dataset")

    def record(self, raw):
        name = pick("cert_name")
        span = F.filter(F.transform(listed("run_range"), lambda r: r.try_cast("long")), lambda r: r.isNotNull())
        return raw.select("input_pos", name.alias("cert_name"), span.alias("run_range"), listed("datasets").alias("datasets"), (name == "").alias("skip"))

    def facts(self, spark, good):
        return P.certification_facts(good)


class Downtimes(Reader):
    name, emits = "gocdb", ("downtime",)

    def __init__(self, records_path=None, records=None, sites: list[str] | None = None, services: list[tuple[str, str]] | None = None):
        super().__init__(records_path, records)
        self.sites, self.services = sites, services

    def record(self, raw):
        downtime = F.coalesce(pick("downtime_id").try_cast("long"), F.lit(0))
        texts = [pick(c).alias(c) for c in ("classification", "severity", "description", "start_date", "end_date", "hosted_by", "service_type", "hostname")]
        return raw.select("input_pos", downtime.alias("downtime_id"), *texts, (downtime <= 0).alias("skip"))

    def facts(self, spark, good):
        services = spark.createDataFrame([(k, n, e) for k, (n, e) in enumerate(self.services or [])], "input_pos long, name string, endpoint string")
        return P.downtime_facts(good, self.known(spark, self.sites), services)


class Workflows(Reader):
    """A repeated workflow is skipped and counted: it means a mixed export."""

    name, profile, emits = "wmstats", "mutable_api", ("workflow", "dataset")

    def __init__(self, records_path=None, records=None, expected: int | None = None):
        super().__init__(records_path, records)
        self.expected = expected

    def record(self, raw):
        name = F.trim(pick("workflow_name", "request_name", "RequestName"))
        rows = raw.select(
            "input_pos", name.alias("workflow_name"), pick("status", "RequestStatus").alias("status"), pick("campaign", "Campaign").alias("campaign"), number("priority", "RequestPriority").alias("priority"),
            pick("cmssw_version", "CMSSWVersion").alias("cmssw_version"), pick("input_dataset", "InputDataset").alias("input_dataset"), listed("output_datasets", "OutputDatasets").alias("output_datasets"),
        )
        first = rows.groupBy("workflow_name").agg(F.min("input_pos").alias("_first"))
        return rows.join(first, "workflow_name").withColumn("skip", (F.col("workflow_name") == "") | (F.col("input_pos") != F.col("_first"))).drop("_first")

    def _health(self, rows, mode):
        return against(super()._health(rows, mode), self.expected)

    def facts(self, spark, good):
        return P.workflow_facts(good)


class Issues(Reader):
    """Issues with people, roles, links between known issues, and their texts in chunks."""

    name, profile, probe, emits = "jira", "mutable_api", "mutable_api", ("jira_issue", "person", "document_chunk")

    def __init__(self, records_path=None, records=None, projects: list[str] | None = None, expected: int | None = None):
        super().__init__(records_path, records)
        self.projects, self.expected = projects, expected

    def record(self, raw):
        names = ("summary", "description", "environment", "status", "priority", "resolution", "assignee", "reporter", "components", "labels")
        spelled = {n: pick(n, f"fields.{n}") for n in names} | {
            "key": pick("key", "issue_key"), "project": pick("fields.project", "project"), "parent_key": pick("parent_key", "parent", "fields.parent"), "fix_versions": pick("fix_versions", "fields.fixVersions", "fields.fix_versions"),
            "links": pick("issue_links", "fields.issuelinks"), "subtasks": pick("subtasks", "fields.subtasks"), "comments": pick("recent_comments", "comments", "fields.comment.comments"),
        }
        # The texts first, then what is made of them: each spelling is looked up once.
        rows = once(raw.select("input_pos", *[c.alias(n) for n, c in spelled.items()]))
        filled = lambda n: F.when(F.col(n) != "", F.col(n))
        clean = lambda c: _redacted(T.no_nul(c))
        rows = rows.select(
            "input_pos", "key", *[clean(F.col(n)).alias(n) for n in ("summary", "description", "environment")], *[X.name_or_key(F.col(n)).alias(n) for n in ("project", "status", "priority", "resolution", "parent_key")],
            *[clean(X.display_name(F.col(n))).alias(n) for n in ("assignee", "reporter")], *[X.strings_of(filled(n)).alias(n) for n in ("components", "labels", "fix_versions")],
            F.array_join(X.strings_of(filled("links")), " ").alias("_links"), F.array_join(X.strings_of(filled("subtasks")), " ").alias("_subtasks"), X.comment_texts(filled("comments")).alias("recent_comments"),
            F.transform(X.typed_links(F.col("links")), lambda l: F.struct(l["key"].alias("key"), l["type"].alias("type"))).alias("typed_links"), (F.col("key") == "").alias("skip"),
        )
        # Keys are those of the given projects, else of the projects that the export itself holds: few, whatever its size.
        projects = self.projects or sorted(r[0] for r in raw.select(F.regexp_extract(pick("key", "issue_key"), r"\A([A-Z][A-Z0-9_]*)-\d+\z", 1)).distinct().collect() if r[0])
        return rows.withColumn("issue_links", X.issue_keys(F.col("_links"), projects)).withColumn("subtasks", X.issue_keys(F.col("_subtasks"), projects)).drop("_links", "_subtasks")

    def _health(self, rows, mode):
        return against(super()._health(rows, mode), self.expected)

    def facts(self, spark, good):
        nodes, edges = P.issue_facts(good)
        chunks, held = R.chunk_facts(R.issue_text(good), R.BACKSLASH_ZERO)
        known = good.select(P.prefixed("jira", "key").alias("node_id"))
        text = F.try_element_at("attrs", F.lit("text"))
        named = chunks.select(F.col("node_id").alias("src"), F.explode(X.issue_keys(text)).alias("key")).select("src", P.prefixed("jira", "key").alias("dst"))
        parents = held.select(F.col("dst").alias("src"), F.col("src").alias("_own"))
        named = named.join(known.withColumnRenamed("node_id", "dst"), "dst", "left_semi").join(parents, "src").where("dst <> _own").select("src", "dst").distinct()
        return P.together(nodes, chunks), P.together(edges, held, P.edges(named, F.col("src"), F.col("dst"), "references", match_type=F.lit("jira_issue")))


def _redacted(text: Column) -> Column:
    from graphloom.functions.redaction import redact_addresses

    return redact_addresses(text)


class Documents(Reader):
    name, emits = "docs", ("documentation_page", "software_repository", "document_chunk")

    def __init__(self, records_path=None, records=None, known: list[str] | None = None, services: list[tuple[str, str]] | None = None):
        super().__init__(records_path, records)
        self.known_ids, self.services = known, services

    def record(self, raw):
        texts = [T.no_nul(pick(c)).alias(c) for c in ("title", "body", "site_name", "source_repo", "path")]
        return raw.select("input_pos", T.no_nul(pick("url")).alias("url"), *texts, (pick("url") == "").alias("skip"))

    def facts(self, spark, good):
        nodes, edges = P.page_facts(good, X.safe_slug)
        rows = first_by(good, ["url"], F.col("input_pos"))
        text = R.joined(" ", F.col("title"), F.col("body"))
        me = P.page_id(F.col("source_repo"), F.col("path"), F.col("url"), X.safe_slug)
        chunks, held = R.chunk_facts(rows.select(me.alias("node_id"), text.alias("text"), F.col("title").alias("heading")))
        services = spark.createDataFrame(self.services, "name string, endpoint string") if self.services else None
        named = R.text_references(chunks, self.known(spark, self.known_ids, "node_id"), services)
        return P.together(nodes, chunks), P.together(edges, held, named)


class Topics(Reader):
    """Wiki topics of a saved tree: (page_id, raw) records; blank ones are counted, not read."""

    name, emits = "twiki_eos", ("documentation_page", "document_chunk")

    def __init__(self, records_path=None, records=None, root: str = "", physics: bool = False, max_files: int | None = None):
        super().__init__(records_path, records)
        self.root, self.physics, self.max_files = root, physics, max_files

    def raw(self, spark):
        if self.given is not None or not self.records_path:
            return super().raw(spark)
        tree = C.text_tree(spark, self.records_path)
        return tree.select(F.xxhash64("page").alias("input_pos"), F.to_json(F.struct(F.col("page").alias("page_id"), F.col("raw").alias("text"))).alias("raw"))

    def record(self, raw):
        text, page = F.coalesce(F.get_json_object("raw", "$.text"), F.lit("")), pick("page_id")
        meta = W.meta(text)
        parts = F.split(page, "/")
        rows = raw.select(
            "input_pos", page.alias("page_id"), F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), "/").alias("web_name"), F.lit(self.root).alias("web_root"), F.element_at(parts, -1).alias("title"),
            F.concat(F.lit("https://twiki.cern.ch/twiki/bin/view/"), page).alias("url"), W.strip_markup(text).alias("body"), meta["author"].alias("author"), meta["last_modified"].alias("last_modified"), meta["version"].alias("version"), meta["parent_topic"].alias("parent_topic"),
            W.link_targets(text).alias("wiki_links"), W.bare_words(text).alias("bare_wikiwords"), F.coalesce((page == "") | (T.strip(F.translate(text, "\0", " ")) == ""), F.lit(True)).alias("skip"),
        )
        return rows if self.max_files is None else rows.orderBy("page_id").limit(self.max_files)

    def facts(self, spark, good):
        from graphloom.functions.redaction import redact_fields

        rows = R.physics_topics(good).drop("stage") if self.physics else good
        return R.wiki_facts(redact_fields(rows, ["title", "body", "author", "last_modified", "parent_topic", "version"]))


class Threads(Reader):
    name, probe, emits = "hypernews", "mutable_api", ("forum_thread", "document_chunk")

    def record(self, raw):
        thread = pick("thread_id")
        return raw.select(
            "input_pos", F.concat(F.lit("hn:"), thread).alias("node_id"), T.no_nul(pick("title")).alias("title"), pick("url").alias("url"), pick("forum_name").alias("forum"), X.forum_body(pick("body")).alias("body"),
            T.no_nul(pick("author")).alias("author"), pick("date").alias("date"), number("reply_count").alias("reply_count"), (thread == "").alias("skip"),
        )

    def facts(self, spark, good):
        return R.forum_facts(first_by(good, ["node_id"], F.col("input_pos")))


class Meetings(Reader):
    """Meetings with attached texts; ``talks`` adds each talk as a meeting of its own."""

    name, emits = "indico", ("meeting_minutes", "document", "document_chunk")

    def __init__(self, records_path=None, records=None, base_url: str = "https://indico.cern.ch", talks: bool = False, image_limit: int = 0):
        super().__init__(records_path, records)
        self.base_url, self.talks, self.image_limit = base_url, talks, image_limit

    def record(self, raw):
        event = pick("id", "event_id")
        return raw.select("input_pos", event.alias("event_id"), F.from_json("raw", R.EVENT).alias("item"), F.from_json(F.get_json_object("raw", "$.contributions"), f"array<{R.TALK}>").alias("contributions"), (event == "").alias("skip"))

    def facts(self, spark, good):
        meetings = R.events(good, self.base_url)
        if not self.talks:
            return R.meeting_facts(meetings)
        each = good.select("event_id", F.col("input_pos").alias("_p"), F.posexplode("contributions").alias("_k", "item"))
        each = each.select("event_id", (F.col("_p") * 1_000_000 + F.col("_k")).alias("input_pos"), "item", F.col("item.session").alias("session"))
        given = R.talks(each, self.base_url, self.image_limit)
        held = given.select("event_id").distinct()
        # Talks that are meetings of their own are not told again in the text of their meeting.
        told = meetings.join(held.withColumn("_held", F.lit(True)), "event_id", "left").withColumn("contributions_text", F.when(F.col("_held"), "").otherwise(F.col("contributions_text"))).drop("_held")
        (n1, e1), (n2, e2) = R.meeting_facts(told), R.talk_facts(given, meetings)
        return P.together(n1, n2), P.together(e1, e2)


class Reports(Reader):
    """Harvested reports; deleted ones are no records and no skips."""

    name, emits = "cds", ("cds_record",)

    def record(self, raw):
        return raw.select("input_pos", pick("oai_id").alias("oai_id"), pick("title").alias("title"), listed("identifiers").alias("identifiers"), listed("creators").alias("creators"), (pick("deleted") == "true").alias("deleted"), (pick("oai_id") == "").alias("skip"))

    def facts(self, spark, good):
        return R.report_facts(good), spark.createDataFrame([], EDGES)


class SiteConfigs(Reader):
    name, probe, emits = "siteconf", "mutable_api", ("site_config",)

    def __init__(self, records_path=None, records=None, sites: list[str] | None = None):
        super().__init__(records_path, records)
        self.sites = sites

    def record(self, raw):
        return raw.select("input_pos", pick("site_name").alias("site_name"), pick("raw_storage_json").alias("raw"), (pick("site_name") == "").alias("skip"))

    def facts(self, spark, good):
        return R.site_config_facts(R.site_configs(good), self.known(spark, self.sites))


class SiteStatus(Reader):
    """Current site status: one page a site, the first of a site; a malformed one is skipped."""

    name, emits = "cmssst", ("documentation_page", "document_chunk")

    def __init__(self, records_path=None, records=None, sites: list[str] | None = None):
        super().__init__(records_path, records)
        self.sites = sites

    def record(self, raw):
        metrics = F.from_json(F.get_json_object("raw", "$.metrics"), "map<string,struct<today:string>>")
        bins = F.transform_values(metrics, lambda _, v: F.when(v["today"].startswith("["), F.array_join(F.from_json(v["today"], "array<string>"), "")).otherwise(v["today"]))
        tickets = F.transform(F.from_json(F.coalesce(F.get_json_object("raw", "$.ggus"), F.lit("[]")), "array<array<bigint>>"), lambda t: F.struct(t[0].alias("ticket"), t[1].alias("opened")))
        time = pick("time").try_cast("long")
        bad = ~pick("site").rlike(r"^T[0-9]_[A-Z]{2}_\w+$") | F.coalesce(time <= 0, F.lit(True)) | F.coalesce(F.size(metrics) <= 0, F.lit(True)) | tickets.isNull() | F.exists(F.map_values(bins), lambda b: b.isNull())
        rows = raw.select("input_pos", pick("site").alias("site"), time.alias("time"), X.markup_text(pick("alert")).alias("alert"), X.markup_text(pick("msg")).alias("msg"), F.array_sort(tickets).alias("ggus"), bins.alias("today"), F.coalesce(bad, F.lit(True)).alias("skip"))
        return rows

    def facts(self, spark, good):
        return R.status_facts(first_by(good.withColumn("today", F.map_entries("today")), ["site"], F.col("input_pos")).withColumn("today", F.map_from_entries("today")), self.known(spark, self.sites))


class Infrastructure(Reader):
    """Sites, facilities, endpoints and operators of keyed exports: one object with a part for each."""

    name, emits = "cric", ("facility", "site", "storage_endpoint", "compute_endpoint", "operator")
    ITEM = "struct<tier_level:int,status:string,sitedb_title:string,computeunits:map<string,string>,cmssites:array<string>,country:string,site:struct<name:string>,state:string>"

    def record(self, raw):
        kind = pick("kind")
        good = kind.isin("site", "facility", "storage", "compute") & (pick("name") != "") | (kind == "duty") & (pick("user") != "")
        return raw.select("input_pos", kind.alias("kind"), pick("name").alias("name"), F.from_json("raw", self.ITEM).alias("item"), pick("user").alias("user"), pick("title").alias("title"), pick("role").alias("role"), F.coalesce(~good, F.lit(True)).alias("skip"))

    def facts(self, spark, good):
        of = lambda k: good.where(F.col("kind") == k).select("name", "item")
        return M.site_facts(of("site"), of("facility"), of("storage"), of("compute"), good.where("kind = 'duty'").select("user", "title", "role"))


class Services(Reader):
    """Services and federations of the experiment, through the sites that resource sites stand for."""

    name, emits = "cric_core", ("infrastructure_service", "federation")

    def record(self, raw):
        kind = pick("kind")
        return raw.select(
            "input_pos", kind.alias("kind"), pick("name").alias("name"), pick("endpoint").alias("endpoint"), pick("rcsite").alias("rcsite"), pick("site").alias("site"), pick("vo_name").alias("vo_name"), listed("vos").alias("vos"), listed("rcsites").alias("rcsites"),
            F.from_json(F.get_json_object("raw", "$.pledges"), "map<string,map<string,map<string,struct<CPU:double>>>>").alias("pledges"), F.coalesce(~kind.isin("service", "member", "federation"), F.lit(True)).alias("skip"),
        )

    def facts(self, spark, good):
        of = lambda k, *c: good.where(F.col("kind") == k).select(*c)
        return M.federation_facts(of("service", "name", "endpoint", "rcsite"), of("member", "rcsite", "site", "vo_name"), of("federation", "name", "vos", "rcsites", "pledges"))


class Monitoring(Reader):
    """Saved monitoring responses of one kind: availability, compute, transfers or datasets."""

    profile, probe = "mutable_api", "mutable_api"
    emits = ("monitoring_snapshot", "transfer_job", "dataset")

    def __init__(self, kind: str, records_path=None, records=None, date: str = "", excluded: tuple[str, ...] = ()):
        super().__init__(records_path, records)
        if kind not in ("sam", "condor", "transfers", "datasets"):
            raise ValueError(f"unknown responses {kind}")
        self.kind, self.date, self.excluded, self.name = kind, date, excluded, f"monit_{kind}"

    def record(self, raw):
        return raw.select("input_pos", F.col("raw").alias("payload"), F.coalesce(F.get_json_object("raw", "$.responses").isNull(), F.lit(True)).alias("skip"))

    def _health(self, rows, mode):
        """A response that timed out, failed in part or left terms out gives facts and no scope."""
        quality = M.quality(rows.where("not skip"))
        return super()._health(rows, mode).join(F.broadcast(quality.select("partial"))).withColumn("completed_scope", F.col("completed_scope") & ~F.coalesce("partial", F.lit(False))).drop("partial")

    def facts(self, spark, good):
        if self.kind == "sam":
            return M.availability_facts(C.availability_rows(C.availability_buckets(good)), self.date)
        if self.kind == "condor":
            return M.compute_facts(M.compute_rows(good, self.date), self.date)
        if self.kind == "transfers":
            return M.transfer_facts(M.transfer_rows(good, self.date), self.date)
        return M.replica_facts(M.dataset_rows(good, self.excluded))


READERS = (Releases, GlobalTags, Datasets, Repositories, Certifications, Downtimes, Workflows, Issues, Documents, Topics, Threads, Meetings, Reports, SiteConfigs, SiteStatus, Infrastructure, Services, Monitoring)
BY_NAME = {r.name or "monit": r for r in READERS}
