"""Registered queries of the readers: each run over a stated export, all that it gives held against stated rows.

A row is a fact or the run's health: ``node`` (id, subtype), ``edge`` (src, type, dst) with
its attributes as ``name=value`` in name order, or ``health`` (status, scope, counts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.plans.cases import values_sql
from graphloom.plans.reader_expected import EXPECTED
from graphloom.sources import readers as S

COLUMNS = ["kind", "a", "b", "c", "attrs"]


def told(run: S.Run, only: tuple[str, ...] = ()) -> DataFrame:
    """All facts and the health of a run as text rows; ``only`` bounds which attributes are told."""
    shown = F.map_filter("attrs", lambda k, _: k.isin(*only)) if only else F.col("attrs")
    text = F.array_join(F.transform(F.array_sort(F.map_entries(shown)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    nodes = run.nodes.select(F.lit("node").alias("kind"), F.col("node_id").alias("a"), F.col("subtype").alias("b"), F.lit("").alias("c"), text.alias("attrs"))
    edges = run.edges.select(F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("edge_type").alias("b"), F.col("dst").alias("c"), text.alias("attrs"))
    health = run.health.select(
        F.lit("health").alias("kind"), F.col("status").alias("a"), F.when(F.col("completed_scope"), "complete").otherwise("open").alias("b"), F.concat_ws("/", F.col("record_count").cast("string"), F.col("skipped_count").cast("string")).alias("c"), F.lit("").alias("attrs")
    )
    return nodes.unionByName(edges).unionByName(health)


#: name: (the reader, the mode, the attributes that are told)
RUNS: dict[str, tuple[Callable[[], S.Reader], str, tuple[str, ...]]] = {
    "cmssw": (lambda: S.Releases(records=[{"label": "CMSSW_1_0_0", "type": "Production", "state": "Announced", "architecture": ["a"]}, {"label": "CMSSW_1_0_1", "type": "Production", "architecture": "b"}, {"label": "CMSSW_1_0_1", "state": "late"}, 7]), "reconcile", ("label", "state", "family")),
    "conddb": (lambda: S.GlobalTags(records=[{"name": "X_v1", "release": "CMSSW_1_0_0"}, {"tag_name": "X_v2", "release": "CMSSW_9_9_9", "scenario": "pp"}], releases=["CMSSW_1_0_0"]), "release_new", ("name", "scenario", "referenced_only")),
    "dbs": (lambda: S.Datasets(records=[
        {"dataset_name": "/P/Run2018A-v1/RAW", "data_tier": "RAW", "primary_dataset": "P", "processed_dataset": "Run2018A-v1", "nevents": 10}, {"dataset": "/P/Run2018A-v2/AOD", "data_tier_name": "AOD", "primary_ds_name": "P", "processed_ds_name": "Run2018A-v2", "total_files": 3}, {"data_tier": "x"},
    ]), "scope_complete", ("data_tier", "era", "campaign", "total_files", "total_events", "src_tier", "dst_tier")),
    "github": (lambda: S.Repositories(["cms-sw/cmssw", "dmwm/CRAB", "cms-sw/cmssw"]), "scope_complete", ("slug", "url")),
    "dqm": (lambda: S.Certifications(records=[{"cert_name": "Cert_Collisions2018_A", "run_range": [5, 9], "datasets": ["/A/B/RAW"]}, {"cert_name": "Cert_B", "datasets": "/A/B/RAW"}, {"filename": "x"}]), "scope_complete", ("group", "year", "run_min", "run_max")),
    "gocdb": (lambda: S.Downtimes(records=[
        {"downtime_id": 7, "classification": "SCHEDULED", "severity": "OUTAGE", "hosted_by": "T2_X", "service_type": "CE", "hostname": "ce.x.org"}, {"downtime_id": "7", "severity": "late", "service_type": "SE", "hostname": "se.x.org:8443"}, {"downtime_id": 0}, "bad",
    ], sites=["T2_X"], services=[("ce-svc", "https://CE.x.org:9/p"), ("second", "ce.x.org")]), "scope_complete", ("severity", "affected_services")),
    "wmstats": (lambda: S.Workflows(records=[{"RequestName": "w1", "RequestStatus": "done", "InputDataset": "/A/B/RAW", "OutputDatasets": ["/A/C/AOD", "/A/B/RAW"], "CMSSWVersion": "CMSSW_1_0_0", "RequestPriority": 5}, {"workflow_name": "w2", "output_datasets": "/A/D/AOD"}, {"workflow_name": "w1"}], expected=2), "scope_complete", ("status", "priority")),
    "wmstats_count": (lambda: S.Workflows(records=[{"workflow_name": "w2"}], expected=2), "scope_complete", ("status",)),
    "jira": (lambda: S.Issues(records=[
        {"key": "AB-1", "fields": {"summary": "see AB-2 by jdoe@cern.ch", "status": {"name": "Open"}, "assignee": {"displayName": "Jo Do"}, "reporter": {"name": "jdo"}, "issuelinks": [{"type": {"name": "Blocks"}, "outwardIssue": {"key": "AB-2"}}, {"type": {"name": "Relates"}, "inwardIssue": {"key": "AB-2"}}]}},
        {"issue_key": "AB-2", "summary": "b", "labels": ["l1", "l2"], "recent_comments": [{"author": {"name": "x"}, "created": "2021", "body": "COVID-19 and AB-1"}], "issue_links": [{"key": "ZZ-9", "type": "Relates", "direction": "outward"}]}, {"summary": "none"},
    ]), "scope_complete", ("summary", "status", "name", "link_kind", "link_type", "match_type", "text", "chunk_index")),
    "docs": (lambda: S.Documents(records=[
        {"url": "https://a.org/p", "title": "T", "body": "T2_US_MIT runs CMSSW_1_2_3 at se.mit.edu:8443, CMSSW_9_9_9", "source_repo": "org/repo", "path": "docs/p.md"}, {"url": "https://a.org/p", "title": "again"}, {"url": "https://b.org", "title": "B"}, {"title": "no url"},
    ], known=["site:T2_US_MIT", "cmssw_release:CMSSW_1_2_3"], services=[("se1", "root://se.mit.edu:8443//x"), ("other", "x.org")]), "scope_complete", ("title", "match_type", "chunk_index")),
    "twiki": (lambda: S.Topics(records=[
        {"page_id": "CMS/HiggsPhysics", "text": '%META:TOPICINFO{author="me" date="0" version="3"}%\nSee [[Sub.Page][p]] and OtherTopic now'}, {"page_id": "CMS/OtherTopic", "text": '%META:TOPICPARENT{name="HiggsPhysics"}%\nmail me[at]cern.ch HiggsPhysics'}, {"page_id": "Sub/Page", "text": "x"}, {"page_id": "CMS/Blank", "text": " \n"},
    ]), "scope_complete", ("title", "author", "last_modified", "parent_topic", "kind", "text", "chunk_index")),
    "twiki_physics": (lambda: S.Topics(records=[
        {"page_id": "CMS/HiggsPhysics", "text": "a"}, {"page_id": "CMS/Child", "text": '%META:TOPICPARENT{name="CMS.HiggsPhysics"}% b'}, {"page_id": "CMS/GrandChild", "text": '%META:TOPICPARENT{name="Child"}% c'}, {"page_id": "CMS/HowToX", "text": "d"},
        {"page_id": "CMS/Plain", "text": "e"}, {"page_id": "CMS/CompOpsTutorial", "text": "f"}, {"page_id": "CMS/LoopA", "text": '%META:TOPICPARENT{name="LoopB"}% g'}, {"page_id": "CMS/LoopB", "text": '%META:TOPICPARENT{name="LoopA"}% h'},
    ], physics=True), "scope_complete", ("title",)),
    "hypernews": (lambda: S.Threads(records=[{"thread_id": "prep/12", "title": "Q", "forum_name": "prep", "body": "<p>hi</p> URCMessage(x) there", "author": "A", "date": "2021-02-03", "reply_count": 2}, {"title": "x"}]), "scope_complete", ("title", "author", "reply_count", "text")),
    "indico": (lambda: S.Meetings(records=[{
        "id": "77", "title": "Ops", "startDate": {"date": "2021-02-03", "time": "10:00"}, "type": "meeting", "category": "C", "categoryId": 5, "description": "<b>agenda</b>", "chairs": [{"fullName": "Do, Jo"}], "speakers": [{"first_name": "A", "last_name": "B"}],
        "folders": [{"attachments": [{"download_url": "https://i.org/f.pdf"}, {"url": ""}]}], "_pdf_texts": [{"text": ""}, {"text": "slide text", "title": "S"}],
    }, {"title": "none"}]), "scope_complete", ("label", "date", "category_id", "speakers", "chairs", "attachment_urls", "text", "path", "title", "relationship", "chunk_index")),
    "indico_live": (lambda: S.Meetings(records=[{"id": "77", "title": "Ops", "_contributions_text": "told", "contributions": [
        {"id": "1", "db_id": "901", "title": "Talk &amp; more", "description": "<p>about</p>", "startDate": {"date": "2021-02-03", "time": "10:00"}, "room": "40/S2 - Salle", "speakers": [{"first_name": "A", "last_name": "B", "affiliation": "MIT"}, {"fullName": "A B"}], "folders": [{"attachments": [{"download_url": "/f.pdf", "filename": "f.pdf"}, {"download_url": "/f.pdf"}]}]},
        {"id": "2", "title": "", "description": "Only an abstract", "session": "S", "url": "https://o.org/x"}, {"id": "901", "title": "repeat"},
    ]}], talks=True, image_limit=2), "scope_complete", ("title", "date", "room", "session", "speakers", "attachment_urls", "attachment_images", "url", "text", "relationship")),
    "cds": (lambda: S.Reports(records=[
        {"oai_id": "oai:cds:11", "title": "T", "identifiers": ["http://x", "CMS-NOTE-2019-001", "CMS-PAS-SUS-08-005"], "creators": ["A", "B"]}, {"oai_id": "oai:cds:12", "deleted": True}, {"oai_id": "oai:cds:11", "title": "T2", "identifiers": ["CMS-NOTE-2019-001"]}, {"title": "x"},
    ]), "scope_complete", ("title", "creators", "report_number", "analysis_codes")),
    "siteconf": (lambda: S.SiteConfigs(records=[{"site_name": "T2_X", "raw_storage_json": '[{"protocol":"root","se":"se.x.org"},{"protocol":"davs","endpoint":"e"},7]'}, {"site_name": "T2_X", "raw_storage_json": '{"protocol":"root"}'}, {"site_name": "T3_Y", "raw_storage_json": "broken"}], sites=["T2_X"]), "scope_complete", ("storage_protocols", "se_endpoints", "text")),
    "cmssst": (lambda: S.SiteStatus(records=[
        {"site": "T2_XX_A", "time": 1_700_000_000, "alert": "<b>a &amp; b</b>", "msg": "", "ggus": [[12, 0]], "metrics": {"LifeStatus": {"today": ["uu", "o" * 60 + "u" * 30]}, "Downtime": {"today": "d" * 96}, "manLifeStatus": {"today": "u" * 96}, "ProdStatus": {"today": "u" * 96}, "FTSsite": {"today": "z" * 96}}},
        {"site": "bad", "time": 1, "metrics": {"x": {"today": "o"}}}, {"site": "T2_XX_B", "time": 0, "metrics": {"x": {"today": "o"}}},
    ], sites=["T2_XX_A"]), "scope_complete", ("title", "body", "observed_at", "match_type")),
    "cric": (lambda: S.Infrastructure(records=[
        {"kind": "site", "name": "T1_A", "tier_level": 1, "status": "on", "sitedb_title": "Alpha", "computeunits": {"cu1": {}}}, {"kind": "facility", "name": "F", "country": "X", "cmssites": ["T1_A", "gone"]}, {"kind": "storage", "name": "se1", "site": {"name": "T1_A"}, "state": "on"}, {"kind": "compute", "name": "cu1", "state": "on"},
        {"kind": "duty", "user": "u", "title": "Alpha", "role": "admin"}, {"kind": "duty", "user": "u", "title": "T1_A", "role": "admin"}, {"kind": "duty", "user": "v", "title": "none", "role": "r"}, {"kind": "what"},
    ]), "scope_complete", ("country", "tier_level", "status", "sitedb_title", "state", "role", "user")),
    "cric_core": (lambda: S.Services(records=[
        {"kind": "service", "name": "s1", "endpoint": "h.org", "rcsite": "R1"}, {"kind": "service", "name": "s2", "endpoint": "x", "rcsite": "R9"}, {"kind": "member", "rcsite": "R1", "site": "T1_A", "vo_name": "CMS"}, {"kind": "member", "rcsite": "R9", "site": "T9", "vo_name": "atlas"},
        {"kind": "federation", "name": "fed", "vos": ["cms"], "rcsites": ["R1"], "pledges": {"2023": {"Q4": {"cms": {"CPU": 1}}}, "2024": {"Q1": {"cms": {"CPU": 2}}, "Q2": {"cms": {"CPU": 3}}}}}, {"kind": "federation", "name": "other", "vos": ["atlas"], "rcsites": ["R9"]},
    ]), "scope_complete", ("endpoint", "pledge_cpu", "pledge_year")),
    "monit_sam": (lambda: S.Monitoring("sam", records=[{"responses": [{"aggregations": {"groups": {"buckets": [{"key": "T1_A", "status_breakdown": {"buckets": [{"key": "OK", "doc_count": 18}, {"key": "CRITICAL", "doc_count": 2}]}}]}}}]}], date="2024-01-02"), "scope_complete", ("status", "availability_pct", "total_tests")),
    "monit_condor": (lambda: S.Monitoring("condor", records=[{"responses": [{"timed_out": True, "aggregations": {"sites": {"buckets": [{"key": "T1_A", "doc_count": 4, "total_jobs": {"value": 0}, "total_core_hrs": {"value": 8}, "total_cpu_time_hrs": {"value": 6}, "by_status": {"buckets": [{"key": "Running", "doc_count": 3}]}}]}}}]}], date="2024-01-02"), "scope_complete", ("total_jobs", "jobs_running", "cpu_efficiency", "status_breakdown")),
    "monit_transfers": (lambda: S.Monitoring("transfers", records=[{"responses": [{"aggregations": {"by_src_rse": {"buckets": [{"key": "T1_A_Disk", "by_dst_rse": {"buckets": [{"key": "T2_B", "by_event_type": {"buckets": [{"key": "transfer-done", "doc_count": 4}, {"key": "transfer-failed", "doc_count": 1}]}, "bytes_total": {"value": 100}}]}}]}}}]}], date="2024-01-02"), "scope_complete", ("done_count", "failed_count", "bytes_total", "role", "snapshot_date")),
    "monit_datasets": (lambda: S.Monitoring("datasets", records=[{"responses": [{"aggregations": {"datasets": {"buckets": [{"key": {"dataset": "/a/b/RAW"}, "replicas": {"buckets": [{"key": "T2_B_Disk", "doc_count": 1}, {"key": "T1_A", "doc_count": 1}]}}, {"key": {"dataset": "/a/RelVal/RAW"}, "replicas": {"buckets": []}}]}}}]}], date="d", excluded=("RelVal",)), "scope_complete", ("label", "relationship")),
    "no_export": (lambda: S.Datasets(records_path="/nowhere/at/all.json"), "scope_complete", ()),
    "empty_mode": (lambda: S.Datasets(records=[{"dataset": "/a/b/RAW"}]), "sample", ("data_tier",)),
}


def _query(name: str):
    make, mode, only = RUNS[name]
    return lambda spark, sf_dir: told(make().run(spark, mode), only)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f"reader_{n}": _query(n) for n in RUNS}
ORACLES = {f"reader_{n}": values_sql(COLUMNS, EXPECTED[n]) for n in RUNS}
