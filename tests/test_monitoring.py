"""Monitoring responses, infrastructure exports and paged connectors on hand-written inputs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from graphloom.sources import connectors, monitoring as M


def buckets(**counts):
    return {"buckets": [{"key": k, "doc_count": n} for k, n in counts.items()]}


def payload(spark, **aggregations):
    return spark.createDataFrame([(json.dumps({"responses": [{"aggregations": aggregations}]}),)], "payload string")


def test_compute_rows(spark):
    full = {"key": " T2_A ", "doc_count": 5, "total_jobs": {"value": 120}, "total_core_hrs": {"value": 100}, "total_cpu_time_hrs": {"value": 75}, "avg_queue_hrs": {"value": None}, "by_status": buckets(Running=60, Idle=30, Held=10)}
    bare = {"key": "T2_B", "doc_count": 7, "total_jobs": {"value": 0}}
    rows = {r.site: r for r in M.compute_rows(payload(spark, sites={"buckets": [full, bare, {"key": " ", "doc_count": 1}]}), "2024-01-01").collect()}
    a, b = rows["T2_A"], rows["T2_B"]
    assert (a.total_jobs, a.cpu_efficiency, a.avg_queue_hours, a.jobs_running, a.jobs_idle, a.jobs_held) == (120, 0.75, None, 60, 30, 10)
    assert (b.total_jobs, b.cpu_efficiency, b.status_breakdown, len(rows)) == (7, None, {}, 2)


def test_transfers_merge_by_site(spark):
    def to(key, done, failed, size, mean, activity, **reasons):
        return {"key": key, "by_event_type": buckets(**{"transfer-done": done, "transfer-failed": failed}), "bytes_total": {"value": size}, "avg_duration": {"value": mean}, "top_activity": buckets(**({activity: 1} if activity else {})), "failure_reasons": buckets(**reasons)}

    source = [
        {"key": "T1_A_Disk", "by_dst_rse": {"buckets": [to("T2_B", 10, 0, 1000, 100.0, "", x=1), to("T2_C", 0, 0, 0, 9.0, "z")]}},
        {"key": "T1_A_Tape", "by_dst_rse": {"buckets": [to("T2_B_Test", 3, 2, 500, 200.0, "Prod", x=2, y=1)]}},
    ]
    rows = {(r.src_site, r.dst_site): r for r in M.transfer_rows(payload(spark, by_src_rse={"buckets": source}), "d").collect()}
    b = rows["T1_A", "T2_B"]
    assert (b.done_count, b.failed_count, b.bytes_total, b.top_activity, b.failure_reasons) == (13, 2, 1500, "Prod", {"x": 3, "y": 1})
    assert b.avg_duration_s == pytest.approx(2000 / 15)
    assert rows["T1_A", "T2_C"].avg_duration_s == 9.0 and rows["T1_A", "T2_C"].failure_reasons == {}


def test_datasets_and_facts(spark):
    rows = M.dataset_rows(payload(spark, datasets={"buckets": [{"key": {"dataset": "/a/b/RAW"}, "doc_count": 1, "replicas": buckets(T2_B_Disk=1, T2_B_Tape=1, T1_A=1)}, {"key": {"dataset": "/a/RelVal/RAW"}, "doc_count": 1, "replicas": buckets(x=1)}]}), ("RelVal",))
    assert [tuple(r) for r in rows.collect()] == [("/a/b/RAW", ["T1_A", "T2_B_Disk", "T2_B_Tape"], ["T1_A", "T2_B"])]
    none = spark.createDataFrame([], "site string, status string, availability_pct double, total_tests long")
    moved = spark.createDataFrame([("A", "B", 1, 0, 5, "p")], "src_site string, dst_site string, done_count long, failed_count long, bytes_total long, top_activity string")
    nodes, edges = M.monitoring_facts(none, moved, rows, "d")
    assert {(r.src, r.dst) for r in edges.collect()} == {("site:A", "site:B"), ("site:T1_A", "dataset:/a/b/RAW"), ("site:T2_B", "dataset:/a/b/RAW")} and nodes.count() == 2


def test_quality(spark):
    text = json.dumps({"responses": [{"timed_out": False, "_shards": {"failed": 1}, "aggregations": {"x": {"sum_other_doc_count": 3}}}, {"timed_out": True}]})
    row = M.quality(spark.createDataFrame([(text,)], "payload string")).first()
    assert (row.timed_out, row.failed_shards, row.errored, row.outside_terms, row.partial) == (True, 1, False, 3, True)


def test_site_facts(spark):
    sites = spark.createDataFrame([("S1", ("Title", 2, "on", {"cu": "x"})), ("S2", ("", None, "on", None))], "name string, item struct<sitedb_title string, tier_level int, status string, computeunits map<string,string>>")
    facilities = spark.createDataFrame([("F", ("X", ["S1", "gone"]))], "name string, item struct<country string, cmssites array<string>>")
    storage = spark.createDataFrame([("se", (("S2",), "on")), ("lost", (("gone",), "on"))], "name string, item struct<site struct<name string>, state string>")
    compute = spark.createDataFrame([("cu", ("on",))], "name string, item struct<state string>")
    duties = spark.createDataFrame([("u", "Title", "admin"), ("u", "S1", "admin"), ("u", "none", "x"), ("", "S1", "x")], "user string, title string, role string")
    nodes, edges = M.site_facts(sites, facilities, storage, compute, duties)
    assert {(r.src, r.dst) for r in edges.collect()} == {("facility:F", "site:S1"), ("site:S1", "ce:cu"), ("site:S2", "se:se"), ("op:u", "site:S1")}
    assert edges.where("edge_type = 'responsible_for'").count() == 1 and nodes.count() == 7


def test_federations(spark):
    services = spark.createDataFrame([("svc", "h.org", "R1"), ("other", "h", "R9")], "name string, endpoint string, rcsite string")
    members = spark.createDataFrame([("R1", "S1", "CMS"), ("R9", "S9", "atlas")], "rcsite string, site string, vo_name string")
    pledges = {"2023": {"Q4": {"cms": {"CPU": 1}}}, "2024": {"Q1": {"cms": {"CPU": 2}}, "Q2": {"cms": {"CPU": 3}}}}
    federations = spark.createDataFrame([("F", ["cms"], ["R1"], pledges)], "name string, vos array<string>, rcsites array<string>, pledges map<string,map<string,map<string,map<string,long>>>>")
    nodes, edges = M.federation_facts(services, members, federations)
    assert {(r.src, r.dst) for r in edges.collect()} == {("site:S1", "svc:svc"), ("site:S1", "fed:F")}
    assert nodes.where("subtype = 'federation'").first().attrs["pledge_cpu"] == "3"


@pytest.mark.parametrize("letters,second,standing,want", [("ouwu", 2 * 900, False, "w"), ("ouwu", 3 * 900, False, "w"), ("uuuu", 900, False, "u"), ("uuwu", 3 * 900, True, "u"), ("uudu", 2 * 900 + 5, True, "d"), ("o", 95 * 900, False, "o")])
def test_current_letter(spark, letters, second, standing, want):
    row = spark.range(1).select(M.current_letter(F.lit(letters), F.lit(86_400 * 20_000 + second), F.lit(standing))).first()
    assert row[0] == want


def test_saved_pages(spark, tmp_path):
    connectors.register(spark)
    good, torn = tmp_path / "good", tmp_path / "torn"
    for folder, pages in ((good, ['<r><resumptionToken n="2">t1</resumptionToken></r>', "<r><resumptionToken/></r>"]), (torn, ['{"after_key": {"d": 1}}'])):
        folder.mkdir()
        for k, body in enumerate(pages):
            (folder / f"{k:04d}").write_text(body)
    read = lambda *f: spark.read.format("saved_pages").option("folders", ",".join(map(str, f))).load()
    assert [(r.page, r.cursor) for r in read(good).orderBy("page").collect()] == [(0, "t1"), (1, "")]
    with pytest.raises(Exception, match="missing"):
        read(good, torn).count()


def test_saved_pages_beyond_the_bound_are_an_error(spark, tmp_path):
    connectors.register(spark)
    for k in range(3):
        (tmp_path / f"{k:04d}").write_text(json.dumps({"next": f"t{k}"} if k < 2 else {}))
    read = lambda most: spark.read.format("saved_pages").option("folders", str(tmp_path)).option("max_pages", most).load()
    assert read(3).count() == 3
    for most in (1, 2):
        with pytest.raises(Exception, match="max_pages"):
            read(most).count()
