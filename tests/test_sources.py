"""Readers, projections and scalar functions on hand-written inputs."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from graphloom.functions import text as T
from graphloom.operators import graph as G, relational as R, search as S
from graphloom.sources import caches, projections as P
from graphloom.streaming import runs


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


def pairs(df):
    return {(r.src, r.dst) for r in df.collect()}


# -- guarded scans -----------------------------------------------------------------------

ITEM = StructType().add("name", StringType()).add("size", LongType())


@pytest.mark.parametrize(
    "content,status",
    [(None, "cache_missing"), (b"", "cache_missing"), (b"  \n", "cache_missing"), (b'[{"na', "cache_missing"), (b"[]", "cache_missing"), (b"\xff\xfe", "cache_missing"), (b"{}", "endpoint_failed"), (b'{"error": "x"}', "endpoint_failed"), (b"3", "endpoint_failed")],
)
def test_broken_lists_are_refused(spark, tmp_path, content, status):
    path = tmp_path / "c.json"
    if content is not None:
        path.write_bytes(content)
    with pytest.raises(caches.CacheUnusable) as error:
        caches.json_list(spark, str(path), ITEM)
    assert error.value.status == status


def test_lists_and_objects(spark, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps([{"name": "a", "size": 1}, 7, {"name": ""}]))
    rows = caches.json_list(spark, str(tmp_path / "l.json"), ITEM).orderBy("input_pos").collect()
    assert [r.item and r.item.name for r in rows] == ["a", None, ""]
    verdict = runs.health(caches.json_list(spark, str(tmp_path / "l.json"), ITEM), F.col("item").isNull(), "reconcile").first()
    assert (verdict.record_count, verdict.skipped_count, verdict.completed_scope) == (2, 1, False)
    (tmp_path / "o.json").write_text(json.dumps({"T2_US_X": {"name": "x"}, "T1_DE_Y": 3}))
    rows = caches.json_objects(spark, str(tmp_path / "o.json"), ITEM, r"T\d_.*").orderBy("input_pos").collect()
    assert [(r.name, r.item and r.item.name) for r in rows] == [("T2_US_X", "x"), ("T1_DE_Y", None)]
    with pytest.raises(caches.CacheUnusable):
        caches.json_objects(spark, str(tmp_path / "o.json"), ITEM, r"svc-.*")


def test_release_lines(spark):
    lines = ["architecture=a1;label=CMSSW_1_2_3;type=Production;state=Announced;prodarch=1;", "architecture=a2;label=CMSSW_1_2_3;type=Production;state=Announced;prodarch=0;junk", "label=ECALTBH4_1", "architecture=a1;label=CMSSW_1_2_3;architecture=a3;prodarch=0"]
    got = caches.releases_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.label, r.architecture, r.production_architecture) for r in got] == [("CMSSW_1_2_3", ["a1", "a2", "a3"], ["a1"])]


def test_pinned_lines(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"a\nb")
    files = spark.read.format("binaryFile").load(str(tmp_path / "f"))
    assert [r.value for r in caches.pinned(files, hashlib.sha256(b"a\nb").hexdigest()).collect()] == ["a", "b"]
    with pytest.raises(Exception, match="pinned"):
        caches.pinned(files, "00").collect()


def test_wiki_tree(spark, tmp_path):
    root = tmp_path / "web"
    (root / "Sub").mkdir(parents=True)
    (root / "Topic.txt").write_text('%META:TOPICINFO{author="me" version="3"}%\n%META:TOPICPARENT{name="Home"}%\n---+ Head\nSee [[OtherTopic][that]] and WikiWord <b>x</b> %TOC%')
    (root / "Sub" / "Blank.txt").write_text(" \n")
    (root / "WebHome.txt").write_text("hidden")
    tree = caches.text_tree(spark, str(root))
    assert sorted((r.page, r.blank) for r in tree.collect()) == [("Sub/Blank", True), ("Topic", False)]
    page = caches.wiki_pages(tree).first()
    assert (page.author, page.version, page.parent, page.links) == ("me", "3", "Home", ["OtherTopic"])
    assert page.body == "Head\nSee that and WikiWord x" and "WikiWord" in page.words


def test_harvest(spark):
    xml = """<r xmlns="u"><record><header status="deleted"><identifier>i1</identifier><datestamp>d1</datestamp></header></record>
    <record><header><identifier>i2</identifier><datestamp>d2</datestamp></header><metadata><title>T</title><creator>A</creator><creator>B</creator></metadata></record></r>"""
    rows = caches.harvest_pages(spark.createDataFrame([(xml,)], "xml string")).collect()
    assert [(r.oai_id, r.deleted, r.title, r.creators) for r in rows] == [("i1", True, "", []), ("i2", False, "T", ["A", "B"])]
    with pytest.raises(Exception, match="harvest error"):
        caches.harvest_pages(spark.createDataFrame([("<r><error>bad</error></r>",)], "xml string")).collect()


def test_availability_response(spark):
    def site(key, **counts):
        return {"key": key, "status_breakdown": {"buckets": [{"key": k, "doc_count": n} for k, n in counts.items()]}}

    payload = json.dumps({"responses": [{"aggregations": {"groups": {"buckets": [site("a", OK=18, CRITICAL=2), site("b", OK=1, WARNING=3), site(" ", OK=1)]}}}]})
    rows = caches.availability_rows(caches.availability_buckets(spark.createDataFrame([(payload,)], "payload string"))).collect()
    assert sorted((r.site, r.total_tests, r.ok_count, float(r.availability_pct), r.status) for r in rows) == [("a", 20, 18, 90.0, "OK"), ("b", 4, 1, 25.0, "CRITICAL")]


# -- projections -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "label,kind,before",
    [
        ("CMSSW_10_6_0", "release", None), ("CMSSW_10_6_3", "release", "CMSSW_10_6_2"), ("CMSSW_10_6_3_patch1", "patch", "CMSSW_10_6_3"), ("CMSSW_10_6_3_patch4", "patch", "CMSSW_10_6_3_patch3"),
        ("CMSSW_10_6_0_pre1", "pre-release", None), ("CMSSW_10_6_0_pre3", "pre-release", "CMSSW_10_6_0_pre2"), ("CMSSW_9_4_AN_X", "integration-series", None), ("CMSSW_6_2_0_SLHC4", "variant", "CMSSW_6_2_0"), ("other", "unrecognized", None),
    ],
)
def test_release_labels(spark, label, kind, before):
    assert one(spark, P.release_kind(F.col("x")), x=label) == kind
    assert one(spark, P.previous_release(F.col("x")), x=label) == before


def test_release_and_tag_facts(spark):
    releases = spark.createDataFrame([("CMSSW_1_0_0", "Production", "Announced", ["a"]), ("CMSSW_1_0_1", "Production", "Announced", ["a", "b"])], "label string, type string, state string, architecture array<string>")
    nodes, edges = P.release_facts(releases)
    assert {r.node_id for r in nodes.collect()} == {"cmssw_release:CMSSW_1_0_0", "cmssw_release:CMSSW_1_0_1", "cmssw_release_family:CMSSW_1_0"}
    assert pairs(edges.where("edge_type = 'supersedes'")) == {("cmssw_release:CMSSW_1_0_1", "cmssw_release:CMSSW_1_0_0")}
    tags = spark.createDataFrame([("10X_a_v1", "CMSSW_1_0_0", ""), ("10X_a_v2", "CMSSW_9_9_9", "s")], "name string, release string, scenario string")
    nodes, edges = P.tag_facts(tags, releases)
    assert [r.attrs["label"] for r in nodes.where("subtype = 'cmssw_release'").collect()] == ["CMSSW_9_9_9"]
    assert pairs(edges.where("edge_type = 'supersedes'")) == {("global_tag:10X_a_v2", "global_tag:10X_a_v1")}


def test_dataset_chain(spark):
    rows = [("/P/Run3Summer23-x/AODSIM", "AODSIM", "P", "Run3Summer23-x"), ("/P/Run3Summer23-y/MINIAODSIM", "MINIAODSIM", "P", "Run3Summer23-y"), ("/Q/Z-y/RAW", "RAW", "Q", "Z-y")]
    df = spark.createDataFrame([(*r, k, 1, 1) for k, r in enumerate(rows)], "dataset_name string, data_tier string, primary_dataset string, processed_dataset string, input_pos long, total_files long, total_events long")
    nodes, edges = P.dataset_facts(df)
    assert pairs(edges) == {("dataset:/P/Run3Summer23-y/MINIAODSIM", "dataset:/P/Run3Summer23-x/AODSIM")}
    assert {r.attrs.get("era") for r in nodes.collect()} == {"Run3Summer23", "Z"}


def test_workflows_downtimes_certificates(spark):
    flows = spark.createDataFrame([("w", "done", "c", 1, "/a/b/RAW", ["/a/b/AOD"], "CMSSW_1_0_0")], "workflow_name string, status string, campaign string, priority long, input_dataset string, output_datasets array<string>, cmssw_version string")
    assert P.workflow_facts(flows)[1].count() == 3
    down = spark.createDataFrame([(1, "c", "s", "d", "x", "y", "S1", t, h, k) for k, (t, h) in enumerate([("SRM", "h.org"), ("CE", "H.org:80")])], "downtime_id long, classification string, severity string, description string, start_date string, end_date string, hosted_by string, service_type string, hostname string, input_pos long")
    services = spark.createDataFrame([("se1", "srm://h.org:8443/x", 0), ("se2", "h.org", 1)], "name string, endpoint string, input_pos long")
    nodes, edges = P.downtime_facts(down, spark.createDataFrame([("S1",)], "name string"), services)
    assert [r.attrs["affected_services"] for r in nodes.collect()] == ["CE,SRM"]
    assert pairs(edges) == {("downtime:1", "site:S1"), ("downtime:1", "svc:se1")}
    cert = spark.createDataFrame([("Cert_Collisions2024_x_Golden", [10, 20], ["/a"])], "cert_name string, run_range array<long>, datasets array<string>")
    nodes, edges = P.certification_facts(cert)
    assert nodes.where("subtype = 'data_certification'").first().attrs["year"] == "2024"
    assert edges.where("edge_type = 'recorded_during'").count() == 2


def test_issue_facts(spark):
    schema = "key string, summary string, status string, priority string, project string, assignee string, reporter string, typed_links array<struct<key string, type string>>"
    rows = [("A-1", "s", "o", "p", "A", " Bob ", "bob", [("A-2", "Relates"), ("A-2", "Sub-task"), ("X-9", "Blocks"), ("A-1", "Blocks")]), ("A-2", "s", "o", "p", "A", "", None, [])]
    nodes, edges = P.issue_facts(spark.createDataFrame(rows, schema))
    assert nodes.where("subtype = 'person'").count() == 1
    link = edges.where("edge_type = 'linked_to'").collect()
    assert [(r.src, r.dst, r.attrs["link_kind"], r.attrs["link_type"]) for r in link] == [("jira:A-1", "jira:A-2", "child", "Relates; Sub-task")]


def test_page_facts(spark):
    schema = "title string, url string, site_name string, source_repo string, path string, input_pos long"
    nodes, edges = P.page_facts(spark.createDataFrame([("t", "u1", "s", "g/Repo", "docs/a.md", 0), ("late", "u1", "s", "g/Repo", "docs/b.md", 1), ("n", "u2", "s", "", "", 2)], schema))
    assert {r.node_id for r in nodes.collect()} == {"documentation_page:g_repo:docs_a_md", "software_repository:g_repo", "documentation_page:" + hashlib.sha256(b"u2").hexdigest()[:16]}
    assert edges.count() == 1


# -- functions, joins, search ------------------------------------------------------------


@pytest.mark.parametrize(
    "kind,text,found",
    [
        ("site", "at T2_XA_Here and T9_XX_Y", ["T2_XA_Here"]), ("release", "CMSSW_10_6_3_patch1.", ["CMSSW_10_6_3_patch1"]), ("issue", "see AB-12, x-1", ["AB-12"]),
        ("dataset", "in /A/B-v1/AODSIM and /a/b/c", ["/A/B-v1/AODSIM"]), ("global_tag", "106X_dataRun2_v32", ["106X_dataRun2_v32"]), ("host", "on se1.site.org:8443 now", ["se1.site.org:8443"]),
    ],
)
def test_mentions(spark, kind, text, found):
    assert one(spark, T.mentions(F.col("x"), kind), x=text) == found


def test_text_functions(spark):
    assert one(spark, T.strip(F.col("x")), x=" \n a b \x1c") == "a b"
    assert one(spark, T.slug(F.col("x")), x="A b/C") == "a_b_c"
    assert one(spark, T.storage_site(F.col("x")), x="T2_X_Disk") == "T2_X"
    assert one(spark, T.host_of(F.col("x")), x="https://A.org:80/p?q") == "a.org"
    assert one(spark, T.redact_emails(F.col("x"), "#"), x="a me@x.org git@host.org b") == "a # git@host.org b"
    assert one(spark, T.redact_spelled_emails(F.col("x"), "#"), x="me (at) x [dot] org") == "#"
    assert one(spark, T.anonymise(F.col("x"), ["Bob Roe"], ""), x="[~bob] Bob Roe said") == "  said"
    assert one(spark, T.report_code(F.col("x")), x="XYZ-PAS-ABC-20-001") == "ABC-20-001"


def test_wiki_signatures_are_removed(spark):
    text = "kept\n-- Main.BobRoe - 2020-01-02\n --- TWiki.AnnPoe \nsee Main.BobRoe\n-- main.x"
    assert one(spark, T.anonymise(F.col("x"), []), x=text) == "kept\n\n\nsee Main.BobRoe\n-- main.x"


def test_every_document_is_redacted(spark, tmp_path):
    from graphloom.plans.catalog import QUERIES

    texts = {1: ("going to ann@x.org", "going to "), 2: ("greg@mail.example.org", ""), 3: ("git@host.org and bob@x.org", "git@host.org and "), 4: ("no address", "no address"), 5: (None, None)}
    spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.digest for r in QUERIES["email_redact_all"](spark, str(tmp_path)).collect()}
    assert got == {k: out if out is None else hashlib.sha256(out.encode()).hexdigest() for k, (_, out) in texts.items()}


def test_range_join_and_lookups(spark):
    ranges = spark.createDataFrame([(1, 0, 130), (2, 64, 64)], "c long, lo long, hi long")
    points = spark.createDataFrame([(v,) for v in (0, 64, 130, 131)], "run long")
    assert {(r.c, r.run) for r in R.range_join(points, ranges, "run", "lo", "hi", 64).collect()} == {(1, 0), (1, 64), (1, 130), (2, 64)}
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y")], "k string, v string")
    assert [r.k for r in R.unique_only(df, "k", "v").collect()] == ["a"]


def test_reach_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e")], "src string, dst string")
    got = G.reachable(edges, spark.createDataFrame([("a",)], "node_id string"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0), ("b", 1), ("c", 2)]


def test_query_string(spark):
    df = spark.createDataFrame([(1, "click", "red car"), (2, "view", "blue"), (3, "buy", "red")], "id long, type string, body string")
    fields = {"type": "type", "body": "body"}
    run = lambda q: {r.id for r in df.where(S.query_string(q, fields, ["body"])).collect()}
    assert run("") == {1, 2, 3} and run("red") == {1, 3} and run("type:(click OR view)") == {1, 2}
    assert run('red AND NOT type:buy') == {1} and run("type:b*") == {3} and run('body:"red car"') == {1} and run("red blue") == {1, 2, 3}
    for bad in ("type:", "(red", "red)", "no:1"):
        with pytest.raises(ValueError):
            run(bad)


def test_read_only_sql(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert S.read_only_sql(spark, "select * from five;", 3).count() == 3
    for bad in ("drop table five", "select 1; drop table five", "insert into five values (1)"):
        with pytest.raises(ValueError):
            S.read_only_sql(spark, bad)


def test_lines_with_context(spark):
    df = spark.createDataFrame([(1, "a\nb hit\nc\nd")], "k long, t string")
    assert [(r.line_no, r.context) for r in S.lines_with_context(df, "k", "t", "hit").collect()] == [(1, "a\nb hit\nc")]


# -- runs --------------------------------------------------------------------------------


def test_retraction_needs_a_completed_scope(spark):
    old, new = spark.range(4).toDF("id"), spark.range(2).toDF("id")
    assert sorted(r.id for r in runs.retracted(old, new, "id", True).collect()) == [2, 3]
    assert runs.retracted(old, new, "id", False).count() == 0


def test_upsert_probe_and_scope(spark, tmp_path):
    a = spark.createDataFrame([("u", 1, 0), ("v", 1, 0)], "url string, x long, pos long")
    b = spark.createDataFrame([("u", 2, 1)], "url string, x long, pos long")
    assert {(r.url, r.x) for r in runs.upsert(a, b, "url", "pos").collect()} == {("u", 2), ("v", 1)}
    (tmp_path / "a").write_text("1")
    probe = lambda s: runs.content_probe(spark.read.format("binaryFile").load(str(tmp_path)), s).first()[0]
    before = probe("x")
    assert before == probe("x") != probe("y")
    (tmp_path / "a").write_text("2")
    assert probe("x") != before
    scope = runs.dirty_scope(spark.createDataFrame([("a",)], "node_id string"), spark.createDataFrame([("b", "c")], "src string, dst string"))
    assert scope.count() == 3 and not runs.is_full_run(scope) and runs.is_full_run(scope, 2)


def test_stream_of_windows(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:10:00' ts, 'a' event_type, 1.0 value, 1L user_id union all select timestamp'2024-01-01 01:10:00', 'a', 2.0, 1L")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = runs.event_windows(stream, "1 hour", late="10 minutes").writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.n for r in spark.table("windows").collect()) == [1, 1]
    assert runs.sessions(rows, "30 minutes").count() == 2
