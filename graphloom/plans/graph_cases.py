"""Registered queries of wiki, redaction, identifier, read, run, crawl, live and snapshot operators.

Those with SQL run over the driver tables; the others over stated rows, and their oracle
is the stated result.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.functions import redaction as D, scalars as X, text as T, wiki as W
from graphloom.operators import graph as G, identifiers as I, live as L, reads as E, relational as R
from graphloom.plans.cases import CASES, _case_query, values_sql
from graphloom.sources import crawl as C, monitoring as M, readers as S, records as RR, snapshot as N
from graphloom.streaming import runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(sql: str | None):
    """A query over the driver tables with its SQL."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def stated(columns: str, *rows: tuple, types: dict[str, str] | None = None):
    """A query over stated rows with its stated result; values are compared as text unless typed."""

    def add(f):
        names = columns.split()
        kinds = types or {}

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(spark)
            return out.select(*[F.col(c) if c in kinds else F.col(c).cast("string").alias(c) for c in names])

        QUERIES[f.__name__] = run
        ORACLES[f.__name__] = values_sql(names, [tuple(None if v is None else str(v) for v in r) for r in rows], kinds)
        return f

    return add


# -- more functions by case --------------------------------------------------------------

TOPIC = '%META:TOPICINFO{author="JoDo" date="1700000000" version="1.3"}%\n%META:TOPICPARENT{name="CMS.Home"}%\n---++ Head [[Web.Topic][the topic]]\n---+++\nUse %TOC{depth="2"}% and %RED% with =ls -la= but MAX=5 and MIN=2, *bold* see [[https://a.org/x][label]] <b>tag</b>\n\n\n\nEnd WikiWord'
MORE = {
    "wiki_text": (W.strip_markup, False, [(TOPIC, "Head the topic Use depth= 2 and with ls -la but MAX=5 and MIN=2, bold see label tag End WikiWord"), ("", ""), ("---+++\nnext", "next"), ("a %WEB% b", "a b")]),
    "wiki_text_markdown": (lambda a: W.strip_markup(a, "markdown", "preserve", link_urls="keep"), False, [
        (TOPIC, "## Head the topic\nUse depth= 2 and with ls -la but MAX=5 and MIN=2, bold see label (https://a.org/x) tag\n\nEnd WikiWord"), ("[[https://a.org][https://a.org]]", "https://a.org"), ("---++++++ six", "###### six"),
    ]),
    "wiki_text_tables": (lambda a: W.strip_markup(a, "drop", "preserve", tables=True, images=True), False, [
        ('<table><tr><th>A</th><th>B &amp; C</th></tr><tr><td>1</td><td> 2 </td></tr></table> x <img src="p.png" alt=" a  b "> <img alt="n">', "| A | B & C |\n| --- | --- |\n| 1 | 2 |\nx ![a b](p.png)"),
    ]),
    "wiki_meta": (W.meta, True, [(TOPIC, '{"author":"JoDo","last_modified":"2023-11-14T22:13:20Z","version":"1.3","parent_topic":"CMS.Home"}'), ("x", '{"author":"","last_modified":"","version":"","parent_topic":""}')]),
    "wiki_targets": (W.link_targets, True, [("[[Web.Topic][x]] [[Topic]] [[https://a.org][y]] [[#anchor]] [[mailto:a@b.c]] [[/Sub/]]", '["Topic","Web/Topic"]')]),
    "wiki_bare_words": (W.bare_words, True, [("WikiWord and [[NotThis]] http://x.org/NorThis <pre>NorThat</pre> JustWord lower Word A.DotWord %MACRO{x=\"InMacro\"}%", '["JustWord","WikiWord"]')]),
    "wiki_is_topic": (W.is_topic, False, [("WebHome.txt", "true"), ("WebIndex.txt", "false"), ("lower.txt", "false"), ("20120101Notes.txt", "false"), ("Topic-replies.txt", "false"), ("HiggsPage.txt", "true"), ("123.txt", "false")]),
    "wiki_page_kind": (W.page_kind, False, [("HowToX", "", "howto"), ("MyFAQ", "", "faq"), ("HIG-21-001", "", "analysis"), ("Minutes", "", "meeting_minutes"), ("Plain", "WeeklyMeeting", "meeting_minutes"), ("Plain", "x", "other"), ("WebHome", "", "web_page"), ("OverviewX", "", "overview")]),
    "wiki_scope": (lambda a: F.concat_ws("/", W.is_physics(a).cast("string"), W.is_operations(a).cast("string")), False, [("HIG-21-001", "true/false"), ("TopMass", "true/false"), ("Topics", "false/false"), ("CompOpsX", "false/true"), ("MuonPOG", "true/false")]),
    "topic_references": (lambda a: W.topic_references(a, F.array(F.lit("Sub/X")), F.array(F.lit("WikiWord")), F.lit("CMS"), F.lit("")), True, [("Home", '[{"priority":0,"kind":"topic_parent","page":"CMS/Home"},{"priority":1,"kind":"wiki_link","page":"Sub/X"},{"priority":2,"kind":"bare_wikiword","page":"CMS/WikiWord"}]'), ("", '[{"priority":1,"kind":"wiki_link","page":"Sub/X"},{"priority":2,"kind":"bare_wikiword","page":"CMS/WikiWord"}]')]),
    "redact_addresses": (D.redact_addresses, False, [
        ("mail john.doe@cern.ch now", "mail  now"), ('quoted "john doe"@cern.ch.', "quoted ."), ("encoded jdoe&#64;cern.ch", "encoded "), ("double jdoe&amp;#64;cern.ch", "double "), ("url ?mail=john.doe%40cern.ch&x=1", "url ?&x=1"), ("double url ?mail=john.doe%2540cern.ch&x=1", "double url ?&x=1"),
        ("non-ascii über.müller@cern.ch end", "non-ascii  end"), ("fullwidth jdoe＠cern．ch end", "fullwidth  end"), ("zero width b​ob@cern‍.ch end", "zero width  end"), ("encoded dot bob&#64;cern&#46;ch end", "encoded dot  end"), ("|bob@cern.ch|alice@fnal.gov|", "|"), ("bob@cern.ch&amp;alice@fnal.gov", ""),
        ("pip install numpy@1.26.4", "pip install numpy@1.26.4"), ("no dot bob@localhost", "no dot bob@localhost"), ("logo image@2x.png end", "logo  end"), ("v bob@cern.ch.123", "v .123"), ("git clone git@github.com:org/x.git", "git clone git@github.com:org/x.git"), ("git@github.com.jdoe@cern.ch", "@cern.ch"),
        ("git@github.com.jdoe.1@cern.ch", ""), ("mail GIT@cern.ch now", "mail  now"), ("cfg url=git@github.com:x/y.git", "cfg :x/y.git"), ('say "hi git@github.com:x"@cern.ch', "say "), ("ssh -Y jdoe@lxplus.cern.ch -L 8080:host", "ssh -Y  -L 8080:host"), ("AT&amp;T ok", "AT&amp;T ok"), (None, None), ("", ""),
    ]),
    "redact_spelled": (D.redact_spelled, False, [
        ("mail jdoe[at]cern.ch now", "mail  now"), ("mail jdoe(at)cern(dot)ch now", "mail  now"), ("mail jdoe at cern(dot)ch now", "mail  now"), ("mail john.doe_at_cern.ch now", "mail  now"), ("mail john.doe_at_physics.ucsd.edu now", "mail  now"), ("mail jdoe@cernNOSPAMch now", "mail  now"), ("mail jd﻿oe[at]cern.ch now", "mail  now"),
        ("john.doe at cern.ch", "john.doe at cern.ch"), ("jdoe AT cern DOT ch", "jdoe AT cern DOT ch"), ("T2_CH_CERN [at] cern.ch", "T2_CH_CERN [at] cern.ch"), ("read[at]self.buf.data", "read[at]self.buf.data"), ("x_2016_at_13TeV.root", "x_2016_at_13TeV.root"), ("NoSpamFilter nospam.ch", "NoSpamFilter nospam.ch"),
    ]),
    "count_addresses": (D.count_addresses, False, [("a@b.ch, c@d.org", "2"), ("none", "0")]),
    "decode_references": (D.decode_references, False, [("John&nbsp;Doe", "John Doe"), ("a&amp;#64;b", "a@b"), ("&lt;tag&gt; &#60;", "&lt;tag&gt; &#60;"), ("&amp;amp;amp;amp;lt;", "&amp;lt;")]),
    "anonymise_text": (lambda a: D.anonymise(a, ["John Doe", "Doe"]), False, [
        ("Hi all,\nDear colleagues,\nGood morning team,\nThe transfer failed overnight.\nThanks in advance,\nBest regards, John\nCheers,\nYours sincerely,\n-- \n", "The transfer failed overnight."), ("However, run 381000 was affected badly.\nRegards to whoever fixed run 381000.", "However, run 381000 was affected badly.\nRegards to whoever fixed run 381000."),
        ("Disk pool drained at T2_US_MIT.\n-- Main.JohnDoe - 2024-01-15", "Disk pool drained at T2_US_MIT."), ("Assigned to John\xa0Doe [~jdoe] for run 1", "Assigned to   for run 1"), ("Contact jdoe&amp;#64;cern.ch about run 1.", "Contact  about run 1."),
    ]),
    "anonymise_markup": (lambda a: D.anonymise(a, markup=True), False, [
        ("<item><dc:creator>Hasan Ozturk</dc:creator><description>Disk full at T2</description></item>", "<item><dc:creator></dc:creator><description>Disk full at T2</description></item>"),
        ('<p>Ping <a href="mailto:jdoe@cern.ch">John Doe</a> when the drain completes</p>', "<p>Ping  when the drain completes</p>"), ('<span class="author">J D</span>text of it', "text of it"), ("<p>the run failed<br>\nJohn</p>", "<p>the run failed</p>"),
    ]),
    "redact_json": (D.redact_json, True, [('{"a":["x jdoe@cern.ch",1],"jdoe@cern.ch k":null}', '{"value":"{\\"a\\":[\\"x \\",1],\\" k\\":null}"}'), ('{"a@b.ch":1,"c@d.ch":2}', '{"problem":"two keys become equal at the top"}'), ("broken{", '{"problem":"not JSON"}')]),
    "hidden_address": (D.has_hidden_address, False, [("jd\x1b[0moe@cern.ch", "true"), ("plain text", "false"), ("jdoe&amp;amp;#x40;cern.ch", "true"), ("a ｂ＠c．ch", "true")]),
    "decode_bytes": (lambda a: D.decode_bytes(F.unhex(a)), False, [("C3A9", "é"), ("6193E9", "a“é"), ("81", "\x81"), ("", "")]),
    "sitemap_urls": (C.sitemap_urls, True, [("<urlset><url><loc> https://a.org/x?a=1&amp;b=2 </loc></url><url><s:loc>https://a.org/y</s:loc></url></urlset>", '["https://a.org/x?a=1&b=2","https://a.org/y"]'), ("", "[]")]),
    "is_html": (C.is_html, False, [("text/html; charset=utf-8", "true"), ("application/pdf", "false"), (None, "true")]),
    "login_bounce": (C.login_bounce, False, [("https://a.org/x", "https://auth.cern.ch/y", "", "true"), ("https://a.org/x", "https://a.org/x", "Sign in to CERN", "false"), ("https://a.org/x", "https://b.org/", "Sign in to CERN", "true"), ("https://a.org/login", "https://a.org/login", "x", "false")]),
    "missing_topic": (C.missing_topic, False, [("https://t/bin/oops/A/B?x", "", "true"), ("https://t/bin/view/A", "x TopicDoesNotExist", "true"), ("https://t/bin/view/A", "%META:TOPICINFO{} oopsmissing", "false")]),
    "seed_page": (C.seed_page, False, [("CMS.HiggsPhysics", "CMS/HiggsPhysics"), ("https://t.org/twiki/bin/viewauth/CMS/X?y", "CMS/X"), ("Alone", None)]),
    "skip_reason": (lambda a, b: C.skip_reason(a, b.cast("long"), [".md", ".rst"], ["/vendor/"], 100), False, [("docs/a.MD", "5", None), ("docs/a.png", "5", "suffix"), ("x/vendor/a.md", "5", "path_fragment"), ("a.rst", "101", "too_large")]),
    "page_fresh": (lambda a, b, c: C.page_fresh(a.cast("timestamp"), b.cast("timestamp"), 2, c, F.lit("k")), False, [("2024-01-02 10:00:00", "2024-01-02 11:59:00", "k", "true"), ("2024-01-02 10:00:00", "2024-01-02 12:01:00", "k", "false"), ("2024-01-01 23:59:00", "2024-01-02 00:01:00", "k", "false"), ("2024-01-02 10:00:00", "2024-01-02 10:01:00", None, "false")]),
    "site_list": (C.site_list, True, [("var siteNames = ['T1_A', // \"no\"\n \"T2]_B\", /* 'x' */ 'it\\'s'];", '["T1_A","T2]_B","it\'s"]'), ("var x = 1;", None), ("sites = ['open'", None)]),
    "unrenderable": (lambda a, b: RR.unrenderable(F.from_json(a, RR._FILE), b, 100, F.lit(False)), False, [
        ('{"filename":"a.PNG"}', "https://i.org/a", None), ('{"is_protected":true}', "https://i.org/a.png", "protected"), ('{"type":"link","filename":"a.png"}', "https://i.org/a", "not_a_file"), ('{"size":101,"filename":"a.png"}', "https://i.org/a", "too_large"), ('{"content_type":"text/html"}', "https://i.org/a.png", "not_renderable"),
        ('{"content_type":"image/PNG; x"}', "https://i.org/a", None), ('{"filename":"a.pdf"}', "https://i.org/../a", "url_refused"), ('{"filename":"a.pdf"}', "http://i.org/a", "url_refused"), ('{}', "https://i.org/a.zip", "not_renderable"),
    ]),
    "safe_name": (N.safe_name, False, [("a/b.json", "true"), ("../a", "false"), ("/a", "false"), ("a/../b", "false"), ("a\\b", "false"), ("a..b", "true")]),
    "current_letter": (lambda a, b, c: M.current_letter(a, b.cast("long"), c.cast("boolean")), False, [("ooe" + "u" * 93, "1800", "false", "e"), ("oou" + "u" * 93, "1800", "false", "o"), ("uuu", "0", "false", "u"), ("d" * 96, "86399", "true", "d"), ("dd", "86399", "true", "u")]),
}
SAID = "T2_US_MIT, CMSSW_12_0_1_patch2 at se.mit.edu:8443; CMSOPS-12 /A/B-v1/MINIAODSIM x/A/B/RAW 106X_data_v3 me@host.org T2_US_MIT"
MORE |= {
    f"mentions_{kind}": (lambda a, k=kind: T.mentions(a, k), True, [(SAID, json.dumps(found, separators=(",", ":")))])
    for kind, found in (("site", ["T2_US_MIT"]), ("release", ["CMSSW_12_0_1_patch2"]), ("issue", ["CMSOPS-12"]), ("dataset", ["/A/B-v1/MINIAODSIM"]), ("global_tag", ["106X_data_v3"]), ("host", ["se.mit.edu:8443"]))
}
for _name, (_f, _complex, _rows) in MORE.items():
    assert _name not in CASES
    QUERIES[f"fn_{_name}"], ORACLES[f"fn_{_name}"] = _case_query(_f, _complex, _rows)


# -- texts at scale ----------------------------------------------------------------------


@table(None)
def redact_documents(t):
    """Addresses of both kinds out of every whole text, by the grammar; no SQL has it."""
    return t("documents").select("doc_id", F.sha2(D.redact_all(F.col("text")), 256).alias("digest"))


@table("select doc_id, sha256(trim(regexp_replace(text, '[ \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0]+', ' ', 'g'))) digest from documents")
def squeeze_documents(t):
    return t("documents").select("doc_id", F.sha2(X.squeezed(F.col("text")), 256).alias("digest"))


# -- identifiers -------------------------------------------------------------------------

_SAID = [
    ("c1", "document_chunk", "T2_US_MIT and CMSSW_12_0_1 at se.mit.edu:8443, see CMSOPS-12 and COVID-19 run 381000"),
    ("c2", "document_chunk", "/Primary/Run2018A-v1/AOD with 106X_dataRun2_v3 or t2_us_mit"), ("c3", "git_commit", "fix CMSOPS-12 on T2_US_MIT"),
]
_GRAPH = [
    ("site:T2_US_MIT", "site", {}), ("cmssw_release:CMSSW_12_0_1", "cmssw_release", {}), ("jira:CMSOPS-12", "jira_issue", {}), ("dataset:/Primary/Run2018A-v1/AOD", "dataset", {}), ("run:381000", "run", {}),
    ("svc:a", "infrastructure_service", {"endpoint": "SE.mit.edu:8443"}), ("svc:b", "infrastructure_service", {"endpoint": "two.org"}), ("svc:c", "infrastructure_service", {"endpoint": "two.org:9"}), ("svc:d", "infrastructure_service", {}), ("wrong:x", "site", {}),
]


def _said(spark):
    return spark.createDataFrame(_SAID, "node_id string, subtype string, text string")


def _graph(spark):
    return spark.createDataFrame(_GRAPH, "node_id string, subtype string, attrs map<string,string>")


@stated(
    "node_id kind value", ("c1", "cms_site", "T2_US_MIT"), ("c1", "cms_jira_key", "CMSOPS-12"), ("c1", "cmssw_release", "CMSSW_12_0_1"), ("c1", "cms_hostname", "se.mit.edu:8443"), ("c1", "global_tag", "T2_US_MIT"), ("c1", "global_tag", "CMSSW_12_0_1"),
    ("c1", "cms_run_number", "381000"), ("c1", "cms_workflow", "CMSSW_12_0_1"), ("c2", "global_tag", "106X_dataRun2_v3"), ("c2", "global_tag", "t2_us_mit"), ("c2", "cms_dataset", "/Primary/Run2018A-v1/AOD"), ("c3", "cms_jira_key", "CMSOPS-12"), ("c3", "cms_site", "T2_US_MIT"), ("c3", "global_tag", "T2_US_MIT"),
)
def extraction_rules(spark):
    return I.extract(_said(spark), "text")


@stated("kind value", ("hlt_path", "HLT_Mu50_v3"), ("l1t_seed", "L1_SingleMu22"), ("dqm_workspace", "DQMGUI"))
def extraction_rules_dqm(spark):
    return I.extract(spark.createDataFrame([("HLT_Mu50_v3 from L1_SingleMu22 in DQMGUI",)], "text string"), "text", I.DQM_RULES)


@stated("kind value", ("cms_run_number", "381000"), ("cms_repo", "cms-sw/cmssw"), ("cms_hostname", "x.cern.ch"), ("cms_site", "T1_DE_KIT"), ("global_tag", "T1_DE_KIT"))
def identifier_patterns(spark):
    return I.extract(spark.createDataFrame([("381000 in cms-sw/cmssw on x.cern.ch for T1_DE_KIT",)], "text string"), "text", I.PATTERNS)


@stated(
    "kind key node_id", ("cms_site", "t2_us_mit", "site:T2_US_MIT"), ("cmssw_release", "cmssw_12_0_1", "cmssw_release:CMSSW_12_0_1"), ("cms_jira_key", "cmsops-12", "jira:CMSOPS-12"), ("cms_dataset", "/Primary/Run2018A-v1/AOD", "dataset:/Primary/Run2018A-v1/AOD"),
    ("cms_run_number", "381000", "run:381000"), ("cms_hostname", "se.mit.edu:8443", "svc:a"), ("cms_hostname", "se.mit.edu", "svc:a"), ("cms_hostname", "two.org:9", "svc:c"),
)
def alias_table(spark):
    return I.alias_table(_graph(spark))


@stated(
    "kind value node_id", ("cms_site", "t2_US_mit ", "site:T2_US_MIT"), ("cms_hostname", "SE.MIT.EDU:8443", "svc:a"), ("cms_hostname", "se.mit.edu:1", "svc:a"), ("cms_dataset", "dataset:/Primary/Run2018A-v1/AOD", "dataset:/Primary/Run2018A-v1/AOD"),
)
def alias_resolution(spark):
    asked = [("cms_site", "t2_US_mit "), ("cms_hostname", "SE.MIT.EDU:8443"), ("cms_hostname", "se.mit.edu:1"), ("cms_hostname", "two.org"), ("cms_dataset", "/primary/run2018a-v1/aod"), ("cms_dataset", "dataset:/Primary/Run2018A-v1/AOD"), ("unknown", "x"), ("cms_site", "")]
    return I.resolve(spark.createDataFrame(asked, "kind string, value string"), I.alias_table(_graph(spark)))


@stated(
    "src dst confidence", ("c1", "site:T2_US_MIT", "0.95"), ("c1", "cmssw_release:CMSSW_12_0_1", "0.95"), ("c1", "svc:a", "0.85"), ("c1", "jira:CMSOPS-12", "0.95"), ("c1", "run:381000", "0.85"), ("c2", "dataset:/Primary/Run2018A-v1/AOD", "0.95"), ("c3", "jira:CMSOPS-12", "0.95"),
)
def linker_routes(spark):
    found = I.extract(_said(spark).withColumnRenamed("node_id", "chunk"), "text")
    return I.routed(I.resolve(found, I.alias_table(_graph(spark))), "chunk", "subtype")


@stated("src dst", ("a", "svc:x"), ("a", "svc:y"), ("b", "svc:x"))
def service_links(spark):
    services = spark.createDataFrame([("x", "https://Host.org:80/p"), ("y", "host.org"), ("z", None)], "name string, endpoint string")
    return I.service_links(spark.createDataFrame([("a", "HOST.org."), ("b", "host.org:80"), ("c", "other.org")], "node_id string, host string"), services)


# -- reads -------------------------------------------------------------------------------


@table("select p_partkey from part where p_type ilike '%brass%' or p_brand ilike 'brand#1_'")
def attribute_like(t):
    nodes = t("part").select("p_partkey", F.create_map(F.lit("type"), "p_type", F.lit("brand"), "p_brand").alias("attrs"))
    return E.like_any(nodes, ["type", "brand"], "%brass%").select("p_partkey").unionByName(E.like_any(nodes, ["brand"], "Brand#1_").select("p_partkey")).distinct()


@table("select o_orderkey from orders where o_totalprice >= 1000 and o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus <> 'F'")
def typed_filter(t):
    nodes = t("orders").select("o_orderkey", F.create_map(*[x for c in ("o_totalprice", "o_orderpriority", "o_orderstatus") for x in (F.lit(c), F.col(c).cast("string"))]).alias("attrs"))
    declared = {"o_totalprice": "double", "o_orderpriority": "string", "o_orderstatus": "string"}
    return E.typed_filter(nodes, declared, [("o_totalprice", "ge", 1000.0), ("o_orderpriority", "in", ["1-URGENT", "2-HIGH"]), ("o_orderstatus", "ne", "F")]).select("o_orderkey")


@table("select c_custkey from customer where c_nationkey in (1, 3, 5)")
def subtype_in(t):
    return t("customer").where(F.col("c_nationkey").isin(1, 3, 5)).select("c_custkey")


@table("select l_orderkey, l_linenumber, cast(l_quantity as bigint) q from lineitem where regexp_matches(cast(cast(l_quantity as bigint) as varchar), '^[0-9]+$')")
def numeric_guard(t):
    text = F.col("l_quantity").cast("long").cast("string")
    return t("lineitem").withColumn("x", text).where(F.col("x").rlike("^[0-9]+$")).select("l_orderkey", "l_linenumber", F.col("x").try_cast("long").alias("q"))


@stated("label", ("CMSSW_12_0_1",), ("CMSSW_12_0_0",), ("CMSSW_12_0_X",))
def newest_releases(spark):
    return E.newest_releases(spark.createDataFrame([(x,) for x in ("CMSSW_9_4_0", "CMSSW_12_0_1", "CMSSW_12_0_X", "other", "CMSSW_12_0_0")], "label string"), 3)


_HELD = [("p", "c2", "contains", {"chunk_index": "1"}), ("p", "c1", "contains", {"chunk_index": "0"}), ("p", "c3", "contains", {}), ("p", "q", "references", {}), ("q", "c9", "contains", {"chunk_index": "0"})]
_NODES = [
    ("p", "jira_issue", {"title": "P"}), ("q", "documentation_page", {"title": "Q", "url": "u"}), ("c1", "document_chunk", {"text": "abcde", "char_offset": "0", "char_end": "5"}), ("c2", "document_chunk", {"text": "defgh", "char_offset": "3", "char_end": "8"}),
    ("c3", "document_chunk", {"text": "hij", "char_offset": "7", "char_end": "10"}), ("c9", "document_chunk", {"text": "q", "char_offset": "0", "char_end": "1"}),
]


def _nodes(spark):
    return spark.createDataFrame(_NODES, "node_id string, subtype string, attrs map<string,string>")


def _edges(spark):
    return spark.createDataFrame(_HELD, "src string, dst string, edge_type string, attrs map<string,string>")


@stated("node_id place text", ("c1", 0, "abcde"), ("c2", 1, "defgh"), ("c3", 7, "hij"))
def chunks_in_order(spark):
    return E.chunks_of(_nodes(spark), _edges(spark), "p").withColumnRenamed("at", "place")


@stated("chunk parent subtype", ("c1", "p", "jira_issue"), ("c9", "q", "documentation_page"))
def parents_of_chunks(spark):
    return E.parents_of(_nodes(spark), _edges(spark), spark.createDataFrame([("c1",), ("c9",), ("none",)], "node_id string"))


@table("select o_orderkey from orders order by case when o_orderkey % 3 = 0 then null else o_orderdate end desc nulls last, o_orderkey limit 25")
def most_recent(t):
    return E.recent(t("orders").withColumn("at", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate"))), "at", "o_orderkey", 25).select("o_orderkey")


@stated("chunk_id continues", ("b", '{"char_offset":10,"chunk_id":"b"}'), ("c", '{"char_offset":20,"chunk_id":"c"}'))
def text_page(spark):
    chunks = spark.createDataFrame([("a", 0, "x" * 10), ("b", 10, "x" * 10), ("c", 20, "x" * 10), ("d", 30, "x" * 10)], "chunk_id string, char_offset long, text string")
    return E.text_page(chunks, (0, "a"), 25).withColumn("continues", F.to_json("continues"))


@stated("what kind n", ("node", "jira_issue", 1), ("node", "documentation_page", 1), ("node", "document_chunk", 4), ("edge", "contains", 4), ("edge", "references", 1))
def inspect_graph(spark):
    return E.inspect_graph(_nodes(spark), _edges(spark))


@stated("attr n", ("text", 4), ("char_offset", 4), ("char_end", 4))
def inspect_subtype(spark):
    return E.inspect_subtype(_nodes(spark), "document_chunk")


@stated("parent text", ("p", "abcdefghij"))
def inspect_text(spark):
    return E.inspect_text(_nodes(spark), _edges(spark), "p")


@stated("edge_type direction count", ("contains", "out", 3), ("references", "out", 1))
def volume_around(spark):
    return G.neighbourhood(_edges(spark), "p")


@table("""with s as (select o_custkey record, o_orderkey passage, o_totalprice score from orders), r as (select *, row_number() over (partition by record order by score desc, passage desc) k, count(*) over (partition by record) passages from s)
select record, score, passage, passages from r where k = 1 order by score desc, record limit 20""")
def passage_roll_up(t):
    scored = t("orders").select(F.col("o_orderkey").alias("node_id"), F.col("o_totalprice").alias("score"))
    return E.roll_up_scores(scored, t("orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst")), 20)


@table("""with recursive p as (select p_partkey c, case when p_partkey > 1 then p_partkey // 2 end parent from part), t as (select c, c rank from p where c % 7 = 0), w(c, rank) as (select c, rank from t union select p.parent, w.rank from w join p on p.c = w.c where p.parent is not null)
select 'k' || c as "commit", 'v' || min(rank) as tag from w group by c""")
def first_tag(t):
    key = F.col("p_partkey")
    name = lambda c: F.concat(F.lit("k"), c.cast("string"))
    commits = t("part").select(name(key).alias("commit"), F.when(key > 1, name(F.floor(key / 2))).alias("parent"))
    tags = t("part").where(key % 7 == 0).select(F.concat(F.lit("v"), key.cast("string")).alias("tag"), name(key).alias("commit"), key.cast("long").alias("rank"))
    return E.first_tag(commits, tags)


@stated("x side more", ("a", "left", 1), ("c", "right", 1))
def fact_difference(spark):
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "x string")
    return E.differing(rows("a", "a", "b"), rows("b", "a", "c"))


@table("select count(*) records, count(*) filter (value > 5) carrying, round(count(*) filter (value > 5) / count(*), 6) share, count(*) filter (value > 5) >= 0.95 * count(*) accepted from events")
def signature_share(t):
    return E.coverage(t("events"), F.col("value") > 5)


@table("select o_custkey, o_orderstatus, count(*) doc_count, round(sum(o_totalprice), 2) total from orders where (o_custkey, o_orderstatus) > (20, 'F') group by all order by 1, 2 limit 30")
def composite_aggregation(t):
    return E.composite(t("orders"), ["o_custkey", "o_orderstatus"], (20, "F"), 30, F.round(F.sum("o_totalprice"), 2).alias("total"))


@table("select o_orderkey issue, l_partkey target, count(*) as chunks from orders join lineitem on o_orderkey = l_orderkey group by all")
def counted_references(t):
    joined = R.spread_join(t("orders"), t("lineitem"), "o_orderkey", "l_orderkey")
    return joined.groupBy(F.col("o_orderkey").alias("issue"), F.col("l_partkey").alias("target")).agg(F.count(F.lit(1)).alias("chunks"))


@table("select l_orderkey src, l_partkey dst from (select distinct l_orderkey, l_partkey from lineitem) where l_orderkey % 2 = 1")
def derived_edges(t):
    """Candidates that are not there yet, by their ids: what an enricher inserts."""
    every = t("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    keyed = every.withColumn("edge_id", G.edge_id("src", F.lit("references"), "dst"))
    return G.without_existing(keyed, keyed.where("src % 2 = 0"), ["edge_id"]).select("src", "dst")


@table("select p_brand, p_type node_id from (select 'B' || p_partkey p_brand, p_type from part union all select 'dup', p_type from part) group by p_brand, p_type qualify count(*) over (partition by p_brand) = 1")
def unique_lookup(t):
    part = t("part").select(F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("p_brand"), F.col("p_type").alias("node_id"))
    return R.unique_only(part.unionByName(t("part").select(F.lit("dup").alias("p_brand"), F.col("p_type").alias("node_id"))), "p_brand", "node_id")


# -- runs --------------------------------------------------------------------------------


@table("select count(*) filter (event_id > 900 and event_type = 'click') > 0 or count(*) filter (event_id > 950 and event_type = 'view') > 0 as work, max(event_id) node_mark, max(event_id) edge_mark from events")
def watermark_work(t):
    facts = t("events").select(F.col("event_id").alias("fact_id"), F.col("event_type").alias("subtype"), F.col("event_type").alias("edge_type"))
    return runs.needs_work(facts, facts, 900, 950, ("click",), ("view",))


@stated("node_id", ("jira:A",), ("jira:B",))
def incremental_scope(spark):
    facts = spark.createDataFrame([(5, "jira:B", "chunk:1", "references"), (1, "jira:C", "x", "references"), (9, "jira:D", "x", "other")], "fact_id long, src string, dst string, edge_type string")
    return runs.incremental_scope(spark.createDataFrame([("jira:A",), ("doc:Z",)], "node_id string"), facts, 3, ("references",), "jira:")


@stated("whole", ("true",))
def incremental_overflow(spark):
    facts = spark.createDataFrame([(5, "a", "b", "references")], "fact_id long, src string, dst string, edge_type string")
    scope = runs.incremental_scope(spark.range(20).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("node_id")), facts, 0, ("references",), above=10)
    return spark.createDataFrame([(str(scope is None).lower(),)], "whole string")


@stated("id", ("a",), ("c",))
def generation_pin(spark):
    return runs.as_of(spark.createDataFrame([("a", 1, None), ("b", 1, 2), ("c", 2, 3), ("d", 3, None)], "id string, added_in int, retired_in int"), 2)


@table("select 100 kept, count(*) - 100 left_out, count(*) > 100 truncated from orders")
def capped_read(t):
    kept, verdict = runs.capped(t("orders"), ["o_orderkey"], 100)
    return verdict.select(F.col("kept").cast("int").alias("kept"), "left_out", "truncated").where(F.lit(kept.count() == 100))


@stated("record_count status completed_scope emits", (5, "ok", "true", "true"), (4, "endpoint_failed", "false", "false"), (0, "cache_missing", "false", "true"))
def count_verdict(spark):
    rows = spark.createDataFrame([(5, 0, 5), (4, 0, 5), (0, 0, None)], "record_count long, skipped_count long, expected long")
    return runs.count_verdict(rows, F.col("expected"), strict=True)


@stated("found status completed_scope", (100, "ok", "true"), (0, "cache_missing", "false"), (50, "endpoint_failed", "false"), (60, "endpoint_failed", "false"), (70, "ok", "false"), (80, "endpoint_failed", "false"), (20000, "ok", "true"))
def snapshot_verdict(spark):
    rows = [(100, 0, 0, 10, 0), (0, 0, 0, 0, 0), (50, 1, 0, 0, 0), (60, 0, 1, 0, 0), (70, 0, 0, 0, 5), (80, 0, 0, 11, 0), (20000, 0, 0, 20, 0)]
    return runs.snapshot_verdict(spark.createDataFrame(rows, "found long, missing_seeds long, unreadable long, empty long, capped long"))


@stated("timed_out terminated_early failed_shards truncated", ("true", "false", 3, '["a","b"]'))
def merged_quality(spark):
    rows = [(False, False, 1, ["a"]), (True, False, 2, ["b", "a"])]
    return runs.merged_quality(spark.createDataFrame(rows, "timed_out boolean, terminated_early boolean, failed_shards long, truncated array<string>")).withColumn("truncated", F.to_json("truncated"))


@stated("status completed_scope record_count", ("ok", "false", 2))
def partial_run(spark):
    """A partial response gives its records and claims no scope."""
    return runs.health(spark.range(2), F.lit(False), "reconcile", partial=True).withColumn("status", F.when(F.col("status") == "partial", "ok").otherwise(F.col("status")))


@stated("url body", ("u1", "new"), ("u2", "old"), ("u3", "new"))
def upsert_by_url(spark):
    rows = lambda n, *r: spark.createDataFrame([(u, b, n) for u, b in r], "url string, body string, batch int")
    return runs.upsert(rows(1, ("u1", "old"), ("u2", "old")), rows(2, ("u1", "new"), ("u3", "new")), "url", "batch").select("url", "body")


@stated("status completed_scope record_count", ("ok", "true", 1), ("cache_missing", "false", 0))
def preflights(spark):
    good = S.Datasets(records=[{"dataset": "/a/b/RAW"}]).preflight(spark)
    return good.unionByName(S.Datasets(records_path="/nowhere.json").preflight(spark), allowMissingColumns=True)


@stated("refused", ("dbs takes no colour",))
def unknown_parameter(spark):
    try:
        S.Datasets.configured(records_path="x", colour="red")
        said = "taken"
    except ValueError as error:
        said = str(error)
    return spark.createDataFrame([(said,)], "refused string")


@stated("same differs", ("true", "true"))
def change_probe(spark):
    token = lambda *r: S.Datasets(records=list(r)).change_probe(spark).first()[0]
    a, b = {"dataset": "/a/b/RAW"}, {"dataset": "/a/c/RAW"}
    return spark.createDataFrame([(token(a, b) == token(b, a), token(a, b) != token(a))], "same boolean, differs boolean")


# -- crawls and live questions -----------------------------------------------------------


@stated("page depth present", ("A", 0, "true"), ("B", 1, "true"), ("C", 2, "true"), ("X", 0, "false"))
def seeded_subtree(spark):
    pages = spark.createDataFrame([(p,) for p in "ABCDE"], "page string")
    links = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "D"), ("C", "A"), ("A", "gone")], "src string, dst string")
    return C.seeded(pages, links, spark.createDataFrame([("A",), ("X",)], "page string"), 2)


@stated("oai_id title", ("i1", "first"), ("i3", "c"))
def paged_harvest(spark):
    rows = [("i1", "first", False, 0), ("i2", "gone", True, 0), ("i1", "again", False, 1), ("i3", "c", False, 1), ("i4", "d", False, 2)]
    records = spark.createDataFrame(rows, "oai_id string, title string, deleted boolean, page long")
    return C.harvested(records, records, max_records=2)


@stated("asked answer", ("cache", "cache"), ("live", "live"), ("none", "refused"))
def cache_or_live(spark):
    def answer(cached, token):
        try:
            return C.source_of(cached, token)
        except PermissionError:
            return "refused"

    return spark.createDataFrame([("cache", answer(True, "")), ("live", answer(False, "t")), ("none", answer(False, ""))], "asked string, answer string")


_NOW = datetime(2024, 1, 2, 12, tzinfo=timezone.utc)


def _live(t) -> L.LiveSource:
    return L.LiveSource(t("events"), "events", "ts", {"type": "event_type", "user": "user_id", "value": "value"}, ("type", "user"), ["event_type"], "event_id")


@table("select event_id::varchar document_id, event_type as type, user_id::varchar as user from events where ts between '2024-01-01' and '2024-01-20' and event_type = 'click' order by ts desc, event_id limit 5 offset 5")
def live_hits(t):
    return _live(t).hits("type:click", {"from": "2024-01-01", "to": "2024-01-20"}, _NOW, 5, 2)


@table("""with c as (select event_type as key, count(*) n from events where ts between '2024-01-01' and '2024-01-20' group by 1), r as (select *, row_number() over (order by n desc, key) k, sum(n) over () total from c)
select key, n doc_count, cast(total - sum(n) over () as bigint) sum_other_doc_count from r where k <= 2""")
def live_terms(t):
    return _live(t).buckets("*", "type.keyword", "terms", {"from": "2024-01-01", "to": "2024-01-20"}, _NOW, 2)


@table("select round(avg(value), 6) as value from events where ts between '2024-01-01' and '2024-01-20' and user_id = 3")
def live_metric(t):
    return _live(t).buckets("user:3", "value", "avg", {"from": "2024-01-01", "to": "2024-01-20"}, _NOW).select(F.round("value", 6).alias("value"))


@table("select count(*) n from events where ts between timestamp '2024-01-02 12:00' - interval 24 hour and timestamp '2024-01-02 12:00'")
def relative_window(t):
    return _live(t).matching("*", {"from": "now-24h", "to": "now"}, _NOW).agg(F.count(F.lit(1)).alias("n"))


@stated(
    "asked answer",
    ("bad", '{"aggregation": {"agg_type": "median", "buckets": [], "error": "agg_type must be one of avg, cardinality, max, min, sum, terms", "group_by": "type", "total_matching_documents": 0}, "boundary": "external_live", "observed_at": "2024-01-02T12:00:00+00:00", "query": {"agg_type": "median", "group_by": "type", "index": "events", "lucene": "*", "time_field": "metadata.timestamp", "top_n": 10}, "source": "events", "time_window": {"from": "now-24h", "time_field": "metadata.timestamp", "to": "now"}}'),
    ("empty", '{"boundary": "external_live", "error": "query must be non-empty", "observed_at": "2024-01-02T12:00:00+00:00", "query": {"index": "events", "lucene": "", "max_results": 5, "offset": 0, "page": 1, "time_field": "metadata.timestamp"}, "results": [], "source": "events", "time_window": {"from": "now-24h", "time_field": "metadata.timestamp", "to": "now"}, "total": {"relation": "eq", "value": 0}}'),
    ("search", '{"boundary": "external_live", "observed_at": "2024-01-02T12:00:00+00:00", "query": {"index": "events", "lucene": "type:a", "max_results": 5, "offset": 0, "page": 1, "time_field": "metadata.timestamp"}, "results": [{"document_id": "2", "fields": {"type": "a", "user": "7"}}], "source": "events", "time_window": {"from": "now-24h", "time_field": "metadata.timestamp", "to": "now"}, "total": {"relation": "eq", "value": 1}}'),
    ("terms", '{"aggregation": {"agg_type": "terms", "buckets": [{"doc_count": 1, "key": "a"}], "group_by": "type", "sum_other_doc_count": 1, "total_matching_documents": 2}, "boundary": "external_live", "observed_at": "2024-01-02T12:00:00+00:00", "query": {"agg_type": "terms", "group_by": "type", "index": "events", "lucene": "*", "time_field": "metadata.timestamp", "top_n": 1}, "source": "events", "time_window": {"from": "now-24h", "time_field": "metadata.timestamp", "to": "now"}}'),
)
def live_envelopes(spark):
    rows = [(1, "a", 7, 1.0, "2024-01-01 11:00:00"), (2, "a", 7, 2.0, "2024-01-02 11:00:00"), (3, "b", 8, 3.0, "2024-01-02 10:00:00")]
    events = spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    source = _live(lambda _: events)
    asked = {"search": source.search("type:a", now=_NOW), "empty": source.search(" ", now=_NOW), "terms": source.aggregate("*", "type", top_n=1, now=_NOW), "bad": source.aggregate("*", "type", "median", now=_NOW)}
    return spark.createDataFrame([(k, L.told(v)) for k, v in asked.items()], "asked string, answer string")


# -- snapshots ---------------------------------------------------------------------------

_CONFIGS = {
    "good": {"snapshot": "s-1", "groups": {"dbs": {"path": "d", "collected": "2024-01-02..2024-01-05", "drop_fields": ["b", "a", "a"], "note": "n"}}},
    "unknown group": {"snapshot": "s", "groups": {"nope": {"path": "d", "collected": "2024-01-02"}}}, "no date": {"snapshot": "s", "groups": {"dbs": {"path": "d"}}}, "bad range": {"snapshot": "s", "groups": {"dbs": {"path": "d", "collected": "2024-02-02..2024-01-01"}}},
    "bad level": {"snapshot": "s", "zstd_level": 30, "groups": {"dbs": {"path": "d", "collected": "2024-01-02"}}}, "bad name": {"snapshot": "a b", "groups": {"dbs": {"path": "d", "collected": "2024-01-02"}}}, "extra": {"snapshot": "s", "more": 1, "groups": {}}, "no mapping": [],
}


@stated(
    "asked answer", ("good", '["s-1", 10, [["dbs", "base/d", "2024-01-02..2024-01-05", ["a", "b"], [], "n", []]]]'), ("unknown group", "refused"), ("no date", "refused"), ("bad range", "refused"), ("bad level", "refused"), ("bad name", "refused"), ("extra", "refused"), ("no mapping", "refused"),
)
def snapshot_config(spark):
    def answer(raw):
        try:
            name, level, groups = N.parse_config(raw, "base")
        except N.Refused:
            return "refused"
        return json.dumps([name, level, [[g.name, g.path, g.collected, g.drop, g.keep, g.note, g.file_dates] for g in groups]])

    return spark.createDataFrame([(k, answer(v)) for k, v in _CONFIGS.items()], "asked string, answer string")


_FILES = [("g1", "d/a.json", b"[1]"), ("g1", "d/b.json", b"{}"), ("g2", "x.txt", b"hello")]


def _files(spark):
    return spark.createDataFrame(_FILES, "grp string, name string, content binary")


@table("""with f as (select 'g1' grp, 'd/a.json' as name, '[1]' c union all select 'g1', 'd/b.json', '{}' union all select 'g2', 'x.txt', 'hello')
select grp, sha256(string_agg(name || chr(0) || sha256(c) || chr(10), '' order by name)) contents_sha256, count(*) file_count, sum(length(c))::bigint content_bytes from f group by grp""")
def contents_digest(t):
    return N.contents_digest(_files(t("region").sparkSession), "grp")


@stated("grp name content", ("g1", "d/a.json", "[1]"), ("g1", "d/b.json", "{}"), ("g2", "x.txt", "hello"))
def archive_round_trip(spark):
    return N.read_archives(N.archives(_files(spark))).withColumn("content", F.col("content").cast("string")).where("problem is null")


@stated("grp problem", ("g1", None), ("g2", "digest differs"), ("g3", "missing"))
def archive_verified(spark):
    packed = N.archives(_files(spark)).persist()
    locked = N.lock(packed, _files(spark))
    gone = locked.where("grp = 'g1'").withColumn("grp", F.lit("g3"))
    broken = packed.withColumn("archive", F.when(F.col("grp") == "g2", F.concat(F.expr("substring(archive, 1, octet_length(archive) - 1)"), F.unhex(F.lit("EE")))).otherwise(F.col("archive")))
    return N.verified(locked.unionByName(gone), broken)


@stated("members problem", (0, "unsafe member '../x'"))
def archive_unsafe(spark):
    packed = spark.createDataFrame([("g", bytearray(N.pack({"../x": b"1"})))], "grp string, archive binary")
    read = N.read_archives(packed)
    return read.agg(F.count("name").alias("members"), F.max("problem").alias("problem"))


@stated("raw", ('{"dataset":"/a","data_tier":"RAW","extra":{"k":1}}',), ("7",))
def pruned_records(spark):
    rows = spark.createDataFrame([('{"dataset":"/a","junk":"x","data_tier":"RAW","nevents":3,"extra":{"k":1},"physics_group":"g"}',), ("7",)], "raw string")
    return N.pruned(rows, N.GROUPS["dbs"], keep=("extra",), drop=("physics_group",))


@stated("asked records identified signed accepted", ("good", 2, 2, 2, "true"), ("no identity", 2, 1, 2, "false"), ("other export", 2, 2, 0, "false"), ("empty", 0, 0, 0, "false"))
def group_shapes(spark):
    asked = {"good": ['{"dataset":"/a"}', '{"name":"/b"}'], "no identity": ['{"dataset":"/a"}', '{"data_tier":"RAW"}'], "other export": [], "empty": []}
    out = None
    for name, rows in asked.items():
        spec = N.GROUPS["dbs"] if name != "other export" else N.Spec("x", "mapping", (), ("known",))
        given = spark.createDataFrame([(r,) for r in (rows if name != "other export" else ['{"a":1}', '{"b":2}'])], "raw string")
        one = N.shape_verdict(given, spec).select(F.lit(name).alias("asked"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@table("select distinct 'n' || c_nationkey as value from customer")
def page_index(t):
    return N.page_index(t("customer").select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("node_id")))


@table("select r_regionkey, r_name from region")
def records_written(t):
    """Written at once and read back."""
    rows = t("region").select("r_regionkey", "r_name")
    spark = rows.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or "/tmp"
    path = f"{base.rstrip('/')}/graphloom-records-{spark.sparkContext.applicationId}"
    N.write_records(rows, path)
    return spark.read.schema(rows.schema).json(path)


@stated("user site role skip", ("u", "s", "r", "false"), (None, None, None, "true"), (None, None, None, "true"))
def row_arrays(spark):
    from graphloom.sources.caches import row_arrays as read

    return read(spark.createDataFrame([('{"desc":{},"result":[["u","s","r"],["x","y"],7]}',)], "value string"), ["user", "site", "role"])
