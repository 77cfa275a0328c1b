"""Registered queries of scalar functions: each applied to stated inputs, held against stated results.

A case is one row: its inputs (text), then the result (text; lists and structs as JSON).
The oracle of a query is the table of its cases, so the expected values are pinned.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from graphloom.functions import scalars as X, text as T
from graphloom.sources import projections as P, requests as Q


LONG = "/" + "p" * 30 + "/" + "m" * 100 + "/AODSIM"
FORUM = (
    '<html><body><i>From:</i> <a href="x"><i></i>A. Person &amp; Co</a> <i>Date:</i> 3 Feb, 2021 <a name="1">x</a><a name="2">y</a><a name="3">z</a>'
    "<script>var x = 1;</script><p>Hello&nbsp;all, message_id='m1' see b &lt; c Next-in-Thread</p> This site runs HyperNewsViewer and more</body></html>"
)

#: name: (function of the input columns, whether its result is a list or struct, cases)
CASES: dict[str, tuple] = {
    "safe_part": (X.safe_part, False, [("a b/c", "a_b_c"), ("__x..y-z__", "x..y-z"), ("??", ""), ("T2_US_MIT", "T2_US_MIT")]),
    "safe_slug": (X.safe_slug, False, [("My Docs/Page 1", "My_Docs_Page_1"), ("_.x_", ".x"), ("??", "e270aeb347f21655")]),
    "dataset_label": (X.dataset_label, False, [
        ("/A/B/RAW", "/A/B/RAW"), (LONG, "/" + "p" * 30 + "/" + "m" * 75 + "..." + "/AODSIM"), ("x" * 130, "x" * 117 + "..."), ("/a/" + "b" * 120, "/a/" + "b" * 114 + "..."),
    ]),
    "rse_site": (X.rse_site, False, [("T1_DE_KIT_Tape", "T1_DE_KIT"), (" T2_US_MIT ", "T2_US_MIT"), ("T0_CH_CERN_Disk", "T0_CH_CERN"), ("T1_X_Disk_Test", "T1_X_Disk"), ("T2 A/B_MSS", "T2_A_B"), ("T2_US_MIT_disk", "T2_US_MIT_disk")]),
    "host_without_port": (X.host_without_port, False, [("h.org:8443", "h.org"), ("h.org", "h.org"), ("a:b:1", "a:b:1"), ("h.org:x", "h.org:x"), (":7", "")]),
    "alias_key": (X.alias_key, False, [("  T2_US_Mit\t", "t2_us_mit"), ("", "")]),
    "endpoint_alias": (X.endpoint_alias, False, [("HTTPS://Host.org:80/Path/", "host.org:80"), (" host.org/;.", "host.org"), ("file:///etc/x", "/etc/x"), ("Host.Org:80,", "host.org:80")]),
    "endpoint_host": (X.endpoint_host, False, [("https://Host.cern.ch:8443/path", "host.cern.ch"), ("host.cern.ch:8443/path", "host.cern.ch"), ("Host", "Host"), ("root://u@h.org//x", "h.org"), ("https://h.org?x", "h.org")]),
    "version_key": (X.version_key, True, [
        ("CMSSW_10_6_3_patch1", '{"major":10,"minor":6,"patch":3,"label":"CMSSW_10_6_3_patch1"}'), ("CMSSW_9_4_AN_X", '{"major":9,"minor":4,"patch":-1,"label":"CMSSW_9_4_AN_X"}'), ("other", '{"major":0,"minor":0,"patch":0,"label":"other"}'),
    ]),
    "report_number": (X.report_number, True, [
        ("CMS-PAS-SUS-08-005", '{"kind":"PAS","pag":"SUS","year":"08","number":"005","analysis_code":"SUS-08-005"}'), (" CMS-NOTE-2019-001 ", '{"kind":"NOTE","pag":"","year":"2019","number":"001","analysis_code":""}'),
        ("CMS-AN-XYZ-20-0012", '{"kind":"AN","pag":"XYZ","year":"20","number":"0012","analysis_code":""}'), ("ATLAS-PAS-SUS-08-005", None), ("CMS-PAS-SUS-8-005", None),
    ]),
    "analysis_ids": (X.analysis_ids, True, [
        ("B2G28992Review", '["B2G-28-992"]'), ("SUS25995CWR", '["SUS-25-995"]'), ("CWRFWD29982COMMENT099", '["FWD-29-982"]'), ("HIN-21-999Comments", '["HIN-21-999"]'), ("HIG29991andHIG27993", '["HIG-29-991","HIG-27-993"]'),
        ("NoDigitsTopic", "[]"), ("SUS20990305", "[]"), ("HIG299910", "[]"), ("SMPJS21999FR", "[]"), ("B2GAN99310", "[]"), ("HWW22998", "[]"), ("HIG29000", "[]"), ("TOP35001", "[]"), ("hig18026", "[]"), ("HIG29991HIG-29-991", '["HIG-29-991"]'),
    ]),
    "analysis_forms": (lambda a: X.analysis_forms(X.analysis_ids(a)), False, [("HIG29991", "HIG-29-991 CMS-HIG-29-991"), ("HIG29991andHIG27993", "HIG-29-991 CMS-HIG-29-991 HIG-27-993 CMS-HIG-27-993"), ("x", "")]),
    "issue_keys": (X.issue_keys, True, [("see CMSOPS-12, COVID-19 and CMSOPS-12", '["CMSOPS-12","COVID-19"]'), ("cmsops-1 XA-1b", "[]"), ("", "[]")]),
    "issue_keys_bounded": (lambda a: X.issue_keys(a, ["CMSOPS", "DM"]), True, [("see CMSOPS-12, COVID-19, DM-3", '["CMSOPS-12","DM-3"]'), ("XDM-3", "[]")]),
    "report_code": (T.report_code, False, [("CMS-PAS-SUS-20-001", "SUS-20-001"), ("CMS-NOTE-2019-001", "")]),
    "topic_page": (X.topic_page, False, [
        ("HiggsPhysics", "CMS", "", "CMS/HiggsPhysics"), ("CMS.HiggsPhysics", "Main", "CMS", "CMS/HiggsPhysics"), ("Sub.Topic", "Main", "CMS", "CMS/Sub/Topic"), ("/Sub/Topic/", "Main", "", "Sub/Topic"), ("  ", "CMS", "", ""), ("Topic", "", "", ""),
    ]),
    "wiki_view_url": (X.wiki_view_url, False, [("https://t.org/twiki/bin/viewauth/CMS/Page?rev=3#Top", "https://t.org/twiki/bin/view/CMS/Page"), ("", ""), ("https://t.org/x#y?z", "https://t.org/x")]),
    "wiki_page_of_url": (X.wiki_page_of_url, False, [("https://t.org/twiki/bin/view/CMS/My%20Page?x=1", "CMS/My Page"), ("https://t.org/twiki/bin/viewauth/CMS/Sub/P/", "CMS/Sub/P"), ("https://t.org/other", ""), ("https://t.org/twiki/bin/view/A/b+c", "A/b+c")]),
    "bare_parent": (lambda a: X.bare_parent(a, ["CMS", "HiggsWG"]), False, [
        ("CMS.HiggsPhysics", "HiggsPhysics"), ("CMS.HiggsWG.Page", "Page"), ("CMS.Other.Page", "CMS.Other.Page"), ("HiggsPhysics", "HiggsPhysics"), ("https://t.org/twiki/bin/view/CMS/HiggsPhysics", "HiggsPhysics"), ("Main.Page", "Main.Page"), ("CMS.", "CMS."),
    ]),
    "markup_text": (X.markup_text, False, [("<p>a &amp; b<br>c &eacute; &#8364;</p><script>x</script>", "a & b c é €"), ("<STYLE a>q</STYLE>t", "t"), ("", "")]),
    "field_text": (X.field_text, False, [("a < b > c <b>x</b>&amp;", "a < b > c x &"), (None, ""), (" <i>q</i>\n r ", "q r")]),
    "clean_text": (X.clean_text, False, [("  a \t b\n\n\n\n\nc  ", "a b\n\n\nc"), ("\n x", "x")]),
    "path_title": (X.path_title, False, [
        ("docs/my-file_name.txt", "body", "My File Name"), ("docs/a.md", "\n## Head\ntext", "Head"), ("docs/a.md", "#\n", "a"), ("a.rst", "=====\nTitle\n=====", "Title"), ("a.RST", "", "A"), ("x/README", "# no", "Readme"),
    ]),
    "forum_author": (X.forum_author, False, [(FORUM, "A. Person"), ("Posted by: Jane Doe<br>", "Jane Doe"), ("nothing", "")]),
    "forum_date": (X.forum_date, False, [(FORUM, "2021-02-03"), ("<i>Date:</i> 12 Mar 2019", "2019-03-12"), ("<i>Date:</i> 99 Foo 2019", "99 Foo 2019"), ("Posted: 2020/01/02 10:11", "2020/01/02 10:11"), ("x", "")]),
    "forum_replies": (X.forum_replies, False, [(FORUM, "2"), ("x", "0")]),
    "forum_body": (X.forum_body, False, [(FORUM, "From: A. Person & Co Date: 3 Feb, 2021 x y z Hello all see b < c")]),
    "login_url": (X.is_login_url, False, [("https://AUTH.cern.ch/x", "true"), ("https://a.org/Login?x", "true"), ("https://a.org/sso/", "true"), ("https://a.org/page", "false")]),
    "login_page": (X.is_login_page, False, [("Sign in to CERN", "true"), ("see login.cern.ch", "true"), ("plain", "false")]),
    "epoch_date": (lambda a: X.epoch_date(a.cast("long")), False, [("0", "1970-01-01"), ("1700000000", "2023-11-14"), ("86399", "1970-01-01")]),
    "epoch_iso": (lambda a: X.epoch_iso(a.cast("long")), False, [("0", "1970-01-01T00:00:00+00:00"), ("1700000000", "2023-11-14T22:13:20+00:00")]),
    "stamp": (X.stamp, False, [('{"date":"2021-02-03","time":"10:00:00","tz":"UTC"}', "2021-02-03T10:00:00"), ('{"date":"2021-02-03"}', "2021-02-03"), ("2021", "2021"), (None, "")]),
    "query_time": (X.query_time, False, [("2021-02-03T10:11:12", "2021/02/03 10:11"), ("2021-02-03", "2021/02/03 00:00"), ("soon", None)]),
    "collected": (X.collected, False, [("2021-02-03", "2021-02-03"), ("2021-02-03..2021-03-01", "2021-02-03..2021-03-01"), ("2021-03-03..2021-02-01", None), ("2021-02-30", None), ("Feb 2021", None), ("2021-02-03..", None)]),
    "empty_topic_limit": (lambda a: X.empty_topic_limit(a.cast("long")), False, [("0", "10"), ("10999", "10"), ("11000", "11"), ("43537", "43")]),
    "status_bin": (lambda a: X.status_bin(a.cast("long")), False, [("0", "0"), ("899", "0"), ("900", "1"), ("86399", "95"), ("86400", "0")]),
    "name_or_key": (X.name_or_key, False, [('{"name":"Open","key":"k"}', "Open"), ('{"name":"","key":"k"}', "k"), ("plain", "plain"), (None, ""), ("{}", "")]),
    "display_name": (X.display_name, False, [('{"displayName":"Jo Do","name":"jdo"}', "Jo Do"), ('{"name":"jdo"}', "jdo"), ('{"key":"J1"}', "J1"), (None, "")]),
    "person_name": (X.person_name, False, [('{"fullName":" Do, Jo "}', "Do, Jo"), ('{"first_name":"Jo","familyName":"Do"}', "Jo Do"), ('{"last_name":"Do"}', "Do"), (" Jo ", "Jo"), ("{}", "")]),
    "dotted_path": (lambda a: X.dotted(a, "data.site.name"), False, [('{"data":{"site":{"name":"x"}}}', "x"), ('{"data":{"site":"s"}}', None), ('{"data.site.name":"x"}', None), ("[]", None)]),
    "hit_source": (lambda a: X.dotted(X.hit_source(a), "a.b"), False, [('{"_source":{"a":{"b":"1"}}}', "1"), ('{"_source":"{\\"a\\":{\\"b\\":\\"2\\"}}"}', "2"), ('{"_source":"broken{"}', None), ('{"_id":"x"}', None)]),
    "strings_of": (X.strings_of, True, [('{"name":"n","value":"v"}', '["n"]'), ('[" a ",{"x":["b",1]},null,""]', '["a","b","1"]'), (None, "[]"), ('"t"', '["t"]'), ("true", '["True"]')]),
    "comment_texts": (X.comment_texts, True, [('[{"author":{"displayName":"Jo"},"created":"2021","body":" hi "},{"body":""},"loose"]', '["Jo 2021: hi","loose"]'), ('{"text":"t"}', '["t"]'), (None, "[]")]),
    "compact_json": (X.compact_json, False, [('{ "b" : 1, "a": [1, 2] }', '{"b":1,"a":[1,2]}'), ('"é"', '"é"')]),
    "sorted_json": (X.sorted_json, False, [('{"b":1,"a":{"d":null,"c":2.5}}', '{"a": {"c": 2.5, "d": null}, "b": 1}')]),
    "typed_links": (X.typed_links, True, [
        ('[{"key":"A-1","type":"Blocks","direction":"outward"},{"key":"A-2","type":"Relates"},{"key":"bad","type":"x","direction":"inward"}]', '[{"key":"A-1","type":"Blocks","direction":"outward"}]'),
        ('[{"type":{"name":"Cloners"},"inwardIssue":{"key":"B-7"}}]', '[{"key":"B-7","type":"Cloners","direction":"inward"}]'), ("7", "[]"), (None, "[]"),
    ]),
    "link_kind": (P.link_kind, False, [("Gantt End to Start", "gantt"), ("Sub-task", "child"), ("Parent-Relation", "child"), ("Blocker", "blocks"), ("Cloners", "clones"), ("Duplicate", "duplicates"), ("Relates", "relates"), (None, "relates")]),
    "uuid5_hex": (X.uuid5_hex, False, [("http://www.python.org/", "c2a8cbf8d0f15ef49740c3faec8ab1a0"), ("a|b|references|c", "46a60a4a300a56b7ace5493a46317b61")]),
    "sha16": (T.digest16, False, [("", "e3b0c44298fc1c14"), ("abc", "ba7816bf8f01cfea")]),
    "int_or_null": (lambda a: F.trim(a).try_cast("long"), False, [("12", "12"), (" 7 ", "7"), ("1.5", None), ("x", None), (None, None)]),
    "nul_to_space": (lambda a: T.no_nul(F.replace(a, F.lit("~"), F.lit("\0"))), False, [("a~b", "a b"), ("ab", "ab")]),
    "previous_version": (T.previous_version, False, [("106X_v3", "106X_v2"), ("106X_v1", None), ("tag", None)]),
    "release_kind": (P.release_kind, False, [("CMSSW_10_6_0", "release"), ("CMSSW_10_6_3_patch1", "patch"), ("CMSSW_10_6_0_pre1", "pre-release"), ("CMSSW_9_4_AN_X", "integration-series"), ("CMSSW_6_2_0_SLHC4", "variant"), ("other", "unrecognized")]),
    "previous_release": (P.previous_release, False, [("CMSSW_10_6_0", None), ("CMSSW_10_6_3", "CMSSW_10_6_2"), ("CMSSW_10_6_3_patch1", "CMSSW_10_6_3"), ("CMSSW_10_6_3_patch4", "CMSSW_10_6_3_patch3"), ("CMSSW_6_2_0_SLHC4", "CMSSW_6_2_0")]),
}

#: name: (what is asked, cases of arguments and result); plain values of the driver, results as JSON.
REQUESTS: dict[str, tuple] = {
    "project_keys": (Q.project_keys, [((["CMSOPS", " DM_1 "],), ["CMSOPS", "DM_1"]), (([],), None), (("CMSOPS",), None), ((["cms"],), None), ((["A", 3],), None)]),
    "issue_query": (Q.issue_query, [(("CMSOPS",), 'project = "CMSOPS"'), (("DM", "2021-02-03T10:11:12", "2022-01-01"), 'project = "DM" and created >= "2021/02/03 10:11" and updated >= "2022/01/01 00:00"'), (("x y",), None)]),
    "quoted": (Q.quoted, [(('a"b\\c',), '"a\\"b\\\\c"'), (("",), '""')]),
    "clean_query": (Q.clean_query, [(("  a:b secret ", "secret"), "a:b [redacted]"), ((None,), ""), (("x" * 900,), "x" * 800)]),
    "clamp": (Q.clamp, [(("7", 5, 1, 10), 7), (("x", 5, 1, 10), 5), ((99, 5, 1, 10), 10), ((None, 5, 1, 10), 5), ((-3, 5, 1, 10), 1)]),
    "window": (Q.window, [((" ", None), {"from": "now-24h", "time_field": "metadata.timestamp", "to": "now"}), (("now-1h", " 2021-01-01 "), {"from": "now-1h", "time_field": "metadata.timestamp", "to": "2021-01-01"})]),
    "terms_field": (Q.terms_field, [(("data.state",), "data.state.keyword"), (("data.state.keyword",), "data.state.keyword")]),
    "aggregation_error": (Q.aggregation_error, [
        (("", "g", "terms"), "query must be non-empty; use '*' for all documents"), (("*", "", "terms"), "group_by must be non-empty"), (("*", "g", "median"), "agg_type must be one of avg, cardinality, max, min, sum, terms"), (("*", "g", "sum"), None),
    ]),
    "aggregation_body": (Q.aggregation_body, [(("*", "f", "terms", 3, Q.window("", "")), {
        "size": 0, "aggs": {"result": {"terms": {"field": "f", "size": 3}}},
        "query": {"bool": {"must": [{"query_string": {"query": "*", "analyze_wildcard": True}}], "filter": [{"range": {"metadata.timestamp": {"gte": "now-24h", "lte": "now", "format": "strict_date_optional_time||epoch_millis"}}}]}},
    })]),
    "search_body": (lambda *a: {k: v for k, v in Q.search_body(*a).items() if k != "query"}, [(("*", ["a"], Q.window("", ""), 5, 3), {"size": 5, "from": 10, "_source": ["a"], "sort": [{"metadata.timestamp": {"order": "desc"}}]})]),
    "retry_raw": (Q.retry_raw, [
        (("no mapping found for [x]", 0, 0, "f.keyword"), True), (("bad F.KEYWORD", 0, 0, "f.keyword"), True), (("timed out", 0, 0, "f.keyword"), False), ((None, 0, 5, "f"), True), ((None, 0, 0, "f"), False), ((None, 2, 5, "f"), False),
    ]),
    "envelope": (Q.envelope, [(("rucio", "2021-01-01T00:00:00+00:00", {"lucene": "*"}, {"from": "a", "to": "b"}), {"boundary": "external_live", "source": "rucio", "observed_at": "2021-01-01T00:00:00+00:00", "query": {"lucene": "*"}, "time_window": {"from": "a", "to": "b"}})]),
}


def values_sql(columns: list[str], rows: list[tuple], types: dict[str, str] | None = None) -> str:
    """DuckDB SQL of a table of stated rows; text unless ``types`` says otherwise."""
    kinds = [(types or {}).get(c, "varchar") for c in columns]

    def cell(value, kind: str) -> str:
        return f"null::{kind}" if value is None else "'" + str(value).replace("'", "''") + f"'::{kind}"

    if not rows:
        return "select " + ", ".join(f"null::{k} as {c}" for c, k in zip(columns, kinds)) + " where false"
    listed = ", ".join("(" + ", ".join(cell(v, k) for v, k in zip(r, kinds)) + ")" for r in rows)
    return f"select * from (values {listed}) pinned({', '.join(columns)})"


def _case_query(function, complex_: bool, cases: list[tuple]):
    inputs = [chr(97 + k) for k in range(len(cases[0]) - 1)]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.createDataFrame([c[:-1] for c in cases], ", ".join(f"{c} string" for c in inputs))
        out = function(*map(F.col, inputs))
        return rows.select(*inputs, (F.to_json(out) if complex_ else out.cast("string")).alias("output"))

    return run, values_sql([*inputs, "output"], cases)


def _told(value) -> str | None:
    return None if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True)


def _request_query(function, cases: list[tuple]):
    def answer(args):
        try:
            return function(*args)
        except ValueError:
            return None

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.createDataFrame([(_told(list(a)), _told(answer(a))) for a, _ in cases], "a string, output string")

    return run, values_sql(["a", "output"], [(_told(list(a)), _told(w)) for a, w in cases])


QUERIES, ORACLES = {}, {}
for _name, (_f, _complex, _cases) in CASES.items():
    QUERIES[f"fn_{_name}"], ORACLES[f"fn_{_name}"] = _case_query(_f, _complex, _cases)
for _name, (_f, _cases) in REQUESTS.items():
    QUERIES[f"req_{_name}"], ORACLES[f"req_{_name}"] = _request_query(_f, _cases)
