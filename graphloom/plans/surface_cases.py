"""Registered queries of enrichers, tools, code chunks, flat caches, timetables and saved pages, over stated rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from graphloom.functions import code as K
from graphloom.operators import enrichers as N, search as S
from graphloom.plans.cases import _request_query, values_sql
from graphloom.sources import crawl as C, monitoring as M, records as R, requests as Q
from graphloom.streaming import runs

QUERIES: dict = {}
ORACLES: dict = {}


def stated(columns: str, *rows: tuple):
    """A query over stated rows with its stated result, compared as text."""

    def add(f):
        names = columns.split()
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark).select(*[F.col(c).cast("string").alias(c) for c in names])
        ORACLES[f.__name__] = values_sql(names, [tuple(None if v is None else str(v) for v in r) for r in rows])
        return f

    return add


# -- enrichers and tools -----------------------------------------------------------------

_NODES = [("jira:A", "jira_issue"), ("c1", "document_chunk"), ("c2", "document_chunk"), ("site:X", "site"), ("svc:Y", "infrastructure_service"), ("person:P", "person"), ("page:D", "documentation_page")]
_EDGES = [("jira:A", "c1", "contains"), ("jira:A", "c2", "contains"), ("page:D", "c2", "contains"), ("c1", "site:X", "references"), ("c2", "site:X", "references"), ("c2", "person:P", "references"), ("c2", "jira:A", "references"), ("jira:A", "svc:Y", "references"), ("page:D", "site:X", "references")]


def _graph(spark):
    return spark.createDataFrame(_NODES, "node_id string, subtype string"), spark.createDataFrame(_EDGES, "src string, dst string, edge_type string")


@stated("src dst edge_type weight", ("jira:A", "site:X", "references", 2), ("page:D", "jira:A", "references", 1))
def enrich_chunk_rollup(spark):
    return N.CHUNK_ROLLUP.apply(*_graph(spark))


@stated("src dst edge_type weight", ("jira:A", "svc:Y", "affects", 1))
def enrich_affects(spark):
    return N.AFFECTS.apply(*_graph(spark))


@stated("missing", ("workflow",))
def schema_consistency(spark):
    declared = {*N.PARENTS, *N.TARGETS, "document_chunk"} - {"workflow"}
    return spark.createDataFrame([(x,) for x in N.undeclared(declared, (N.CHUNK_ROLLUP, N.AFFECTS))], "missing string")


@stated("spec answer", ("graphloom.sources.requests:window", '["start", "end"]'), ("graphloom.sources.requests:none", "refused"), ("no.module:x", "refused"))
def tool_table(spark):
    def answer(spec):
        try:
            return json.dumps(N.parameters(spec))
        except ValueError:
            return "refused"

    return spark.createDataFrame([(s, answer(s)) for s in ("graphloom.sources.requests:window", "graphloom.sources.requests:none", "no.module:x")], "spec string, answer string")


# -- code --------------------------------------------------------------------------------

_CODE = "import os\n\n\ndef one(a):\n    return a\n\n\n@wrap\nclass Two:\n    x = 1\n\n    def go(self):\n        return 2\n\n\nprint(one(1))\n"


@stated("path idx symbol start_line end_line", ("a.py", 0, "<module>", 1, 3), ("a.py", 1, "one", 4, 5), ("a.py", 2, "Two", 8, 13), ("a.py", 3, "<module>", 14, 17), ("bad.py", 0, "", 1, 1), ("t.txt", 0, "", 1, 1), ("t.txt", 1, "", 1, 1), ("big.py", 0, "Big", 1, 1), ("big.py", 1, "Big.m", 2, 3), ("big.py", 2, "Big.n", 4, 5), ("big.py", 3, "Big.n", 5, 5))
def code_chunks(spark):
    big = "class Big:\n    def m(self):\n        return 1\n    def n(self):\n        return '" + "x" * 5000 + "'"
    files = [("a.py", _CODE), ("bad.py", "def ("), ("t.txt", "y" * 2000), ("big.py", big), ("none.py", "")]
    return K.file_chunks(spark.createDataFrame(files, "path string, text string"))


# -- saved pages and caches --------------------------------------------------------------

_TIMETABLE = {"results": {"9": {"20210203": {
    "s1": {"entryType": "Session", "title": " Morning ", "entries": {"c1": {"entryType": "Contribution", "contributionId": "1", "title": "A"}, "b": {"entryType": "Break", "id": "x"}, "c1b": {"entryType": "Contribution", "contributionId": "1", "title": "again"}}},
    "c2": {"contributionId": 2, "title": "B"}, "odd": {"entryType": "Session", "entries": {"deep": {"entryType": "Session", "entries": {"c3": {"entryType": "Contribution", "id": "3"}}}}},
}}}}


@stated("event_id talk_id session title", ("9", "1", "Morning", "A"), ("9", "2", "", "B"), ("9", "3", "", None))
def timetable(spark):
    found = R.timetable(spark.createDataFrame([("9", json.dumps(_TIMETABLE)), ("8", "{}")], "event_id string, payload string"))
    return found.select("event_id", "talk_id", "session", F.get_json_object("raw", "$.title").alias("title"))


@stated("node_id author date reply_count body", ("hn:prep/12", "Jo Do", "2021-02-03", 1, "From: Jo Do Date: 3 Feb 2021 hello"), ("hn:prep/13", "", "", 0, ""))
def forum_pages(spark):
    page = '<i>From:</i> <a href="x"><i></i>Jo Do</a> <i>Date:</i> 3 Feb 2021 <a name="1"></a><a name="2"></a><p>hello</p>'
    return R.forum_threads(spark.createDataFrame([("prep", "12", "u", "t", page), ("prep", "13", "u", "t", None)], "forum string, thread string, url string, title string, html string"))


@stated("site snapshot_date availability_pct status total_tests ok_count", ("T1_A", "d", "97.5", "OK", 10, 9), ("T2_B", "2024-01-02", "0.0", "UNKNOWN", 0, 0))
def cached_availability(spark):
    rows = [(0, '{"site":"T1_A","availability_pct":97.5,"status":"OK","total_tests":10,"ok_count":9}'), (1, '{"site":"T2_B","date":"2024-01-02"}'), (2, "{}")]
    return M.cached_availability(spark.createDataFrame(rows, "input_pos long, raw string"), "d")


@stated("src_site dst_site done_count failed_count bytes_total avg_duration_s top_activity", ("T1_A", "T2_B", 13, 2, 1500, "133.333", "Prod"), ("T1_A", "T2_C", 0, 0, 0, "9.0", ""))
def cached_transfers(spark):
    rows = [
        (0, '{"src_rse":"T1_A_Disk","dst_site":"T2_B","done_count":10,"bytes_total":1000,"avg_duration_s":100}'), (1, '{"src_site":"T1_A","dst_rse":"T2_B_Test","done_count":3,"failed_count":2,"bytes_total":500,"avg_duration_s":200,"top_activity":"Prod"}'), (2, '{"src_site":"T1_A","dst_site":"T2_C","avg_duration_s":9}'),
    ]
    return M.cached_transfers(spark.createDataFrame(rows, "input_pos long, raw string"), "d").withColumn("avg_duration_s", F.round("avg_duration_s", 3))


@stated("dataset replica_rses replica_sites", ("/a/b/RAW", '["T1_A","T2_B_Disk"]', '["T1_A","T2_B"]'), ("/a/c/RAW", '["T3_X"]', '["T3_X"]'))
def cached_replicas(spark):
    rows = [('{"dataset":"/a/b/RAW","replica_rses":["T2_B_Disk","T1_A","T1_A"]}',), ('{"dataset":"/a/c/RAW","replica_sites":["T3_X",""]}',)]
    out = M.cached_replicas(spark.createDataFrame(rows, "raw string"))
    return out.withColumns({c: F.to_json(c) for c in ("replica_rses", "replica_sites")})


@stated(
    "path cookies live expired fresh reason", ("good", 2, 1, 1, "true", "1 live cookies"), ("old", 1, 1, 0, "false", "cookie file is older than max age"), ("gone", 1, 0, 1, "false", "all 1 cookies are expired"), ("other", 0, 0, 0, "false", "cookie file has no cookies for domain cern.ch"), ("session", 1, 1, 0, "true", "1 live cookies"), ("broken", 0, 0, 0, "false", "cookie file could not be parsed"),
)
def cookie_files(spark):
    row = lambda domain, ends: "\t".join([domain, "TRUE", "/", "TRUE", str(ends), "n", "v"])
    head = "# Netscape HTTP Cookie File\n"
    files = [
        ("good", head + row("a.cern.ch", 2000) + "\n" + row("b.cern.ch", 500), 990), ("old", head + row("cern.ch", 2000), 1), ("gone", head + row("cern.ch", 10), 990), ("other", head + row("x.org", 2000), 990), ("session", head + "#HttpOnly_" + row("cern.ch", 0), 990), ("broken", "what", 990),
    ]
    return C.cookie_verdict(spark.createDataFrame(files, "path string, text string, modified long"), "cern.ch", 1000, 100)


@stated("doc_id line_no line context", (1, 1, "b error", "a\nb error\nc"), (2, 0, "error", "error"))
def lines_with_context(spark):
    return S.lines_with_context(spark.createDataFrame([(1, "a\nb error\nc\nd"), (2, "error"), (3, "fine")], "doc_id long, text string"), "doc_id", "text", "error")


@stated("asked answer", ("select", "2"), ("with", "1"), ("insert", "refused"), ("two", "refused"))
def read_only_sql(spark):
    spark.range(2).createOrReplaceTempView("graphloom_two_rows")

    def answer(text):
        try:
            return str(S.read_only_sql(spark, text, 10).count())
        except ValueError:
            return "refused"

    asked = {"select": "select * from graphloom_two_rows;", "with": "with x as (select 1 a) select a from x", "insert": "insert into t values (1)", "two": "select 1; select 2"}
    return spark.createDataFrame([(k, answer(v)) for k, v in asked.items()], "asked string, answer string")


@stated("same differs", ("true", "true"))
def run_cursor(spark):
    files = lambda *f: spark.createDataFrame([(p, bytearray(c)) for p, c in f], "path string, content binary")
    token = lambda df: runs.cursor(df).first()[0]
    a, b = ("p1", b"x"), ("p2", b"y")
    return spark.createDataFrame([(token(files(a, b)) == token(files(b, a)), token(files(a, b)) != token(files(a, ("p2", b"z"))))], "same boolean, differs boolean")


REQUESTS = {
    "http_error": (Q.http_error, [((401,), "MONIT OpenSearch authentication failed with HTTP 401"), ((503,), "MONIT OpenSearch request failed with HTTP 503"), ((None,), "MONIT OpenSearch request failed with HTTP unknown")]),
    "total": (Q.total, [(({"value": 3, "relation": "gte"},), {"relation": "gte", "value": 3}), ((7,), {"relation": "eq", "value": 7}), ((None,), {"relation": "eq", "value": 0})]),
    "first_response": (Q.first_response, [(({"responses": [{"a": 1}, {"b": 2}]},), {"a": 1}), (({"x": 1},), {"x": 1}), (({"responses": [3]},), {})]),
    "response_error": (Q.response_error, [(({"error": {"reason": "r", "type": "t"}},), "r"), (({"error": {"type": "t"}},), "t"), (({"error": "plain"},), "plain"), (({},), None)]),
    "waits": (Q.waits, [((8,), [1.0, 2.0, 4.0, 8.0, 16.0, 30.0, 30.0, 30.0]), ((0,), [])]),
}
for _name, (_f, _cases) in REQUESTS.items():
    QUERIES[f"req_{_name}"], ORACLES[f"req_{_name}"] = _request_query(_f, _cases)
