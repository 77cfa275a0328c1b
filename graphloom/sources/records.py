"""Text-bearing records to nodes and edges: issues, pages, forum threads, meetings, site pages, reports.

Every projection gives (nodes, edges) like those of structured records; texts become
chunk nodes that their parents contain, and the identifiers in chunks become edges to
the nodes that are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.functions import scalars as X, text as T, wiki as W
from graphloom.operators import graph as G, identifiers as I
from graphloom.operators.relational import first_by
from graphloom.sources.projections import attrs, edges, nodes, prefixed, together

#: What stands between the parts that a chunk's id is made of, by the kind of its parent.
NUL, BACKSLASH_ZERO = "\0", "\\0"
#: The parts of an issue's text, in order, and what joins their values.
ISSUE_PARTS = (
    ("summary", None), ("description", None), ("environment", None), ("status", None), ("priority", None), ("resolution", None), ("parent", None), ("components", " "), ("labels", " "),
    ("fix_versions", " "), ("issue_links", " "), ("subtasks", " "), ("recent_comments", "\n"),
)
#: A status letter in words.
_OK, _WARNING, _ERROR, _DOWN = "ok (site state or evaluation good)", "warning (site or evaluation has issues)", "error (site or evaluation failed)", "downtime"
_UNKNOWN, _WAITING, _MORGUE = "unknown (site or evaluation status unknown)", "site not in service (Waiting Room)", "site not in service (Morgue)"
STATUS_WORDS = {
    "o": _OK, "w": _WARNING, "e": _ERROR, "p": "site in partial downtime", "d": "site or service in full downtime", "a": "site or service in unscheduled downtime", "r": "site at risk of downtime", "u": _UNKNOWN,
    "R": f"{_OK}; {_WAITING}", "S": f"{_WARNING}; {_WAITING}", "T": f"{_ERROR}; {_WAITING}", "U": f"{_DOWN}; {_WAITING}", "V": f"{_UNKNOWN}; {_WAITING}", "W": _WAITING,
    "H": f"{_OK}; {_MORGUE}", "I": f"{_WARNING}; {_MORGUE}", "J": f"{_ERROR}; {_MORGUE}", "K": f"{_DOWN}; {_MORGUE}", "L": f"{_UNKNOWN}; {_MORGUE}", "M": _MORGUE,
}
#: The metrics of a status page, in order.
STATUS_METRICS = (
    ("LifeStatus", "Life Status"), ("manLifeStatus", "Life Status manual override"), ("ProdStatus", "Production (Prod) Status"), ("manProdStatus", "Production (Prod) Status manual override"),
    ("CrabStatus", "CRAB analysis (Crab) Status"), ("manCrabStatus", "CRAB analysis (Crab) Status manual override"), ("RucioStatus", "Rucio Status"), ("manRucioStatus", "Rucio Status manual override"),
    ("SiteReadiness", "Site Readiness"), ("SAMsite", "SAM Status"), ("FTSsite", "FTS Status"), ("HammerCloud", "HammerCloud"), ("Downtime", "Downtime"), ("Summary", "Summary"),
)
TICKET_URL, STATUS_URL = "https://helpdesk.ggus.eu/#ticket/zoom/", "https://cmssst.web.cern.ch/siteStatus/detail.html?site="


def joined(separator: str, *parts: Column) -> Column:
    """The parts that are neither null nor empty, joined."""
    return F.array_join(F.filter(F.array(*[p.cast("string") for p in parts]), lambda p: p != ""), separator)


def chunk_facts(parents: DataFrame, separator: str = NUL, both_ways: bool = False) -> tuple[DataFrame, DataFrame]:
    """Chunk nodes of parents (node_id, text, heading), and what contains them (``both_ways``: member_of, too)."""
    headed = parents.select(F.to_json(F.struct("node_id", "heading")).alias("_parent"), "text")
    rows = G.chunks(headed, "_parent", "text").withColumn("_p", F.from_json("_parent", "struct<node_id:string,heading:string>"))
    rows = rows.select(F.col("_p.node_id").alias("parent"), F.col("_p.heading").alias("heading"), "idx", "char_offset", "char_end", "chunk")
    rows = rows.withColumn("node_id", G.chunk_id(F.col("parent"), F.col("idx"), F.col("chunk"), separator))
    made = nodes(rows, F.col("node_id"), "document_chunk", "char_offset", "char_end", text=F.col("chunk"), content_sha256=F.sha2("chunk", 256), char_length=F.length("chunk"), heading_path=F.col("heading"))
    held = edges(rows, F.col("parent"), F.col("node_id"), "contains", chunk_index=F.col("idx"))
    return made, held.unionByName(edges(rows, F.col("node_id"), F.col("parent"), "member_of", chunk_index=F.col("idx"))) if both_ways else held


def text_references(chunks: DataFrame, known: DataFrame, services: DataFrame | None = None) -> DataFrame:
    """``references`` edges from chunk nodes to the known nodes (node_id) that their texts name, of six kinds.

    Only identifiers that are known make an edge; a host leads to every service of its alias.
    """
    text = F.try_element_at("attrs", F.lit("text"))
    kinds = (("site", "site", "cms_site"), ("release", "cmssw_release", "cmssw_release"), ("issue", "jira", "jira_issue"), ("dataset", "dataset", "dbs_dataset"), ("global_tag", "global_tag", "conditions_global_tag"))

    def found_of(kind: str, prefix: str, match: str) -> Column:
        return F.transform(T.mentions(text, kind), lambda v: F.struct(F.concat(F.lit(f"{prefix}:"), v).alias("dst"), F.lit(match).alias("match_type")))

    named = F.concat(*[found_of(*k) for k in kinds])
    found = chunks.select(F.col("node_id").alias("src"), F.explode(named).alias("_n")).select("src", "_n.dst", "_n.match_type")
    drawn = found.join(known.select(F.col("node_id").alias("dst")).distinct(), "dst", "left_semi").where("src <> dst").distinct()
    if services is not None:
        hosts = chunks.select("node_id", F.explode(T.mentions(text, "host")).alias("host"))
        drawn = drawn.unionByName(I.service_links(hosts, services).withColumn("match_type", F.lit("infrastructure_service")))
    return edges(drawn, F.col("src"), F.col("dst"), "references", match_type=F.col("match_type"))


# -- issues ------------------------------------------------------------------------------


def issue_text(issues: DataFrame) -> DataFrame:
    """node_id, text and heading of issues: the labelled parts that are not empty, a blank line between them.

    Lists are arrays; columns that the table lacks count as empty.
    """
    def part(label: str, joint: str | None) -> Column:
        column = "parent_key" if label == "parent" else label
        value = F.lit("") if column not in issues.columns else F.coalesce(F.array_join(column, joint) if joint else F.col(column), F.lit(""))
        return F.when(value != "", F.concat(F.lit(f"{label}: "), value)).otherwise("")

    return issues.select(prefixed("jira", "key").alias("node_id"), joined("\n\n", *[part(*p) for p in ISSUE_PARTS]).alias("text"), F.coalesce("summary", F.lit("")).alias("heading"))


# -- pages -------------------------------------------------------------------------------


def wiki_facts(topics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Wiki pages with their chunks, and references between known pages.

    ``topics``: page_id, web_name, web_root, title, url, body, author, last_modified,
    version, parent_topic, wiki_links, bare_wikiwords.  A page refers to another once, by
    the first kind that names it: its parent, a link, a bare word.
    """
    page = lambda c: F.concat(F.lit("twiki:"), F.replace(F.regexp_replace(c, r"\A/+|/+\z", ""), F.lit("/"), F.lit(":")))
    rows = topics.withColumn("node_id", page(F.col("page_id"))).withColumn("_ids", X.analysis_ids(F.col("title")))
    named = rows.select("node_id", F.explode(W.topic_references(F.col("parent_topic"), F.col("wiki_links"), F.col("bare_wikiwords"), F.col("web_name"), F.col("web_root"))).alias("r"))
    named = named.select("node_id", page(F.col("r.page")).alias("dst"), "r.priority", "r.kind").where("r.page <> '' and dst <> node_id")
    known = rows.select(F.col("node_id").alias("dst")).distinct()
    referred = first_by(named.join(known, "dst", "left_semi"), ["node_id", "dst"], F.col("priority"))
    text = joined(" ", F.col("title"), F.col("body"))
    made, held = chunk_facts(rows.select("node_id", text.alias("text"), F.col("title").alias("heading")), BACKSLASH_ZERO)
    header = X.analysis_forms(F.col("_ids"))
    return (
        together(nodes(rows, F.col("node_id"), "documentation_page", "title", "url", "web_name", "author", "last_modified", "parent_topic", "version", analysis_ids=F.array_join("_ids", ","), text=joined("\n", header, text)), made),
        together(edges(referred, F.col("node_id"), F.col("dst"), "references", kind=F.col("kind")), held),
    )


def physics_topics(topics: DataFrame) -> DataFrame:
    """Topics of a physics scope, with ``stage`` saying why each is kept.

    Operations topics go; topics that are physics by name are seeds, those whose parents
    lead to a seed follow, and of the rest those stay whose kind of page is kept.  A
    parent qualified by known webs is looked up by its bare name; cycles end.
    """
    rows = topics.where(~W.is_operations(F.col("title")))
    webs = rows.select(F.explode(F.concat(F.split("web_root", "/"), F.slice(F.split("page_id", "/"), F.lit(1), F.greatest(F.size(F.split("page_id", "/")) - 1, F.lit(0))))).alias("w")).where("w <> ''").distinct()
    # Webs are folders of the wiki: as many as its sections, not as its topics.
    parent = X.bare_parent(F.col("parent_topic"), sorted(r.w for r in webs.collect()))
    tree = rows.groupBy("title").agg(F.max_by(parent, "input_pos").alias("parent"))
    seeds = rows.where(W.is_physics(F.col("title"))).select("title").distinct()
    reached = G.reachable(tree.select(F.col("parent").alias("src"), F.col("title").alias("dst")), seeds.select(F.col("title").alias("node_id")))
    staged = rows.join(reached.select(F.col("node_id").alias("title"), "depth"), "title", "left")
    kind = W.page_kind(F.col("title"), F.col("parent_topic"))
    stage = F.when(F.col("depth") == 0, "seed").when(F.col("depth") > 0, "closure").when(kind.isin(*W.KEPT_KINDS), "page_kind")
    return staged.withColumn("stage", stage).where("stage is not null").select(*topics.columns, "stage")


def status_page(sites: DataFrame) -> DataFrame:
    """site, time and body of status pages: sites with time, alert, msg, ggus (ticket, opened) and today (metric to letters)."""
    words = F.create_map(*[F.lit(x) for pair in STATUS_WORDS.items() for x in pair])
    now = F.least(F.lit(95), X.status_bin(F.col("time"))).cast("int")

    def said(metric: str) -> Column:
        letters = F.try_element_at("today", F.lit(metric))
        word = lambda x: F.coalesce(F.try_element_at(words, x), F.concat(F.lit("unrecognised status code '"), x, F.lit("'")))
        here = F.when(F.length(letters) > now, F.substring(letters, now + 1, F.lit(1))).otherwise("u")
        none = "no downtime at the snapshot time" if metric == "Downtime" else "no manual override set at the snapshot time"
        standing = F.when(here != "u", F.concat(word(here), F.lit(", at the snapshot time"))).otherwise(none)
        latest = F.regexp_extract(F.substring(letters, F.lit(1), now + 1), r"([^u])u*\z", 1)
        evaluated = F.when(latest != "", F.concat(word(latest), F.lit(", latest evaluation"))).otherwise("unknown (no evaluation yet today)")
        return F.when(letters.isNull(), "not reported on the page").otherwise(standing if metric == "Downtime" or metric.startswith("man") else evaluated)

    head = F.concat("site", F.lit(" current site status from the CMS Site Support Team (CMS SST) site status page."))
    metrics = [F.concat(F.lit(f"{label}: "), said(metric), F.lit(".")) for metric, label in STATUS_METRICS]
    ticket = F.transform("ggus", lambda g: F.concat(g["ticket"].cast("string"), F.lit(" (opened "), X.epoch_date(g["opened"]), F.lit(f", {TICKET_URL}"), g["ticket"].cast("string"), F.lit(")")))
    tickets = F.concat(F.lit("GGUS tickets listed for "), "site", F.lit(": "), F.when(F.size("ggus") > 0, F.array_join(ticket, ", ")).otherwise("none"), F.lit("."))
    notes = [F.when(F.col(c) != "", F.concat(F.lit(f"{label}: "), c)) for c, label in (("alert", "Alert"), ("msg", "Message"))]
    body = joined("\n", head, *metrics, tickets, *notes, F.concat(F.lit(f"Source: {STATUS_URL}"), "site"))
    return sites.select("site", "time", body.alias("body"))


def status_facts(sites: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Status pages with chunks, and their reference to the site, if it is known (name)."""
    rows = status_page(sites).withColumn("node_id", F.concat(F.lit("documentation_page:cmssst:"), "site")).withColumn("title", F.concat("site", F.lit(" site status")))
    made, held = chunk_facts(rows.select("node_id", F.col("body").alias("text"), F.col("title").alias("heading")))
    of = rows.join(known.select(F.col("name").alias("site")).distinct(), "site", "left_semi")
    return (
        together(nodes(rows, F.col("node_id"), "documentation_page", "title", "body", record_kind=F.lit("cmssst_site_status"), observed_at=X.epoch_iso(F.col("time"))), made),
        together(edges(of, F.col("node_id"), prefixed("site", "site"), "references", match_type=F.lit("cmssst_site_status")), held),
    )


# -- forum -------------------------------------------------------------------------------


def forum_threads(pages: DataFrame) -> DataFrame:
    """Threads of saved forum pages (forum, thread, url, title, html): body, author, date and replies read from the markup."""
    html = F.coalesce("html", F.lit(""))
    return pages.select(
        F.concat(F.lit("hn:"), "forum", F.lit("/"), "thread").alias("node_id"), "forum", "url", T.no_nul(F.col("title")).alias("title"),
        X.forum_body(html).alias("body"), X.forum_author(html).alias("author"), X.forum_date(html).alias("date"), X.forum_replies(html).cast("long").alias("reply_count"),
    )


def forum_facts(threads: DataFrame) -> tuple[DataFrame, DataFrame]:
    text = joined(" ", F.col("title"), F.col("body"))
    made, held = chunk_facts(threads.select("node_id", text.alias("text"), F.col("title").alias("heading")))
    return together(nodes(threads, F.col("node_id"), "forum_thread", "title", "url", "forum", "author", "date", "reply_count", text=text), made), held


# -- meetings ----------------------------------------------------------------------------

_PERSON = "struct<fullName:string,first_name:string,last_name:string,affiliation:string,familyName:string,firstName:string,name:string>"
_FILE = "struct<download_url:string,url:string,filename:string,title:string,content_type:string,size:bigint,type:string,is_protected:boolean>"
_DAY = "struct<date:string,time:string>"
TALK = (
    f"struct<id:string,db_id:string,contributionId:string,title:string,description:string,url:string,room:string,session:string,startDate:{_DAY},endDate:{_DAY},"
    f"speakers:array<{_PERSON}>,presenters:array<{_PERSON}>,folders:array<struct<is_protected:boolean,attachments:array<{_FILE}>>>,attachments:struct<files:array<{_FILE}>>,entryType:string>"
)
EVENT = (
    f"struct<title:string,url:string,description:string,startDate:{_DAY},endDate:{_DAY},type:string,event_type:string,category:string,categoryId:string,speakers:array<{_PERSON}>,creators:array<{_PERSON}>,"
    f"chairs:array<{_PERSON}>,folders:array<struct<attachments:array<{_FILE}>>>,_pdf_texts:array<struct<text:string,title:string,filename:string,url:string,download_url:string>>,_contributions_text:string>"
)
#: How deep the session blocks of a timetable may nest.
NESTED = 4
RENDERABLE = ("image/png", "image/jpeg", "application/pdf")


def _empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def _people(people: Column) -> Column:
    """The names of people, full or first and last, without empty ones."""
    name = lambda p: F.trim(F.coalesce(F.nullif(p["fullName"], F.lit("")), F.concat_ws(" ", _empty(p["first_name"]), _empty(p["last_name"]))))
    return F.filter(F.transform(F.coalesce(people, F.array().cast(f"array<{_PERSON}>")), name), lambda n: n != "")


def _link(file: Column) -> Column:
    return F.coalesce(F.nullif(file["download_url"], F.lit("")), F.nullif(file["url"], F.lit("")))


def absolute(url: Column, base: str) -> Column:
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def events(exported: DataFrame, base: str) -> DataFrame:
    """Meetings of exported events (event_id, item: EVENT): an event_id once, the first one."""
    rows = first_by(exported, ["event_id"], F.col("input_pos"))
    item = lambda c: F.col(f"item.{c}")
    files = F.flatten(F.transform(F.coalesce(item("folders"), F.array().cast(f"array<struct<attachments:array<{_FILE}>>>")), lambda f: F.coalesce(f["attachments"], F.array().cast(f"array<{_FILE}>"))))
    speakers = F.when(F.size(item("speakers")) > 0, item("speakers")).otherwise(item("creators"))
    plain = lambda c: T.strip(F.regexp_replace(F.regexp_replace(_empty(c), "<[^>]+>", " "), r"\s+", " "))
    return rows.select(
        F.concat(F.lit("meeting_minutes:"), "event_id").alias("node_id"), "event_id", T.no_nul(_empty(item("title"))).alias("title"),
        F.coalesce(F.nullif(item("url"), F.lit("")), F.concat(F.lit(f"{base}/event/"), "event_id", F.lit("/"))).alias("url"), plain(item("description")).alias("description"),
        _empty(item("startDate.date")).alias("date"), _empty(item("endDate.date")).alias("end_date"), F.coalesce(F.nullif(item("type"), F.lit("")), item("event_type"), F.lit("")).alias("event_type"),
        _empty(item("category")).alias("category"), item("categoryId").try_cast("long").alias("category_id"), _people(speakers).alias("speakers"), _people(item("chairs")).alias("chairs"),
        F.filter(F.transform(files, _link), lambda u: u.isNotNull()).alias("attachment_urls"), _empty(item("_contributions_text")).alias("contributions_text"), F.col("item._pdf_texts").alias("pdfs"),
    )


def meeting_facts(meetings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Meetings, the texts attached to them and their chunks."""
    listed = lambda label, c: F.when(F.size(c) > 0, F.concat(F.lit(f"{label}: "), F.array_join(c, ", ")))
    text = joined(" ", F.col("title"), F.col("category"), F.col("description"), F.col("contributions_text"), listed("Speakers", "speakers"), listed("Chairs", "chairs"))
    label = F.coalesce(F.nullif("title", F.lit("")), F.concat(F.lit("Indico event "), "event_id"))
    pdfs = meetings.select("node_id", "event_id", F.col("title").alias("meeting"), F.posexplode("pdfs").alias("n", "p")).where(_empty(F.col("p.text")) != "")
    number = (F.col("n") + 1).cast("string")
    docs = pdfs.select(
        "node_id", "meeting", F.concat(F.lit("doc:indico:event/"), "event_id", F.lit("/pdf/"), F.col("n").cast("string")).alias("doc_id"), F.concat(F.lit("event/"), "event_id", F.lit("/pdf/"), F.col("n").cast("string"), F.lit(".pdf")).alias("path"),
        T.no_nul(F.col("p.text")).alias("text"), F.coalesce(F.nullif("p.title", F.lit("")), F.nullif("p.filename", F.lit("")), F.concat(F.lit("Indico event "), "event_id", F.lit(" PDF "), number)).alias("doc_title"),
    )
    made, held = chunk_facts(docs.select(F.col("doc_id").alias("node_id"), "text", F.col("meeting").alias("heading")), BACKSLASH_ZERO, both_ways=True)
    return (
        together(
            nodes(meetings, F.col("node_id"), "meeting_minutes", "title", "url", "date", "end_date", "event_type", "category", "category_id", label=label, speakers=F.array_join("speakers", "; "), chairs=F.array_join("chairs", "; "), attachment_urls=F.array_join("attachment_urls", " "), text=text),
            nodes(docs, F.col("doc_id"), "document", "path", title=F.col("doc_title"), repo=F.lit("indico"), format=F.lit("pdf"), content_sha256=F.sha2("text", 256), byte_count=F.octet_length("text")),
            made,
        ),
        together(edges(docs, F.col("node_id"), F.col("doc_id"), "contains", relationship=F.lit("indico_pdf_attachment")), held),
    )


def timetable(payloads: DataFrame) -> DataFrame:
    """Talks (event_id, item: TALK as JSON, session) of timetables (event_id, payload), each talk once in page order.

    Days hold entries, a session block nests its talks up to ``NESTED`` deep; breaks are
    no talks.  A talk's session is the title of the outermost block around it.
    """
    entries = "map<string,string>"
    days = payloads.select("event_id", F.coalesce(F.call_function("get_json_object", F.col("payload"), F.concat(F.lit("$.results['"), F.col("event_id"), F.lit("']"))), F.try_element_at(F.map_values(F.from_json(F.get_json_object("payload", "$.results"), entries)), F.lit(1))).alias("d"))
    level = days.select("event_id", F.posexplode(F.map_values(F.from_json("d", entries))).alias("_day", "day"))
    level = level.select("event_id", "_day", F.posexplode(F.map_values(F.from_json("day", entries))).alias("_at", "raw"))
    title = F.trim(_empty(F.get_json_object("raw", "$.title")))
    level = level.select("event_id", F.array("_day", "_at").alias("order"), "raw", F.when(F.get_json_object("raw", "$.entryType") == "Session", title).otherwise("").alias("session"))
    parts = []
    for depth in range(NESTED):
        parts.append(level)
        if depth + 1 < NESTED:
            level = level.select("event_id", "order", "session", F.posexplode(F.map_values(F.from_json(F.get_json_object("raw", "$.entries"), entries))).alias("_k", "raw"))
            level = level.select("event_id", F.concat("order", F.array("_k")).alias("order"), "raw", "session")
    every = together(*parts).withColumn("kind", F.get_json_object("raw", "$.entryType"))
    talk_id = F.trim(F.coalesce(F.nullif(F.get_json_object("raw", "$.contributionId"), F.lit("")), F.get_json_object("raw", "$.id"), F.lit("")))
    talks = every.where("kind = 'Contribution' or (coalesce(kind, '') <> 'Break' and get_json_object(raw, '$.contributionId') is not null)").withColumn("talk_id", talk_id).where("talk_id <> ''")
    return first_by(talks.select("event_id", "talk_id", "order", "raw", "session"), ["event_id", "talk_id"], F.col("order"))


def unrenderable(file: Column, url: Column, max_bytes: int, protected: Column) -> Column:
    """Why an attachment is not shown as an image, null if it can be."""
    kind = F.lower(F.trim(F.substring_index(_empty(file["content_type"]), ";", 1)))
    name = F.lower(F.coalesce(F.nullif(file["filename"], F.lit("")), F.nullif(file["title"], F.lit("")), F.substring_index(url, "?", 1)))
    bad_url = ~url.startswith("https://") | url.rlike(r"/\.\.(?:/|\z)|\\|%5[cC]|\s") | F.contains(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("@"))
    return (
        F.when(F.coalesce(file["is_protected"], F.lit(False)) | protected, "protected")
        .when(F.coalesce(file["type"], F.lit("file")) != "file", "not_a_file")
        .when(file["size"] > max_bytes, "too_large")
        .when(F.when(kind != "", ~kind.isin(*RENDERABLE)).otherwise(~name.rlike(r"\.(png|jpg|jpeg|pdf)\z")), "not_renderable")
        .when(bad_url, "url_refused")
    )


def talks(contributions: DataFrame, base: str, image_limit: int = 0, max_bytes: int = 10_000_000) -> DataFrame:
    """Talks of meetings: (event_id, item: TALK, session) in ``input_pos`` order, each id once.

    The two exports name things differently (speakers or presenters, folders or files);
    both are read.  ``db_id`` names a talk where there is one.
    """
    rows = contributions.withColumn("talk_id", F.trim(F.coalesce(F.nullif("item.db_id", F.lit("")), F.nullif("item.id", F.lit("")), F.col("item.contributionId"), F.lit("")))).where("talk_id <> ''")
    rows = first_by(rows.select("event_id", "talk_id", "input_pos", "item", "session"), ["event_id", "talk_id"], F.col("input_pos"))
    none = F.array().cast(f"array<{_PERSON}>")
    people = F.concat(F.coalesce("item.speakers", none), F.coalesce("item.presenters", none))

    def named(p):
        full = F.trim(F.coalesce(F.nullif(p["fullName"], F.lit("")), _empty(p["name"])))
        parts = F.filter(F.array(F.trim(F.coalesce(F.nullif(p["first_name"], F.lit("")), _empty(p["firstName"]))), F.trim(F.coalesce(F.nullif(p["last_name"], F.lit("")), _empty(p["familyName"])))), lambda x: x != "")
        name = F.when(full != "", full).otherwise(F.array_join(parts, " "))
        place = F.trim(_empty(p["affiliation"]))
        return F.struct(name.alias("name"), F.when(place != "", F.concat(name, F.lit(" ("), place, F.lit(")"))).otherwise(name).alias("shown"))

    known = F.filter(F.transform(people, named), lambda p: p["name"] != "")
    once = F.filter(known, lambda p, k: ~F.exists(F.slice(known, F.lit(1), k), lambda q: q["name"] == p["name"]))
    file = f"array<struct<file:{_FILE},protected:boolean>>"
    of_folders = F.flatten(F.transform(F.coalesce("item.folders", F.array().cast(f"array<struct<is_protected:boolean,attachments:array<{_FILE}>>>")), lambda f: F.transform(F.coalesce(f["attachments"], F.array().cast(f"array<{_FILE}>")), lambda a: F.struct(a.alias("file"), F.coalesce(f["is_protected"], F.lit(False)).alias("protected"))))).cast(file)
    direct = F.transform(F.coalesce("item.attachments.files", F.array().cast(f"array<{_FILE}>")), lambda a: F.struct(a.alias("file"), F.lit(False).alias("protected"))).cast(file)
    held = F.transform(F.filter(F.concat(of_folders, direct), lambda x: _link(x["file"]).isNotNull()), lambda x: F.struct(absolute(_link(x["file"]), base).alias("url"), F.coalesce(F.nullif(x["file"]["filename"], F.lit("")), x["file"]["title"], F.lit("")).alias("name"), unrenderable(x["file"], absolute(_link(x["file"]), base), max_bytes, x["protected"]).alias("why")))
    files = F.filter(held, lambda x, k: ~F.exists(F.slice(held, F.lit(1), k), lambda y: y["url"] == x["url"]))
    about = X.field_text(F.col("item.description"))
    spoken = X.field_text(F.col("item.title"))
    title = F.when(spoken != "", spoken).when(about != "", F.rtrim(F.substring(about, 1, 80))).otherwise(F.concat(F.lit("Contribution "), "talk_id"))
    when = lambda c: F.concat_ws("T", F.nullif(F.trim(_empty(F.col(f"item.{c}.date"))), F.lit("")), F.nullif(F.trim(_empty(F.col(f"item.{c}.time"))), F.lit("")))
    rows = rows.withColumn("_files", files).withColumn("_people", once)
    images = F.slice(F.transform(F.filter("_files", lambda f: f["why"].isNull()), lambda f: f["url"]), 1, image_limit)
    url = F.coalesce(F.nullif("item.url", F.lit("")), F.concat(F.lit("/event/"), "event_id", F.lit("/contributions/"), "talk_id", F.lit("/")))
    return rows.select(
        F.concat(F.lit("meeting_minutes:"), "event_id", F.lit(":contribution:"), "talk_id").alias("node_id"), "event_id", "talk_id", title.alias("title"), about.alias("description"), absolute(url, base).alias("url"),
        when("startDate").alias("date"), when("endDate").alias("end_date"), X.field_text(F.col("session")).alias("session"), F.trim(F.substring_index(_empty(F.col("item.room")), " - ", 1)).alias("room"),
        F.transform("_people", lambda p: p["name"]).alias("speakers"), F.transform("_people", lambda p: p["shown"]).alias("shown"), F.transform("_files", lambda f: f["url"]).alias("attachment_urls"),
        F.transform("_files", lambda f: f["name"]).alias("attachment_names"), images.alias("image_urls"),
        F.size(F.filter("_files", lambda f: f["why"] == "url_refused")).alias("images_refused"),
    )


def talk_facts(given: DataFrame, meetings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Talks as meetings of their own, contained by the meeting that they are part of."""
    of = given.join(meetings.select("event_id", F.col("node_id").alias("meeting_id"), F.col("title").alias("meeting"), "category"), "event_id")
    names = F.filter("attachment_names", lambda n: n != "")
    said = lambda c, label, end=".": F.when(_empty(F.col(c)) != "", F.concat(F.lit(label), c, F.lit(end)))
    text = joined(
        " ", F.col("title"), said("meeting", "Part of "), said("session", "Session: "), F.when(F.size("shown") > 0, F.concat(F.lit("Speakers: "), F.array_join("shown", "; "))), F.col("description"),
        F.when(F.size(names) > 0, F.concat(F.lit("Attachments: "), F.array_join(names, ", "))),
    )
    return (
        nodes(of, F.col("node_id"), "meeting_minutes", "title", "url", "date", "end_date", "category", "session", "room", event_type=F.lit("contribution"), speakers=F.array_join("speakers", "; "), attachment_urls=F.array_join("attachment_urls", " "), attachment_images=F.array_join("image_urls", " "), parent_event_id=F.col("event_id"), text=text),
        edges(of, F.col("meeting_id"), F.col("node_id"), "contains", relationship=F.lit("indico_contribution")),
    )


# -- sites, repositories, reports --------------------------------------------------------


def site_configs(files: DataFrame) -> DataFrame:
    """site_name, protocols and endpoints of storage descriptions (site_name, raw): a list of entries or one entry.

    A site may have several files; texts that are no JSON add nothing.
    """
    entry = "struct<protocol:string,se:string,endpoint:string>"
    trimmed = F.trim("raw")
    listed = F.when(trimmed.startswith("["), F.from_json("raw", "array<string>")).when(trimmed.startswith("{"), F.array(trimmed))
    each = files.select("site_name", F.explode_outer(listed).alias("e")).select("site_name", F.when(F.col("e").startswith("{"), F.from_json("e", entry)).alias("e"))
    return each.groupBy("site_name").agg(
        F.array_sort(F.collect_set(F.nullif("e.protocol", F.lit("")))).alias("storage_protocols"),
        F.array_sort(F.collect_set(F.coalesce(F.nullif("e.se", F.lit("")), F.nullif("e.endpoint", F.lit(""))))).alias("se_endpoints"),
    )


def site_config_facts(configs: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Site configurations, contained by their site where it is known (name)."""
    protocols = F.when(F.size("storage_protocols") > 0, F.concat(F.lit("Protocols: "), F.array_join("storage_protocols", ", ")))
    ends = F.when(F.size("se_endpoints") > 0, F.concat(F.lit("SE: "), F.array_join(F.slice("se_endpoints", 1, 5), ", ")))
    text = joined("\n", F.concat(F.lit("SITECONF for "), "site_name"), protocols, ends)
    of = configs.join(known.select(F.col("name").alias("site_name")).distinct(), "site_name", "left_semi")
    me = prefixed("siteconf", "site_name")
    return nodes(configs, me, "site_config", "site_name", storage_protocols=F.array_join("storage_protocols", ","), se_endpoints=F.array_join("se_endpoints", ","), text=text), edges(of, prefixed("site", "site_name"), me, "contains")


def repo_facts(slugs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two identities of each repository (slug) and the reference between them; repeats are dropped."""
    rows = slugs.select(F.trim("slug").alias("slug")).where("slug <> ''").distinct()
    url = F.concat(F.lit("https://github.com/"), "slug")
    return (
        together(nodes(rows, prefixed("software_repository", "slug"), "software_repository", "slug", url=url), nodes(rows, prefixed("repo", "slug"), "repo", "slug", url=url)),
        edges(rows, prefixed("software_repository", "slug"), prefixed("repo", "slug"), "references"),
    )


def report_facts(records: DataFrame) -> DataFrame:
    """Report nodes of harvested records (oai_id, title, identifiers, creators, deleted): the first of an id, no deleted ones.

    The first report number with an analysis code names the report, else the first one.
    """
    rows = first_by(records.where("not deleted"), ["oai_id"], F.col("input_pos"))
    numbers = F.filter(F.transform("identifiers", X.report_number), lambda n: n.isNotNull())
    raw = F.filter("identifiers", lambda i: X.report_number(i).isNotNull())
    rows = rows.withColumns({"_n": numbers, "_raw": raw})
    codes = F.array_distinct(F.filter(F.transform("_n", lambda n: n["analysis_code"]), lambda c: c != ""))
    first = F.coalesce(F.try_element_at(F.filter("_raw", lambda i: X.report_number(i)["analysis_code"] != ""), F.lit(1)), F.try_element_at("_raw", F.lit(1)), F.lit(""))
    recid = F.regexp_extract("oai_id", r"(\d+)\z", 1)
    return nodes(rows, F.concat(F.lit("cds:"), recid), "cds_record", "title", creators=F.array_join("creators", "; "), report_number=F.trim(first), analysis_codes=F.array_join(codes, ","))
