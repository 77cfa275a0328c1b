"""Wiki markup as Column expressions: text with its fidelity flags, metadata, links, page kinds."""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from graphloom.functions.scalars import topic_page
from graphloom.functions.text import SPACE, no_nul, strip

#: File names of a wiki that are not topics.
STRUCTURAL = (
    r"^[0-9]+\.txt$",
    r"^[0-9]{6,8}[A-Za-z]",
    r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}",
    r"-replies\.txt$",
    r"^[a-z]",
    r"^Web(Atom|Changes|CreateNewTopic|Index|LeftBar|Notify|Preferences|Rss|Search|SearchAdvanced|Statistics|TopicCreator|TopicEditTemplate|TopicList|TopMenu|BottomBar)\.txt$",
    r"^(LastViewedTopics|TWeederSummaryViews|SearchResults)\.txt$",
)
#: Topic names that are physics by themselves, and those that are operations.
PHYSICS = (
    r"^(HIG|TOP|SUS|SMP|B2G|BPH|BTV|EXO|FTR|HIN|JME|MUO|TAU|TRK|EGM|PPS|FSQ)[-_]?[0-9]",
    r"^(Muon|Egamma|JetMET|BTag|Tau|Tracking|Trigger|AlCa)",
    r"^(Higgs|SUSY|Exotica|WorkBook|PhysicsResults|StandardModel|HeavyIons|HeavyFlavor|SWGuidePhysics|Top[A-Z0-9])",
)
OPERATIONS = r"^(CompOps|WMCore|DataOps|SiteReadiness|SiteStatus)"
#: What a title says of its page, the first that fits; and the kinds that are kept.
PAGE_KINDS = (
    (r"^HowTo[A-Z0-9]", "howto"),
    (r"(?i)(FAQ|FrequentlyAsked)", "faq"),
    (r"(?i)(Glossary|Acronym|Abbreviat|Terminolog)", "glossary"),
    (r"(?i)^Tutorial", "tutorial"),
    (r"^(Overview|Introduction)[A-Z0-9]?", "overview"),
    (r"(?i)(SiteMap|TopicMap|TopicTree)", "topicmap"),
    (r"(?i)Reference$", "reference"),
    (r"^(HIG|TOP|SUS|SMP|B2G|BPH|BTV|EXO|FTR|HIN|JME|MUO|TAU|TRK|EGM|PPS|FSQ)[\-_]?\d{2,}([\-_]?\d{2,})?", "analysis"),
    (r"(?i)(Minutes$|Meeting|Weekly|Daily)", "meeting_minutes"),
    (r"^Web(Home|Index|TopicList)$", "web_page"),
)
KEPT_KINDS = ("analysis", "howto", "faq", "tutorial", "glossary", "overview", "reference", "meeting_minutes")


def is_topic(file_name: Column) -> Column:
    """Whether a file holds a topic rather than the wiki's own structure."""
    return ~file_name.rlike("|".join(f"(?:{p})" for p in STRUCTURAL))


def is_physics(topic: Column) -> Column:
    return topic.rlike("|".join(f"(?:{p})" for p in PHYSICS))


def is_operations(topic: Column) -> Column:
    return topic.rlike(OPERATIONS)


def page_kind(title: Column, parent: Column) -> Column:
    """What kind of page a title, or else its parent's, names; ``other`` without a sign."""
    out = F.when(parent.rlike("(?i)(Weekly|Daily|Minutes|Agenda)"), "meeting_minutes").otherwise("other")
    for pattern, kind in reversed(PAGE_KINDS):
        out = F.when(title.rlike(pattern), kind).otherwise(out)
    return out


# -- text --------------------------------------------------------------------------------

_TABLE = re.compile(r"(?is)<table\b.*?</table>")
_ROW = re.compile(r"(?is)<tr\b[^>]*>(.*?)</tr>")
_CELL = re.compile(r"(?is)<(t[hd])\b[^>]*>(.*?)</\1>")
_IMAGE = re.compile(r"(?i)<img\b[^>]*>")
_ATTRIBUTE = re.compile(r"""(?i)(?<![-\w:.])(src|alt)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")


def _plain(text: str) -> str:
    return " ".join(text.split())


@F.udf(returnType=StringType(), useArrow=True)
def pipe_tables(text):
    """Markup tables as rows of cells between bars, the first row ruled off; a table without cells is a blank."""
    if text is None:
        return None

    def piped(found: re.Match) -> str:
        rows = [[_plain(unescape(re.sub(r"<[^>]+>", " ", c[2]))) for c in _CELL.finditer(r[1])] for r in _ROW.finditer(found[0])]
        lines = ["| " + " | ".join(r) + " |" for r in rows if r]
        if lines:
            first = next(r for r in rows if r)
            lines.insert(1, "|" + " --- |" * len(first))
        return "\n" + ("\n".join(lines) or " ") + "\n"

    return _TABLE.sub(piped, text)


@F.udf(returnType=StringType(), useArrow=True)
def marked_images(text):
    """Image tags as ``![alt](src)``; one without a source is a blank."""
    if text is None:
        return None

    def marked(found: re.Match) -> str:
        named = {m[1].lower(): unescape(m[2].strip("\"'")) for m in _ATTRIBUTE.finditer(found[0])}
        return f"![{_plain(named.get('alt', ''))}]({named['src']})" if named.get("src") else " "

    return _IMAGE.sub(marked, text)


def strip_markup(text: Column, headings: str = "drop", lines: str = "collapse", tables: bool = False, images: bool = False, link_urls: str = "drop") -> Column:
    """A topic's text without its markup.

    ``headings``: ``drop`` leaves their titles, ``markdown`` leads them with ``#``.
    ``lines``: ``collapse`` makes one line, ``preserve`` keeps lines and single blank ones.
    ``tables`` and ``images`` keep markup tables and images in text form; ``link_urls``:
    ``keep`` writes a labelled web link as ``label (URL)``.
    """
    for value, known in ((headings, ("drop", "markdown")), (lines, ("collapse", "preserve")), (link_urls, ("drop", "keep"))):
        if value not in known:
            raise ValueError(f"{value!r} is none of {known}")
    out = F.regexp_replace(text, r"%META:[^%]+%", " ")
    # What stands between the marks is a macro's arguments, without their quotes.
    out = F.regexp_replace(F.translate(out, "\x01\x02", "  "), r"%[A-Z][A-Z0-9_]*\{([^}]*)\}%", "\x01$1\x02")
    parts = F.transform(F.split(out, "[\x01\x02]"), lambda p, k: F.when(k % 2 == 1, F.replace(p, F.lit('"'), F.lit(" "))).otherwise(p))
    out = F.regexp_replace(F.array_join(parts, " "), r"%[A-Z][A-Z0-9_]*%", " ")
    if link_urls == "keep":
        out = F.regexp_replace(out, r"\[\[\s*((?i:https?)://[^\]\s]+)\s*\]\[\s*\1\s*\]\]", "$1")
        out = F.regexp_replace(out, r"\[\[\s*((?i:https?)://[^\]\s]+)\s*\]\[([^\]]+)\]\]", "$2 ($1)")
    out = F.regexp_replace(out, r"\[\[[^\]]+\]\[([^\]]+)\]\]", "$1")
    out = F.regexp_replace(out, r"\[\[([^\]]+)\]\]", "$1")
    out = F.regexp_replace(out, r"(?md)^---\+{1,6}!?[^\S\n]*(?:\n|\z)", "")
    if headings == "markdown":
        for level in range(6, 0, -1):
            more = "" if level == 6 else r"(?!\+)"
            out = F.regexp_replace(out, rf"(?md)^---\+{{{level}}}{more}!?[ \t]*([^\n]*?)[^\S\n]*$", "#" * level + " $1")
    else:
        out = F.regexp_replace(out, r"(?md)^---\+{1,6}!?[ \t]*", "")
    out = F.regexp_replace(out, r"(?i)</?(verbatim|pre|code|noautolink)>", " ")
    out = pipe_tables(out) if tables else out
    out = marked_images(out) if images else out
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    out = F.regexp_replace(out, r"(?U)(?<![\w=])=([^=\s\n][^=\n]*[^=\s\n])=(?![\w=])", "$1")
    out = no_nul(F.regexp_replace(out, r"(?U)(?<=\s)[*_]([^*_\s][^*_]*[^*_\s])[*_](?=\s)", "$1"))
    if lines == "collapse":
        return strip(F.regexp_replace(out, f"{SPACE}+", " "))
    each = F.transform(F.split(out, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " ")))
    return strip(F.regexp_replace(F.array_join(each, "\n"), r"\n{3,}", "\n\n"))


# -- metadata and links ------------------------------------------------------------------


def meta(text: Column) -> Column:
    """author, last_modified, version and parent_topic of a topic's first metadata lines, empty where missing."""
    info = F.regexp_extract(text, r"(?i)%META:TOPICINFO\{([^}]*)\}%", 1)
    field = lambda name: F.coalesce(F.try_element_at(F.regexp_extract_all(info, F.lit(rf'\b{name}="([^"]*)"'), F.lit(1)), F.lit(-1)), F.lit(""))
    date = field("date")
    stamp = F.date_format(F.timestamp_seconds(date.try_cast("long")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    modified = F.when(date.rlike(r"\A\d+\z"), F.coalesce(stamp, date)).otherwise("")
    parent = F.regexp_extract(text, r'(?i)%META:TOPICPARENT\{[^}]*name="([^"]+)"[^}]*\}%', 1)
    return F.struct(field("author").alias("author"), modified.alias("last_modified"), field("version").alias("version"), parent.alias("parent_topic"))


def link_targets(text: Column) -> Column:
    """The sorted topics that explicit links name, with slashes for dots."""
    found = F.regexp_extract_all(text, F.lit(r"(?U)\[\[(?!https?://|mailto:|#|[A-Za-z]+:/)([A-Za-z][\w./]*?)(?:\]\[[^\]]*)?\]\]"), F.lit(1))
    plain = F.transform(found, lambda x: F.regexp_replace(F.replace(F.trim(x), F.lit("."), F.lit("/")), r"\A/+|/+\z", ""))
    return F.array_sort(F.array_distinct(F.filter(plain, lambda x: x != "")))


def bare_words(text: Column) -> Column:
    """The sorted wiki words outside metadata, macros, verbatim parts, links and addresses."""
    out = text
    for pattern in (
        r"%META:[^%]+%", r"%[A-Z][A-Z0-9_]*\{[^}]*\}%", r"(?is)<verbatim>.*?</verbatim>", r"(?is)<pre>.*?</pre>", r"(?s)<!--.*?-->", r"\[\[[^\]]+\]\]", r"https?://\S+",
    ):
        out = F.regexp_replace(out, pattern, " ")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(out, F.lit(r"(?<![A-Za-z./_])([A-Z][a-z]+(?:[A-Z][a-z]*)+)(?![a-z])"), F.lit(1))))


def topic_references(parent: Column, links: Column, words: Column, web: Column, root: Column) -> Column:
    """(priority, kind, page) of every page that a topic names: its parent, then links, then bare words."""
    each = lambda names, rank, kind: F.transform(names, lambda t: F.struct(F.lit(rank).alias("priority"), F.lit(kind).alias("kind"), topic_page(t, web, root).alias("page")))
    above = F.filter(F.array(parent), lambda p: p != "")
    return F.concat(each(above, 0, "topic_parent"), each(links, 1, "wiki_link"), each(words, 2, "bare_wikiword"))
