"""What crawls decide, without their network: sitemaps, bounces, missing pages, seeds, caches, filters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from graphloom.functions.scalars import is_login_page, wiki_page_of_url, wiki_view_url
from graphloom.operators import graph as G

#: Hosts that only log people in.
LOGIN_HOSTS = ("auth.cern.ch", "login.cern.ch")


def sitemap_urls(xml: Column) -> Column:
    """The addresses that a sitemap lists, in order."""
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?s)<(?:\w+:)?loc\b[^>]*>\s*(.*?)\s*</(?:\w+:)?loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def is_html(content_type: Column) -> Column:
    """Whether a response is a page; one that names no type is taken for one."""
    kind = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return kind.isin("", "text/html", "application/xhtml+xml")


def login_bounce(asked: Column, landed: Column, text: Column) -> Column:
    """Whether a fetch ended at a login: by the host it landed on, or redirected to a page that reads as one."""
    host = F.lower(F.regexp_extract(landed, r"://(?:[^@/?#]*@)?([^:/?#]*)", 1))
    return host.isin(*LOGIN_HOSTS) | ((landed != "") & (landed != asked) & is_login_page(F.substring(text, 1, 2000)))


def missing_topic(landed: Column, body: Column) -> Column:
    """Whether a wiki answered that a topic does not exist."""
    path = F.lower(F.regexp_replace(F.regexp_replace(landed, r"(?s)[?#].*\z", ""), r"\A[a-zA-Z][\w+.-]*://[^/]*", ""))
    text = F.lower(body)
    named = F.contains(text, F.lit("topicdoesnotexist")) | F.contains(text, F.lit("oopsmissing"))
    return F.contains(path, F.lit("/bin/oops/")) | (~F.contains(text, F.lit("%meta:topicinfo")) & named)


def seed_page(seed: Column) -> Column:
    """The page of a crawl's seed, an address or ``Web.Topic``; null for one that names no web."""
    plain = F.trim(seed)
    page = F.when(F.contains(plain, F.lit("://")), wiki_page_of_url(wiki_view_url(plain))).otherwise(F.regexp_replace(F.replace(plain, F.lit("."), F.lit("/")), r"\A/+|/+\z", ""))
    return F.when(F.contains(page, F.lit("/")), page)


def seeded(pages: DataFrame, links: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """page, depth and whether it is there, of what the seeds reach over links (src, dst) of known pages.

    A seed that is not there is told as missing; what is not there is not followed.
    """
    known = pages.select(F.col("page").alias("dst")).distinct()
    reached = G.reachable(links.join(known, "dst", "left_semi"), seeds.select(F.col("page").alias("node_id")), max_depth)
    return reached.join(known.select(F.col("dst").alias("node_id"), F.lit(True).alias("_there")), "node_id", "left").select(F.col("node_id").alias("page"), "depth", F.coalesce("_there", F.lit(False)).alias("present"))


def skip_reason(path: Column, size: Column, suffixes: list[str], fragments: list[str], max_bytes: int) -> Column:
    """Why a repository's file is left out, null if it is taken."""
    lower = F.lower(path)
    ending = F.lit(False)
    for suffix in suffixes:
        ending = ending | lower.endswith(suffix.lower())
    inside = F.lit(False)
    for fragment in fragments:
        inside = inside | F.contains(lower, F.lit(fragment.lower()))
    return F.when(~ending, "suffix").when(inside, "path_fragment").when(size > max_bytes, "too_large")


def page_fresh(fetched: Column, now: Column, ttl_hours: float, cached_after: Column, after: Column) -> Column:
    """Whether a saved page may stand for a request: of the same day (UTC), young enough, and after the same key."""
    young = (F.unix_timestamp(now) - F.unix_timestamp(fetched)).between(0, int(ttl_hours * 3600))
    return F.coalesce((F.to_date(fetched) == F.to_date(now)) & young, F.lit(False)) & cached_after.eqNullSafe(after)


def source_of(cached: bool, token: str) -> str:
    """Where records come from: the export if there is one, else live, for which a token is needed."""
    if cached:
        return "cache"
    if not token:
        raise PermissionError("neither an export nor a token")
    return "live"


_STRING = re.compile(r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)\"""", re.S)
_BLANK = re.compile(r"""//[^\n]*|/\*.*?\*/""", re.S)


@F.udf(returnType=ArrayType(StringType()), useArrow=True)
def site_list(script):
    """The strings of the first array that a script assigns to a name holding ``site``; null without one.

    Comments are no strings, and brackets within strings do not end the array.
    """
    if script is None or not (start := re.search(r"\b\w*[sS]ite\w*\s*=\s*\[", script)):
        return None
    out, at = [], start.end()
    while at < len(script):
        if found := _BLANK.match(script, at):
            at = found.end()
        elif found := _STRING.match(script, at):
            out.append(re.sub(r"\\(.)", r"\1", found[1] if found[1] is not None else found[2]))
            at = found.end()
        elif script[at] == "]":
            return out
        else:
            at += 1
    return None


def harvested(pages: DataFrame, records: DataFrame, max_records: int | None = None) -> DataFrame:
    """Records of a paged harvest (oai_id, deleted, page): the first of an id counts, deleted ones go, up to a bound in page order."""
    from graphloom.operators.relational import first_by

    kept = first_by(records.where("not deleted"), ["oai_id"], F.col("page"))
    return kept if max_records is None else kept.orderBy("page", "oai_id").limit(max_records)


def cookie_verdict(files: DataFrame, domain: str, now: int, max_age: int | None = None) -> DataFrame:
    """path, cookies, live, expired, fresh and reason of saved cookie files (path, text, modified), without a network.

    Fresh is a file with a cookie of the domain that has not expired, or that lasts for
    a session, and that is no older than ``max_age`` seconds.
    """
    lines = F.filter(F.split("text", r"\r?\n"), lambda x: (F.trim(x) != "") & (~x.startswith("#") | x.startswith("#HttpOnly_")))
    fields = F.transform(lines, lambda x: F.split(F.regexp_replace(x, r"\A#HttpOnly_", ""), "\t"))
    broken = F.exists(fields, lambda f: F.size(f) != 7) | ~F.col("text").rlike(r"(?i)\A#.*cookie file")
    own = F.filter(fields, lambda f: f[0].endswith(domain))
    ends = F.transform(own, lambda f: f[4].try_cast("long"))
    session, live = F.size(F.filter(ends, lambda e: e.isNull() | (e == 0))), F.size(F.filter(ends, lambda e: e > now))
    rows = files.select("path", (F.lit(now) - F.col("modified")).alias("_age"), broken.alias("_broken"), F.size(own).alias("cookies"), (session + live).alias("live"), F.size(F.filter(ends, lambda e: (e != 0) & (e <= now))).alias("expired"))
    old = F.lit(False) if max_age is None else F.col("_age") > max_age
    reason = (
        F.when(F.col("_broken"), "cookie file could not be parsed").when(F.col("cookies") == 0, f"cookie file has no cookies for domain {domain}")
        .when(F.col("live") == 0, F.concat(F.lit("all "), F.col("cookies").cast("string"), F.lit(" cookies are expired"))).when(old, "cookie file is older than max age").otherwise(F.concat(F.col("live").cast("string"), F.lit(" live cookies")))
    )
    return rows.select("path", "cookies", "live", "expired", (~F.col("_broken") & (F.col("live") > 0) & ~old).alias("fresh"), reason.alias("reason"))
