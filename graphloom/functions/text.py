"""Scalar text functions as Column expressions: cleaning, ids, mentions, versions, markup."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: What Python's strip removes, as a Java character class.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: The identifiers that documents mention, by kind.
MENTIONS = {
    "site": r"\bT[0-3]_[A-Z]{2}_[A-Za-z0-9_]+(?:_[A-Za-z0-9]+)?\b",
    "release": r"\bCMSSW_\d+_\d+_\d+(?:_[A-Za-z0-9_]+)?\b",
    "issue": r"\b[A-Z][A-Z0-9_]*-\d+\b",
    "dataset": r"(?<![\w/])/[A-Za-z0-9][A-Za-z0-9._-]*/[A-Za-z0-9][A-Za-z0-9._-]*/(?:AOD|AODSIM|MINIAOD|MINIAODSIM|NANOAOD|NANOAODSIM|RAW|RECO|GEN|GEN-SIM|GEN-SIM-RECO|GEN-SIM-DIGI-RAW|USER|ALCARECO|DQMIO)(?![\w/])",
    "global_tag": r"\b\d{2,3}X_[A-Za-z0-9]+(?:_[A-Za-z0-9]+)*\b",
    "host": r"(?<![\w.@-])(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?::\d{2,5})?(?![\w.-])",
}
#: Suffixes that name a storage element's role rather than its site.
STORAGE_SUFFIXES = ("_Tape", "_Disk", "_Buffer", "_Export", "_Test", "_MSS")


def strip(text: Column) -> Column:
    """Without white space at both ends, of every kind."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def lstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+", "")


def no_nul(text: Column) -> Column:
    """NUL characters become spaces, so offsets stay."""
    return F.translate(text, "\0", " ")


def digest16(text: Column) -> Column:
    """The first 16 hex digits of SHA-256: the form of content-derived ids."""
    return F.substring(F.sha2(text, 256), 1, 16)


def slug(text: Column) -> Column:
    """Lower-case letters, digits and single underscores; a digest if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "_"), r"\A_+|_+\z", "")
    return F.when(plain != "", plain).otherwise(digest16(text))


def mentions(text: Column, kind: str) -> Column:
    """The distinct identifiers of a kind, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("(?U)" + MENTIONS[kind]), F.lit(0))))


def storage_site(name: Column) -> Column:
    """The site of a storage element: its name without a role suffix."""
    return F.regexp_replace(name, f"({'|'.join(STORAGE_SUFFIXES)})$", "")


def host_of(endpoint: Column) -> Column:
    """The lower-case host of an endpoint or URL, without scheme, path and port."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(endpoint)), r"^[a-z][a-z0-9+.-]*://", ""), r"[/?#].*$", "")
    return F.regexp_replace(bare, r":\d+$", "")


def version_parts(label: Column) -> Column:
    """Major, minor and patch of a release label; null where it names none."""
    found = [F.regexp_extract(label, r"^CMSSW_(\d+)_(\d+)_(\d+)", k) for k in (1, 2, 3)]
    return F.when(found[0] != "", F.struct(*[x.try_cast("int").alias(n) for x, n in zip(found, ("major", "minor", "patch"))]))


def previous_version(name: Column) -> Column:
    """``x_vN`` to ``x_v(N-1)``; null for the first version and for names without one."""
    number = F.regexp_extract(name, r"_v(\d+)$", 1)
    before = number.try_cast("long") - 1
    return F.when((number != "") & (before >= 1), F.concat(F.regexp_replace(name, r"_v\d+$", "_v"), before.cast("string")))


def html_title(markup: Column) -> Column:
    return F.trim(F.regexp_replace(unescape(F.regexp_extract(markup, r"(?is)<title[^>]*>(.*?)</title>", 1)), r"\s+", " "))


def html_text(markup: Column) -> Column:
    """All text of a page: no scripts, styles, comments or tags; single spaces."""
    bare = F.regexp_replace(markup, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]+>", " ")
    return F.trim(F.regexp_replace(unescape(bare), r"\s+", " "))


def unescape(text: Column) -> Column:
    """The named references of markup itself; the ampersand last, so none is decoded twice."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def redact_emails(text: Column, mark: str = "") -> Column:
    """Mail addresses removed; ``git@host`` is a login and stays."""
    return F.regexp_replace(text, r"(?i)\b(?!git@)[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}\b", mark)


def redact_spelled_emails(text: Column, mark: str = "") -> Column:
    """Addresses spelled with (at) and (dot) in brackets removed."""
    return F.regexp_replace(text, r"(?i)[a-z0-9._%+-]+\s*[\[({]\s*at\s*[\])}]\s*[a-z0-9-]+(?:\s*(?:\.|[\[({]\s*dot\s*[\])}])\s*[a-z0-9-]+)+", mark)


def anonymise(text: Column, names: list[str], mark: str = "") -> Column:
    """Addresses, ``[~user]`` mentions, wiki signatures, greetings, sign-offs and the given names removed."""
    out = redact_spelled_emails(redact_emails(text, mark), mark)
    out = F.regexp_replace(out, r"\[~[^\]]+\]", mark)
    out = F.regexp_replace(out, r"(?m)^[ \t]*-{2,}[ \t]*(?:Main|TWiki)\.[A-Z]\w*(?:[ \t]*-[ \t]*[^\n]*)?[ \t]*$", mark)
    out = F.regexp_replace(out, r"(?im)^\s*(?:dear|hi|hello)\b[^\n]{0,60}$", mark)
    out = F.regexp_replace(out, r"(?im)^\s*(?:best|kind|regards|cheers|thanks)\b[^\n]{0,60}$", mark)
    for name in sorted(names, key=len, reverse=True):
        out = F.regexp_replace(out, rf"(?i)\b\Q{name}\E\b", mark)
    return out


def strip_wiki(text: Column) -> Column:
    """Wiki markup to text: meta lines, headings, variables, links, emphasis, tags."""
    out = F.regexp_replace(text, r"(?m)^%META:[^\n]*$", "")
    out = F.regexp_replace(out, r"(?m)^---\++!*\s*", "")
    out = F.regexp_replace(out, r"\[\[[^\]]*\]\[([^\]]*)\]\]", "$1")
    out = F.regexp_replace(out, r"\[\[([^\]]*)\]\]", "$1")
    out = F.regexp_replace(out, r"%[A-Z][A-Z0-9_]*(?:\{[^}]*\})?%", "")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", "")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def wiki_links(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\[\[([^\]\[]+)\](?:\[[^\]]*\])?\]"), F.lit(1)))


def wiki_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<![\w.!\[])([A-Z]+[a-z]+(?:[A-Z]+[a-z0-9]+)+)(?!\w)"), F.lit(1)))


def meta_field(text: Column, kind: str, field: str) -> Column:
    """A field of a ``%META:KIND{...}%`` line, empty if there is none."""
    return F.regexp_extract(text, rf'%META:{kind}\{{[^}}]*\b{field}="([^"]*)"', 1)


def report_code(number: Column) -> Column:
    """The analysis code of a report number such as ``XYZ-PAS-ABC-20-001``: ``ABC-20-001``."""
    return F.regexp_extract(number, r"^[A-Z]+-PAS-([A-Z0-9]{3}-\d{2}-\d{3})$", 1)
