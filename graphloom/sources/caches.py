"""Guarded scans of exported caches: JSON lists and objects, key=value lines, text trees, XML pages.

A scan either yields typed rows or raises ``CacheUnusable`` with a status; it never
turns a broken export into an empty one, because an empty run could retract a graph.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from graphloom.functions.text import meta_field, strip, strip_wiki, wiki_links, wiki_words


class CacheUnusable(Exception):
    """A cache that must not be read as data; ``status`` is cache_missing or endpoint_failed."""

    def __init__(self, status: str, reason: str):
        super().__init__(f"{status}: {reason}")
        self.status = status


def _guarded(spark: SparkSession, path: str, expect: str, allow_empty: bool = False) -> DataFrame:
    """One row ``value``, the whole text of an export that is a JSON ``expect`` (list or object).

    Only a status comes to the driver; the text is read, checked and parsed on executors.
    """
    from pyspark.errors import AnalysisException

    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        raise CacheUnusable("cache_missing", f"{path} cannot be found") from error
    texts = files.select(F.is_valid_utf8(F.col("content").cast("string")).alias("utf8"), F.col("content").cast("string").alias("value"))
    bare = strip(F.col("value"))
    kind = (
        F.when(~F.col("utf8"), "bytes")
        .when(bare == "", "blank")
        .when(bare.startswith("[") & bare.endswith("]") & F.from_json(bare, "array<string>").isNotNull(), "list")
        .when(bare.startswith("{") & bare.endswith("}") & F.from_json(bare, "map<string,string>").isNotNull(), "object")
        .when(bare.rlike(r"""\A(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|"(?:[^"\\]|\\.)*")\z"""), "scalar")
        .otherwise("broken")
    )
    size = F.when(kind == "list", F.size(F.from_json(bare, "array<string>"))).when(kind == "object", F.size(F.from_json(bare, "map<string,string>")))
    found = texts.select(kind.alias("kind"), size.alias("size")).limit(2).collect()
    if len(found) != 1 or found[0].kind in ("bytes", "blank", "broken"):
        why = {"bytes": "is not UTF-8", "blank": "is empty", "broken": "is not JSON"}.get(found[0].kind if len(found) == 1 else "", "is not one file")
        raise CacheUnusable("cache_missing", f"{path} {why}")
    if found[0].kind != expect:
        raise CacheUnusable("endpoint_failed", f"{path} holds a JSON {found[0].kind}, not a JSON {expect}")
    if not found[0].size and not allow_empty:
        raise CacheUnusable("cache_missing", f"{path} holds an empty JSON {expect}")
    return texts.select(bare.alias("value"))


def json_rows(spark: SparkSession, path: str, unwrap: tuple[str, ...] = (), allow_empty: bool = False) -> DataFrame:
    """input_pos and raw (an object's JSON text, null for any other item) of a JSON list.

    ``unwrap`` names keys under which an object may hold the list instead.
    """
    try:
        text = _guarded(spark, path, "list", allow_empty)
    except CacheUnusable as error:
        if not unwrap or error.status != "endpoint_failed" or "JSON object" not in str(error):
            raise
        held = _guarded(spark, path, "object").select(F.coalesce(*[F.get_json_object("value", f"$.{k}") for k in unwrap]).alias("value"))
        size = held.select(F.size(F.from_json("value", "array<string>"))).first()[0]
        if size is None or size < 0:
            raise
        if not size and not allow_empty:
            raise CacheUnusable("cache_missing", f"{path} holds no records") from None
        text = held
    return rows_of_text(text)


def rows_of_text(text: DataFrame) -> DataFrame:
    """input_pos and raw of the items of JSON lists (value)."""
    each = text.select(F.posexplode(F.from_json("value", "array<string>")).alias("input_pos", "raw"))
    return each.select(F.col("input_pos").cast("long").alias("input_pos"), F.when(F.ltrim("raw").startswith("{"), F.col("raw")).alias("raw"))


def json_list(spark: SparkSession, path: str, item: StructType, unwrap: tuple[str, ...] = ()) -> DataFrame:
    """A JSON list of objects as rows with ``input_pos``; items that are not objects come as null ``item``."""
    return json_rows(spark, path, unwrap).select("input_pos", F.from_json("raw", item).alias("item"))


def json_objects(spark: SparkSession, path: str, value: DataType, key_pattern: str = r".+") -> DataFrame:
    """A JSON object keyed by name as rows (name, item); an error body is refused.

    A value that is no object is a null ``item``: a row to skip and to count.
    """
    text = _guarded(spark, path, "object")
    entries = text.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("input_pos", "e"))
    rows = entries.select(F.col("input_pos").cast("long").alias("input_pos"), F.col("e.key").alias("name"), F.when(F.ltrim("e.value").startswith("{"), F.col("e.value")).alias("raw"))
    seen = rows.agg(F.bool_or(F.col("name").isin("error", "errors")).alias("error"), F.bool_or(F.col("name").rlike(rf"\A(?:{key_pattern})\z")).alias("named")).first()
    if seen.error:
        raise CacheUnusable("endpoint_failed", f"{path} is not an object of records")
    if not seen.named:
        raise CacheUnusable("endpoint_failed", f"no key of {path} looks like a name")
    return rows.select("input_pos", "name", F.from_json("raw", value).alias("item"))


def row_arrays(text: DataFrame, fields: list[str], key: str = "result") -> DataFrame:
    """Rows of ``{key: [[a, b, c], ...]}`` texts (value) as columns, with ``skip`` for rows of another length.

    A text without such a list raises when it is read.
    """
    listed = F.from_json(F.get_json_object("value", f"$.{key}"), "array<string>")
    checked = F.when(listed.isNotNull() & (F.size(listed) > 0), listed).otherwise(F.raise_error(F.lit(f"no rows under {key}")))
    each = text.select(F.posexplode(checked).alias("input_pos", "raw"))
    row = F.when(F.ltrim("raw").startswith("["), F.from_json("raw", "array<string>"))
    each = each.select(F.col("input_pos").cast("long").alias("input_pos"), row.alias("_r"))
    good = F.coalesce(F.size("_r") == len(fields), F.lit(False))
    return each.select("input_pos", *[F.when(good, F.col("_r")[k]).alias(f) for k, f in enumerate(fields)], (~good).alias("skip"))


def spelled(item: str, *names: str) -> Column:
    """The first spelling of a field that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(f"{item}.{n}").cast("string"), F.lit("")) for n in names], F.lit(""))


def keyed_lines(lines: DataFrame, label: str = "label") -> DataFrame:
    """``a=b;c=d`` lines as maps: parts without ``=`` are dropped, the last of a repeated key wins."""
    parts = F.filter(F.split("value", ";"), lambda p: F.contains(p, F.lit("=")))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("k"), F.trim(F.substring(p, F.locate("=", p) + 1, F.length(p))).alias("v")))
    merged = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))
    return lines.select(merged.alias("fields")).where(F.try_element_at("fields", F.lit(label)).isNotNull())


def releases_from_lines(lines: DataFrame) -> DataFrame:
    """label, type, state, architectures, production architectures of a release map."""
    at = lambda k: F.try_element_at("fields", F.lit(k))
    rows = keyed_lines(lines).select(at("label").alias("label"), at("type").alias("type"), at("state").alias("state"), at("architecture").alias("architecture"), (at("prodarch") == "1").alias("prod"))
    rows = rows.where(F.col("label").rlike(r"^CMSSW_\d+_\d+_"))
    return rows.groupBy("label").agg(
        F.min("type").alias("type"), F.min("state").alias("state"), F.array_sort(F.collect_set("architecture")).alias("architecture"),
        F.array_sort(F.collect_set(F.when(F.col("prod"), F.col("architecture")))).alias("production_architecture"),
    )


def pinned(files: DataFrame, digest: str) -> DataFrame:
    """A binaryFile scan whose bytes must have the given SHA-256, as lines."""
    checked = F.when(F.sha2("content", 256) == digest.lower(), F.decode("content", "UTF-8")).otherwise(F.raise_error(F.lit("the content is not the pinned one")))
    return files.select(F.explode(F.split(checked, r"\r?\n")).alias("value"))


def text_tree(spark: SparkSession, root: str, suffix: str = ".txt", skip: str = r"(?:^|/)(?:\.|_default|Web[A-Z])") -> DataFrame:
    """Pages of a tree of text files: page path below the root, text, and whether it is blank."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root)
    below = F.regexp_replace(F.regexp_replace("path", r"^.*" + re.escape(root.rstrip("/").rsplit("/", 1)[-1]) + "/", ""), re.escape(suffix) + "$", "")
    rows = files.select(below.alias("page"), F.decode("content", "UTF-8").alias("raw"))
    return rows.where(~F.col("page").rlike(skip)).withColumn("blank", strip(F.col("raw")) == "")


def wiki_pages(tree: DataFrame) -> DataFrame:
    """Wiki topics with metadata, stripped body and link targets."""
    return tree.where("not blank").select(
        "page", strip_wiki(F.col("raw")).alias("body"), meta_field(F.col("raw"), "TOPICINFO", "author").alias("author"),
        meta_field(F.col("raw"), "TOPICINFO", "version").alias("version"), meta_field(F.col("raw"), "TOPICPARENT", "name").alias("parent"),
        wiki_links(F.col("raw")).alias("links"), wiki_words(F.col("raw")).alias("words"),
    )


def harvest_pages(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """Records of harvested XML pages: id, datestamp, deleted, title, identifiers, creators; an error page raises.

    Element prefixes are dropped, so names are looked up whatever their namespaces are called.
    """
    plain = F.regexp_replace(F.regexp_replace(xml, r"<\?[^>]*\?>", ""), r"<(/?)[\w.-]+:", "<$1")
    bad = F.regexp_extract(plain, r"(?s)<error\b[^>]*>(.*?)</error>", 1)
    checked = F.when(bad != "", F.raise_error(F.concat(F.lit("harvest error: "), bad))).otherwise(plain)
    each = pages.select(F.explode(F.regexp_extract_all(checked, F.lit(r"(?s)<record\b.*?</record>"), F.lit(0))).alias("_r"))
    one = lambda path: F.xpath_string("_r", F.lit(path))
    return each.select(
        one("/record/header/identifier").alias("oai_id"), one("/record/header/datestamp").alias("datestamp"), (one("/record/header/@status") == "deleted").alias("deleted"),
        one("/record/metadata//title").alias("title"), F.xpath("_r", F.lit("/record/metadata//identifier/text()")).alias("identifiers"), F.xpath("_r", F.lit("/record/metadata//creator/text()")).alias("creators"),
    )


#: Buckets of terms aggregations, as monitoring responses nest them.
BUCKET = "struct<key string, doc_count bigint>"


def availability_buckets(responses: DataFrame, column: str = "payload") -> DataFrame:
    """site, status, doc_count of a nested status breakdown; blank sites are dropped."""
    schema = f"struct<responses array<struct<aggregations struct<groups struct<buckets array<struct<key string, status_breakdown struct<buckets array<{BUCKET}>>>>>>>>>"
    parsed = responses.select(F.from_json(column, schema).alias("p")).select(F.explode("p.responses").alias("r"))
    sites = parsed.select(F.explode("r.aggregations.groups.buckets").alias("b")).where(F.trim("b.key") != "")
    return sites.select(F.col("b.key").alias("site"), F.explode("b.status_breakdown.buckets").alias("s")).select("site", F.col("s.key").alias("status"), "s.doc_count")


def availability_rows(buckets: DataFrame) -> DataFrame:
    """Counts by status, percent OK and class of each site."""
    of = lambda s: F.coalesce(F.sum(F.when(F.upper("status") == s, F.col("doc_count"))), F.lit(0))
    share = F.try_divide(of("OK") * 100.0, F.sum("doc_count"))
    label = F.when(share >= 90, "OK").when(share >= 70, "WARNING").when(share.isNotNull(), "CRITICAL").otherwise("UNKNOWN")
    return buckets.groupBy("site").agg(
        F.sum("doc_count").alias("total_tests"), of("OK").alias("ok_count"), of("WARNING").alias("warning_count"), of("CRITICAL").alias("critical_count"),
        F.round(share, 2).alias("availability_pct"), label.alias("status"),
    )


ANY_MAP = MapType(StringType(), StringType())
ANY_LIST = ArrayType(StringType())
