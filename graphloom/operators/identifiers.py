"""Identifiers in texts and what they resolve to: extraction rules, alias tables, linker routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.functions.scalars import alias_key, endpoint_alias, host_without_port
from graphloom.operators.relational import unique_only

#: Fixed values: (kind, expression whose first group is the identifier, confidence).
RULES = (
    ("cms_site", r"\b(T[0-3]_[A-Z]{2}(?:_[A-Za-z0-9]+)+)\b", 0.95),
    ("cms_jira_key", r"\b((?:CMS[A-Z0-9]*|PRCAMPAIGNS)-[0-9]+)\b", 0.95),
    ("cmssw_release", r"\b(CMSSW_[0-9]+_[0-9]+_[0-9]+(?:_[A-Za-z0-9]+)*)\b", 0.95),
    ("cms_hostname", r"\b([A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,}(?::[0-9]+)?)\b", 0.85),
    ("global_tag", r"\b((?:auto:)?[0-9A-Za-z]+(?:_[0-9A-Za-z]+){2,}(?:::[0-9A-Za-z_]+)?)\b", 0.9),
    ("cms_dataset", r"(\B/[A-Za-z0-9][A-Za-z0-9._-]+/[A-Za-z0-9][A-Za-z0-9._-]+/[A-Z0-9-]+\b)", 0.95),
    ("cms_run_number", r"\b(?:run|Run|RUN)\s*#?\s*([1-9][0-9]{5,6})\b", 0.85),
    ("cms_workflow", r"\b([A-Za-z0-9]+(?:[-_][A-Za-z0-9]+){3,})\b", 0.75),
)
DQM_RULES = (
    ("hlt_path", r"\b(HLT_[A-Za-z0-9_]+_v[0-9]+)\b", 0.9),
    ("l1t_seed", r"\b(L1_[A-Za-z0-9_]+)\b", 0.85),
    ("dqm_workspace", r"\b(Online DQM|Online Trigger|Offline Tracker DQM|TKDQM|DQMGUI|Beam Monitor|FED Integrity)\b", 0.8),
)
#: The expressions by which identifiers are looked for in questions.
PATTERNS = (
    ("cms_site", r"\b(T[0-3]_[A-Z]{2}(?:_[A-Za-z0-9]+)+)\b", 1.0),
    ("cms_jira_key", r"\b((?:CMS[A-Z0-9]*|PRCAMPAIGNS)-[0-9]+)\b", 1.0),
    ("cmssw_release", r"\b(CMSSW_[0-9]+_[0-9]+_[0-9]+(?:_[A-Za-z0-9]+)*)\b", 1.0),
    ("global_tag", r"\b((?:auto:)?[0-9A-Za-z]+(?:_[0-9A-Za-z]+){2,}(?:::[0-9A-Za-z_]+)?)\b", 1.0),
    ("cms_repo", r"\b((?:cms-sw|dmwm|cms-data|cms-l1t-offline)/[A-Za-z0-9_.-]+)\b", 1.0),
    ("cms_dataset", r"(\B/[A-Za-z0-9][A-Za-z0-9._-]+/[A-Za-z0-9][A-Za-z0-9._-]+/[A-Z0-9-]+\b)", 1.0),
    ("cms_run_number", r"\b([1-9][0-9]{5,6})\b", 1.0),
    ("cms_hostname", r"\b([A-Za-z0-9][A-Za-z0-9.-]*\.(?:cern\.ch|fnal\.gov|edu|org|net|com|it|de|fr|uk|ch|es|tw|kr|br|in|ru))\b", 1.0),
)
#: Fixed values: (kind, subtype of the text's node) to the confidence of the edge that is drawn.
ROUTES = {
    ("cms_site", "document_chunk"): 0.95,
    ("cms_jira_key", "document_chunk"): 0.95,
    ("cms_jira_key", "git_commit"): 0.95,
    ("cmssw_release", "document_chunk"): 0.95,
    ("cms_hostname", "document_chunk"): 0.85,
    ("global_tag", "document_chunk"): 0.9,
    ("cms_dataset", "document_chunk"): 0.95,
    ("cms_run_number", "document_chunk"): 0.85,
    ("cms_workflow", "document_chunk"): 0.75,
}
#: The kind of identifier that a node's id holds after its prefix, by subtype.
PREFIXES = {
    "site": ("cms_site", "site"), "cmssw_release": ("cmssw_release", "cmssw_release"), "jira_issue": ("cms_jira_key", "jira"),
    "global_tag": ("global_tag", "global_tag"), "dataset": ("cms_dataset", "dataset"), "run": ("cms_run_number", "run"), "workflow": ("cms_workflow", "workflow"),
}


def extract(df: DataFrame, text: str, rules: tuple = RULES) -> DataFrame:
    """``df`` without its text, a row for each distinct (kind, identifier) in it, with the rule's confidence.

    All rules run in one projection; a text's findings are one array of its own row.
    """

    def of(kind: str, pattern: str, confidence: float) -> Column:
        values = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(1)))
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"), F.lit(confidence).alias("confidence")))

    found = F.concat(*[of(*rule) for rule in rules])
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(found).alias("_f")).select(*rest, "_f.kind", "_f.value", "_f.confidence")


def alias_table(nodes: DataFrame) -> DataFrame:
    """kind, key and node_id of every alias of nodes (node_id, subtype, attrs).

    Keys are lower-case, but those of datasets, whose case tells them apart; of several
    nodes with one key the greatest id counts.  A service's endpoint, with and without
    its port, is an alias only where it leads to that service alone.
    """
    value = F.regexp_extract("node_id", r"(?s)\A[^:]*:(.*)\z", 1)
    pick = F.create_map(*[F.lit(x) for subtype, (kind, prefix) in PREFIXES.items() for x in (subtype, f"{kind} {prefix}")])
    known = nodes.withColumn("_p", F.split(F.try_element_at(pick, F.col("subtype")), " ")).where((F.substring_index("node_id", ":", 1) == F.col("_p")[1]) & (value != ""))
    direct = known.select(F.col("_p")[0].alias("kind"), F.when(F.col("subtype") == "dataset", F.trim(value)).otherwise(alias_key(value)).alias("key"), "node_id")
    direct = direct.groupBy("kind", "key").agg(F.max("node_id").alias("node_id"))
    endpoint = F.try_element_at("attrs", F.lit("endpoint"))
    served = nodes.where((F.col("subtype") == "infrastructure_service") & (F.trim(endpoint) != ""))
    served = served.select("node_id", F.explode(F.array_distinct(F.array(alias_key(endpoint), alias_key(host_without_port(endpoint))))).alias("key"))
    return direct.unionByName(unique_only(served, "key", "node_id").select(F.lit("cms_hostname").alias("kind"), "key", "node_id"))


def _keys(kind: Column, value: Column) -> Column:
    """The keys under which an identifier is looked up, the first that is known counts."""
    plain = F.trim(value)
    return (
        F.when(kind == "cms_hostname", F.array(alias_key(plain), alias_key(host_without_port(plain))))
        .when(kind == "cms_dataset", F.array(plain, F.regexp_replace(plain, r"\Adataset:", "")))
        .otherwise(F.array(alias_key(plain)))
    )


def resolve(found: DataFrame, aliases: DataFrame) -> DataFrame:
    """``found`` (with kind and value) with the node_id that each resolves to; the rest has none and goes.

    Distinct identifiers meet the alias table once, however often texts name them.
    """
    wanted = found.select("kind", "value").distinct().select("kind", "value", F.posexplode(F.array_distinct(_keys(F.col("kind"), F.col("value")))).alias("_at", "key"))
    matched = wanted.join(aliases, ["kind", "key"]).groupBy("kind", "value").agg(F.min_by("node_id", "_at").alias("node_id"))
    return found.join(matched, ["kind", "value"])


def routed(resolved: DataFrame, src: str, subtype: str) -> DataFrame:
    """``references`` edges (src, dst, confidence) of resolved identifiers whose kind has a route from the subtype."""
    routes = F.create_map(*[F.lit(x) for (kind, of), confidence in ROUTES.items() for x in (f"{kind} {of}", confidence)])
    confidence = F.try_element_at(routes, F.concat_ws(" ", "kind", subtype))
    drawn = resolved.select(F.col(src).alias("src"), F.col("node_id").alias("dst"), confidence.alias("confidence")).where("confidence is not null and src <> dst")
    return drawn.groupBy("src", "dst").agg(F.max("confidence").alias("confidence")).select("src", "dst", F.lit("references").alias("edge_type"), "confidence")


def service_aliases(services: DataFrame) -> DataFrame:
    """alias and node_id of services (name, endpoint): several services may share an alias."""
    name, endpoint = endpoint_alias(F.col("name")), endpoint_alias(F.coalesce("endpoint", F.lit("")))
    each = F.array_distinct(F.filter(F.array(name, endpoint, host_without_port(endpoint)), lambda a: a != ""))
    return services.select(F.concat(F.lit("svc:"), "name").alias("node_id"), F.explode(each).alias("alias"))


def service_links(mentions: DataFrame, services: DataFrame) -> DataFrame:
    """Edges (src, dst) from texts' hosts (node_id, host) to every service of that alias."""
    host = mentions.select(F.col("node_id").alias("src"), endpoint_alias(F.col("host")).alias("alias"))
    return host.join(service_aliases(services).withColumnRenamed("node_id", "dst"), "alias").select("src", "dst").distinct()
