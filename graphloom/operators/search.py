"""Read operators: lexical, vector and hybrid ranking, text search, query-string filters, bounded SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The common constants of BM25.
K1, B = 1.2, 0.75


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bm25(docs: DataFrame, key: str, text: str, query: str, k: int) -> DataFrame:
    """The ``k`` best documents for a query: key, score, ties by key.

    Only the query's terms enter the postings, so the shuffle is of matching documents;
    lengths and document counts are one partial aggregation over all.
    """
    wanted = sorted(set(re.findall(r"\w+", query.lower())))
    words = docs.select(key, tokens(F.col(text)).alias("_words"))
    # One pass for the statistics, a row of them whatever the corpus; one for the scores. Words never leave their row.
    dfs = F.create_map(*[x for t in wanted for x in (F.lit(t), F.sum(F.array_contains("_words", t).cast("long")))])
    stats = words.agg(F.count(F.lit(1)).alias("_n"), F.avg(F.size("_words")).alias("_avg"), dfs.alias("_dfs"))
    held = F.transform(F.array(*map(F.lit, wanted)), lambda t: F.struct(t.alias("term"), F.size(F.filter("_words", lambda w: w == t)).alias("tf")))
    counted = words.select(key, F.size("_words").alias("_len"), F.filter(held, lambda x: x["tf"] > 0).alias("_held")).where(F.size("_held") > 0)
    joined = counted.join(F.broadcast(stats)).select("*", F.explode("_held").alias("_h")).select(key, "_len", "_n", "_avg", F.col("_h.tf").alias("_tf"), F.element_at("_dfs", F.col("_h.term")).alias("_df"))
    idf = F.log(1 + (F.col("_n") - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    part = idf * F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_len") / F.col("_avg")))
    return joined.groupBy(key).agg(F.sum(part).alias("score")).orderBy(F.desc("score"), key).limit(k)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column, b: Column, metric: str) -> Column:
    """cosine similarity, inner product, or negative Euclidean distance: greater is nearer."""
    if metric == "cosine":
        return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))
    if metric == "ip":
        return _dot(a, b)
    if metric == "l2":
        gap = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
        return -F.sqrt(_dot(gap, gap))
    raise ValueError(f"unknown metric {metric}")


def vector_top(vectors: DataFrame, key: str, column: str, query: list[float], k: int, metric: str = "cosine") -> DataFrame:
    """The ``k`` nearest vectors: a projection and a top-k, no shuffle of vectors."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select(key, distance(F.col(column), q, metric).alias("score")).orderBy(F.desc("score"), key).limit(k)


def hybrid_top(lexical: DataFrame, semantic: DataFrame, key: str, k: int, weights: tuple[float, float] = (0.6, 0.4)) -> DataFrame:
    """Two rankings merged: each divided by its best, weighted, added."""
    def scaled(df: DataFrame, weight: float) -> DataFrame:
        best = df.agg(F.max("score").alias("_best"))
        return df.join(F.broadcast(best)).select(key, (F.col("score") / F.col("_best") * weight).alias("score"))

    both = scaled(lexical, weights[0]).unionByName(scaled(semantic, weights[1]))
    return both.groupBy(key).agg(F.sum("score").alias("score")).orderBy(F.desc("score"), key).limit(k)


def grep(df: DataFrame, column: str, query: str) -> DataFrame:
    """Rows that hold every word of a query, case aside; words led by ``-`` must be absent."""
    text, keep = F.lower(F.col(column)), F.lit(True)
    for word in query.lower().split():
        keep = keep & (~F.contains(text, F.lit(word[1:])) if word[0] == "-" and len(word) > 1 else F.contains(text, F.lit(word)))
    return df.where(keep)


_PART = re.compile(r'\s*(?:(\()|(\))|(AND|OR|NOT)\b|([\w.@-]+):|"((?:[^"\\]|\\.)*)"|([^\s()":]+))')


def query_string(query: str, columns: dict[str, str], default: list[str]) -> Column:
    """A query string as a filter: field:value, quotes, ``*`` wildcards, AND, OR, NOT, parentheses.

    ``columns`` maps the fields that may be named to expressions; free words look into
    ``default``.  Adjacent terms are joined by OR; NOT binds closest, then AND.
    """
    parts, at = [], 0
    while at < len(query.rstrip()):
        m = _PART.match(query, at)
        if not m:
            raise ValueError(f"cannot read the query at {at}")
        kind = next(k for k in range(1, 7) if m[k] is not None)
        parts.append((("(", ")", "op", "field", "value", "value")[kind - 1], m[kind]))
        at = m.end()

    def test(field: str | None, value: str) -> Column:
        if field is not None and field not in columns:
            raise ValueError(f"unknown field {field}")
        out = F.lit(False)
        for expression in [columns[field]] if field else default:
            column = F.expr(expression).cast("string")
            if value == "*":
                hit = column.isNotNull()
            elif "*" in value:
                hit = F.lower(column).rlike("^" + ".*".join(re.escape(p) for p in value.lower().split("*")) + "$")
            elif field:
                hit = F.lower(column) == value.lower()
            else:
                hit = F.contains(F.lower(column), F.lit(value.lower()))
            out = out | F.coalesce(hit, F.lit(False))
        return out

    def any_of(field: str | None) -> Column:
        out = all_of(field)
        while parts and parts[0][0] != ")":
            if parts[0] == ("op", "OR"):
                parts.pop(0)
            out = out | all_of(field)
        return out

    def all_of(field: str | None) -> Column:
        out = one(field)
        while parts and parts[0] == ("op", "AND"):
            parts.pop(0)
            out = out & one(field)
        return out

    def one(field: str | None) -> Column:
        if not parts:
            raise ValueError("the query ends early")
        kind, value = parts.pop(0)
        if kind == "op" and value == "NOT":
            return ~one(field)
        if kind == "field":
            return one(value)
        if kind == "(":
            inner = any_of(field)
            if not parts or parts.pop(0)[0] != ")":
                raise ValueError("a parenthesis is open")
            return inner
        if kind == "value":
            return test(field, value)
        raise ValueError(f"unexpected {value}")

    if not parts:
        return F.lit(True)
    found = any_of(None)
    if parts:
        raise ValueError("a parenthesis closes too often")
    return found


_READ_ONLY = re.compile(r"\A\s*(?:select|with)\b", re.I)


def read_only_sql(spark: SparkSession, statement: str, limit: int = 1000) -> DataFrame:
    """One SELECT or WITH statement over the session's views, of at most ``limit`` rows."""
    if not _READ_ONLY.match(statement) or ";" in statement.rstrip().rstrip(";"):
        raise ValueError("only one SELECT or WITH statement is run")
    return spark.sql(statement.rstrip().rstrip(";")).limit(limit)


def lines_with_context(df: DataFrame, key: str, text: str, pattern: str, context: int = 1) -> DataFrame:
    """Lines that match, with the lines around them: one row a match, no join."""
    lines = F.split(F.col(text), "\n")
    each = df.select(key, lines.alias("_lines"), F.posexplode(lines).alias("line_no", "line")).where(F.col("line").rlike(pattern))
    first = F.greatest(F.lit(0), F.col("line_no") - context)
    around = F.slice("_lines", first + 1, F.col("line_no") - first + context + 1)
    return each.select(key, "line_no", "line", F.array_join(around, "\n").alias("context"))
