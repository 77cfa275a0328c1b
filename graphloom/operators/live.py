"""Live questions over a table of events: time windows, query strings, hits and aggregations.

The query string and the window become one filter, so both reach the scan; what comes
back is bounded by the request (``size`` hits, ``top_n`` buckets), so an answer can be
put into its envelope on the driver.
"""

from __future__ import annotations

import json
import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from graphloom.operators.relational import terms
from graphloom.operators.search import query_string
from graphloom.sources import requests as Q

_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}


def moment(value: str, now: datetime) -> datetime:
    """``now``, ``now-24h`` and the like, epoch milliseconds, or an ISO time (UTC where it names no zone)."""
    if found := re.fullmatch(r"now(?:([+-])(\d+)([smhdw]))?", value):
        sign, count, unit = found.groups()
        return now if not sign else now + timedelta(**{_UNITS[unit]: int(f"{sign}{count}")})
    if re.fullmatch(r"-?\d{5,}", value):
        return datetime.fromtimestamp(int(value) / 1000, timezone.utc)
    at = datetime.fromisoformat(value)
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def within(ts: str, span: dict[str, str], now: datetime) -> Column:
    """Whether a time is in the window, both ends included."""
    ends = [F.lit(moment(span[k], now).astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")) for k in ("from", "to")]
    return F.col(ts).cast("timestamp_ntz").between(*map(F.to_timestamp_ntz, ends))


class LiveSource:
    """A table of events with the names by which requests call its columns."""

    def __init__(self, table: DataFrame, name: str, ts: str, columns: dict[str, str], summary: tuple[str, ...], default: list[str], tie: str):
        self.table, self.name, self.ts, self.columns, self.summary, self.default, self.tie = table, name, ts, columns, summary, default, tie

    def matching(self, query: str, span: dict[str, str], now: datetime) -> DataFrame:
        everything = query.strip() == "*"
        wanted = within(self.ts, span, now)
        return self.table.where(wanted if everything else wanted & query_string(query, self.columns, self.default))

    def hits(self, query: str, span: dict[str, str], now: datetime, size: int = 5, page: int = 1) -> DataFrame:
        """document_id and summary fields of one page of hits, the newest first (ties by id)."""
        size, page = Q.clamp(size, 5, 1, Q.MAX_RESULTS), Q.clamp(page, 1, 1, Q.MAX_PAGE)
        rows = self.matching(query, span, now).orderBy(F.col(self.ts).desc(), self.tie).offset((page - 1) * size).limit(size)
        return rows.select(F.col(self.tie).cast("string").alias("document_id"), *[F.expr(self.columns[f]).cast("string").alias(f) for f in self.summary])

    def buckets(self, query: str, group_by: str, agg_type: str, span: dict[str, str], now: datetime, top_n: int = 10) -> DataFrame:
        """Terms: key, doc_count and sum_other_doc_count of the greatest buckets; else one row with ``value``."""
        if error := Q.aggregation_error(query, group_by, agg_type):
            raise ValueError(error)
        rows = self.matching(query, span, now).withColumn("_value", F.expr(self.columns[group_by.removesuffix(".keyword")]))
        if agg_type == "terms":
            keyed = rows.where("_value is not null").select(F.col("_value").cast("string").alias("key"))
            return terms(keyed, ["key"], Q.clamp(top_n, 10, 1, Q.MAX_TOP_N)).orderBy(F.desc("doc_count"), "key")
        measure = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "cardinality": F.approx_count_distinct}[agg_type]
        return rows.agg(measure("_value").cast("double").alias("value"))

    def search(self, query: str, start: str = "", end: str = "", size: int = 5, page: int = 1, now: datetime | None = None, token: str = "") -> dict:
        """A page of hits in its envelope; a query that cannot be read is an error within it."""
        now = now or datetime.now(timezone.utc)
        clean, span = Q.clean_query(query, token), Q.window(start, end)
        size, page = Q.clamp(size, 5, 1, Q.MAX_RESULTS), Q.clamp(page, 1, 1, Q.MAX_PAGE)
        asked = {"lucene": clean, "index": self.name, "time_field": Q.TIME_FIELD, "max_results": size, "page": page, "offset": (page - 1) * size}
        none = {"total": {"value": 0, "relation": "eq"}, "results": []}
        if not clean:
            return Q.envelope(self.name, now.isoformat(), asked, span, **none, error="query must be non-empty")
        try:
            total = self.matching(clean, span, now).count()
            found = [{"document_id": r.document_id, "fields": {f: r[f] for f in self.summary if r[f] is not None}} for r in self.hits(clean, span, now, size, page).collect()]
        except ValueError as error:
            return Q.envelope(self.name, now.isoformat(), asked, span, **none, error=str(error))
        return Q.envelope(self.name, now.isoformat(), asked, span, total={"value": total, "relation": "eq"}, results=found)

    def aggregate(self, query: str, group_by: str, agg_type: str = "terms", top_n: int = 10, start: str = "", end: str = "", now: datetime | None = None, token: str = "") -> dict:
        """An aggregation in its envelope."""
        now = now or datetime.now(timezone.utc)
        clean, span, field, kind = Q.clean_query(query, token), Q.window(start, end), (group_by or "").strip(), (agg_type or "").strip()
        asked = {"lucene": clean, "index": self.name, "time_field": Q.TIME_FIELD, "group_by": field, "agg_type": kind, "top_n": Q.clamp(top_n, 10, 1, Q.MAX_TOP_N)}
        out: dict = {"agg_type": kind, "group_by": field, "total_matching_documents": 0, "buckets": []}
        try:
            rows = self.buckets(clean, field, kind, span, now, top_n).collect()
            out["total_matching_documents"] = self.matching(clean, span, now).count()
            if kind == "terms":
                out["buckets"] = [{"key": r.key, "doc_count": r.doc_count} for r in rows]
                out["sum_other_doc_count"] = rows[0].sum_other_doc_count if rows else 0
            else:
                out["value"] = rows[0].value
        except (ValueError, KeyError) as error:
            out["error"] = str(error) if isinstance(error, ValueError) else f"no mapping found for [{field}]"
        return Q.envelope(self.name, now.isoformat(), asked, span, aggregation=out)


def told(answer: dict) -> str:
    """An envelope as text, keys sorted."""
    return json.dumps(answer, ensure_ascii=False, sort_keys=True)
