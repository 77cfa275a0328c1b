"""What readers and live tools ask of services: keys, query texts, windows, bodies, envelopes.

Plain driver-side values: a request is small whatever the data behind it.
"""

from __future__ import annotations

import re
from datetime import datetime

#: Bounds of a live request.
MAX_QUERY_CHARS, MAX_RESULTS, MAX_TOP_N, MAX_PAGE = 800, 10, 100, 1000
TIME_FIELD, BOUNDARY = "metadata.timestamp", "external_live"
AGGREGATIONS = ("avg", "cardinality", "max", "min", "sum", "terms")
#: How a service says that a field cannot be aggregated.
FIELD_ERRORS = ("no mapping found", "fielddata", "field data", "unknown field", "failed to find field", "not aggregatable")
_KEY = re.compile(r"[A-Z][A-Z0-9_]*")


def project_keys(value: object) -> list[str]:
    """The issue projects of a setting, trimmed; anything but a list of valid keys is refused."""
    keys = [k.strip() if isinstance(k, str) else "" for k in value] if isinstance(value, list) else []
    if not keys or not all(_KEY.fullmatch(k) for k in keys):
        raise ValueError("project keys are a non-empty list of capitals, digits and underscores")
    return keys


def quoted(value: str) -> str:
    """A string of an issue query."""
    return '"' + re.sub(r'([\\"])', r"\\\1", value) + '"'


def issue_query(project: str, created_after: str | None = None, updated_after: str | None = None) -> str:
    """The query for one project's issues, within ISO times."""
    parts = [f"project = {quoted(project_keys([project])[0])}"]
    for field, since in (("created", created_after), ("updated", updated_after)):
        if since:
            parts.append(f'{field} >= "{datetime.fromisoformat(since):%Y/%m/%d %H:%M}"')
    return " and ".join(parts)


def clean_query(query: str | None, token: str = "") -> str:
    """A query trimmed and bounded, with the access token masked."""
    bounded = (query or "").strip()[:MAX_QUERY_CHARS]
    return bounded.replace(token, "[redacted]") if token else bounded


def clamp(value: object, default: int, lower: int, upper: int) -> int:
    """A whole number within bounds; the default for what is none."""
    try:
        number = int(value)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        number = default
    return max(lower, min(upper, number))


def window(start: str | None, end: str | None) -> dict[str, str]:
    """The time window that a request uses and echoes."""
    return {"from": (start or "").strip() or "now-24h", "to": (end or "").strip() or "now", "time_field": TIME_FIELD}


def terms_field(field: str) -> str:
    """The exact-value form of a text field."""
    return field if field.endswith(".keyword") else f"{field}.keyword"


def aggregation_error(query: str, group_by: str, agg_type: str) -> str | None:
    """Why an aggregation cannot be asked for, or None."""
    if not query:
        return "query must be non-empty; use '*' for all documents"
    if not group_by:
        return "group_by must be non-empty"
    return None if agg_type in AGGREGATIONS else "agg_type must be one of " + ", ".join(AGGREGATIONS)


def filter_body(query: str, span: dict[str, str]) -> dict:
    """A query string and a time range, both required."""
    wanted = {"query_string": {"query": query, "analyze_wildcard": True}}
    within = {"gte": span["from"], "lte": span["to"], "format": "strict_date_optional_time||epoch_millis"}
    return {"bool": {"must": [wanted], "filter": [{"range": {TIME_FIELD: within}}]}}


def search_body(query: str, fields: list[str], span: dict[str, str], size: int, page: int) -> dict:
    return {"size": size, "from": (page - 1) * size, "_source": fields, "query": filter_body(query, span), "sort": [{TIME_FIELD: {"order": "desc"}}]}


def aggregation_body(query: str, field: str, agg_type: str, top_n: int, span: dict[str, str]) -> dict:
    clause = {"field": field, "size": top_n} if agg_type == "terms" else {"field": field}
    return {"size": 0, "query": filter_body(query, span), "aggs": {"result": {agg_type: clause}}}


def retry_raw(error: str | None, buckets: int, matched: int, field: str) -> bool:
    """Whether terms of ``field.keyword`` are asked for again by the plain field.

    So where the first attempt failed on the field, or matched documents without a
    bucket; no match and no bucket is a result.
    """
    if error:
        text = error.lower()
        return bool(field) and field.lower() in text or any(w in text for w in FIELD_ERRORS)
    return buckets == 0 and matched > 0


def envelope(source: str, observed_at: str, query: dict, span: dict[str, str], **result) -> dict:
    """What a live tool answers: never pinned to a generation, so it says when and what was asked."""
    return {"boundary": BOUNDARY, "source": source, "observed_at": observed_at, "query": query, "time_window": span, **{k: v for k, v in result.items() if v is not None}}


def http_error(status: int | None) -> str:
    """What a refused request is reported as."""
    if status in (401, 403):
        return f"MONIT OpenSearch authentication failed with HTTP {status}"
    return f"MONIT OpenSearch request failed with HTTP {status if status is not None else 'unknown'}"


def request_error(error: Exception) -> str:
    """What a failed request is reported as: by its kind alone, since its text may hold addresses."""
    if isinstance(error, TimeoutError):
        return "MONIT OpenSearch request timed out"
    if isinstance(error, ValueError):
        return "MONIT OpenSearch returned a non-JSON response body"
    return f"MONIT OpenSearch request failed: {type(error).__name__}"


def total(value: object) -> dict:
    """A hit count as value and relation, however the service writes it."""
    if isinstance(value, dict):
        return {"value": value.get("value", 0), "relation": value.get("relation", "eq")}
    return {"value": value or 0, "relation": "eq"}


def first_response(payload: dict) -> dict:
    """The first of several responses, or the payload itself."""
    several = payload.get("responses")
    if not isinstance(several, list) or not several:
        return payload
    return several[0] if isinstance(several[0], dict) else {}


def response_error(response: dict) -> str | None:
    error = response.get("error")
    if isinstance(error, dict):
        return str(error.get("reason") or error.get("type") or "OpenSearch error") if error else None
    return str(error) if error else None


def waits(retries: int, first: float = 1.0, most: float = 30.0) -> list[float]:
    """Seconds between attempts at a service that is busy: doubled each time, up to a bound."""
    return [min(most, first * 2**k) for k in range(retries)]
