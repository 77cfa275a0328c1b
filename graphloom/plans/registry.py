"""All registered queries and oracles that are no part of the training-data operators."""

from __future__ import annotations

from graphloom.plans import cases, catalog, graph_cases, reader_cases, surface_cases

QUERIES = {**catalog.QUERIES, **cases.QUERIES, **graph_cases.QUERIES, **reader_cases.QUERIES, **surface_cases.QUERIES}
ORACLES = {**catalog.ORACLES, **cases.ORACLES, **graph_cases.ORACLES, **reader_cases.ORACLES, **surface_cases.ORACLES}
