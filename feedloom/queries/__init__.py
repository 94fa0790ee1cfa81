"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with their SQL."""

from __future__ import annotations

from feedloom.queries import feeds, publication, shapes  # noqa: F401 (publication and shapes add to the queries of feeds)

QUERIES = feeds.QUERIES
ORACLES: dict[str, str] = feeds.ORACLES
