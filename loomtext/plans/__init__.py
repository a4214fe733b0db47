"""Registered queries and their SQL twins."""

from __future__ import annotations

from . import defined, dictionary, entities, evaluation, neighbours, rules, series, streams, tables, textual, topical
from .base import ORACLES, QUERIES

__all__ = ["defined", "dictionary", "entities", "evaluation", "neighbours", "oracle_sql", "queries", "rules", "series", "streams", "tables", "textual", "topical"]


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
