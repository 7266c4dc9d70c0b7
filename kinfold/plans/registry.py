"""Registered queries of the case-based operators."""

from __future__ import annotations

from . import q_extra, q_more, q_profile, q_react, q_series, q_stats

_MODULES = [q_react, q_stats, q_more, q_profile, q_series, q_extra]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
