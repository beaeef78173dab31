"""All queries of the package and their SQL twins."""

from __future__ import annotations

from importlib import import_module

PARTS = ["star_queries", "ingest_queries", "load_queries", "nested_queries", "merge_queries", "calendar_queries", "drift_queries", "time_queries", "quality_queries", "rule_queries", "text_queries"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for part in PARTS:
        for name, value in getattr(import_module(f"viewloom.plans.{part}"), attribute).items():
            if name in merged:
                raise ValueError(f"query {name!r} is defined twice")
            merged[name] = value
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
