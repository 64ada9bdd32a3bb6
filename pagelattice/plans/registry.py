"""All registered queries of the engine and their SQL oracles."""

from __future__ import annotations

from . import bands, layout, misc, pipelines, readings, reports, rules

FLAGSHIP = "reading_relation"
MODULES = (readings, layout, bands, rules, reports, pipelines, misc)


def queries() -> dict:
    return {name: f for m in MODULES for name, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
