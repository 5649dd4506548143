"""All registered queries of the catalogue operators and their SQL twins, gathered from the modules of ``marquee.cases``."""

from __future__ import annotations

from marquee.cases import expressions, gates, ingest, judging, searching, tables

MODULES = (expressions, tables, searching, ingest, gates, judging)


def queries() -> dict:
    return {name: f for m in MODULES for name, (f, _) in m.CASES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.CASES.items() if sql}
