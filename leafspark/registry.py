"""Every query of the engine, by name, with the SQL that an independent engine runs for it."""

from __future__ import annotations

from leafspark.plans import queries as tables

Query = tables.Query


def queries() -> dict[str, Query]:
    return dict(tables.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(tables.ORACLES)
