"""Registered queries: each family module exports ``QUERIES`` and ``ORACLE``.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs a pipeline over the whole
driver tables; ``ORACLE[name]`` is the same result written as DuckDB SQL over
the raw tables (no shared code with the Spark side). Outputs are flattened to
scalar columns so both sides compare value by value.
"""

from __future__ import annotations

import importlib

FAMILIES = (
    "keys", "cumulative", "scd", "datelists", "devices", "month_arrays", "facts", "graph",
    "reports", "published",
)


def _modules():
    return [importlib.import_module(f"tessera.catalog.{f}") for f in FAMILIES]


def all_queries() -> dict:
    out: dict = {}
    for m in _modules():
        dup = set(out) & set(m.QUERIES)
        if dup:
            raise ValueError(f"duplicate query names {dup}")
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.ORACLE)
    return out
