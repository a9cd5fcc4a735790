"""All queries of the core, by name."""

from __future__ import annotations

from loomgraph.plans import dealt, planted, retrieval, shape, structure

MODULES = [dealt, retrieval, structure, planted, shape]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for m in MODULES for k, sql in m.ORACLES.items()}


def flagship(spark, sf_dir: str):
    return queries()["bm25_topk"](spark, sf_dir)
