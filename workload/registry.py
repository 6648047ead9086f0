"""All registered queries and their check SQL."""

from __future__ import annotations

from workload import clusters, discovery, enumeration, gates, graphs, scoring

MODULES = [discovery, enumeration, gates, clusters, graphs, scoring]


def queries():
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracles():
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
