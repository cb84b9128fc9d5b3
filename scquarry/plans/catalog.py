"""All queries of the core, by name."""

from __future__ import annotations

from scquarry.plans import ambient, audit, checking, figures, graphs, invariants, joins, kernels, problems, qc, statistics

_MODULES = (qc, joins, statistics, graphs, ambient, audit, figures, checking, kernels, invariants, problems)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
