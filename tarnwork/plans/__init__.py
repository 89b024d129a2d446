"""Registered queries, one module per family."""

from tarnwork.plans import aggregates, functions, graphs, joins, learning, projections, sorting, sources, streams, workloads  # noqa: F401
