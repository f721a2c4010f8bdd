"""Importing this module registers every query."""

from . import queries_features, queries_models, queries_policy, queries_streams, queries_tables, queries_trips  # noqa: F401
