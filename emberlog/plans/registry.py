"""Imports every module that registers queries."""

from emberlog.plans import queries, queries_models, queries_newest, queries_parsing, queries_rollup, queries_tables  # noqa: F401
