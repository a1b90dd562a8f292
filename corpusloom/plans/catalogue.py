"""Registered queries of the corpus operators and the SQL they equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import corpus_queries, graph_queries, media_queries, state_queries, vault_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = corpus_queries.QUERIES | graph_queries.QUERIES | media_queries.QUERIES | vault_queries.QUERIES | state_queries.QUERIES
SQL: dict[str, str] = corpus_queries.SQL | graph_queries.SQL | media_queries.SQL | vault_queries.SQL | state_queries.SQL
