"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarkaloom.llm import q_concepts, q_languages, q_leaks, q_lines, q_mixing, q_scans, q_truncation

_MODULES = (q_lines, q_leaks, q_concepts, q_languages, q_truncation, q_scans, q_mixing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
