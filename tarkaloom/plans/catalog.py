"""Registered queries of the core, by name, each with its SQL where SQL can say it.

Every query reads whole tables; ``(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarkaloom.plans import numbered, q_flow, q_graph, q_passages, q_records, q_states, q_text

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for module in (numbered, q_flow, q_graph, q_passages, q_records, q_states, q_text):
        out |= module.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in (numbered, q_flow, q_graph, q_passages, q_records, q_states, q_text):
        out |= module.SQL
    return out
