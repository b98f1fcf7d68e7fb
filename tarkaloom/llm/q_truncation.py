"""Queries of problem 5: values without their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarkaloom.llm import truncation
from tarkaloom.plans.session import stage, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_values(table(spark, sf_dir, "corpus_record"), table(spark, sf_dir, "graph_edge")).select("tbl", "row_key")


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts, per table."""
    records, edges = table(spark, sf_dir, "corpus_record"), table(spark, sf_dir, "graph_edge")
    return truncation.cut_rates(stage(truncation.cut_values(records, edges), "cut"), records, edges)


QUERIES = {"p5_found": p5_found, "p5_rates": p5_rates}
SQL: dict[str, str] = {}
