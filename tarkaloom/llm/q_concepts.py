"""Queries of problem 6: typed values and the list of concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.llm import concept_match
from tarkaloom.plans.session import table


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concept_match.match_edges(table(spark, sf_dir, "graph_edge"), table(spark, sf_dir, "concept_ref"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir).select("edge_id", "side", "concept_id")


def p6_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that mean no entry, with their number of uses."""
    return _matches(spark, sf_dir).where("concept_id = -1").groupBy("value").agg(F.count("*").alias("n_uses"))


QUERIES = {"p6_found": p6_found, "p6_unmatched": p6_unmatched}
SQL: dict[str, str] = {}
