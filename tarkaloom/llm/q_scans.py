"""Queries of problem 1: noise of scanned pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarkaloom.llm import scan_noise
from tarkaloom.plans.session import spread, stage, table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(scan_noise.read_pages(spread(table(spark, sf_dir, "documents"))), "pages")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return scan_noise.line_noise(pages, stage(scan_noise.corrections(pages), "fixes"))


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scan as continuous, corrected paragraphs."""
    pages = _pages(spark, sf_dir)
    return scan_noise.repaired(spread(table(spark, sf_dir, "documents")), pages, stage(scan_noise.corrections(pages), "fixes"))


QUERIES = {"p1_found": p1_found, "p1_clean": p1_clean}
SQL: dict[str, str] = {}
