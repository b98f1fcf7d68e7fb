"""Queries of problem 8 (leaked test items) and problem 10 (look-alike text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.llm import leakage, lookalike
from tarkaloom.plans.session import spread, stage, table


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(table(spark, sf_dir, "benchmark_item"), spread(table(spark, sf_dir, "documents")))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item with the number of documents that hold a part of it."""
    items = table(spark, sf_dir, "benchmark_item").select("item_id", "lang")
    per = p8_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n"))
    return items.join(per, "item_id", "left").select("item_id", "lang", F.coalesce("n", F.lit(0)).alias("n_documents"), F.col("n").isNotNull().alias("leaked"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = lookalike.alike_pairs(lookalike.consistent(spread(table(spark, sf_dir, "documents"))))
    return pairs.select(F.col("doc_id_a").cast("bigint").alias("doc_id_a"), F.col("doc_id_b").cast("bigint").alias("doc_id_b"))


def p10_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form with the class of its form."""
    forms = stage(lookalike.consistent(spread(table(spark, sf_dir, "documents"))), "forms")
    classes = forms.groupBy("form_key").agg(F.min("doc_id").alias("class_id"))
    return forms.join(classes, "form_key").select("doc_id", "class_id", F.col("form").alias("text"), (F.col("form") != F.col("text")).alias("changed"))


QUERIES = {"p8_found": p8_found, "p8_report": p8_report, "p10_found": p10_found, "p10_forms": p10_forms}
SQL: dict[str, str] = {}
