"""Queries of problem 2: languages of commentaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.llm import languages
from tarkaloom.plans.session import spread, table


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.commentary_languages(spread(table(spark, sf_dir, "corpus_record")), table(spark, sf_dir, "documents"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.doubtful(_languages(spark, sf_dir))


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment of every commentary with language and confidence."""
    seg = _languages(spark, sf_dir).select("rec_no", "com_pos", F.posexplode("segments").alias("seg_pos", "s"))
    return seg.select("rec_no", "com_pos", F.col("seg_pos").cast("bigint").alias("seg_pos"), F.col("s.lang").alias("lang"), F.col("s.confidence").alias("confidence"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def p2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every commentary with its main language and the confidence in it."""
    return _languages(spark, sf_dir).select("rec_no", "com_pos", "label", "lang", "confidence")


QUERIES = {"p2_found": p2_found, "p2_segments": p2_segments, "p2_languages": p2_languages}
SQL: dict[str, str] = {}
