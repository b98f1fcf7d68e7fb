"""Queries of problem 9: the mix of sources and the shares it reached."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarkaloom.llm import mixing
from tarkaloom.plans.session import spread, stage, table


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_target"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(stage(p9_mix(spark, sf_dir), "mix"), table(spark, sf_dir, "mix_target"))


def p9_full_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of a mix as large as all its sources together: small sources are repeated, and
    stop at their caps where their target asks for more."""
    targets = table(spark, sf_dir, "mix_target")
    mix = mixing.mixed(spread(table(spark, sf_dir, "documents")), targets, of_corpus=1.0)
    return mixing.shares(stage(mix, "mix"), targets)


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_full_shares": p9_full_shares}
SQL: dict[str, str] = {}
