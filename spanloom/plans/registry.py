"""Queries by name and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.plans import q_aggregate, q_files, q_interval, q_order, q_reads, q_relational, q_sequence, q_sources, q_stats
from spanloom.plans.book import ORACLES, QUERIES

MODULES = (q_aggregate, q_files, q_interval, q_order, q_reads, q_relational, q_sequence, q_sources, q_stats)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional methylation over fixed windows of the interval table."""
    return QUERIES["w1_fixed_windows"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
