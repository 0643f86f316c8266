"""Counts over items and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def awaiting_review(items: DataFrame) -> DataFrame:
    return items.agg(F.count_if(F.col("needs_review") & ~F.col("reviewed")).alias("awaiting_review"))


def failed_targets(source_runs: DataFrame, run_id: int) -> DataFrame:
    """Targets of a run that failed."""
    return source_runs.filter((F.col("run_id") == run_id) & ~F.col("ok"))


def header(items: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: items, organisations, runs, items to review, failed targets of the newest run."""
    left = items.agg(F.count(F.lit(1)).alias("items"), F.countDistinct("org").alias("orgs"), F.count_if("needs_review").alias("to_review"))
    right = runs.agg(F.count(F.lit(1)).alias("runs"), F.max_by("failed_sources", "id").alias("failed_latest"))
    return left.crossJoin(F.broadcast(right))  # one row each


def stages(items: DataFrame, run_id: int) -> DataFrame:
    """One row of counters of a run. Items that came with a publisher's form count once among the classified, and are also shown apart."""
    own = F.col("run_id") == run_id
    return items.agg(
        F.count_if(own).alias("discovered"),
        F.count_if(own & F.col("status").isin("extracted", "classified", "duplicate")).alias("extracted"),
        F.count_if(own & (F.col("status") == "duplicate")).alias("duplicates"),
        F.count_if(own & (F.col("status") == "classified")).alias("classified"),
        F.count_if(own & (F.col("status") == "classified") & F.col("pub_content_type").isNotNull()).alias("by_publisher"),
    )
