"""Revisions: which texts an item has had."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(revisions: DataFrame) -> DataFrame:
    """``item_id, content_hash, seen_at`` of each item's last revision (ties: the larger hash)."""
    last = F.max(F.struct("seen_at", "content_hash")).alias("r")
    return revisions.groupBy("item_id").agg(last).select("item_id", "r.content_hash", "r.seen_at")


def updated(items: DataFrame, revisions: DataFrame) -> DataFrame:
    """``id, updated``: whether an item's text differs from its last revision; items without one are not updated."""
    last = latest(revisions).select(F.col("item_id").alias("id"), F.col("content_hash").alias("_last"))
    return items.select("id", "content_hash").join(last, "id", "left").select("id", F.coalesce(F.col("_last") != F.col("content_hash"), F.lit(False)).alias("updated"))


def insert_or_ignore(revisions: DataFrame, new: DataFrame) -> DataFrame:
    """``revisions`` and those of ``new`` whose item and hash are not there; of several in ``new`` the first seen."""
    fresh = new.groupBy("item_id", "content_hash").agg(F.min_by(F.struct(*new.columns), "seen_at").alias("r")).select("r.*")
    return revisions.unionByName(fresh.join(revisions, ["item_id", "content_hash"], "left_anti").select(*new.columns), allowMissingColumns=True)


def set_updated(items: DataFrame, flags: DataFrame, now: datetime) -> DataFrame:
    out = items.join(flags, "id", "left")
    return out.withColumn("updated_at", F.when(F.coalesce("updated", F.lit(False)), F.lit(now)).otherwise(F.col("updated_at"))).select(*items.columns)
