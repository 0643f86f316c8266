"""Discovery: which candidates are new, which known items are seen again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import canonical_url
from ..plans.cuts import cut

#: The order in which candidates come: source file, target, place in the target.
ORDER = ["source_ord", "target_ord", "cand_ord"]


def keyed(candidates: DataFrame) -> DataFrame:
    """With ``canonical_url``."""
    return candidates.withColumn("canonical_url", canonical_url(F.col("url")))


def first_of_each(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key. Aggregates before the shuffle, so a key with very many rows costs one row a task."""
    place = F.struct(*order)
    whole = F.struct(*rows.columns)
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(whole, place).alias("_row")).select("_row.*")


def new_candidates(candidates: DataFrame, held: DataFrame) -> DataFrame:
    """Candidates whose canonical URL is not held; of several with one URL the first, over all sources."""
    return first_of_each(keyed(candidates).join(held.select("canonical_url").distinct(), "canonical_url", "left_anti"), "canonical_url", ORDER)


def known_candidates(candidates: DataFrame, held: DataFrame) -> DataFrame:
    """Candidates whose canonical URL is held."""
    return keyed(candidates).join(held.select("canonical_url"), "canonical_url", "left_semi")


def numbered(rows: DataFrame, order: list[str | Column], top: int) -> DataFrame:
    """``rows`` with ``id``: numbers after ``top`` in that order.

    Ranges of the order are numbered apart and shifted by the sizes of the ranges before; only the sizes, one a range, meet in one task.
    """
    placed = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "placed")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))  # as many rows as ranges
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.join(F.broadcast(before), "_range").withColumn("id", F.lit(top) + F.col("_before") + own).drop("_range", "_before")


def insert_new(items: DataFrame, fresh: DataFrame, now: datetime, run_id: int) -> DataFrame:
    """``items`` and the new candidates as discovered items; a publisher's own form makes them certain."""
    ids = numbered(fresh.select("canonical_url", *ORDER), ORDER, items.agg(F.max("id")).first()[0] or 0).select("canonical_url", "id")
    rows = fresh.join(ids, "canonical_url").withColumns(
        {
            "status": F.lit("discovered"),
            "first_seen": F.lit(now),
            "last_seen": F.lit(now),
            "run_id": F.lit(run_id).cast("long"),
            "confidence": F.when(F.col("content_type").isNotNull(), F.lit(1.0)),
            "needs_review": F.lit(False),
            "reviewed": F.lit(False),
        }
    )
    return items.unionByName(rows.select(*[c for c in items.columns if c in rows.columns]), allowMissingColumns=True)


def touch(items: DataFrame, seen: DataFrame, now: datetime) -> DataFrame:
    """Known items that are seen again go back to discovered."""
    again = seen.select("canonical_url").distinct().withColumn("_again", F.lit(True))
    hit = F.col("_again").isNotNull()
    out = items.join(again, "canonical_url", "left")
    out = out.withColumn("last_seen", F.when(hit, F.lit(now)).otherwise(F.col("last_seen"))).withColumn("status", F.when(hit, F.lit("discovered")).otherwise(F.col("status")))
    return out.select(*items.columns)


def target_log(candidates: DataFrame, fresh: DataFrame, run_id: int, targets: DataFrame | None = None) -> DataFrame:
    """Found and new candidates of each of ``targets(source_id, target)``; one that found nothing counts as failed. Without ``targets`` the candidates' own count."""
    found = candidates.groupBy("source_id", "target").agg(F.count(F.lit(1)).alias("found"))
    new = fresh.groupBy("source_id", "target").agg(F.count(F.lit(1)).alias("new_items"))
    if targets is not None:
        found = targets.select("source_id", "target").distinct().join(found, ["source_id", "target"], "left")
    joined = found.join(new, ["source_id", "target"], "left").na.fill(0, ["found", "new_items"])
    return joined.select(F.lit(run_id).cast("long").alias("run_id"), "*", (F.col("found") > 0).alias("ok"))


def pages_until_cutoff(rows: DataFrame, cutoff) -> DataFrame:  # noqa: ANN001
    """Rows ``page, ord, published_at`` as far as the first page whose last row is older than the cutoff; that page stays whole.

    A last row without a date does not stop the walk.
    """
    last = rows.groupBy("page").agg(F.max_by("published_at", "ord").alias("last"))
    stop = last.filter(F.col("last") < F.lit(cutoff)).agg(F.min("page").alias("stop"))  # one row
    return rows.crossJoin(F.broadcast(stop)).filter(F.col("stop").isNull() | (F.col("page") <= F.col("stop"))).drop("stop")
