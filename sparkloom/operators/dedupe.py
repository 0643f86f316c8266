"""Duplicates: equal texts, and near-equal ones with a resolution in order of id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import compared_words, length_bucket, shingles, word_count
from ..plans.cuts import cut

NEAR_PERCENT = 82
RECENT = 500
EXACT, NEAR = "exact content match", "near-duplicate text"


def first_by_hash(items: DataFrame) -> DataFrame:
    """``content_hash, first_id``: the smallest id among all rows with a hash that are no duplicates."""
    return items.filter("content_hash IS NOT NULL AND status <> 'duplicate'").groupBy("content_hash").agg(F.min("id").alias("first_id"))


def exact_duplicates(items: DataFrame) -> DataFrame:
    """``id, duplicate_of``: extracted rows whose text a smaller id has."""
    found = items.filter("status = 'extracted'").join(first_by_hash(items), "content_hash")
    return found.filter("id <> first_id").select("id", F.col("first_id").alias("duplicate_of"))


def prepared(texts: DataFrame) -> DataFrame:
    """``id, bucket, sh`` of ``id, text``: length bucket and 64-bit hashes of the shingles, written before they are joined."""
    words = texts.select("id", word_count(F.col("text")).alias("n"), compared_words(F.col("text")).alias("w"))
    rows = words.select("id", length_bucket(F.col("n")).alias("bucket"), F.transform(shingles(F.col("w")), lambda s: F.xxhash64(s)).alias("sh"))
    return cut(rows.withColumn("sh", F.array_distinct("sh")), "shingles")


def near_pairs(texts: DataFrame, percent: int = NEAR_PERCENT) -> DataFrame:
    """``a, b, common, total``: pairs a < b in the same or adjacent length buckets whose similarity reaches the threshold.

    Sets are ordered by how rare their shingles are; two sets that are similar enough share one of their first ``n - ceil(t * n) + 1``, so only
    these are joined, with bounds by size, and the whole sets decide. Common shingles come last and seldom enter.
    """
    sets = prepared(texts).filter(F.size("sh") > 0)
    each = sets.select("id", F.explode("sh").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    # what only one set has joins nothing, but takes its place among a set's first
    ordered = each.join(often, "s").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("o"))
    size = F.size("o")
    lead = F.slice("o", 1, (size - F.ceil(size * percent / F.lit(100)) + 1).cast("int"))
    keys = cut(ordered.select("id", size.alias("n"), F.explode(F.filter(lead, lambda x: x["df"] > 1)).alias("x")).select("id", "n", F.col("x.s").alias("s")).join(sets.select("id", "bucket"), "id"), "leads")
    left, right = keys.select("s", *[F.col(c).alias(f"{c}1") for c in ("id", "n", "bucket")]), keys.select("s", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "bucket")])
    fits = (F.col("id1") < F.col("id2")) & (F.abs(F.col("bucket1") - F.col("bucket2")) <= 1) & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
    pairs = left.join(right, "s").filter(fits).select(F.col("id1").alias("a"), F.col("id2").alias("b")).distinct()
    whole = pairs.join(sets.select(F.col("id").alias("a"), F.col("sh").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("sh").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    rows = whole.select("a", "b", common.cast("long").alias("common"), (F.size("sa") + F.size("sb") - common).cast("long").alias("total"))
    return rows.filter(F.col("common") * 100 >= F.col("total") * percent)


def resolve(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id, kept``: in order of id, an item is kept unless a kept smaller one is near it.

    In rounds: what has no open or kept smaller neighbour is kept, what has a kept one goes, until nothing is open. Each round decides at least the smallest
    open id of each connected group; chains make more rounds, ordinary data one or two.
    """
    pairs = cut(pairs.select("a", "b"), "pairs")
    linked = pairs.select(F.col("b").alias("id")).distinct()
    # what has no smaller neighbour at all is kept from the start
    kept = cut(pairs.select(F.col("a").alias("id")).distinct().join(linked, "id", "left_anti"), "kept")
    gone = None
    open_ = cut(linked, "open")
    while not open_.isEmpty():
        out = cut(pairs.join(kept.select(F.col("id").alias("a")), "a", "left_semi").join(open_.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("b").alias("id")).distinct(), "gone")
        gone = out if gone is None else cut(gone.union(out), "gone")
        open_ = cut(open_.join(out, "id", "left_anti"), "open")
        waits = pairs.join(open_.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        free = cut(open_.join(waits, "id", "left_anti"), "free")
        kept = cut(kept.union(free), "kept")
        open_ = cut(open_.join(free, "id", "left_anti"), "open")
    if gone is None:
        return ids.select("id", F.lit(True).alias("kept"))
    return ids.select("id").join(gone.withColumn("_gone", F.lit(True)), "id", "left").select("id", F.col("_gone").isNull().alias("kept"))


def near_duplicates(survivors: DataFrame, recent: DataFrame | None = None) -> DataFrame:
    """``id, duplicate_of`` of ``survivors(id, text)``.

    A survivor is a duplicate of the first match: by bucket (one below, own, one above), among the rows of ``recent(id, text)`` (newest first) before the
    kept survivors (in order of id). ``recent`` holds the last ``RECENT`` classified items in the incremental run.
    """
    every = survivors.select("id", "text", F.lit(False).alias("old"))
    if recent is not None:
        every = every.unionByName(recent.select("id", "text", F.lit(True).alias("old")))
    every = cut(every, "compared")
    flags = every.select("id", "old", length_bucket(word_count(F.col("text"))).alias("bucket"))
    pairs = near_pairs(every)
    pairs = pairs.join(flags.select(F.col("id").alias("a"), F.col("old").alias("old_a"), F.col("bucket").alias("bucket_a")), "a")
    pairs = cut(pairs.join(flags.select(F.col("id").alias("b"), F.col("old").alias("old_b"), F.col("bucket").alias("bucket_b")), "b").filter("NOT (old_a AND old_b)"), "pairs")
    # matches as (survivor, other), where other is older work or an earlier survivor
    forward = pairs.filter("NOT old_b").select(F.col("b").alias("id"), F.col("a").alias("other"), F.col("old_a").alias("old"), (F.col("bucket_a") - F.col("bucket_b")).alias("off"))
    back = pairs.filter("NOT old_a AND old_b").select(F.col("a").alias("id"), F.col("b").alias("other"), F.lit(True).alias("old"), (F.col("bucket_b") - F.col("bucket_a")).alias("off"))
    matches = cut(forward.unionByName(back), "matches")
    from_old = matches.filter("old").select("id").distinct()
    inner = matches.filter("NOT old").join(from_old, "id", "left_anti").join(from_old.select(F.col("id").alias("other")), "other", "left_anti")
    kept = resolve(survivors, inner.select(F.col("other").alias("a"), F.col("id").alias("b"))).filter("kept").join(from_old, "id", "left_anti").select("id")
    eligible = matches.filter("old").unionByName(matches.filter("NOT old").join(kept.select(F.col("id").alias("other")), "other", "left_semi").select(*matches.columns))
    order = F.struct("off", F.expr("NOT old"), F.when(F.col("old"), -F.col("other")).otherwise(F.col("other")))
    return eligible.join(kept, "id", "left_anti").groupBy("id").agg(F.min_by("other", order).alias("duplicate_of"))


def mark(items: DataFrame, duplicates: DataFrame, reason: str) -> DataFrame:
    """Items with the duplicates' status, target and reason."""
    joined = items.join(duplicates.select("id", F.col("duplicate_of").alias("_of")), "id", "left")
    hit = F.col("_of").isNotNull()
    out = joined.withColumn("duplicate_of", F.coalesce("_of", "duplicate_of")).withColumn("status", F.when(hit, F.lit("duplicate")).otherwise(F.col("status")))
    return out.withColumn("error", F.when(hit, F.lit(reason)).otherwise(F.col("error"))).select(*items.columns)
