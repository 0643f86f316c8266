"""Connected components of a graph in a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def components(links: DataFrame) -> DataFrame:
    """``id, root``: for each end of ``links(a, b)`` the smallest id reachable. Links with a null end are ignored.

    Rounds of contraction: each node points to its smallest neighbour if that is smaller; pointers are followed to their ends; links between the ends
    remain for the next round. A round at least halves the number of linked nodes. Only minima, joins and distinct rows are
    used, so a node with very many links costs no more than the rows of its links, pre-aggregated before the shuffle.
    """
    left = cut(links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    whole = None
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("root")), "links")
        while True:
            next_ = point.select(F.col("id").alias("root"), F.col("root").alias("further"))
            point_ = cut(point.join(next_, "root").select("id", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "links")
            moved = not point_.filter("moved").isEmpty()
            point = point_.drop("moved")
            if not moved:
                break
        if whole is None:
            whole = point
        else:
            more = point.select(F.col("id").alias("root"), F.col("root").alias("further"))
            whole = cut(whole.join(more, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "links")
        ends = lambda c: point.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))
        left = left.join(ends("a"), "a").join(ends("b"), "b").filter("ra != rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
        left = cut(left.distinct(), "links")
    if whole is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return whole
