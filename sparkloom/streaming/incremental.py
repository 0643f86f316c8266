"""Candidates as a stream: an extension that feeds the batch stages. Each micro-batch makes the next snapshot of the items."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import discover
from ..plans.cuts import cut


class Snapshots:
    """The current items; a batch that is seen again (after a failure) changes nothing, as its addresses are held."""

    def __init__(self, items: DataFrame):
        self.items = items

    def add(self, batch: DataFrame, number: int, clock: Callable[[], datetime]) -> None:
        fresh = discover.new_candidates(batch, self.items)
        self.items = cut(discover.insert_new(self.items, fresh, clock(), number), "items")


def follow(spark: SparkSession, folder: str, schema: str, snapshots: Snapshots, checkpoint: str, clock: Callable[[], datetime]) -> StreamingQuery:
    """Takes in all Parquet files of candidates that lie in a folder, and ends."""
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(lambda batch, number: snapshots.add(batch, number, clock)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
