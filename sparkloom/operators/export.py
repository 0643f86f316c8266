"""What leaves the corpus: items without their text, sources, runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CARD, search_text, summary

# The columns of an exported item. The text is not among them.
COLUMNS = [
    "id", "source_id", "org", "country", "region", "url", "title", "summary", "published_at", "date_source", "first_seen", "updated_at", "word_count", "media_type", "language",
    "content_type", "topics", "evidence", "confidence", "pub_content_type", "needs_review",
]
RUNS = 26


def exported(items: DataFrame) -> DataFrame:
    """Classified items as cards; :func:`write` puts the newest first."""
    rows = items.filter("status = 'classified'").select(*COLUMNS)
    rows = rows.withColumn("topics", F.coalesce("topics", F.array().cast("array<string>"))).withColumn("summary", summary(F.col("summary"), CARD))
    return rows.withColumn("search", search_text(F.col("title"), F.col("summary")))


def sources(items: DataFrame) -> DataFrame:
    """Per source the number of classified items and the latest date; org, country and region are the latest row's (ties: the largest id)."""
    latest = F.struct("published_at", "id")
    rows = items.filter("status = 'classified'").groupBy("source_id")
    return rows.agg(*[F.max_by(c, latest).alias(c) for c in ("org", "country", "region")], F.count(F.lit(1)).alias("items"), F.max("published_at").alias("latest")).orderBy("org", "source_id")


def runs(runs_: DataFrame, source_runs: DataFrame, last: int = RUNS) -> DataFrame:
    """The last runs with the number of their failed targets, none as 0."""
    newest = runs_.orderBy(F.col("id").desc()).limit(last)
    failed = source_runs.filter("NOT ok").groupBy(F.col("run_id").alias("id")).agg(F.count(F.lit(1)).alias("failed_sources"))
    return newest.join(failed, "id", "left").na.fill(0, ["failed_sources"]).orderBy(F.col("id").desc())


def write(items: DataFrame, runs_: DataFrame, source_runs: DataFrame, folder: str) -> None:
    """Three JSON tables in a folder."""
    exported(items).orderBy(F.col("published_at").desc(), F.col("id").desc()).write.mode("overwrite").json(f"{folder}/items")
    sources(items).write.mode("overwrite").json(f"{folder}/sources")
    runs(runs_, source_runs).write.mode("overwrite").json(f"{folder}/runs")


def read(spark, folder: str, schema=None) -> DataFrame:  # noqa: ANN001
    """Exported items; columns that an older export lacks come out null where a schema names them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(f"{folder}/items")
