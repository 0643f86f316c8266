"""The tables of the corpus, and views of other tables in their shape."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapsed, content_hash, summary, word_count
from ..operators.classify import CONTENT_TYPES, EVIDENCE, TOPICS

ITEMS = (
    "id long, source_id string, org string, country string, region string, target_name string, url string, canonical_url string, title string, author string, published_at date, "
    "date_source string, first_seen timestamp, last_seen timestamp, updated_at timestamp, body_text string, summary string, word_count int, content_hash string, media_type string, "
    "language string, content_type string, topics array<string>, evidence string, pub_content_type string, pub_topics array<string>, confidence double, needs_review boolean, "
    "reviewed boolean, duplicate_of long, status string, error string, run_id long"
)
REVISIONS = "id long, item_id long, content_hash string, seen_at timestamp, word_count int"
RUNS = "id long, started_at timestamp, finished_at timestamp, discovered int, extracted int, duplicates int, classified int, ok boolean, notes string"
SOURCE_RUNS = "id long, run_id long, source_id string, target string, found int, new_items int, ok boolean, error string"

#: Today, for all queries over the test tables.
AS_OF = date(2026, 4, 1)
#: Keywords that the invented words of the test tables hold.
SAMPLE_KEYWORDS = {"digital": ["thand", "ouer", "ing the"], "finance": ["ander", "ention"], "food": ["eau", "tre"], "energy": ["schaft", "ung"], "safety": ["ción", "ado"], "law": ["erst", "hand", "the th"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def aligned(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema: missing ones null, others dropped, types as given."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in (f.split(" ", 1) for f in schema.split(", "))])


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` and ``labels`` as classified items; what documents do not state follows from their id."""
    docs = table(spark, sf_dir, "documents")
    poor = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("_q"))
    i = F.col("doc_id")
    pick = lambda values, at: F.get(F.array(*map(F.lit, values)), at.cast("int"))
    topics = F.array_distinct(F.array(pick(TOPICS, i % 11), pick(TOPICS, F.floor(i / 11) % 11)))
    rows = docs.join(poor, "doc_id", "left").select(
        i.alias("id"),
        F.col("source").alias("source_id"),
        F.concat(F.lit("Org "), "source", F.when(i % 2 == 1, F.lit(" Ltd")).otherwise(F.lit(""))).alias("org"),
        F.concat(F.lit("C"), (i % 7).cast("string")).alias("country"),
        F.concat(F.lit("R"), (i % 3).cast("string")).alias("region"),
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), i.cast("string")).alias("url"),
        F.substring(collapsed(F.col("text")), 1, 80).alias("title"),
        F.date_add(F.lit("2025-10-01").cast("date"), ((i * 37) % 120).cast("int")).alias("published_at"),
        F.when(i % 6 == 0, F.lit("first_seen")).otherwise(F.lit("feed")).alias("date_source"),
        F.date_add(F.lit("2026-01-01").cast("date"), (i % 90).cast("int")).cast("timestamp").alias("first_seen"),
        F.col("text").alias("body_text"),
        summary(F.col("text")).alias("summary"),
        word_count(F.col("text")).alias("word_count"),
        content_hash(F.col("text")).alias("content_hash"),
        F.lit("html").alias("media_type"),
        F.col("lang").alias("language"),
        pick(CONTENT_TYPES, i % 9).alias("content_type"),
        F.when(i % 5 == 4, F.array().cast("array<string>")).when(i % 3 == 0, topics).otherwise(F.slice(topics, 1, 1)).alias("topics"),
        pick(EVIDENCE, i % 4).alias("evidence"),
        F.when(i % 8 == 0, F.lit("Press")).alias("pub_content_type"),
        ((i % 10) / 10).alias("confidence"),
        (F.coalesce("_q", F.lit(0)) == 0).alias("needs_review"),
        (i % 13 == 0).alias("reviewed"),
        F.lit("classified").alias("status"),
        F.lit(1).cast("long").alias("run_id"),
    )
    return aligned(rows, ITEMS)


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as freshly extracted items: no labels yet."""
    return items(spark, sf_dir).withColumns({"status": F.lit("extracted"), "content_type": F.lit(None).cast("string"), "topics": F.lit(None).cast("array<string>"), "evidence": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of ``pages`` as candidates, each also in a second form."""
    own = pages(spark, sf_dir).select("page_id", "url")
    both = own.select((F.col("page_id") % 5).cast("int").alias("source_ord"), F.lit(0).alias("target_ord"), F.col("page_id").cast("int").alias("cand_ord"), "page_id", "url")
    again = own.filter("page_id % 4 = 0").select(
        (F.col("page_id") % 3).cast("int").alias("source_ord"), F.lit(1).alias("target_ord"), F.col("page_id").cast("int").alias("cand_ord"), "page_id", F.concat(F.split_part("url", F.lit("#"), F.lit(1)), F.lit("#again")).alias("url")
    )
    return both.unionByName(again)


def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the log of targets: a day is a run."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).cast("long").alias("run_id"),
        F.concat(F.lit("s"), (F.col("user_id") % 20).cast("string")).alias("source_id"),
        F.col("event_type").alias("target"),
        F.floor("value").cast("int").alias("found"),
        F.col("ts").cast("timestamp").alias("at"),
        (F.col("event_type") != "error").alias("ok"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = source_runs(spark, sf_dir)
    return log.groupBy(F.col("run_id").alias("id")).agg(F.min("at").alias("started_at"), F.sum("found").alias("discovered"))


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as sights of items: user is the item, the type its text."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("item_id"), F.sha2("event_type", 256).alias("content_hash"), F.col("ts").cast("timestamp").alias("seen_at"))
