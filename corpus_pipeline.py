"""A pipeline over documents: toxicity, line dedup, near duplicates, benchmark decontamination, token ids.

Each stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before it wrote, and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe, decontaminate, jaccard, line_dedup, toxicity
from sparkloom.llm.shared import bounded_batches, cut, new_folder

#: A document goes if its score is this or more.
TOXIC = 0.7
#: Words of a benchmark passage, and the share of a document's words in such passages above which it goes whole.
PASSAGE, COVERAGE = 10, 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go. The models learn from all labels of the documents at hand."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, "toxic")
    return toxicity.score(docs, model).filter(F.col("score") < TOXIC).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in later occurrences of three-line windows go; a document that loses all its words goes with them."""
    kept = line_dedup.line_dedup(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return kept.filter(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity, the one with the smallest doc_id stays. Of rows equal in doc_id and text one stays. A document
    without doc_id goes by a hash of its text instead, of 2**62 or more, so that one with a doc_id stays before it."""
    bounded_batches(spark)
    high = 1 << 62
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(F.lit(high - 1)).bitwiseOR(F.lit(high)))
    named = docs.withColumn("_own", own).withColumn("_text", F.xxhash64("text"))
    groups = jaccard.jaccard_join(named.select(F.col("_own").alias("doc_id"), "text"))
    gone = cut(groups.filter("component_id != doc_id").select(F.col("doc_id").alias("_own")).distinct(), "copies")
    left = named.join(gone, "_own", "left_anti")
    again = cut(named.groupBy("_own", "_text").count().filter("count > 1").select("_own", "_text"), "repeats")
    if not again.isEmpty():
        repeated = left.join(again, ["_own", "_text"], "left_semi").dropDuplicates(["_own", "_text"])
        left = left.join(again, ["_own", "_text"], "left_anti").unionByName(repeated)
    return left.select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go; a document that consists mostly of them goes whole."""
    bounded_batches(spark)
    clean = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), PASSAGE, COVERAGE)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: ``doc_id, n_tokens, ids``."""
    bounded_batches(spark)
    import public_tokenizers

    return bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("bpe", encode_tokens),
]

#: SQL cannot express the first and the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
