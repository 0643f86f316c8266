"""Queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, html_render, jaccard, line_dedup, lm, quality, simhash, token_files, toxicity
from .kernels import crc32_of_id
from .shared import bounded_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held(mod: int, rest: int) -> Column:
    """Whether a row is held out by its id; one without id is not."""
    return F.coalesce(crc32_of_id() % mod == rest, F.lit(False))


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm.score(docs, lm.train(docs.filter(~_held(7, 2)), cutoff=1))
    return scored.select("doc_id", _held(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = _table(spark, sf_dir, "labels").filter(~_held(3, 1))
    scored = toxicity.score(docs, toxicity.train(docs, learn, "toxic"))
    return scored.select("doc_id", _held(3, 1).alias("held_out"), "score", quality.predicted(0.7))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.match(docs, _table(spark, sf_dir, "benchmark"), n=10))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = _table(spark, sf_dir, "labels").filter(~_held(5, 0))
    scored = quality.score(docs, quality.train(docs, learn, "quality"))
    return scored.select("doc_id", _held(5, 0).alias("held_out"), "score", quality.predicted(0.3))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited(_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.figures(html_render.extract(_table(spark, sf_dir, "pages")))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), _vocabulary("word_bpe_49k.json"), decoded=True))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents"), n=5, percent=80)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = token_files.write(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, folder, files, ids=False)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), width=3)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_html_text": op6_html_text,
    "op7_bpe": op7_bpe,
    "op8_jaccard": op8_jaccard,
    "op9_token_files": op9_token_files,
    "op10_line_dedup": op10_line_dedup,
}

SQL: dict[str, str] = {
    "op3_decontamination": decontaminate.SQL,
    "op8_jaccard": jaccard.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
