"""Classification: keyword scores, a model's replies, a publisher's labels, and what needs review."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsons import valid_only
from ..functions.text import collapsed, occurrences
from ..plans.cuts import cut

# The axes on which items are tagged, and the words that suggest a topic.
CONTENT_TYPES = ["news", "advice", "research", "policy", "enforcement", "review", "campaign", "blog", "event"]
EVIDENCE = ["original", "cited", "none"]
TOPICS = ["digital", "finance", "food", "energy", "safety", "sustainability", "scams", "law", "travel", "telecoms", "housing"]
KEYWORDS = {
    "digital": ["privacy", "data protection", "algorithm", "platform", " ai ", "artificial intelligence", "online", "digital", "cyber"],
    "finance": ["bank", "credit", "loan", "insurance", "payment", "fintech", "mortgage", "interest rate", "overdraft"],
    "food": ["food", "nutrition", "labelling", "obesity", "hfss", "diet"],
    "energy": ["energy", "electricity", "gas bill", "tariff", "utility"],
    "safety": ["recall", "product safety", "hazard", "unsafe", "standard"],
    "sustainability": ["sustainab", "repair", "greenwash", "waste", "circular", "emissions"],
    "scams": ["scam", "fraud", "misleading", "rip-off", "phishing"],
    "law": ["consumer law", "redress", "compensation", "regulation", "competition", "rights"],
}

READ_CHARS = 2000
PROMPT_CHARS = 2500
OFFLINE_CONFIDENCE = 0.4
REVIEW_BELOW = 0.7
BATCH = 10


def haystack(title: Column, body: Column) -> Column:
    return F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(F.coalesce(body, F.lit("")), 1, READ_CHARS)))


def keyword_score(text: Column, words: list[str]) -> Column:
    """Places where one of the words occurs, summed over the words."""
    out = F.lit(0).cast("long")
    for w in words:
        out = out + occurrences(text, w)
    return out


def keyword_topics(text: Column, keywords: dict[str, list[str]] = KEYWORDS, top: int = 2) -> Column:
    """The best topics by score, then by name, both descending; none that scores nothing."""
    scored = F.array(*[F.struct(keyword_score(text, words).alias("score"), F.lit(topic).alias("topic")) for topic, words in keywords.items()])
    best = F.slice(F.sort_array(scored, asc=False), 1, top)
    return F.transform(F.filter(best, lambda s: s["score"] > 0), lambda s: s["topic"])


def offline(rows: DataFrame, keywords: dict[str, list[str]] = KEYWORDS) -> DataFrame:
    """``id, content_type, topics, evidence, confidence`` of ``id, title, body_text, target_name`` without a model."""
    form = F.when(F.col("target_name").isin(CONTENT_TYPES), F.col("target_name")).otherwise(F.lit("news"))
    # the text is prepared once, before the many scores over it
    text = rows.select("id", "target_name", haystack(F.col("title"), F.col("body_text")).alias("_h"))
    return text.select(
        "id", form.alias("content_type"), keyword_topics(F.col("_h"), keywords).alias("topics"), F.lit(None).cast("string").alias("evidence"), F.lit(OFFLINE_CONFIDENCE).alias("confidence")
    )


def checked(replies: DataFrame) -> DataFrame:
    """A model's replies: unknown forms go with their rows, unknown topics and evidence go; confidence is 0.5 if not given."""
    known = F.col("evidence").isin(EVIDENCE)
    return replies.filter(F.col("content_type").isin(CONTENT_TYPES)).select(
        "id", "content_type", F.coalesce(valid_only(F.col("topics"), TOPICS), F.array().cast("array<string>")).alias("topics"), F.when(known, F.col("evidence")).alias("evidence"), F.coalesce("confidence", F.lit(0.5)).alias("confidence")
    )


def with_default(work: DataFrame, replies: DataFrame) -> DataFrame:
    """A reply for every row; where there is none: news, no topics, no evidence, confidence 0."""
    joined = work.select("id").join(replies, "id", "left")
    return joined.select(
        "id", F.coalesce("content_type", F.lit("news")).alias("content_type"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"), "evidence", F.coalesce("confidence", F.lit(0.0)).alias("confidence")
    )


def prompt_part(n: Column, org: Column, title: Column, body: Column) -> Column:
    """What a model reads of an item: its number, organisation, title and the first 2500 characters of its collapsed text."""
    return F.concat_ws("\n", F.concat(F.lit("ITEM "), n.cast("string")), F.concat(F.lit("ORGANISATION: "), F.coalesce(org, F.lit(""))), F.concat(F.lit("TITLE: "), F.coalesce(title, F.lit(""))), F.concat(F.lit("TEXT: "), F.substring(collapsed(body), 1, PROMPT_CHARS)))


def may_classify(again: bool, has_model: bool, offline_: bool) -> None:
    """Labelling everything anew by keywords would lose a model's labels, so it must be asked for."""
    if again and not has_model and not offline_:
        raise ValueError("classifying everything again needs a model, or offline=True")


def model_replies(work: DataFrame, ask: Callable[[list[dict]], list[dict]], keywords: dict[str, list[str]] = KEYWORDS) -> DataFrame:
    """Replies of ``ask`` to batches of ten rows, checked; a batch that fails is classified by keywords."""
    from collections.abc import Iterator

    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                rows = frame.iloc[at : at + BATCH]
                try:
                    got = ask(rows.to_dict("records"))
                    yield pd.DataFrame([{"id": r["id"], "content_type": r.get("content_type"), "topics": list(r.get("topics") or []), "evidence": r.get("evidence"), "confidence": r.get("confidence"), "failed": False} for r in got])
                except Exception:  # noqa: BLE001  any failure of the service
                    yield pd.DataFrame([{"id": i, "content_type": None, "topics": [], "evidence": None, "confidence": None, "failed": True} for i in rows["id"]])

    schema = "id long, content_type string, topics array<string>, evidence string, confidence double, failed boolean"
    # both uses below read what was written: the service is asked once, and no batch counts as answered in one and as failed in the other
    got = cut(work.select("id", "title", "body_text", "target_name").mapInPandas(run, schema), "replies")
    fine = checked(got.filter("NOT failed"))
    return with_default(work, fine.unionByName(offline(work.join(got.filter("failed").select("id"), "id", "left_semi"), keywords)))


def review_flag(confidence: Column, topics: Column, evidence: Column, from_publisher: Column) -> Column:
    """Whether a person should look: no topics or no evidence, and for a model's labels a low confidence."""
    thin = (F.size(F.coalesce(topics, F.array().cast("array<string>"))) <= 0) | evidence.isNull()
    return F.when(from_publisher, thin).otherwise(thin | (F.coalesce(confidence, F.lit(0.0)) < REVIEW_BELOW))


def work_set(items: DataFrame, again: bool = False) -> DataFrame:
    """Items to classify: extracted ones without a form, and any without evidence; with ``again`` all."""
    open_ = items.filter("status IN ('extracted', 'classified')")
    return open_ if again else open_.filter("(status = 'extracted' AND content_type IS NULL) OR evidence IS NULL")


def pre_tag(items: DataFrame) -> DataFrame:
    """Extracted items whose form is known count as classified and need no review."""
    hit = F.expr("status = 'extracted' AND content_type IS NOT NULL")
    return items.withColumn("needs_review", F.when(hit, F.lit(False)).otherwise(F.col("needs_review"))).withColumn("status", F.when(hit, F.lit("classified")).otherwise(F.col("status")))


def apply(items: DataFrame, replies: DataFrame) -> DataFrame:
    """Items with the replies. A publisher's form and confidence stay, and its topics where it gave any; otherwise all fields are the reply's."""
    own = replies.select("id", *[F.col(c).alias(f"_{c}") for c in ("content_type", "topics", "evidence", "confidence")])
    joined = items.join(own, "id", "left")
    hit, publisher = F.col("_content_type").isNotNull(), F.coalesce(F.col("pub_content_type"), F.lit("")) != ""
    topics = F.when(publisher & (F.size(F.coalesce("pub_topics", F.array().cast("array<string>"))) > 0), F.col("pub_topics")).otherwise(F.col("_topics"))
    joined = joined.withColumn("_new_topics", topics)
    flag = review_flag(F.col("_confidence"), F.col("_new_topics"), F.col("_evidence"), publisher)
    new = {
        "content_type": F.when(publisher, F.col("content_type")).otherwise(F.col("_content_type")),
        "confidence": F.when(publisher, F.col("confidence")).otherwise(F.col("_confidence")),
        "topics": F.col("_new_topics"),
        "evidence": F.col("_evidence"),
        "needs_review": flag,
        "status": F.lit("classified"),
    }
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in items.columns])
