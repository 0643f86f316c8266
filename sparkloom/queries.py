"""Queries by name: each applies one operator to whole test tables; SQL with the same rows beside it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates, jsons, text, urls
from .operators import audit, classify, dedupe, discover, export, extract, revisions, search, stats
from .plans import harvest, model
from .plans.model import AS_OF, SAMPLE_KEYWORDS, table
from .sources import feeds, pages

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    """Registers a function (spark, sf_dir) under its name."""

    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- SQL in common

WS = r"'[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"
_list = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
ITEMS = f"""
flat AS (SELECT d.doc_id AS id, source AS source_id, lang AS language, text AS body_text, trim(regexp_replace(coalesce(text, ''), {WS}, ' ', 'g')) AS t, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
items AS (
  SELECT id, source_id, 'Org ' || source_id || CASE WHEN id % 2 = 1 THEN ' Ltd' ELSE '' END AS org, 'C' || (id % 7) AS country, 'R' || (id % 3) AS region, language, body_text,
    'https://' || source_id || '.example.org/' || id AS url, substring(t, 1, 80) AS title, substring(t, 1, 400) AS summary, substring(t, 1, 240) AS card,
    lower(substring(t, 1, 80) || ' ' || substring(t, 1, 240)) AS search,
    DATE '2025-10-01' + CAST((id * 37) % 120 AS INTEGER) AS published_at, DATE '2026-01-01' + CAST(id % 90 AS INTEGER) AS seen,
    CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS word_count, sha256(lower(t)) AS content_hash,
    {_list(classify.CONTENT_TYPES)}[CAST(id % 9 AS INTEGER) + 1] AS content_type,
    CASE WHEN id % 5 = 4 THEN [] WHEN id % 3 = 0 AND id % 11 <> (id // 11) % 11 THEN [{_list(classify.TOPICS)}[CAST(id % 11 AS INTEGER) + 1], {_list(classify.TOPICS)}[CAST((id // 11) % 11 AS INTEGER) + 1]]
      ELSE [{_list(classify.TOPICS)}[CAST(id % 11 AS INTEGER) + 1]] END AS topics,
    {_list(classify.EVIDENCE)}[CAST(id % 4 AS INTEGER) + 1] AS evidence, CASE WHEN id % 8 = 0 THEN 'Press' END AS pub_content_type, (id % 10) / 10 AS confidence,
    coalesce(quality, 0) = 0 AS needs_review, id % 13 = 0 AS reviewed FROM flat)"""

_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?', 1)), '^www\\.', ''), ':443$', '')"
CANON = rf"""
parts AS (SELECT *, {_HOST} AS h, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS p0, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q FROM src),
paths AS (SELECT *, regexp_replace(regexp_replace(p0, '^((?:.*/)?[^/;]*);[^/]*$', '\1'), '/index\.(html?|php|aspx)$', '/') AS p1 FROM parts),
pairs AS (SELECT *, list_sort(list_filter(list_transform(list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '^[^=]*=.')),
    lambda x: {{'k': url_decode(replace(regexp_extract(x, '^([^=]*)=', 1), '+', ' ')), 'v': url_decode(replace(regexp_extract(x, '^[^=]*=(.*)$', 1), '+', ' '))}}),
    lambda s: NOT regexp_matches(s.k, '(?i)^({"|".join(urls.JUNK_PREFIXES)})'))) AS kept FROM paths),
canon AS (SELECT * EXCLUDE (h, p0, q, p1, kept), 'https://' || h || CASE WHEN length(p1) > 1 AND regexp_replace(p1, '/+$', '') <> '' THEN regexp_replace(p1, '/+$', '') WHEN p1 = '' THEN '/' ELSE '/' END
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_transform(kept, lambda s: replace(url_encode(s.k), '%20', '+') || '=' || replace(url_encode(s.v), '%20', '+')), '&') ELSE '' END AS canonical_url FROM pairs)"""
CANDIDATES = """
src AS (SELECT page_id % 5 AS source_ord, 0 AS target_ord, page_id AS cand_ord, page_id, url FROM pages
  UNION ALL SELECT page_id % 3, 1, page_id, page_id, split_part(url, '#', 1) || '#again' FROM pages WHERE page_id % 4 = 0)"""
RUN_LOG = "log AS (SELECT event_id AS id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS run_id, 's' || (user_id % 20) AS source_id, event_type AS target, CAST(floor(value) AS INTEGER) AS found, ts, event_type <> 'error' AS ok FROM events)"


# ---- addresses


@query(f"WITH src AS (SELECT page_id, url FROM pages), {CANON} SELECT page_id, canonical_url FROM canon")
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.pages(spark, sf_dir).select("page_id", urls.canonical_url(F.col("url")).alias("canonical_url"))


@query(f"WITH {CANDIDATES}, {CANON} SELECT canonical_url, page_id, source_ord, target_ord FROM canon QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY source_ord, target_ord, cand_ord) = 1")
def url_first_seen_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = discover.first_of_each(discover.keyed(model.candidates(spark, sf_dir)), "canonical_url", discover.ORDER)
    return rows.select("canonical_url", "page_id", F.col("source_ord").cast("long").alias("source_ord"), "target_ord")


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.keyed(model.pages(spark, sf_dir).filter("page_id % 2 = 0"))


_HELD = f"WITH {CANDIDATES}, {CANON}, held AS (SELECT canonical_url FROM canon WHERE target_ord = 0 AND page_id % 2 = 0)"


@query(f"{_HELD} SELECT canonical_url, page_id FROM canon WHERE canonical_url NOT IN (SELECT canonical_url FROM held) QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY source_ord, target_ord, cand_ord) = 1")
def url_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.new_candidates(model.candidates(spark, sf_dir), _held(spark, sf_dir)).select("canonical_url", "page_id")


@query(f"{_HELD} SELECT canonical_url, page_id, target_ord FROM canon WHERE canonical_url IN (SELECT canonical_url FROM held)")
def url_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.known_candidates(model.candidates(spark, sf_dir), _held(spark, sf_dir)).select("canonical_url", "page_id", "target_ord")


@query(f"WITH src AS (SELECT page_id, url FROM pages), {CANON} SELECT page_id, CAST(len(list_filter(string_split(canonical_url, '/')[4:], lambda s: s <> '')) AS INTEGER) AS depth FROM canon")
def url_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.pages(spark, sf_dir).select("page_id", urls.depth(urls.canonical_url(F.col("url"))).alias("depth"))


@query("SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, count(*) AS n, max(page_id) AS last_page FROM pages GROUP BY 1")
def host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.pages(spark, sf_dir).groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last_page"))


@query("SELECT page_id, url FROM pages WHERE (contains(url, '/en/') OR contains(url, '/fr/')) AND NOT contains(url, 'spam') AND NOT contains(url, '#')")
def include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.pages(spark, sf_dir).filter(urls.matches(F.col("url"), ["/en/", "/fr/"], ["spam", "#"])).select("page_id", "url")


# ---- texts and duplicates


@query(f"SELECT doc_id, sha256(lower(trim(regexp_replace(coalesce(text, ''), {WS}, ' ', 'g')))) AS content_hash FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query(f"WITH {ITEMS} SELECT id, first_id AS duplicate_of FROM (SELECT id, min(id) OVER (PARTITION BY content_hash) AS first_id FROM items) WHERE id <> first_id")
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.exact_duplicates(model.extracted(spark, sf_dir))


@query(f"WITH {ITEMS} SELECT content_hash, min(id) AS first_id, count(*) AS n FROM items GROUP BY 1 HAVING count(*) > 1")
def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.items(spark, sf_dir).groupBy("content_hash").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return rows.filter("n > 1")


@query(f"WITH {ITEMS} SELECT id, CAST(word_count AS INTEGER) AS word_count, 'too short (' || word_count || ' words)' AS error FROM items WHERE word_count < 40")
def word_count_stub_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.items(spark, sf_dir).select("id", "word_count", extract.failure(F.lit(200), F.col("word_count")).alias("error"))
    return rows.filter("error IS NOT NULL")


_WORDS = "words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')[:300] AS w, text FROM documents)"
_SETS = (
    "sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) ELSE [] END AS sh, "
    f"CAST(floor(floor(sqrt(CASE WHEN trim(regexp_replace(coalesce(text, ''), {WS}, ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(coalesce(text, ''), {WS}, ' ', 'g')), ' ')) END)) / 2) AS BIGINT) AS bucket FROM words)"
)
_SURVIVORS = f"{_WORDS}, {_SETS}, firsts AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(lower(trim(regexp_replace(coalesce(text, ''), {WS}, ' ', 'g')))))"
_NEAR = f"""{_SURVIVORS},
s AS (SELECT doc_id, unnest(sh) AS x FROM sets SEMI JOIN firsts USING (doc_id)),
near AS (SELECT p.a, p.b, p.common, len(x.sh) + len(y.sh) - p.common AS total FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common FROM s l JOIN s r ON l.x = r.x AND l.doc_id < r.doc_id GROUP BY 1, 2) p
  JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b WHERE abs(x.bucket - y.bucket) <= 1 AND p.common * 100 >= 82 * (len(x.sh) + len(y.sh) - p.common))"""


@query(f"WITH {_WORDS}, {_SETS} SELECT doc_id, CAST(len(sh) AS INTEGER) AS n_shingles FROM sets")
def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", text.compared_words(F.col("text")).alias("w"))
    return words.select("doc_id", F.size(text.shingles(F.col("w"))).alias("n_shingles"))


@query(f"WITH {_WORDS}, {_SETS} SELECT bucket, count(*) AS n FROM sets GROUP BY 1")
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(text.length_bucket(text.word_count(F.col("text"))).alias("bucket"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def _survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model.extracted(spark, sf_dir)
    return rows.join(dedupe.exact_duplicates(rows).select("id"), "id", "left_anti").select("id", F.col("body_text").alias("text"))


@query(f"WITH {_NEAR} SELECT a, b, common, total FROM near")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.near_pairs(_survivors(spark, sf_dir))


@query(
    f"""WITH {_NEAR}, off AS (SELECT n.*, x.bucket - y.bucket AS off FROM near n JOIN sets x ON x.doc_id = n.a JOIN sets y ON y.doc_id = n.b),
k0 AS (SELECT DISTINCT a AS id FROM off WHERE a NOT IN (SELECT b FROM off)),
g1 AS (SELECT DISTINCT b AS id FROM off WHERE a IN (SELECT id FROM k0)),
k1 AS (SELECT id FROM k0 UNION SELECT b FROM off WHERE b NOT IN (SELECT id FROM g1) GROUP BY b HAVING bool_and(a IN (SELECT id FROM g1))),
g2 AS (SELECT DISTINCT b AS id FROM off WHERE a IN (SELECT id FROM k1)),
k2 AS (SELECT id FROM k1 UNION SELECT b FROM off WHERE b NOT IN (SELECT id FROM g2) GROUP BY b HAVING bool_and(a IN (SELECT id FROM g2)))
SELECT b AS id, arg_min(a, off * 1000000000000 + a) AS duplicate_of FROM off WHERE a IN (SELECT id FROM k2) AND b NOT IN (SELECT id FROM k2) GROUP BY 1"""
)
def near_dup_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.near_duplicates(_survivors(spark, sf_dir))


# ---- revisions

_LATEST = "latest AS (SELECT item_id, content_hash, seen_at FROM rev QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY seen_at DESC, content_hash DESC) = 1)"
_REV = "rev AS (SELECT event_id AS id, user_id AS item_id, sha256(event_type) AS content_hash, ts AS seen_at FROM events)"


@query(f"WITH {_REV}, {_LATEST} SELECT item_id, content_hash, CAST(epoch_us(seen_at) AS BIGINT) AS seen_us FROM latest")
def revision_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisions.latest(model.revisions(spark, sf_dir)).select("item_id", "content_hash", F.unix_micros("seen_at").alias("seen_us"))


@query(
    f"""WITH {_REV}, old AS (SELECT * FROM rev WHERE id % 50 = 0), new AS (SELECT * FROM rev WHERE id % 50 <> 0),
fresh AS (SELECT * FROM new ANTI JOIN old USING (item_id, content_hash) QUALIFY row_number() OVER (PARTITION BY item_id, content_hash ORDER BY seen_at) = 1)
SELECT id, item_id, content_hash FROM old UNION ALL SELECT id, item_id, content_hash FROM fresh"""
)
def revision_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    # an earlier state and what comes after it: the two halves of the whole table
    every = model.revisions(spark, sf_dir)
    return revisions.insert_or_ignore(every.filter("id % 50 = 0"), every.filter("id % 50 <> 0")).select("id", "item_id", "content_hash")


@query(f"WITH {_REV}, {_LATEST} SELECT u.item_id AS id, coalesce(l.content_hash <> sha256('click'), false) AS updated FROM (SELECT DISTINCT item_id FROM rev) u LEFT JOIN latest l USING (item_id)")
def updated_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rev = model.revisions(spark, sf_dir)
    now = rev.select(F.col("item_id").alias("id")).distinct().withColumn("content_hash", F.sha2(F.lit("click").cast("binary"), 256))
    return revisions.updated(now, rev)


# ---- classification


def _count_sql(words: list[str], column: str = "h") -> str:
    return "(" + " + ".join(f"(length({column}) - length(replace({column}, '{w}', ''))) // {len(w)}" for w in words) + ")"


_HAY = f"{ITEMS}, hay AS (SELECT *, lower(coalesce(title, '') || ' ' || substring(coalesce(body_text, ''), 1, 2000)) AS h FROM items)"


def _topic_sql(keywords: dict[str, list[str]]) -> str:
    scored = ", ".join(f"{{'score': {_count_sql(w)}, 'topic': '{t}'}}" for t, w in keywords.items())
    return f"list_transform(list_filter(list_sort([{scored}], 'DESC')[:2], lambda s: s.score > 0), lambda s: s.topic)"


@query(f"WITH {_HAY} SELECT id, " + ", ".join(f"CAST({_count_sql(w)} AS BIGINT) AS {t}" for t, w in SAMPLE_KEYWORDS.items()) + " FROM hay")
def keyword_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = model.items(spark, sf_dir).select("id", classify.haystack(F.col("title"), F.col("body_text")).alias("h"))
    return h.select("id", *[classify.keyword_score(F.col("h"), w).alias(t) for t, w in SAMPLE_KEYWORDS.items()])


@query(f"WITH {_HAY} SELECT id, array_to_string({_topic_sql(SAMPLE_KEYWORDS)}, ',') AS topics FROM hay")
def keyword_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = model.items(spark, sf_dir).select("id", classify.haystack(F.col("title"), F.col("body_text")).alias("h"))
    return h.select("id", F.concat_ws(",", classify.keyword_topics(F.col("h"), SAMPLE_KEYWORDS)).alias("topics"))


@query(f"WITH {_HAY} SELECT id, 'news' AS content_type, array_to_string({_topic_sql(classify.KEYWORDS)}, ',') AS topics, CAST(0.4 AS DOUBLE) AS confidence FROM hay")
def offline_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.offline(model.extracted(spark, sf_dir)).select("id", "content_type", F.concat_ws(",", "topics").alias("topics"), "confidence")


_THIN = "(len(topics) = 0 OR evidence IS NULL)"


@query(f"WITH {ITEMS} SELECT id, CASE WHEN pub_content_type IS NOT NULL THEN {_THIN} ELSE {_THIN} OR confidence < 0.7 END AS needs_review FROM items")
def review_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = classify.review_flag(F.col("confidence"), F.col("topics"), F.col("evidence"), F.col("pub_content_type").isNotNull())
    return model.items(spark, sf_dir).select("id", flag.alias("needs_review"))


@query(f"WITH {ITEMS} SELECT count(*) FILTER (needs_review AND NOT reviewed) AS awaiting_review FROM items")
def review_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.awaiting_review(model.items(spark, sf_dir))


@query(
    f"""WITH {_HAY}, m AS (SELECT *, {_topic_sql(SAMPLE_KEYWORDS)} AS model_topics, pub_content_type IS NOT NULL AS pub FROM hay)
SELECT id, CASE WHEN pub THEN content_type ELSE 'news' END AS content_type, array_to_string(CASE WHEN pub AND len(topics) > 0 THEN topics ELSE model_topics END, ',') AS topics,
CASE WHEN pub THEN CAST(1 AS DOUBLE) ELSE 0.4 END AS confidence, true AS needs_review FROM m"""
)
def publisher_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    pub = F.col("pub_content_type").isNotNull()
    items = model.items(spark, sf_dir).withColumns({"pub_topics": F.when(pub, F.col("topics")), "confidence": F.when(pub, F.lit(1.0)), "content_type": F.when(pub, F.col("content_type")), "status": F.lit("extracted")})
    done = classify.apply(items, classify.offline(items, SAMPLE_KEYWORDS))
    return done.select("id", "content_type", F.concat_ws(",", "topics").alias("topics"), "confidence", "needs_review")


_MAP = {" Click": "digital", "VIEW ": "digital", "purchase": "finance", "error": ""}


@query("SELECT event_id, array_to_string(list_filter([CASE event_type WHEN 'click' THEN 'digital' WHEN 'view' THEN 'digital' WHEN 'purchase' THEN 'finance' END], lambda x: x IS NOT NULL), ',') AS labels FROM events")
def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.array("event_type", F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")))
    return table(spark, sf_dir, "events").select("event_id", F.concat_ws(",", jsons.mapped_labels(raw, _MAP)).alias("labels"))


# ---- roll-ups and export


@query(f"WITH {ITEMS} SELECT source_id, arg_max(org, published_at::VARCHAR || lpad(id::VARCHAR, 12, '0')) AS org, arg_max(country, published_at::VARCHAR || lpad(id::VARCHAR, 12, '0')) AS country, count(*) AS items, CAST(max(published_at) AS VARCHAR) AS latest FROM items GROUP BY 1")
def source_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.sources(model.items(spark, sf_dir)).select("source_id", "org", "country", "items", F.col("latest").cast("string").alias("latest"))


@query(f"WITH {RUN_LOG} SELECT id, source_id, target, found FROM log WHERE run_id = 30 AND NOT ok")
def runs_failed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.failed_targets(model.source_runs(spark, sf_dir), 30).select("id", "source_id", "target", "found")


@query(f"WITH {RUN_LOG} SELECT run_id AS id, count(*) FILTER (NOT ok) AS failed_sources, sum(found)::BIGINT AS discovered FROM log GROUP BY 1 ORDER BY 1 DESC LIMIT 26")
def last_26_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.runs(model.runs(spark, sf_dir), model.source_runs(spark, sf_dir)).select("id", "failed_sources", "discovered")


@query(f"WITH {ITEMS} SELECT id, source_id, org, country, region, url, title, card AS summary, CAST(published_at AS VARCHAR) AS published_at, CAST(word_count AS INTEGER) AS word_count, language, content_type, array_to_string(topics, ',') AS topics, evidence, confidence, pub_content_type, needs_review, search FROM items")
def export_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = export.exported(model.items(spark, sf_dir))
    keep = "id source_id org country region url title summary word_count language content_type evidence confidence pub_content_type needs_review search".split()
    return out.select(*keep, F.col("published_at").cast("string").alias("published_at"), F.concat_ws(",", "topics").alias("topics"))


@query(f"WITH {ITEMS} SELECT id, search FROM items")
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.items(spark, sf_dir).select("id", text.search_text(F.col("title"), text.summary(F.col("summary"), text.CARD)).alias("search"))


@query(
    f"""WITH {RUN_LOG}, {ITEMS}, f AS (SELECT run_id AS id, count(*) FILTER (NOT ok) AS failed FROM log GROUP BY 1)
SELECT (SELECT count(*) FROM items) AS items, (SELECT count(DISTINCT org) FROM items) AS orgs, (SELECT count(*) FILTER (needs_review) FROM items) AS to_review, (SELECT count(*) FROM f WHERE id > (SELECT max(id) - 26 FROM f)) AS runs, (SELECT arg_max(failed, id) FROM f) AS failed_latest"""
)
def header_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.header(model.items(spark, sf_dir), export.runs(model.runs(spark, sf_dir), model.source_runs(spark, sf_dir)))


# ---- search

_QUERY = "the on"


def _score_sql(terms: list[str]) -> str:
    body = lambda t: f"((length(search) - length(replace(search, '{t}', ''))) // {len(t)})"
    every = " AND ".join(f"(contains(lower(title), '{t}') OR {body(t)} > 0)" for t in terms)
    total = " + ".join(f"CASE WHEN contains(lower(title), '{t}') THEN 12 ELSE 0 END + least({body(t)}, 6)" for t in terms)
    return f"CAST(CASE WHEN {every} THEN {total} ELSE 0 END AS BIGINT)"


_FOUND = f"{ITEMS}, found AS (SELECT *, {_score_sql(search.terms_of(_QUERY))} AS score FROM items)"


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.exported(model.items(spark, sf_dir))


@query(f"WITH {_FOUND} SELECT id, title, score, CAST(published_at AS VARCHAR) AS published_at, row_number() OVER (ORDER BY score DESC, published_at DESC, id DESC) AS rank FROM found WHERE score > 0")
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hits with their ranks."""
    found = search.filtered(_cards(spark, sf_dir), _QUERY, as_of=AS_OF).select("id", "title", "score", "published_at")
    return search.numbered_ranks(found).select("id", "title", "score", F.col("published_at").cast("string").alias("published_at"), "rank")


@query(f"WITH {ITEMS} SELECT id FROM items WHERE seen >= DATE '{AS_OF}' - 7")
def lens_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filtered(_cards(spark, sf_dir), lens="this_week", as_of=AS_OF).select("id")


@query(f"WITH {ITEMS} SELECT id FROM items WHERE list_has_any(topics, ['finance', 'digital'])")
def lens_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filtered(_cards(spark, sf_dir), lens="digital_finance", as_of=AS_OF).select("id")


@query(f"WITH {ITEMS} SELECT id FROM items WHERE evidence = 'original'")
def lens_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filtered(_cards(spark, sf_dir), lens="network_research", as_of=AS_OF).select("id")


@query(f"WITH {ITEMS} SELECT id FROM items WHERE content_type IN ('policy', 'research')")
def lens_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filtered(_cards(spark, sf_dir), lens="policy", as_of=AS_OF).select("id")


@query(f"WITH {ITEMS} SELECT id FROM items WHERE needs_review")
def lens_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filtered(_cards(spark, sf_dir), lens="review_queue", as_of=AS_OF).select("id")


@query(f"WITH {_FOUND} SELECT id, score FROM found WHERE source_id = 'src3' AND content_type = 'news' AND list_has_any(topics, ['food', 'law', 'digital']) AND score > 0")
def facet_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filtered(_cards(spark, sf_dir), _QUERY, org="src3", content_type="news", topics=["food", "law", "digital"], as_of=AS_OF).select("id", "score")


@query(
    f"WITH {_FOUND}, w AS (SELECT *, date_trunc('week', seen) AS week FROM found WHERE score > 0) SELECT id, CAST(CAST(week AS DATE) AS VARCHAR) AS week, count(*) OVER (PARTITION BY week) AS n_week, week = (SELECT date_trunc('week', max(seen)) FROM items) AS is_latest FROM w"
)
def week_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _cards(spark, sf_dir)
    out = search.by_week(search.filtered(items, _QUERY, as_of=AS_OF), items)
    return out.select("id", F.col("week").cast("string").alias("week"), "n_week", "is_latest")


@query(f"WITH {ITEMS} SELECT id, CASE WHEN length(card) > 230 THEN substring(card, 1, 230) || '…' ELSE card END AS extract, id % 6 = 0 AS harvested, false AS is_pdf, false AS is_updated, coalesce(evidence, 'none') <> 'none' AS shows_evidence FROM items")
def card_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.cards(_cards(spark, sf_dir)).drop("title")


# ---- dates and JSON


@query(
    """SELECT event_id, CAST(CASE WHEN event_id % 4 = 3 THEN CASE WHEN event_id % 8 = 7 THEN NULL ELSE CAST(ts AS DATE) END ELSE CAST(ts AS DATE) END AS VARCHAR) AS day FROM events"""
)
def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), F.col("event_id")
    raw = (
        F.when(i % 4 == 0, F.unix_seconds("ts").cast("string"))
        .when(i % 4 == 1, F.unix_millis("ts").cast("string"))
        .when(i % 4 == 2, F.date_format("ts", "d MMM yyyy"))
        .when(i % 8 == 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.lit("0"))
    )
    return e.select("event_id", dates.api_date(raw, AS_OF).cast("string").alias("day"))


_SANE_AS_OF = date(2024, 1, 20)


@query("SELECT event_id, CAST(CASE WHEN year(d) >= 1995 AND d <= DATE '2024-01-20' THEN d END AS VARCHAR) AS day FROM (SELECT event_id, CAST(ts AS DATE) - CAST((event_id % 40) * 365 AS INTEGER) AS d FROM events)")
def date_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_sub(F.to_date("ts"), ((F.col("event_id") % 40) * 365).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", dates.sane(day, _SANE_AS_OF).cast("string").alias("day"))


@query(
    """WITH r AS (SELECT event_id, event_id // 100 AS page, event_id % 100 AS ord, CAST(ts AS DATE) AS d FROM events), l AS (SELECT page, arg_max(d, ord) AS last FROM r GROUP BY 1)
SELECT event_id FROM r WHERE page <= coalesce((SELECT min(page) FROM l WHERE last < DATE '2024-01-02'), 1000000000)"""
)
def cutoff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.floor(F.col("event_id") / 100).alias("page"), (F.col("event_id") % 100).alias("ord"), F.to_date("ts").alias("published_at"))
    return discover.pages_until_cutoff(rows, date(2024, 1, 2)).select("event_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def json_dig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", jsons.dig(F.col("props"), "k", "long").alias("k"), jsons.dig(F.col("props"), "k.0.x").alias("missing"))


@query("SELECT conv_id, turn, role || '|' || 'x' AS labels FROM conversations WHERE role <> ''")
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter("role <> ''")
    doc = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("role").alias("name")), F.struct(F.lit("x").alias("name"))).alias("items")).alias("data")))
    return c.select("conv_id", "turn", F.concat_ws("|", jsons.labels(doc, "data.items")).alias("labels"))


# ---- pages

_STRIP = "regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?is)<!--.*?-->', ' ', 'g')"
_TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
_TEXTS = "replace(replace(replace(replace(regexp_replace({}, '&amp;?', '&', 'g'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<')"


@query(None)
def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.facts(model.pages(spark, sf_dir)).select("page_id", "text", text.word_count(F.col("text")).alias("n_words"))


@query(f"SELECT page_id, trim({_TEXTS.format(_TITLE)}) AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.facts(model.pages(spark, sf_dir))
    return rows.select("page_id", extract.best_title(F.lit(None).cast("string"), F.col("og_title"), F.col("title")).alias("title"))


@query(
    r"""WITH l AS (SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)"', 1)) AS href FROM pages)
SELECT DISTINCT page_url, regexp_extract(page_url, '^[a-z]+://[^/?#]*', 0) || href AS url FROM l"""
)
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.links(model.pages(spark, sf_dir), "nav").select("page_url", "url")


@query(
    "WITH c AS (SELECT page_id, 's' || (page_id % 20) AS source_id, 't' || (page_id % 3) AS target FROM pages), t AS (SELECT DISTINCT source_id, target FROM c) "
    "SELECT t.source_id, t.target, count(page_id) AS found, CAST(coalesce(sum(CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS new_items, count(page_id) > 0 AS ok "
    "FROM t LEFT JOIN (SELECT * FROM c WHERE page_id % 20 NOT IN (3, 7)) f ON t.source_id = f.source_id AND t.target = f.target GROUP BY 1, 2"
)
def target_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of twenty sources, two of which find nothing and so fail."""
    page = F.col("page_id")
    every = model.pages(spark, sf_dir).select(page, F.concat(F.lit("s"), (page % 20).cast("string")).alias("source_id"), F.concat(F.lit("t"), (page % 3).cast("string")).alias("target"))
    found = every.filter(~(page % 20).isin(3, 7))
    return discover.target_log(found, found.filter(page % 2 == 0), 1, every).drop("run_id")


@query(None)
def find_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.find_date(pages.facts(model.pages(spark, sf_dir)), AS_OF)
    return rows.select("page_id", F.col("page_date").cast("string").alias("page_date"), "page_date_source")


_ESCAPED = "replace(url, '&', '&amp;')"


@query("SELECT page_id % 10 AS map, replace(url, '&', '&amp;') AS url, CASE WHEN page_id % 3 = 0 THEN CAST(DATE '2026-01-01' + CAST(page_id % 60 AS INTEGER) AS VARCHAR) END AS published_at, CASE WHEN page_id % 3 = 0 THEN 'sitemap' END AS date_source FROM pages WHERE NOT contains(url, 'spam')")
def sitemap_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = model.pages(spark, sf_dir)
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 60).cast("int")).cast("string")
    block = F.concat(F.lit("<url><loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc>"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<lastmod>"), day, F.lit("T10:00:00Z</lastmod>"))).otherwise(F.lit("")), F.lit("</url>"))
    maps = p.groupBy((F.col("page_id") % 10).alias("map")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(block), "\n"), F.lit("</urlset>")).alias("body"))
    return feeds.sitemap_urls(maps, exclude=["spam"]).select("map", "url", F.col("published_at").cast("string").alias("published_at"), "date_source")


@query("SELECT page_id, url, CAST(DATE '2026-01-01' + CAST(page_id % 60 AS INTEGER) AS VARCHAR) AS published_at, 'Page ' || page_id AS title FROM pages WHERE page_id % 7 <> 0")
def feed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = model.pages(spark, sf_dir)
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 60).cast("int")), "dd MMM yyyy")
    link = F.when(F.col("page_id") % 7 != 0, F.concat(F.lit("<link>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</link>"))).otherwise(F.lit(""))
    body = F.concat(F.lit("<rss><channel><title>t</title><item><title>Page "), F.col("page_id").cast("string"), F.lit("</title>"), link, F.lit("<pubDate>Thu, "), day, F.lit(" 23:30:00 -0800</pubDate></item></channel></rss>"))
    return feeds.feed_entries(p.select("page_id", body.alias("body"))).select("page_id", "url", F.col("published_at").cast("string").alias("published_at"), "title")


# ---- audits


@query("SELECT tier, count(*) AS n FROM (SELECT CASE WHEN page_id % 10 = 0 THEN '?' WHEN contains(url, 'utm_') THEN '1' WHEN contains(url, '#') THEN '2' ELSE '3' END AS tier FROM pages) GROUP BY 1")
def tier_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = audit.tier(F.col("page_id") % 10 != 0, F.contains("url", F.lit("utm_")), F.contains("url", F.lit("#")))
    return audit.tier_counts(model.pages(spark, sf_dir).select(tier.alias("tier")))


@query("SELECT page_id, page_id % 3 <> 0 AND page_id % 2 = 0 AS feed FROM pages")
def looks_like_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = model.pages(spark, sf_dir)
    body = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<?xml version='1.0'?><RSS>"), "html")).otherwise(F.col("html"))
    status = F.when(F.col("page_id") % 3 == 0, 404).otherwise(200)
    return p.select("page_id", audit.looks_like_feed(status, F.lit("text/html"), body).alias("feed"))


_FURNITURE = "[" + ", ".join(f"'{t}'" for t in audit.FURNITURE) + "]"


@query(
    f"""WITH src AS (SELECT page_id, url, lower(trim({_TEXTS.format(_TITLE)})) AS t FROM pages), {CANON},
f AS (SELECT page_id % 8 AS target, count(*) AS n, count(*) FILTER (t IN {_FURNITURE.replace('[', '(').replace(']', ')')} OR length(t) < 9) AS n_junk, count(DISTINCT t) AS n_titles, CAST(0 AS BIGINT) AS n_dated,
  count(DISTINCT len(list_filter(string_split(canonical_url, '/')[4:], lambda s: s <> ''))) AS n_depths FROM canon GROUP BY 1)
SELECT *, array_to_string(list_filter([CASE WHEN n < 3 THEN 'few' END, CASE WHEN n > 250 THEN 'many' END, CASE WHEN n_junk * 3 > n THEN 'junk_titles' END, CASE WHEN n_titles * 2 < n THEN 'repeated_titles' END, CASE WHEN n_dated = 0 THEN 'no_dates' END, CASE WHEN n_depths > 3 THEN 'many_depths' END], lambda x: x IS NOT NULL), ',') AS warnings FROM f"""
)
def candidate_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.facts(model.pages(spark, sf_dir)).select((F.col("page_id") % 8).alias("target"), "url", "title", F.lit(None).cast("date").alias("published_at"))
    return audit.warnings(audit.figures(rows, ["target"])).withColumn("warnings", F.concat_ws(",", "warnings"))


# ---- everything


@query(
    f"""WITH {_NEAR}, {_HAY.removeprefix("WITH ")},
off AS (SELECT n.*, x.bucket - y.bucket AS off FROM (SELECT near.* FROM near JOIN items ia ON ia.id = near.a JOIN items ib ON ib.id = near.b WHERE ia.word_count >= 40 AND ib.word_count >= 40) n JOIN sets x ON x.doc_id = n.a JOIN sets y ON y.doc_id = n.b),
k0 AS (SELECT DISTINCT a AS id FROM off WHERE a NOT IN (SELECT b FROM off)),
g1 AS (SELECT DISTINCT b AS id FROM off WHERE a IN (SELECT id FROM k0)),
k1 AS (SELECT id FROM k0 UNION SELECT b FROM off WHERE b NOT IN (SELECT id FROM g1) GROUP BY b HAVING bool_and(a IN (SELECT id FROM g1))),
g2 AS (SELECT DISTINCT b AS id FROM off WHERE a IN (SELECT id FROM k1)),
k2 AS (SELECT id FROM k1 UNION SELECT b FROM off WHERE b NOT IN (SELECT id FROM g2) GROUP BY b HAVING bool_and(a IN (SELECT id FROM g2)))
SELECT h.id, CASE WHEN word_count < 40 THEN 'failed' WHEN h.id NOT IN (SELECT doc_id FROM firsts) THEN 'duplicate' WHEN h.id IN (SELECT b FROM off) AND h.id NOT IN (SELECT id FROM k2) THEN 'duplicate' ELSE 'classified' END AS status,
CASE WHEN word_count >= 40 AND h.id IN (SELECT doc_id FROM firsts) AND NOT (h.id IN (SELECT b FROM off) AND h.id NOT IN (SELECT id FROM k2)) THEN array_to_string({_topic_sql(SAMPLE_KEYWORDS)}, ',') END AS topics FROM hay h"""
)
def harvest_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as fetched pages through extraction, deduplication and classification."""
    found = model.items(spark, sf_dir).select("id", "source_id", "title", "body_text", "first_seen")
    fetched = found.select("id", F.lit(200).alias("status_code"), F.col("body_text").alias("text"), "title", F.lit(None).cast("string").alias("og_title"), F.lit(None).cast("date").alias("page_date"), F.lit(None).cast("string").alias("page_date_source"), F.lit("html").alias("media_type"))
    items = model.aligned(found.drop("body_text").withColumn("status", F.lit("discovered")), model.ITEMS)
    state = harvest.State(items, model.empty(spark, model.REVISIONS))
    done = harvest.after_fetch(state, fetched, AS_OF, keywords=SAMPLE_KEYWORDS)
    return done.items.select("id", "status", F.when(F.col("topics").isNotNull(), F.concat_ws(",", "topics")).alias("topics"))
