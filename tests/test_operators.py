import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import audit, classify, dedupe, discover, export, extract, revisions, search
from sparkloom.plans import harvest, model
from sparkloom.sources import api, catalogue, feeds, fetch, pages
from sparkloom.streaming import incremental

NOW, AS_OF = datetime(2026, 8, 20, 10), date(2026, 8, 20)
CAND = "source_ord int, target_ord int, cand_ord int, source_id string, target string, url string, title string, published_at date, date_source string, content_type string, pub_content_type string"


def cands(spark, *rows):
    return spark.createDataFrame([(s, t, c, f"s{s}", f"t{t}", u, None, None, None, None, None) for s, t, c, u in rows], CAND)


def test_first_candidate_wins_over_all_sources(spark):
    held = spark.createDataFrame([("https://x.com/old",)], "canonical_url string")
    rows = cands(spark, (1, 0, 0, "http://x.com/a?utm_x=1"), (0, 1, 5, "https://www.x.com/a/"), (0, 1, 7, "https://x.com/a"), (2, 0, 0, "http://x.com/old"))
    new = discover.new_candidates(rows, held).collect()
    assert [(r.source_ord, r.cand_ord, r.canonical_url) for r in new] == [(0, 5, "https://x.com/a")]
    assert [r.url for r in discover.known_candidates(rows, held).collect()] == ["http://x.com/old"]
    log = {r.source_id: (r.found, r.new_items, r.ok) for r in discover.target_log(rows, discover.new_candidates(rows, held), 3).collect()}
    assert log == {"s0": (2, 1, True), "s1": (1, 0, True), "s2": (1, 0, True)}


def items(spark, *rows):
    """Rows of (id, dict)."""
    data = [{"id": i, "source_id": "s", "org": "o", "url": f"https://s/{i}", "canonical_url": f"https://s/{i}", "first_seen": NOW, "last_seen": NOW, "needs_review": False, "reviewed": False, **r} for i, r in rows]
    names = [f.split(" ", 1)[0] for f in model.ITEMS.split(", ")]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], model.ITEMS)


def test_insert_and_refresh(spark):
    have = items(spark, (4, {"status": "classified"}))
    rows = cands(spark, (0, 0, 0, "https://s/4"), (0, 0, 1, "https://s/9"))
    state = harvest.discover_stage(harvest.State(have, None), rows, NOW, 2, refresh=True)
    assert {(r.id, r.status, r.canonical_url) for r in state.items.collect()} == {(4, "discovered", "https://s/4"), (5, "discovered", "https://s/9")}


def test_cutoff_keeps_the_boundary_page(spark):
    rows = spark.createDataFrame([(0, 0, date(2026, 5, 1)), (0, 1, None), (1, 0, date(2025, 1, 1)), (1, 1, date(2024, 1, 1)), (2, 0, date(2026, 1, 1))], "page int, ord int, published_at date")
    assert {r.page for r in discover.pages_until_cutoff(rows, date(2025, 6, 1)).collect()} == {0, 1}
    assert discover.pages_until_cutoff(rows, date(2020, 6, 1)).count() == 5


def test_extraction_failures_titles_and_dates(spark):
    long, short = " ".join(["word"] * 40), " ".join(["word"] * 39)
    have = items(
        spark, (1, {"status": "discovered", "error": "old", "duplicate_of": 7}), (2, {"status": "discovered"}), (3, {"status": "discovered"}), (4, {"status": "discovered"}),
        (5, {"status": "discovered", "title": "Listed", "published_at": date(2026, 1, 1), "date_source": "feed"}), (6, {"status": "classified"}), (7, {"status": "discovered", "published_at": date(2026, 1, 1), "date_source": "sitemap"}),
    )
    schema = "id long, status_code int, text string, title string, og_title string, page_date date, page_date_source string, media_type string"
    day = date(2026, 8, 1)
    rows = [(1, 200, long, "T" * 500, None, None, None, "html"), (2, 404, None, None, None, None, None, None), (3, 200, short, "x", None, None, None, "html"), (5, 200, long, "Tag", "Og", day, "jsonld", "html"), (7, 200, long, "Tag", "Og", day, "meta", "html")]
    got = {r.id: r for r in extract.extract(have, spark.createDataFrame(rows, schema), NOW).collect()}
    assert [(got[k].status, got[k].error) for k in (1, 2, 3, 4, 6)] == [("extracted", None), ("failed", "http 404"), ("failed", "too short (39 words)"), ("failed", "unreachable"), ("classified", None)]
    assert (got[1].date_source, got[1].published_at, len(got[1].title), got[1].duplicate_of) == ("first_seen", AS_OF, 400, 7)
    assert (got[5].title, got[5].published_at, got[5].date_source) == ("Listed", date(2026, 1, 1), "feed")
    assert (got[7].title, got[7].published_at, got[7].date_source) == ("Og", day, "meta")
    assert {r.id for r in extract.extract(have, spark.createDataFrame(rows, schema), NOW, limit=1).filter("status <> 'discovered'").collect()} == {1, 6}


def chain():
    base = [f"w{k}" for k in range(60)]
    b, c = list(base), list(base)
    b[57:] = ["b1", "b2", "b3"]
    c[0:3], c[57:] = ["c1", "c2", "c3"], ["b1", "b2", "b3"]
    return [" ".join(x) for x in (base, b, c)]


def test_a_chain_resolves_in_order(spark):
    a, b, c = chain()
    rows = spark.createDataFrame([(1, a), (2, b), (3, c), (4, "x y"), (5, None)], "id long, text string")
    assert {(r.a, r.b) for r in dedupe.near_pairs(rows).collect()} == {(1, 2), (2, 3)}
    assert {r.id: r.duplicate_of for r in dedupe.near_duplicates(rows).collect()} == {2: 1}
    recent = spark.createDataFrame([(100, b), (101, b)], "id long, text string")
    assert {r.id: r.duplicate_of for r in dedupe.near_duplicates(rows, recent).collect()} == {1: 101, 2: 101, 3: 101}


def test_exact_duplicates_see_failed_rows_too(spark):
    have = items(spark, (1, {"status": "failed", "content_hash": "h"}), (2, {"status": "extracted", "content_hash": "h"}), (3, {"status": "duplicate", "content_hash": "g"}), (4, {"status": "extracted", "content_hash": "g"}), (5, {"status": "classified", "content_hash": "h"}))
    found = dedupe.exact_duplicates(have)
    assert [tuple(r) for r in found.collect()] == [(2, 1)]
    got = {r.id: (r.status, r.duplicate_of, r.error) for r in dedupe.mark(have, found, dedupe.EXACT).collect()}
    assert got[2] == ("duplicate", 1, "exact content match") and got[4] == ("extracted", None, None)


def test_marking_keeps_repeated_ids_and_earlier_marks(spark):
    have = items(spark, (1, {"status": "extracted"}), (1, {"status": "extracted"}), (2, {"status": "duplicate", "duplicate_of": 9, "error": "old"}), (3, {"status": "extracted"}))
    found = spark.createDataFrame([(1, 7)], "id long, duplicate_of long")
    got = sorted((r.id, r.status, r.duplicate_of, r.error) for r in dedupe.mark(have, found, "why").collect() if r.id < 3)
    assert got == [(1, "duplicate", 7, "why")] * 2 + [(2, "duplicate", 9, "old")]
    assert dedupe.mark(have, found, "why").count() == 4


def test_revisions(spark):
    rev = spark.createDataFrame([(1, 1, "a", datetime(2026, 1, 1), 5), (2, 1, "b", datetime(2026, 1, 2), 5)], model.REVISIONS)
    flags = {r.id: r.updated for r in revisions.updated(items(spark, (1, {"content_hash": "a"}), (2, {"content_hash": "z"})), rev).collect()}
    assert flags == {1: True, 2: False}
    new = spark.createDataFrame([(3, 1, "a", NOW, 5), (4, 2, "z", NOW, 5)], model.REVISIONS)
    assert {(r.item_id, r.content_hash) for r in revisions.insert_or_ignore(rev, new).collect()} == {(1, "a"), (1, "b"), (2, "z")}


def test_review_rules(spark):
    rows = [(0.7, ["law"], "cited", False, False), (0.69, ["law"], "cited", False, True), (0.9, [], "cited", False, True), (0.9, ["law"], None, False, True), (0.1, ["law"], "cited", True, False), (1.0, ["law"], None, True, True), (None, ["law"], "none", False, True)]
    df = spark.createDataFrame(rows, "confidence double, topics array<string>, evidence string, pub boolean, want boolean")
    flag = classify.review_flag(F.col("confidence"), F.col("topics"), F.col("evidence"), F.col("pub"))
    assert df.filter(flag != F.col("want")).count() == 0


def test_keywords_and_ties(spark):
    df = spark.createDataFrame([(1, "Bank loan", "food and food, energy", "advice"), (2, None, None, "resources")], "id long, title string, body_text string, target_name string")
    got = {r.id: r for r in classify.offline(df).collect()}
    assert (got[1].topics, got[1].content_type, got[1].evidence, got[1].confidence) == (["food", "finance"], "advice", None, 0.4)
    assert (got[2].topics, got[2].content_type) == ([], "news")


def test_model_replies_and_fallback(spark):
    work = items(spark, *[(k, {"title": "bank", "status": "extracted"}) for k in range(1, 24)]).coalesce(1)

    def ask(rows):
        if any(r["id"] == 15 for r in rows):
            raise RuntimeError("down")
        return [{"id": r["id"], "content_type": "news" if r["id"] != 2 else "odd", "topics": ["law", "zz", "law"], "evidence": "cited" if r["id"] != 3 else "zz", "confidence": 0.9} for r in rows if r["id"] != 4]

    calls = spark.sparkContext.accumulator(0)

    def counting(rows):
        calls.add(1)
        return ask(rows)

    got = {r.id: r for r in classify.model_replies(work, counting).collect()}
    assert len(got) == 23 and calls.value == 3
    assert (got[1].topics, got[1].evidence, got[1].confidence) == (["law", "law"], "cited", 0.9)
    assert [(got[k].content_type, got[k].confidence) for k in (2, 4)] == [("news", 0.0)] * 2 and got[3].evidence is None
    assert (got[15].topics, got[15].confidence) == (["finance"], 0.4)


def test_publisher_labels_stay(spark):
    have = items(spark, (1, {"status": "extracted", "content_type": "policy", "pub_content_type": "Submission", "pub_topics": [], "confidence": 1.0}), (2, {"status": "extracted"}), (3, {"status": "classified", "content_type": "news", "evidence": "cited"}))
    tagged = classify.pre_tag(have)
    assert {r.id for r in classify.work_set(tagged).collect()} == {1, 2}
    replies = spark.createDataFrame([(1, "news", ["law"], "cited", 0.2), (2, "blog", [], "cited", 0.9)], "id long, content_type string, topics array<string>, evidence string, confidence double")
    got = {r.id: (r.content_type, r.topics, r.confidence, r.needs_review, r.status) for r in classify.apply(tagged, replies).collect()}
    assert got == {1: ("policy", ["law"], 1.0, False, "classified"), 2: ("blog", [], 0.9, True, "classified"), 3: ("news", None, None, False, "classified")}


def test_export_has_no_text_and_follows_the_latest_org(spark, tmp_path):
    have = items(spark, (1, {"status": "classified", "org": "old", "published_at": date(2026, 1, 1), "summary": "s" * 400, "title": "T"}), (2, {"status": "classified", "org": "new", "published_at": date(2026, 2, 1)}), (3, {"status": "failed"}))
    out = export.exported(have)
    assert "body_text" not in out.columns and {r.id for r in out.collect()} == {1, 2} and len(out.filter("id = 1").first().summary) == 240
    assert [tuple(r) for r in export.sources(have).select("org", "items").collect()] == [("new", 2)]
    runs = spark.createDataFrame([(k,) for k in range(1, 31)], "id long")
    log = spark.createDataFrame([(30, False), (30, False), (29, True)], "run_id long, ok boolean")
    got = export.runs(runs, log).collect()
    assert len(got) == 26 and (got[0].id, got[0].failed_sources, got[1].failed_sources) == (30, 2, 0)
    export.write(have, runs, log, str(tmp_path))
    assert export.read(spark, str(tmp_path)).count() == 2


def test_search_scores(spark):
    df = spark.createDataFrame([(1, "Scam alert", "scam alert " + "scam " * 9), (2, "Other", "other alert"), (3, None, "scam alert")], "id long, title string, search string")
    got = {r.id: r.s for r in df.withColumn("s", search.score(search.terms_of("Scam a ALERT"))).collect()}
    assert got == {1: 12 + 6 + 12 + 1, 2: 0, 3: 2}
    assert df.withColumn("s", search.score([])).agg(F.min("s")).first()[0] == 1


def test_audit_rules(spark):
    rows = spark.createDataFrame([("t", "https://x/a", "Read more", None), ("t", "https://x/a/b", "Read more", None), ("u", "https://x/a", "A long enough title", AS_OF)] + [("u", f"https://x/{k}", f"A long enough title {k}", AS_OF) for k in range(3)], "target string, url string, title string, published_at date")
    got = {r.target: r.warnings for r in audit.warnings(audit.figures(rows, ["target"])).collect()}
    assert got == {"t": ["few", "junk_titles", "no_dates"], "u": []}
    found = spark.createDataFrame([("b", 0, "b/feed", 404, "", ""), ("b", 1, "b/rss", 200, "text/xml", "<RSS>"), ("b", 2, "b/atom", 200, "text/xml", "<feed>")], "base string, ord int, url string, status int, content_type string, body string")
    assert [tuple(r) for r in audit.first_feed(found).collect()] == [("b", "b/rss")]
    text = spark.createDataFrame([("User-agent: *\n Sitemap: https://x/s.xml\nsitemap:https://x/t.xml", "<urlset><URL><lastmod>")], "r string, b string")
    r = text.select(audit.sitemaps_in_robots(F.col("r")).alias("s"), audit.sitemap_facts(F.col("b")).alias("f")).first()
    assert r.s == ["https://x/s.xml", "https://x/t.xml"] and (r.f.n_urls, r.f.has_lastmod) == (1, True)


ARTICLE = "<html><head><title>Page title</title><meta property='og:title' content='Og'>{head}</head><body><nav>menu</nav><article><h1>H</h1><p>{text}</p>{more}</article><footer>foot</footer></body></html>"


def test_page_facts_and_dates(spark):
    rows = [
        (1, ARTICLE.format(head="<script type='application/ld+json'>{\"datePublished\": \"2026-08-19T10:00:00Z\"}</script><meta name='date' content='2026-01-01'>", text="t", more="")),
        (2, ARTICLE.format(head="<meta name='date' content='2099-01-01'><meta name='pubdate' content='2026-02-03'>", text="t", more="")),
        (3, ARTICLE.format(head="", text="t", more="<time>4 March 2026</time>")),
        (4, ARTICLE.format(head="<script type='application/ld+json'>{bad</script>", text="Posted 5 Apr 2026", more="")),
        (5, ARTICLE.format(head="", text="nothing", more="")),
        (6, None),
    ]
    got = {r.id: r for r in pages.find_date(pages.facts(spark.createDataFrame(rows, "id long, html string")), AS_OF).collect()}
    assert [(got[k].page_date, got[k].page_date_source) for k in range(1, 7)] == [(date(2026, 8, 19), "jsonld"), (date(2026, 2, 3), "meta"), (date(2026, 3, 4), "time_tag"), (date(2026, 4, 5), "body_text"), (None, None), (None, None)]
    assert (got[5].text, got[5].title, got[5].og_title) == ("Page title H nothing", "Page title", "Og")


def test_titles_with_bare_signs(spark):
    """Space around a bare "<" stays; a reference cut off before its semicolon is one all the same, as in HTML."""
    titles = {"a < b": "a < b", "a < < b": "a < < b", " x\n<3 y ": "x\n<3 y", "1<2": "1<2", "R&amp;D, token = &quot": 'R&D, token = "', "cut &quo": "cut &quo", " ": None}
    rows = [(t, f"<html><head><title>{t}</title><style>p{{}}</style></head><body><p>p</p></body></html>") for t in titles]
    assert {r.t: r.title for r in pages.facts(spark.createDataFrame(rows, "t string, html string")).collect()} == titles


def test_links_and_declared_feeds(spark):
    html = "<link rel='alternate' type='application/rss+xml' href='/feed'><a href='/out'>outside of it all</a><div class='x listing'><a href='/a#1'>A good long title</a><a href='#x'>no</a><a href='https://other/z'>no</a><a href='mailto:a'>no</a><a href='/a#1'>again</a><a href='b'>short</a></div>"
    df = spark.createDataFrame([("https://x.com/l/", html)], "url string, html string")
    got = {(r.url, r.title) for r in pages.links(df, ".listing").collect()}
    assert got == {("https://x.com/a#1", "A good long title"), ("https://x.com/l/b", None)}
    assert pages.links(df).count() == 3
    assert [r.feed for r in pages.declared_feeds(df).collect()] == ["https://x.com/feed"]


@pytest.mark.parametrize(
    ("selector", "found"),
    [
        ('a[href*="/blogs/"]', {"/blogs/1", "/blogs/2"}),
        (".listing a", {"/blogs/1", "/n/3"}),
        ("div.listing > p > a", {"/blogs/1"}),
        ("div.listing>a", {"/n/3"}),
        ("#top a, nav a", {"/blogs/2", "/home/"}),
        ("a[rel~=next][href^='/h']", {"/home/"}),
        ("a[href$='3'], a:not(.x)", None),
        ("div >", None),
        ("*", {"/blogs/1", "/blogs/2", "/n/3", "/home/"}),
    ],
)
def test_selectors(spark, selector, found):
    html = (
        "<nav><a rel='up next' href='/home/'>Home of all</a></nav><div id='top'><b><a href='/blogs/2'>Second</a></b></div>"
        "<div class='x listing'><p><a class=x href='/blogs/1'>First<br>one</a></p><a href='/n/3'>Third</a></div>"
    )
    df = spark.createDataFrame([("https://x.com/l/", html)], "url string, html string")
    if found is None:
        with pytest.raises(ValueError):
            pages.links(df, selector)
    else:
        assert {r.url.removeprefix("https://x.com") for r in pages.links(df, selector).collect()} == found


def test_unreadable_pdf_files_have_no_text(spark):
    rows = spark.createDataFrame([("a", b"no pdf"), ("b", None)], "url string, content binary")
    assert {(r.url, r.text, r.title, r.n_pages) for r in fetch.pdf_texts(rows).collect()} == {("a", "", None, 0), ("b", "", None, 0)}


def test_discovery_from_the_catalogue(spark):
    from sparkloom.sources import discovery

    web = {
        "https://x.org/feed": "<rss><channel><item><title>Bank fees are up</title><link>https://x.org/a</link><pubDate>Wed, 19 Aug 2026 10:00:00 +0000</pubDate></item></channel></rss>",
        "https://x.org/list/": "<div class=listing><a href='/blogs/1'>First of the blogs</a><a href='/blogs/1'>again</a><a href='https://o.org/blogs/2'>off</a><a href='/blogs/no'>left out</a><a href='#'>x</a></div>",
        "https://x.org/map.xml": "<sitemapindex><sitemap><loc>https://x.org/m1.xml</loc></sitemap><sitemap><loc>https://x.org/gone.xml</loc></sitemap></sitemapindex>",
        "https://x.org/m1.xml": "<urlset><url><loc>https://x.org/en/p</loc><lastmod>2026-08-01</lastmod></url><url><loc>https://x.org/fr/p</loc></url></urlset>",
    }
    answers = {0: {"items": [{"u": "n/1", "d": "2026-08-20"}, {"u": "n/2", "d": "2026-08-10"}]}, 1: {"items": [{"u": "n/3", "d": "2026-01-01"}]}, 2: {"items": [{"u": "n/4", "d": "2026-08-20"}]}}
    api_target = {"name": "api", "method": "json", "url": "https://x.org/api", "items_path": "items", "url_field": "u", "url_prefix": "https://x.org/", "date_field": "d", "page_param": "p", "pages": 3, "days_back": 30}
    targets = [
        {"name": "feed", "method": "rss", "url": "https://x.org/feed"},
        {"name": "list", "method": "html", "url": "https://x.org/list/", "item_selector": 'a[href*="/blogs/"]', "exclude_patterns": ["/no"]},
        {"name": "map", "method": "sitemap", "url": "https://x.org/map.xml", "include_patterns": ["/en/"]},
        {"name": "down", "method": "rss", "url": "https://x.org/down"},
        {"name": "odd", "method": "telex", "url": "https://x.org/telex"},
        api_target,
    ]
    sources = [{"id": "x", "org": "X", "targets": targets}]
    got, every = discovery.discover(
        sources,
        lambda u: (200, {"content-type": "text/html"}, web[u], u) if u in web else None,
        date(2026, 8, 25),
        lambda r: (200, json.dumps(answers[r["params"]["p"]])),
        spark=spark,
        pause=0,
    )
    rows = {(r.target, r.url.removeprefix("https://x.org/"), str(r.published_at), r.title) for r in got.collect()}
    assert rows == {
        ("feed", "a", "2026-08-19", "Bank fees are up"),
        ("list", "blogs/1", "None", "First of the blogs"),
        ("map", "en/p", "2026-08-01", None),
        ("api", "n/1", "2026-08-20", None),
        ("api", "n/2", "2026-08-10", None),
        ("api", "n/3", "2026-01-01", None),
    }
    log = discover.target_log(got, discover.new_candidates(got, got.limit(0).withColumn("canonical_url", got.url)), 1, every)
    assert {r.target: r.ok for r in log.collect()} == {"feed": True, "list": True, "map": True, "api": True, "down": False, "odd": False}
    with pytest.raises(ValueError):
        discovery.discover([{"id": "x", "org": "X", "targets": [{"name": "l", "method": "html", "url": "u", "item_selector": "a:hover"}]}], web.get, AS_OF, spark=spark)


def test_targets_without_candidates_fail(spark):
    have = spark.createDataFrame([("s", "a"), ("s", "a")], "source_id string, target string")
    every = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a"), ("t", "a")], "source_id string, target string")
    got = {(r.source_id, r.target): (r.found, r.new_items, r.ok) for r in discover.target_log(have, have.limit(1), 1, every).collect()}
    assert got == {("s", "a"): (2, 1, True), ("s", "b"): (0, 0, False), ("t", "a"): (0, 0, False)}


def test_search_prepares_each_text_once(spark):
    from sparkloom.operators import export

    have = items(spark, (1, {"status": "classified", "title": "bank fee", "summary": "the bank"}), (2, {"status": "classified", "title": "none"}))
    found = search.filtered(export.exported(have), "bank fee loan", as_of=AS_OF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 2
    hits = search.numbered_ranks(search.filtered(export.exported(have), "bank", as_of=AS_OF)).collect()
    assert [(r.id, r.rank) for r in hits] == [(1, 1)]


def test_feeds_and_sitemaps(spark):
    rss = "<rss><channel><item><title>A &amp; b</title><link>https://x/a</link><pubDate>Wed, 19 Aug 2026 23:30:00 -0800</pubDate></item><item><title>none</title></item></channel></rss>"
    atom = "<feed><entry><title><![CDATA[C]]></title><link rel='alternate' href='https://x/c'/><updated>2026-08-01T00:00:00Z</updated><author><name>N</name></author></entry></feed>"
    got = {r.url: (r.title, r.published_at, r.date_source, r.author) for r in feeds.feed_entries(spark.createDataFrame([(rss,), (atom,)], "body string")).collect()}
    assert got == {"https://x/a": ("A & b", date(2026, 8, 19), "feed", None), "https://x/c": ("C", date(2026, 8, 1), "feed", "N")}
    index = "<SitemapIndex>" + "".join(f"<loc>c{k}</loc>" for k in range(25)) + "</SitemapIndex>"
    maps = spark.createDataFrame([("i", index), ("m", "<url><loc> https://x/en/1 </loc><lastmod>2026-01-02</lastmod></url><URL><loc>https://x/de/2</loc></URL>")], "url string, body string")
    kids = spark.createDataFrame([(f"c{k}", f"<url><loc>https://x/en/k{k}</loc></url>") for k in (1, 22)], "url string, body string")
    assert {(r.url, r.published_at) for r in feeds.sitemap_walk(maps, kids, ["/en/"]).collect()} == {("https://x/en/1", date(2026, 1, 2)), ("https://x/en/k1", None)}


def test_json_api_pages(spark, tmp_path):
    (tmp_path / "0.json").write_text('{"data": {"items": [{"slug": "a", "t": "T", "d": 1755680400, "kind": [{"name": " Press "}], "tags": ["x", "y"]}, {"slug": "https://z/b"}]}}')
    (tmp_path / "1.json").write_text('{"data": {"items": [{"slug": "a", "t": "again"}]}}')
    spark.dataSource.register(api.PagedJson)
    rows = spark.read.format("paged_json").options(folder=str(tmp_path), pages="3", items_path="data.items").load()
    target = {"url_field": "slug", "url_prefix": "https://x/", "title_field": "t", "date_field": "d", "field_map": {"content_type": {"field": "kind", "map": {"press": "news"}}, "topics": {"field": "tags", "map": {"X": "law"}}}}
    got = {r.url: r for r in api.candidates(rows, target, AS_OF).collect()}
    a = got["https://x/a"]
    assert (a.title, a.published_at, a.date_source, a.content_type, a.topics, a.pub_topics) == ("T", date(2025, 8, 20), "api", "news", ["law"], ["x", "y"])
    assert set(got) == {"https://x/a", "https://z/b"} and got["https://z/b"].content_type is None
    assert api.request_of({"url": "u", "http_method": "post", "page_param": "q.page", "body": {"q": {"n": 1}}}, 2)["body"] == {"q": {"n": 1, "page": 2}}
    assert api.live({"url": "u", "items_path": "i"}, lambda _: (200, '{"i": [1]}'), 0) == [(0, 0, "1")]
    with pytest.raises(RuntimeError):
        api.read_response(500, "x")


def test_fetching_is_polite():
    web = {"https://a/robots.txt": (200, {}, "User-agent: *\nDisallow: /no", ""), "https://a/x": (200, {}, "body", "https://a/x"), "https://b/big": (200, {"content-length": str(9 << 20)}, "", "")}
    waits, now = [], [0.0]
    f = fetch.Fetcher(web.get, pause=2.0, sleep=waits.append, clock=lambda: now[0])
    assert f.fetch("https://a/no/1") is None and f.fetch("https://a/x")[2] == "body" and f.fetch("https://a/x")[2] == "body"
    assert f.fetch("https://b/big") is None and f.fetch("https://c/none") is None
    # the first page waits for robots.txt, every further request for the one before
    assert waits == [2.0] * 4


def test_fetch_all_over_hosts(spark):
    got = fetch.fetch_all(spark.createDataFrame([("https://a/x",), ("https://b/y",)], "url string"), lambda u: (200, {"content-type": "text/html"}, "b", u) if u.endswith("x") else None, pause=0, partitions=2)
    assert {(r.url, r.status_code, r.body) for r in got.collect()} == {("https://a/x", 200, "b"), ("https://b/y", None, None)}


def test_catalogue(spark, tmp_path):
    with pytest.raises(ValueError):
        catalogue.load_sources(str(tmp_path))
    (tmp_path / "b.yml").write_text("id: b\norg: B\ntargets:\n  - {name: n, method: rss, url: u, include_patterns: [x]}\n")
    (tmp_path / "a.yml").write_text("id: a\norg: A\ncountry: X\ntargets:\n  - {name: m, method: odd}\n  - {name: k, method: html}\n")
    rows = catalogue.targets(spark, catalogue.load_sources(str(tmp_path))).orderBy("source_ord", "target_ord").collect()
    assert [(r.id, r.name, r.include_patterns) for r in rows] == [("a", "m", None), ("a", "k", None), ("b", "n", ["x"])]
    (tmp_path / "c.yml").write_text("id: c\n")
    with pytest.raises(ValueError, match="org, targets"):
        catalogue.load_sources(str(tmp_path))


def test_run_from_discovery_to_labels(spark):
    """Four articles: one seen twice at two addresses, one a little longer, as the sample site has them."""
    base = "payments and scams are on the rise and banks refund too few of the people who lose money to fraud " * 3
    other = " ".join(f"claim{k}" for k in range(40))
    texts = {1: base, 2: base, 3: other, 4: other + " " + " ".join(f"more{k}" for k in range(12))}
    rows = cands(spark, *[(0, 0, k, f"https://s/news/{k}?utm_source=x") for k in texts])
    state = harvest.discover_stage(harvest.State(model.empty(spark, model.ITEMS), model.empty(spark, model.REVISIONS)), rows, NOW, 1)
    schema = "id long, status_code int, text string, title string, og_title string, page_date date, page_date_source string, media_type string"
    fetched = spark.createDataFrame([(k, 200, t, f"Title {k}", None, None, None, "html") for k, t in texts.items()], schema)
    done = harvest.after_fetch(state, fetched, AS_OF)
    got = {r.id: r for r in done.items.collect()}
    assert [(got[k].status, got[k].duplicate_of) for k in (1, 2, 3, 4)] == [("classified", None), ("duplicate", 1), ("classified", None), ("classified", None)]
    assert got[1].topics == ["scams", "finance"] and got[1].needs_review and "utm" not in got[1].canonical_url
    assert {r.item_id for r in done.revisions.collect()} == {1, 3, 4}
    assert {r.date_source for r in done.items.collect()} == {"first_seen"}


def test_a_whole_run_and_a_failing_one(spark):
    words = " ".join(f"bank{k}" for k in range(50))
    rows = cands(spark, (0, 0, 0, "https://s/a"), (1, 0, 0, "https://s/b"))
    state = harvest.State(model.empty(spark, model.ITEMS), model.empty(spark, model.REVISIONS))

    def fetch(found):
        return found.select("id", F.when(F.col("canonical_url").endswith("b"), 500).otherwise(200).alias("status_code"), F.lit(words).alias("text"), F.lit("T").alias("title"), *[F.lit(None).cast(t).alias(n) for n, t in (("og_title", "string"), ("page_date", "date"), ("page_date_source", "string"))], F.lit("html").alias("media_type"))

    done, row, log = harvest.run(state, rows, fetch, NOW, 1)
    r = row.first()
    assert (r.discovered, r.extracted, r.classified, r.ok, r.notes) == (2, 1, 1, True, None)
    assert {(x.source_id, x.found, x.new_items) for x in log.collect()} == {("s0", 1, 1), ("s1", 1, 1)}
    assert {(x.canonical_url, x.status, x.error) for x in done.items.collect()} == {("https://s/a", "classified", None), ("https://s/b", "failed", "http 500")}

    def broken(_):
        raise RuntimeError("no network")

    _, row, _ = harvest.run(done, cands(spark, (0, 0, 0, "https://s/c")), broken, NOW, 2)
    assert (row.first().ok, row.first().notes) == (False, "no network")
    with pytest.raises(ValueError, match="offline"):
        harvest.run(done, rows, fetch, NOW, 3, again=True, offline=False)


def test_prompt_and_audit_file(spark, tmp_path):
    df = spark.createDataFrame([(7, "Org", None, " a\n b " + "x" * 3000)], "id long, org string, title string, body string")
    got = df.select(classify.prompt_part(*[F.col(c) for c in df.columns]).alias("p")).first().p
    assert got.startswith("ITEM 7\nORGANISATION: Org\nTITLE: \nTEXT: a b x") and len(got.split("TEXT: ")[1]) == 2500
    audit.write(spark.createDataFrame([("?", "b"), ("1", "z"), ("1", "a")], "tier string, org string"), str(tmp_path / "a"))
    assert spark.read.json(str(tmp_path / "a")).count() == 3


def test_stream_of_candidates(spark, tmp_path):
    cands(spark, (0, 0, 0, "https://x/a"), (0, 0, 1, "https://x/a#b")).write.parquet(str(tmp_path / "in/1"))
    snapshots = incremental.Snapshots(model.empty(spark, model.ITEMS))
    incremental.follow(spark, str(tmp_path / "in/*"), CAND, snapshots, str(tmp_path / "state"), lambda: NOW).awaitTermination()
    assert [r.canonical_url for r in snapshots.items.collect()] == ["https://x/a"]
