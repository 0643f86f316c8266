from datetime import date

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import dates, jsons, text, urls

AS_OF = date(2026, 8, 20)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


URLS = [
    ("HTTP://WWW.Ex.com:443/a/index.html?b=2&a=1&utm_x=3#f", "https://ex.com/a?a=1&b=2"),
    ("http://x.com//", "https://x.com/"),
    ("http://x.com/a;p=1?x=%20y+z&e=&q=~*", "https://x.com/a?q=~%2A&x=+y+z"),
    ("https://x.com/?reference=1&Source=2&k=é", "https://x.com/?k=%C3%A9"),
    ("http://x.com/Index.HTML", "https://x.com/Index.HTML"),
    ("http://u@X.com:80/A/", "https://u@x.com:80/A"),
    ("http://x.com/a?b=2&b=1&B=0", "https://x.com/a?B=0&b=1&b=2"),
    ("http://x.com/a?x=%zz&y=%FF", "https://x.com/a?x=%25zz&y=%EF%BF%BD"),
    ("www.x.com/a", "https:www.x.com/a"),
    ("  http://x.com  ", "https://x.com/"),
    (None, None),
]


@pytest.mark.parametrize(("url", "key"), URLS)
def test_canonical_url(spark, url, key):
    assert one(spark, urls.canonical_url(F.col("x")), url) == key


def test_url_parts(spark):
    assert one(spark, urls.depth(F.col("x")), "https://a.b/c//d/e") == 3
    assert one(spark, urls.host(F.col("x")), "https://A.b:8/c") == "a.b:8"
    assert one(spark, urls.matches(F.col("x"), [], ["no"]), "https://a/yes") is True
    assert one(spark, urls.matches(F.col("x"), ["en"], []), "https://a/yes") is False
    assert one(spark, urls.with_prefix(F.col("x"), "https://p/"), "slug") == "https://p/slug"
    assert one(spark, urls.absolute(F.lit("https://a.b/c/d"), F.col("x")), "../e") == "https://a.b/e"


SPACED = "a b c\u001cd\n\n e"


def test_texts(spark):
    assert one(spark, text.collapsed(F.col("x")), f"  {SPACED} ") == "a b c d e"
    assert one(spark, text.word_count(F.col("x")), SPACED) == 5
    assert [one(spark, text.word_count(F.col("x")), v) for v in (None, "", " \n")] == [0, 0, 0]
    assert one(spark, text.content_hash(F.col("x")), " A  b ") == one(spark, text.content_hash(F.col("x")), "a b")
    sets = text.shingles(text.compared_words(F.col("x")))
    assert one(spark, sets, "one two") == []
    assert one(spark, sets, "café au lait au lait au lait") == ["caf au lait", "au lait au", "lait au lait"]
    assert [one(spark, text.length_bucket(F.col("x")), n, "int") for n in (None, 0, 15, 16, 35, 36)] == [0, 0, 1, 2, 2, 3]
    assert one(spark, text.occurrences(F.col("x"), "aa"), "aaaa") == 2
    assert one(spark, text.without_fence(F.col("x")), '```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(spark, text.highlighted(F.col("x"), ["foo", "ba"]), "Foo <bar>") == "<mark>Foo</mark> &lt;bar&gt;"
    assert one(spark, text.search_text(F.lit(None).cast("string"), F.col("x")), "Ab") == " ab"


DATES = [
    ("1755680400", date(2025, 8, 20)), ("1755680400000", date(2025, 8, 20)), ("0", None), ("", None), (None, None), ("1994-01-01", None), ("2027-05-05", date(2027, 5, 5)), ("2028-05-05", None),
    ("19 Aug 2026", date(2026, 8, 19)), ("2026-08-19T23:30:00-08:00", date(2026, 8, 19)), ("Wed, 19 Aug 2026 23:30:00 -0800", date(2026, 8, 19)), ("August 19, 2026", date(2026, 8, 19)), ("August 2026", None), ("soon", None),
]


@pytest.mark.parametrize(("value", "day"), DATES)
def test_api_dates(spark, value, day):
    assert one(spark, dates.api_date(F.col("x"), AS_OF), value) == day


def test_other_dates(spark):
    assert one(spark, dates.body_date(F.col("x"), AS_OF), "Posted 3 September 2025, seen 2024-01-01") == date(2025, 9, 3)
    assert one(spark, dates.body_date(F.col("x"), AS_OF), "Posted 3 September 2031, seen 2024-01-01") is None
    assert one(spark, dates.week(F.col("x").cast("date")), "2026-08-23") == date(2026, 8, 17)
    assert one(spark, dates.shown(F.col("x").cast("date")), "2026-08-03") == "3 Aug 2026"
    assert one(spark, dates.since(F.col("x"), 7, AS_OF), "2026-08-13") is True
    assert one(spark, dates.since(F.col("x"), 7, AS_OF), "2026-08-12") is False


DOC = '{"a": [{"b": "x"}, {"b": "y"}], "s": " One ", "l": ["p", "q"], "n": null}'


def test_json(spark):
    x = F.col("x")
    assert one(spark, jsons.dig(x, "a.1.b"), DOC) == "y"
    assert [one(spark, jsons.dig(x, p), DOC) for p in ("a.7.b", "a.b", "s.t")] == [None, None, None]
    assert one(spark, jsons.dig(x, "a"), "no json") is None
    assert one(spark, jsons.labels(x, "a", "b"), DOC) == ["x", "y"]
    assert one(spark, jsons.labels(x, "s"), DOC) == ["One"]
    assert one(spark, jsons.labels(x, "l"), DOC) == ["p", "q"]
    assert one(spark, jsons.labels(x, "zz"), DOC) == []
    raw = F.array(F.lit(" Rail "), F.lit("bus"), F.lit("?"), F.lit("RAIL"))
    assert one(spark, jsons.mapped_labels(raw, {"rail": "travel", "Bus ": "travel", "x": "law"}), "") == ["travel"]
    assert one(spark, jsons.valid_only(F.array(F.lit("a"), F.lit("z"), F.lit("a")), ["a"]), "") == ["a", "a"]
    assert one(spark, jsons.json_texts(x), '["a","b"]') == ["a", "b"] and one(spark, jsons.json_texts(x), None) == []
    assert jsons.bury({}, "a.b", 1) == {"a": {"b": 1}}
    assert jsons.arrays_in({"a": {"b": [1, 2]}, "c": [[3]]}) == [("a.b", 2, 1), ("c", 1, [3])]
    assert jsons.outline({"a": [1], "b": "x"}) == '{a: [1 x 1], b: "x"}'
    assert jsons.hinted(["pageUrl", "x", "createdAt"], jsons.LINK_HINTS) == ["pageUrl"]
