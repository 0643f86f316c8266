"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, the ASCII separators among it.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: Lengths that the summary of an item and of an exported card have.
SUMMARY, CARD = 400, 240
#: Words of a document that take part in the near-duplicate comparison, words of a shingle.
COMPARED, SHINGLE = 300, 3


def or_else(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def collapsed(text: Column) -> Column:
    """White space runs as one space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))


def content_hash(text: Column) -> Column:
    """SHA-256 of the collapsed, lower-cased text."""
    return F.sha2(F.lower(collapsed(text)), 256)


def word_count(text: Column) -> Column:
    """Number of words between white space."""
    flat = collapsed(text)
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, " ")))


def summary(text: Column, length: int = SUMMARY) -> Column:
    return F.substring(collapsed(text), 1, length)


def search_text(title: Column, summary_: Column) -> Column:
    """What a search looks through."""
    return F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary_, F.lit(""))))


def compared_words(text: Column, limit: int = COMPARED) -> Column:
    """The leading runs of a-z and 0-9 of the lower-cased text."""
    return F.slice(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)), 1, limit)


def shingles(words: Column, n: int = SHINGLE) -> Column:
    """Distinct runs of n words, as texts; none of fewer words."""
    full = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, F.array_distinct(full)).otherwise(F.array().cast("array<string>"))


def length_bucket(words: Column) -> Column:
    """Half the root of a word count, both rounded down; null as 0."""
    return F.floor(F.floor(F.sqrt(F.coalesce(words, F.lit(0)).cast("double"))) / 2).cast("long")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets; 0 where one is empty."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def occurrences(text: Column, part: str) -> Column:
    """Number of places where ``part`` occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def without_fence(reply: Column) -> Column:
    """A reply without the code fence around it."""
    return F.trim(F.regexp_replace(reply, "(?m)^```(?:json)?|```$", ""), F.lit(" \t\r\n"))


def highlighted(text: Column, terms: list[str]) -> Column:
    """Terms of three letters or more marked; other characters escaped for HTML."""
    import re

    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    long = sorted({t for t in terms if len(t) >= 3}, key=len, reverse=True)
    return F.regexp_replace(out, "(?i)(" + "|".join(map(re.escape, long)) + ")", "<mark>$1</mark>") if long else out


def clipped(text: Column, length: int, tail: bool = False) -> Column:
    """The first or the last characters."""
    return F.right(text, F.lit(length)) if tail else F.substring(text, 1, length)
