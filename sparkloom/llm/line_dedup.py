"""Line deduplication over overlapping windows of three lines.

The non-blank lines of a text, stripped of surrounding spaces, tabs and carriage returns, form windows of ``width`` consecutive lines. A window's content
is hashed (128 bits); equal windows are found over all documents; the first occurrence, by (doc_id, text hash, position), stays and
every line that a later occurrence covers goes, whatever window covers it. Only DataFrame functions run.

Shuffles carry 40 bytes a window. Windows are written once; equal ones are pre-aggregated before the shuffle, and where windows meet their first
occurrence again, those that a large share of all windows equals (at most 1024) are broadcast instead, so none of them lands in one task.
Texts move once, to meet the positions that they lose.

Defined results: texts with fewer than ``width`` non-blank lines have no window and stay; null stays null; rows that repeat both doc_id and
text are one document and get one result; rows without doc_id come first in the order; other columns pass through, except that
columns named ``n_lines`` or ``n_removed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, others, spread

_BLANKS = " \t\r"
#: A window that more than this share of all windows equals is joined apart; at most ``1 / HOT`` of them exist.
HOT = 1 / 1024


def _lines(text: str = "text") -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_hash() -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())


def windows(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, th, at, h1, h2``: one row for each window of each document. Each line is stripped and hashed once; a window's hashes are made of its lines'."""
    stripped = F.filter(F.transform(_lines(), lambda x: F.trim(x, F.lit(_BLANKS))), lambda x: x != "")
    coded = F.transform(stripped, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b")))
    lines = docs.select("doc_id", _text_hash().alias("th"), F.posexplode(F.transform(F.array(coded), lambda x: x)).alias("_", "c")).filter(F.size("c") >= width)
    each = lines.select("doc_id", "th", "c", F.explode(F.sequence(F.lit(0), F.size("c") - width)).alias("at"))
    of = lambda f: [F.get("c", F.col("at") + k).getField(f) for k in range(width)]
    return each.select("doc_id", "th", "at", F.xxhash64(*of("a")).alias("h1"), F.xxhash64(*of("b")).alias("h2"))


def _later(every: DataFrame) -> DataFrame:
    """The windows that equal an earlier one: ``doc_id, th, at``."""
    me = F.struct("doc_id", "th", "at")
    repeated = cut(every.groupBy("h1", "h2").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "windows")
    # a window that a large share of all equals would meet in one task: those few are broadcast, at most 1 / HOT by their definition
    least = max(1000, int(every.count() * HOT))
    hot, cold = repeated.filter(F.col("n") > least), repeated.filter(F.col("n") <= least)
    fronts = hot.select("h1", "h2", F.col("first").alias("hot"))
    told = every.join(F.broadcast(fronts), ["h1", "h2"], "left")
    few = told.filter("hot IS NULL").join(cold.drop("n"), ["h1", "h2"]).filter(~me.eqNullSafe(F.col("first")))
    return told.filter(F.col("hot").isNotNull() & ~me.eqNullSafe(F.col("hot"))).select("doc_id", "th", "at").unionByName(few.select("doc_id", "th", "at"))


def line_dedup(docs: DataFrame, width: int = 3) -> DataFrame:
    """``docs`` with the kept text and ``n_lines`` (non-blank lines before), ``n_removed``."""
    docs = spread(docs.select(*others(docs, "n_lines", "n_removed")))
    later = _later(cut(windows(docs, width), "windows"))
    lost = later.groupBy("doc_id", "th").agg(F.collect_set("at").alias("_at")).select(F.col("doc_id").alias("_doc"), F.col("th").alias("_thl"), "_at")
    # the documents' other columns travel in one, so that none is taken for a working column
    rest = others(docs, "doc_id", "text")
    packed = docs.select("doc_id", "text", F.struct(*rest).alias("_row") if rest else F.lit(None).cast("int").alias("_row"), _text_hash().alias("_th"))
    rows = packed.join(lost, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_th") == F.col("_thl")), "left").withColumn("_cut", _without(width))
    own = {"text": F.when(F.col("_at").isNull(), F.col("text")).otherwise(F.col("_cut.text")), "doc_id": F.col("doc_id")}
    return rows.select(
        *[own.get(c.lower(), F.col("_row").getField(c) if rest else None).alias(c) for c in docs.columns],
        F.col("_cut.n").cast("long").alias("n_lines"),
        F.col("_cut.gone").cast("long").alias("n_removed"),
    )


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value computed once, however often ``of`` names it and whatever the optimizer merges."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _without(width: int) -> Column:
    """The text without the lines of the windows ``_at``, how many of its lines are not blank, and how many go."""
    none = F.array().cast("array<int>")

    def of_places(lines: Column, places: Column) -> Column:
        gone = F.array_distinct(F.flatten(F.transform(F.coalesce("_at", F.array().cast("array<int>")), lambda j: F.slice(places, j + 1, width))))
        return _let(F.coalesce(gone, none), lambda g: F.struct(of_gone(lines, g).alias("text"), F.size(places).alias("n"), F.size(g).alias("gone")))

    def of_gone(lines: Column, gone: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.when(F.size(gone) > 0, F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))

    def of_lines(lines: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(F.get(lines, i), F.lit(_BLANKS)) != "")
        return _let(places, lambda p: of_places(lines, p))

    return _let(_lines(), of_lines)


SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos FROM (SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13)) AS line FROM lines) WHERE line <> ''),
wins AS (
  SELECT * FROM (SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS win FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE win IS NOT NULL),
later AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM wins) WHERE nth > 1),
gone AS (SELECT DISTINCT f.doc_id, f.i FROM full_lines f JOIN (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM later) l ON f.doc_id = l.doc_id AND f.pos = l.pos),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM full_lines GROUP BY 1) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1) g USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
