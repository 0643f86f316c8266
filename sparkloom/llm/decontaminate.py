"""Benchmark decontamination with generalised suffix automata of the test items.

Items are normalised to words (A-Z lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``), dealt to blocks of bounded size, and each block becomes
one automaton of all its items, built in a task and written to the shared folder. Documents stream through the automata: only runs of words that occur in
some item are walked, tracking state and longest matching length. Where the length reaches ``n`` words, all the matched words are hit and the items of the state
that holds the last ``n`` words occur in the document; an item of fewer than ``n`` words counts where it occurs whole.

Nothing is shuffled but the items; documents stay in their partitions. Memory is one slice of documents and the automata of the blocks
(at most ``KEEP_BLOCKS`` are held, further ones are read again for each slice).

Defined results: null or wordless texts have no words and no hits; items without words or without item_id are no items; item_ids that repeat are
one item if any of their texts occurs; repeated rows all stay; other columns pass through, but the operator's own columns replace those of their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .shared import get, new_folder, others, put, spread

#: Words of items in a block, at most (or one item); about 1 KB of memory each.
BLOCK_WORDS = 100_000
#: Automata that a worker holds.
KEEP_BLOCKS = 2


class Automaton:
    """A suffix automaton of several word sequences.

    ``step`` holds the transitions, ``link`` the suffix links and ``length`` the longest word sequence of each state.
    """

    def __init__(self, items: list[tuple[int, list[int]]], n: int):
        self.n, self.step, self.link, self.length = n, [{}], [-1], [0]
        self.ids = [i for i, _ in items]
        for _, words in items:
            at = 0
            for w in words:
                at = self._extend(at, w)
        self._annotate([words for _, words in items])

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, w: int) -> int:
        """The state for the sequence of ``p`` and ``w``, cut out of the one that also holds longer sequences."""
        q, need = self.step[p][w], self.length[p] + 1
        if self.length[q] == need:
            return q
        clone = self._state(need, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.step[last]:
            return self._split(last, w)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new

    def _annotate(self, texts: list[list[int]]) -> None:
        """Which items hold a state's sequences; for each state the one of its last n words; whole short items."""
        size = len(self.step)
        self.items: list[list[int]] = [[] for _ in range(size)]
        seen = [-1] * size
        whole: list[list[int]] = [[] for _ in range(size)]
        for k, words in enumerate(texts):
            v = 0
            for w in words:
                v = u = self.step[v][w]
                while u > 0 and seen[u] != k:
                    seen[u] = k
                    if self.length[u] >= self.n:
                        self.items[u].append(k)
                    u = self.link[u]
            if len(words) < self.n:
                whole[v].append(k)
        order = sorted(range(size), key=self.length.__getitem__)
        self.last_n, self.short = [0] * size, [0] * size
        for v in order[1:]:
            up = self.link[v]
            self.last_n[v] = self.last_n[up] or (v if self.length[v] >= self.n else 0)
            self.short[v] = v if whole[v] else self.short[up]
        self.whole = whole

    def walk(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans [start, end) of hit words, and the item numbers."""
        step, link, length, n = self.step, self.link, self.length, self.n
        v = size = 0
        hits: list[tuple[int, int]] = []
        states: set[int] = set()
        for i, w in enumerate(words):
            while v and w not in step[v]:
                v = link[v]
                size = length[v]
            if w in step[v]:
                v = step[v][w]
                size += 1
            else:
                continue
            found = 0
            if size >= n:
                states.add(self.last_n[v])
                found = size
            s = self.short[v if length[v] <= size else link[v]]
            while s:
                states.add(~s)
                found = max(found, length[s])
                s = self.short[link[s]]
            if found:
                start = i + 1 - found
                while hits and hits[-1][1] >= start:
                    start = min(start, hits.pop()[0])
                hits.append((start, i + 1))
        items: set[int] = set()
        for s in states:
            items.update(self.items[s] if s > 0 else self.whole[~s])
        return hits, items


def build(items: DataFrame, n: int) -> tuple[str, list[int]]:
    """Writes the automata of ``item_id, text``; returns their folder and block numbers."""
    spark = items.sparkSession
    folder = new_folder(spark, "automata")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                hashes, counts = K.word_hashes(part.column("text"), K.ALNUM)
                rows = pa.ListArray.from_arrays(pa.array(K.row_starts(counts).astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("item_id").cast(pa.int64()), rows], ["item_id", "words"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in batches:
            for k, i, words in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(k, []).append((i, words))
        for k, rows in own.items():
            vocabulary = np.unique(np.array([w for _, words in rows for w in words], dtype=np.int64).view(np.uint64))
            coded = [(i, np.searchsorted(vocabulary, np.array(words, np.int64).view(np.uint64)).tolist()) for i, words in sorted(rows)]
            least = min(min(len(words), n) for _, words in coded)
            put(f"{folder}/{k}.pickle", pickle.dumps((vocabulary, least, Automaton(coded, n))))
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32())], ["block"])

    words = items.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text").mapInArrow(counted, "item_id long, words array<long>").filter(F.size("words") > 0)
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-2 * total // BLOCK_WORDS) if total > BLOCK_WORDS else 1
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)).cast("int")
    made = words.select(block.alias("block"), "item_id", "words").repartition(blocks, "block").mapInArrow(make, "block int")
    return folder, sorted({r.block for r in made.collect()})


def match(docs: DataFrame, items: DataFrame, n: int = 10, text: str = "text", clean: bool = False) -> DataFrame:
    """``docs`` with ``n_words, n_hit long``, ``spans array<struct<start int, stop int>>`` (word positions) and ``items array<long>``.

    With ``clean`` the text loses the bytes from the first to the last word of each span.
    """
    folder, blocks = build(items, n)
    own = others(docs, "n_words", "n_hit", "spans", "items")
    rest = docs.select(*own)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
    schema = T.StructType(
        [*rest.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("items", T.ArrayType(T.LongType()))]
    )
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}

        def block(k: int) -> tuple:
            if k not in kept:
                loaded = pickle.loads(get(f"{folder}/{k}.pickle"))
                if len(kept) >= KEEP_BLOCKS:
                    return loaded
                kept[k] = loaded
            return kept[k]

        for batch in batches:
            for part in K.slices(batch, text):
                data, offsets = K.text_bytes(part.column(text))
                low = K.lookup(K.LOWER, data)
                starts, lengths, counts = K.spans(K.lookup(K.ALNUM, low), offsets)
                hashes = K.hash_spans(low, starts, lengths)
                first = K.row_starts(counts)
                hits: dict[int, list] = {}
                found: dict[int, set] = {}
                for k in blocks:
                    vocabulary, least, automaton = block(k)
                    code = np.searchsorted(vocabulary, hashes)
                    code[code == len(vocabulary)] = 0
                    known = vocabulary[code] == hashes
                    if not known.any():
                        continue
                    edge = np.zeros(len(known) + 1, dtype=np.int8)
                    edge[0], edge[-1] = known[0], known[-1]
                    change = np.zeros(len(known) + 1, dtype=bool)
                    change[1:-1] = known[1:] != known[:-1]
                    change[0] = change[-1] = True
                    change[first] = True
                    bounds = np.flatnonzero(change)
                    runs = np.flatnonzero(known[bounds[:-1]] & (np.diff(bounds) >= least))
                    texts = np.searchsorted(first, bounds[runs], "right") - 1
                    for a, b, d in zip(bounds[runs].tolist(), bounds[runs + 1].tolist(), texts.tolist()):
                        spans, items_ = automaton.walk(code[a:b].tolist())
                        if spans:
                            base = a - int(first[d])
                            hits.setdefault(d, []).extend((s + base, e + base) for s, e in spans)
                            found.setdefault(d, set()).update(automaton.ids[i] for i in items_)
                merged = {d: _merge(s) for d, s in hits.items()}
                rows = part.num_rows
                spans_col = [[{"start": s, "stop": e} for s, e in merged.get(d, ())] for d in range(rows)]
                columns = [part.column(c) for c in own]
                if clean and merged:
                    columns[own.index(text)] = _without(part.column(text), data, offsets, starts, lengths, first, merged)
                columns += [
                    pa.array(counts.astype(np.int64)),
                    pa.array([sum(e - s for s, e in merged.get(d, ())) for d in range(rows)], pa.int64()),
                    pa.array(spans_col, arrow_span),
                    pa.array([sorted(found.get(d, ())) for d in range(rows)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return spread(rest).mapInArrow(run, schema)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _without(column: pa.Array, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, merged: dict) -> pa.Array:
    """The texts without the bytes of the spans."""
    texts = column.to_pylist()
    for d, spans in merged.items():
        at, parts, base = int(offsets[d]), [], int(first[d])
        for s, e in spans:
            parts.append(data[at : starts[base + s]].tobytes())
            at = int(starts[base + e - 1] + lengths[base + e - 1])
        parts.append(data[at : offsets[d + 1]].tobytes())
        texts[d] = b"".join(parts).decode("utf-8", "replace")
    return pa.array(texts, column.type)


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without the matched spans; documents of which more than ``max_coverage`` of the words is matched go."""
    # the documents' own columns travel in one, so that none is taken for a figure
    packed = docs.select("text", F.struct(*others(docs, "text")).alias("rest")) if others(docs, "text") else docs
    matched = match(packed, items, n, clean=True).filter((F.col("n_words") == 0) | (F.col("n_hit") <= max_coverage * F.col("n_words")))
    return matched.select(*[F.col("text") if c.lower() == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def report(matched: DataFrame) -> DataFrame:
    """Per document the figures and a digest of the items."""
    return matched.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>"))), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS m FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(ws[i + 1 : i + m], ' ') AS win FROM (SELECT *, unnest(range(len(ws) - m + 1)) AS i FROM b)),
ms AS (SELECT DISTINCT m FROM b),
dw AS (SELECT doc_id, m, i, array_to_string(ws[i + 1 : i + m], ' ') AS win FROM (SELECT doc_id, ws, m, unnest(range(len(ws) - m + 1)) AS i FROM w, ms WHERE len(ws) >= m)),
hit AS (SELECT d.doc_id, d.i, d.m, k.item_id FROM dw d JOIN bw k ON d.m = k.m AND d.win = k.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
