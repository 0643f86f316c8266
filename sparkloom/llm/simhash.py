"""SimHash fingerprints and their neighbours.

Terms are the three-word shingles of a text (A-Z lower-cased, words by ASCII white space; a text of one or two words is one term). A term's 256-bit hash
votes on each bit, +w or -w, where w (1 to 4) grows with the term's length in bytes; the sign of the sum is the fingerprint's bit. Votes are
added eight bytes at a time: a table turns a byte of the hash into two words of four 16-bit counters.

``neighbours`` finds all pairs of different fingerprints within a Hamming radius: the bits are cut into ``radius + spare`` blocks, and each
table permutes one choice of ``spare`` blocks to the front; two fingerprints within the radius agree on all of some choice. Each table is
an equi-join on those leading blocks. The default radius makes 630 tables with leads of about 14 bits: whole, but for few millions of fingerprints
at most; a smaller radius has fewer tables and longer leads. Equal fingerprints are one class beforehand, so exact copies make no pairs.

Defined results: null and empty texts have no terms and the fingerprint of all zeros; equal texts have equal fingerprints; repeated rows all stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import cut, shards_for, spread

BITS = 256
#: Bits within which near copies lie. Measured on 1500 texts of sf0.01 with words replaced, among those that keep a five-word Jaccard of 0.8: 99 % are
#: within 31 bits after one word, 34 after two, 38 after five (95 % within 26, 29 and 33). Of 1500 pairs of different texts the nearest was 42 apart.
RADIUS = 34
#: Terms of a segment at most: four times as many fit a 16-bit counter.
_SEGMENT = 16_000
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
#: Four 16-bit counters in a word: bits 0 to 3 and 4 to 7 of a byte.
_LOW = np.array([sum(((b >> k) & 1) << (16 * k) for k in range(4)) for b in range(256)], dtype=np.uint64)
_HIGH = np.array([sum(((b >> (k + 4)) & 1) << (16 * k) for k in range(4)) for b in range(256)], dtype=np.uint64)


def fingerprints(column: pa.Array) -> np.ndarray:
    """A row of 32 bytes for each text."""
    data, offsets = K.text_bytes(column)
    data = K.lookup(K.LOWER, data)
    starts, lengths, counts = K.spans(K.lookup(K.NOT_SPACE, data), offsets)
    words = K.hash_spans(data, starts, lengths)
    first = K.row_starts(counts)
    full = np.where(counts >= 3, counts - 2, np.minimum(counts, 1))
    at = K.ranges(first[:-1], full)
    if not len(at):
        return np.zeros((len(counts), BITS // 8), np.uint8)
    term, size = words[at].copy(), lengths[at].copy()
    row = np.repeat(np.arange(len(counts)), full)
    for k in (1, 2):
        more = np.flatnonzero(counts[row] > k)
        term[more] = K.mix(term[more] * np.uint64(0xD6E8FEB86659FD93) + words[at[more] + k])
        size[more] += lengths[at[more] + k]
    weight = np.clip(size >> 2, 1, 4).astype(np.uint64)
    # segments: a text, or a piece of a long one
    begin = K.row_starts(full)
    edges = np.unique(np.concatenate([begin[:-1][full > 0], np.arange(0, len(at), _SEGMENT)]))
    owner = row[edges]
    total = np.add.reduceat(weight.astype(np.int64), edges)
    votes = np.zeros((len(counts), BITS), dtype=np.int64)
    for part, seed in enumerate(_SEEDS):
        raw = K.mix(term ^ seed).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            value = raw[:, byte]
            for half, table in enumerate((_LOW, _HIGH)):
                sums = np.add.reduceat(table[value] * weight, edges)
                bit = part * 64 + byte * 8 + half * 4
                np.add.at(votes, (owner[:, None], np.arange(bit, bit + 4)[None, :]), 2 * sums.view("<u2").reshape(-1, 4).astype(np.int64) - total[:, None])
    return np.packbits(votes > 0, axis=1)


def _hex(rows: np.ndarray) -> pa.Array:
    text = rows.tobytes().hex()
    n = 2 * rows.shape[1]
    return pa.array([text[i : i + n] for i in range(0, len(text), n)], pa.string())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) / BITS


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint string`` (64 hex digits)."""
    rest = docs.drop("fingerprint")
    schema = rest.select("*", F.lit("").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, _hex(fingerprints(part.column(text)))], [f.name for f in schema.fields])

    return spread(rest).mapInArrow(run, schema)


def neighbours(prints: DataFrame, radius: int = RADIUS, spare: int = 2) -> DataFrame:
    """``a, b string, distance int``: all pairs a < b of different values of ``fingerprint`` at most ``radius`` bits apart."""
    distinct = cut(prints.filter(F.col("fingerprint").isNotNull()).select("fingerprint").distinct(), "prints")
    blocks = radius + spare
    digits = BITS // 4
    edges = [digits * k // blocks for k in range(blocks + 1)]
    keys = [
        F.struct(F.lit(t).alias("t"), F.concat_ws("", *[F.substring("fingerprint", edges[k] + 1, edges[k + 1] - edges[k]) for k in chosen]).alias("lead"))
        for t, chosen in enumerate(combinations(range(blocks), spare))
    ]
    tables = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select("k.t", "k.lead", "fingerprint")
    words = range(1, digits + 1, 15)  # 60 bits at a time
    apart = sum(
        (F.bit_count(F.conv(F.substring(F.col("a"), i, 15), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring(F.col("b"), i, 15), 16, 10).cast("long"))) for i in words),
        F.lit(0),
    )
    left, right = tables.withColumnRenamed("fingerprint", "a"), tables.withColumnRenamed("fingerprint", "b")
    return left.join(right, ["t", "lead"]).filter("a < b").withColumn("distance", apart.cast("int")).filter(F.col("distance") <= radius).select("a", "b", "distance").distinct()


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``bucket, tail, doc_id, text`` dealt so that each bucket is a range of descending doc_id and ends with the first row after it.

    Ranges come from approximate quantiles of doc_id (one number a bucket); the texts are shuffled once; the extra row of a bucket (``tail``) is the
    head of the next range, and of the whole after the last one.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    n = shards_for(docs, 8 << 20, 2 * spark.sparkContext.defaultParallelism)
    bounds = np.array(sorted(set(docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n))), dtype=np.float64)

    @F.pandas_udf("int")
    def bucket_of(ids):  # noqa: ANN001, ANN202  # a larger id comes earlier; rows without one are last
        import pandas as pd

        found = len(bounds) - np.searchsorted(bounds, ids.to_numpy(dtype=np.float64, na_value=-np.inf), "right")
        return pd.Series(found.astype(np.int32))

    dealt = docs.withColumn("bucket", bucket_of("doc_id"))
    heads = sorted((r.bucket, r.head) for r in docs.select("doc_id").withColumn("bucket", bucket_of("doc_id")).groupBy("bucket").agg(F.max("doc_id").alias("head")).collect())
    if not heads:
        return dealt.withColumn("tail", F.lit(False)), 1
    # the head of each range goes to the range before it; as many rows as there are buckets
    places = [(heads[k - 1][0], heads[k][0], heads[k][1]) for k in range(len(heads))]
    to = spark.createDataFrame(places, "bucket int, at int, head long")
    first = dealt.withColumnRenamed("bucket", "own").join(F.broadcast(to), (F.col("own") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("head")))
    tails = first.groupBy("bucket", "doc_id").agg(F.min("text").alias("text"), F.max(F.col("text").isNull()).alias("void"))
    tails = tails.select("doc_id", F.when(~F.col("void"), F.col("text")).alias("text"), "bucket", F.lit(True).alias("tail"))
    return dealt.withColumn("tail", F.lit(False)).unionByName(tails), n


def edited(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, the one of its edited text, and how alike they and the next document's are.

    The edited text has the last half of the code points (rounded down) replaced by the first as many, or all, of the next document, in descending order
    of doc_id (equal ids: by text, null first; rows without id last); after the last document comes the first.
    """
    rows, n = with_next(docs)
    order = [F.col("bucket"), F.col("tail"), F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, str, bool] | None = None  # the last row still waits for the one after it
        for batch in batches:
            for part in K.slices(batch, "text", K.SLICE_BYTES // 2):
                ids, tails = part.column("doc_id").to_pylist(), part.column("tail").to_pylist()
                texts = pc.fill_null(part.column("text"), "").to_pylist()
                if held is not None:
                    ids, texts, tails = [held[0], *ids], [held[1], *texts], [held[2], *tails]
                held = (ids[-1], texts[-1], tails[-1])
                own = [k for k in range(len(ids) - 1) if not tails[k]]
                if not own:
                    continue
                new = [texts[k][: len(texts[k]) - len(texts[k]) // 2] + texts[k + 1][: len(texts[k]) // 2] for k in own]
                prints = fingerprints(pa.array(texts, pa.large_string()))
                new_prints = fingerprints(pa.array(new, pa.large_string()))
                mine, after = prints[own], prints[np.array(own) + 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[k] for k in own], pa.int64()),
                        pa.array([len(texts[k]) for k in own], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                        _hex(mine),
                        _hex(new_prints),
                        pa.array(likeness(mine, new_prints)),
                        pa.array(likeness(mine, after)),
                    ],
                    [x.split()[0] for x in schema.split(", ")],
                )

    return rows.repartitionById(n, F.col("bucket")).sortWithinPartitions(*order).mapInArrow(run, schema)
