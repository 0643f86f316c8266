"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters and digits (any byte beyond ASCII counts as a letter) and runs of punctuation, case kept; features are unigrams and bigrams, hashed
to ``2**BITS`` places, and one more that all bigrams of equal words share. A text's vector holds its term frequencies, scaled to length one, so the length of a text does not matter.

Training takes a bounded sample of the labelled rows (``max_rows``, the smallest by hash of doc_id, of rows with one doc_id the least text, ``LONGEST`` characters at most): one task holds their features and makes
per-coordinate FTRL-proximal updates, document by document. The weights (one float a place) go to the shared folder; scoring
is a map over the documents without any shuffle: sparse dot products, vectorised over a slice.

Defined results: null and empty texts have no features and score by the intercept alone; a table without usable labels gives every text a score of 0.5;
documents whose labels repeat use the largest label; repeated rows all stay; other columns pass through, but ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .shared import get_array, new_folder, put_array, spread

BITS = 20
#: Place of the feature that all bigrams of one word twice share.
REPEAT = np.uint64(1)
MAX_ROWS = 6000
#: Characters of the longest text to learn from: with MAX_ROWS it bounds what meets in the task that trains. Every text is scored whole.
LONGEST = 1 << 18

#: 1: letters, digits and bytes beyond ASCII; 2: punctuation and control characters; 0: white space.
CLASSES = np.full(256, 2, dtype=np.uint8)
CLASSES[[0x20, 9, 10, 11, 12, 13]] = 0
CLASSES[0x30:0x3A] = CLASSES[0x41:0x5B] = CLASSES[0x61:0x7B] = CLASSES[0x80:] = 1


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of the texts' vectors, and the number of entries of each."""
    data, offsets = K.text_bytes(column)
    kinds = K.lookup(CLASSES, data)
    starts, lengths, counts = K.spans(kinds > 0, offsets, kinds)
    uni = K.hash_spans(data, starts, lengths)
    rows = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    two = np.flatnonzero(rows[1:] == rows[:-1]) if len(rows) else np.zeros(0, np.int64)
    again = two[uni[two] == uni[two + 1]]
    bi = K.mix(uni[two] * np.uint64(0xD6E8FEB86659FD93) + uni[two + 1])
    shift, low = np.uint64(BITS), np.uint64((1 << BITS) - 1)
    key = np.concatenate([rows << shift | uni & low, rows[two] << shift | bi & low, rows[again] << shift | REPEAT])
    key.sort()
    new = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    tf = np.diff(new, append=len(key)).astype(np.float64)
    row = (key[new] >> shift).astype(np.int64)
    norm = np.sqrt(np.bincount(row, tf * tf, minlength=len(counts)))
    return (key[new] & low).astype(np.int64), tf / norm[row] if len(row) else tf, np.bincount(row, minlength=len(counts))


def ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01) -> np.ndarray:
    """Weights, the intercept last, by FTRL-proximal updates in a fixed random order."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(7)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for d in order.permutation(len(vectors)):
            at, x = vectors[d]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - labels[d]) * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[at] = ni + g * g
    return weights(z, n).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS) -> str:
    """Fits on at most ``max_rows`` labelled documents; returns the place of the weights."""
    spark = docs.sparkSession
    uri = f"{new_folder(spark, 'quality')}/weights.npy"
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                at, x, n = features(part.column("text"))
                ends = pa.array(K.row_starts(n).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(x.astype(np.float32)))],
                    ["doc_id", "y", "at", "x"],
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for d, y, at, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                at, x = at.values.to_numpy(), x.values.to_numpy().astype(np.float64)
                rows.append((d, len(at), y, np.append(at, 1 << BITS), np.append(x, 1.0)))
        rows.sort(key=lambda r: r[:3])
        put_array(uri, ftrl([(r[3], r[4]) for r in rows], [r[2] for r in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], ["n"])

    # at most max_rows rows of two numbers are broadcast, and their features meet in one task
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST)
    found = found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # one row an id, so the bound holds; aggregated before the shuffle
    vectors_ = found.mapInArrow(vectors, "doc_id long, y int, at array<int>, x array<float>")
    if not vectors_.repartition(1).mapInArrow(fit, "n long").collect():  # no task ran: no rows
        put_array(uri, np.zeros((1 << BITS) + 1, np.float32))
    return uri


def score(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``score double``: the probability of label 1."""
    rest = docs.drop("score")
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.asarray(get_array(model))
        for batch in batches:
            for part in K.slices(batch, text):
                at, x, n = features(part.column(text))
                margin = np.bincount(np.repeat(np.arange(len(n)), n), w[at] * x, minlength=len(n)) + w[-1]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(margin, -500, 500))))], [f.name for f in schema.fields])

    return spread(rest).mapInArrow(run, schema)


def predicted(threshold: float) -> Column:
    return (F.col("score") >= threshold).cast("int").alias("predicted")
