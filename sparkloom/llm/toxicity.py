"""Toxicity by class-conditional Kneser-Ney models.

Both classes have a model of the spelling of words (lower-cased runs of letters, digits and bytes beyond ASCII, with a start and an end symbol): byte n-grams of
order ``ORDER``. The lower level is shared: one Kneser-Ney model of both classes together, absolute discounting with continuation counts, which smooths
rare expressions alike for both. On top, each class discounts its own counts and backs off to the shared model, from orders of ``CLASS_FROM`` on.
A toxic text is one in which a small share of the words (``SHARE``) comes from the toxic model and the rest from the ordinary one; a document's evidence is
the difference of its log-likelihoods as a toxic and as an ordinary text, normalised by its number of words. A word's likelihoods are
computed once and kept in a bounded table of the worker.

The labelled sample makes the counts (a word counts once a document). Evidence becomes a probability by logistic regression on the
logs of the normalised difference, the whole difference and the length; for that, each half of the sample is scored by a model of the other half, so
the counts' own words cannot flatter it; a label's rows are dealt to both halves. Where a label has a single row the model of the whole sample scores it. The sample is bounded by ``max_rows``
rows a label (the smallest by hash of doc_id; of rows with one doc_id the least text) of ``LONGEST`` characters at most; the share of the labels among all rows that may be learnt from corrects the intercept.
One task trains; the tables go to the shared folder. Scoring is a map over the documents, without any shuffle.

Defined results: texts without words (null, empty) have evidence 0; without labels of both kinds every text scores 0; labels that repeat use the
largest; repeated rows all stay; other columns pass through, but ``score`` is replaced.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .shared import get, new_folder, put, spread

ORDER = 6
CLASS_FROM = 4
MAX_ROWS = 3000
#: Characters of the longest text to learn from: with MAX_ROWS it bounds what meets in the task that trains. Every text is scored whole.
LONGEST = 1 << 18
#: Share of a toxic text's words that the toxic model speaks.
SHARE = 0.0025
#: Words whose evidence a worker keeps at most; then it starts anew.
REMEMBER = 1_500_000
DISCOUNT = 0.75
#: A class's own counts lose so much: what fewer documents show is left to the shared model.
CLASS_DISCOUNT = 2.0
_P = np.uint64(0xD6E8FEB86659FD93)


def distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes; starts, lengths and hashes of the distinct words; the index of each word among them, and words per text."""
    data, offsets = K.text_bytes(column)
    data = K.lookup(K.LOWER, data)
    starts, lengths, counts = K.spans(K.lookup(K.ALNUM, data), offsets)
    found, index = K.distinct(K.hash_spans(data, starts, lengths))
    place = np.zeros(len(found), dtype=np.int64)
    place[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    return data, starts[place], lengths[place], found, index, counts


def grams(flat: np.ndarray, lengths: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes by order of the n-grams that end at each symbol of the padded words, each symbol's place in its word, and its word."""
    n = lengths + 2
    first = K.row_starts(n)
    symbols = np.full(first[-1], 3, dtype=np.uint64)
    symbols[K.ranges(first[:-1] + 1, lengths)] = flat
    symbols[first[:-1]] = 2
    place = K.ranges(np.zeros_like(n), n)
    word = np.repeat(np.arange(len(n)), n)
    out = [np.zeros(len(symbols), np.uint64), K.mix(symbols + np.uint64(1))]
    for _ in range(2, ORDER + 1):
        before = np.zeros(len(symbols), np.uint64)
        before[1:] = out[-1][:-1]
        out.append(K.mix(before * _P + symbols + np.uint64(1)))
    return out, place, word


def _sums(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, with sums of the weights."""
    found, index = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(index, w, minlength=len(found)).astype(np.float32) for w in weights)


class Model:
    """Counts by order: of n-grams (shared, class 0, class 1) and of contexts (total and distinct followers, likewise)."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.t = tables

    @staticmethod
    def fit(flat: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> Model:
        """From distinct words and their numbers in class 0 and 1 (two rows)."""
        by_order, place, word = grams(flat, lengths)
        t: dict[str, np.ndarray] = {}
        for m in range(1, ORDER + 1):
            at = np.flatnonzero((place >= m - 1) & (place > 0))
            keys, one = np.unique(by_order[m][at], return_index=True)
            at_one = at[one]
            context = by_order[m - 1][at_one - 1] if m > 1 else np.zeros(len(keys), np.uint64)
            own = [_sums(by_order[m][at], counts[c][word[at]])[1] for c in (0, 1)]
            shared = own[0] + own[1]
            if m < ORDER:
                longer = np.flatnonzero((place >= m) & (place > 0))
                _, pick = np.unique(by_order[m + 1][longer], return_index=True)
                left, n_left = np.unique(by_order[m][longer[pick]], return_counts=True)
                cont = np.zeros(len(keys), np.float32)
                cont[np.searchsorted(keys, left)] = n_left
                shared = np.where(place[at_one] == m - 1, shared, cont)  # nothing stands before a start symbol
            t[f"key{m}"], t[f"n{m}"] = keys, np.stack([shared, *own]).astype(np.float32)
            rows = np.concatenate([t[f"n{m}"], t[f"n{m}"][:1] > 0, np.minimum(t[f"n{m}"][1:], CLASS_DISCOUNT)])
            ctx, *sums = _sums(context, *rows)
            t[f"ctx{m}"], t[f"s{m}"] = ctx, np.stack(sums)
            by_order[m - 1] = np.zeros(0, np.uint64)  # no longer n-gram asks for it
        return Model(t)

    def _find(self, kind: str, m: int, keys: np.ndarray, table: str) -> np.ndarray:
        known, values = self.t[f"{kind}{m}"], self.t[f"{table}{m}"]
        at = np.searchsorted(known, keys)
        at[at == len(known)] = 0
        return np.where(known[at] == keys, values[:, at], np.float32(0))

    def evidence(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log P(word | class 1) - log P(word | class 0) for each word."""
        if not len(lengths):
            return np.zeros(0)
        by_order, place, word = grams(flat, lengths)
        at = np.flatnonzero(place > 0)
        p = np.full(len(at), 1 / 257)
        layers = []
        for m in range(1, ORDER + 1):
            use = np.flatnonzero(place[at] >= m - 1)
            own = at[use]
            n = self._find("key", m, by_order[m][own], "n")
            s = self._find("ctx", m, by_order[m - 1][own - 1] if m > 1 else np.zeros(len(own), np.uint64), "s")
            has = s[0] > 0
            total = np.where(has, s[0], 1)
            p[use] = np.where(has, (np.maximum(n[0] - DISCOUNT, 0) + DISCOUNT * s[3] * p[use]) / total, p[use])
            layers.append((use, n, s))
        logs = []
        for c in (1, 2):
            q = p.copy()
            for m, (use, n, s) in enumerate(layers, 1):
                keep = (m >= CLASS_FROM) | (place[at[use]] == m - 1)
                u, nc, sc, dc = use[keep], n[c][keep], s[c][keep], s[3 + c][keep]
                has = sc > 0
                q[u] = np.where(has, (np.maximum(nc - CLASS_DISCOUNT, 0) + dc * q[u]) / np.where(has, sc, 1), q[u])
            logs.append(np.log(np.maximum(q, 1e-30)))
        return np.bincount(word[at], logs[1] - logs[0], minlength=len(lengths))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.t)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Model:
        found = np.load(io.BytesIO(raw))
        return Model({k: found[k] for k in found.files})


class Evidence:
    """The evidence of words, kept for those seen before."""

    def __init__(self, model: Model):
        self.model, self.hashes, self.values = model, np.zeros(0, np.uint64), np.zeros(0)

    def of(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes))
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        out[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            e = self.model.evidence(data[K.ranges(starts[part], lengths[part])], lengths[part])
            out[part] = np.log1p(SHARE * np.expm1(np.minimum(e, 60)))
        if len(self.hashes) + len(new) > REMEMBER:
            self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0)
        together = np.concatenate([self.hashes, hashes[new]])
        order = np.argsort(together)
        self.hashes, self.values = together[order], np.concatenate([self.values, out[new]])[order]
        return out


def inputs(evidence: Evidence, column: pa.Array) -> np.ndarray:
    """The three inputs of the calibration for each text."""
    data, starts, lengths, hashes, index, counts = distinct_words(column)
    word = evidence.of(data, starts, lengths, hashes)
    total = np.bincount(np.repeat(np.arange(len(counts)), counts), word[index], minlength=len(counts)) if len(index) else np.zeros(len(counts))
    total = np.maximum(total, 0)
    return np.stack([np.log(0.002 + total / np.maximum(counts, 1)), np.log(0.1 + total), np.log1p(counts)], axis=1)


def calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Mean and scale of the inputs, weights and intercept of a ridge logistic regression, set to the share ``prior`` of label 1."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(4), np.diag([1.0, 1.0, 1.0, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    share = y.mean()
    w[3] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return np.concatenate([mean, scale, w])


def fit_model(texts: pa.Array, y: np.ndarray) -> Model:
    """The model of labelled texts; each word counts once a text."""
    data, starts, lengths, _, index, counts = distinct_words(texts)
    pair = np.unique(np.repeat(np.arange(len(counts)), counts) * len(lengths) + index)
    row, index = pair // len(lengths), pair % len(lengths)
    ones, every = np.bincount(index, y[row], minlength=len(lengths)), np.bincount(index, minlength=len(lengths))
    return Model.fit(data[K.ranges(starts, lengths)], lengths, np.stack([every - ones, ones]))


def train(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS) -> str:
    """Fits on at most ``max_rows`` documents of each label; returns the model's place."""
    spark = docs.sparkSession
    uri = f"{new_folder(spark, 'toxicity')}/model.npz"
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    n, ones = usable.agg(F.count(F.lit(1)), F.sum("y")).first()
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    chosen = usable.filter("y = 1").orderBy(*by_hash).limit(max_rows).union(usable.filter("y = 0").orderBy(*by_hash).limit(max_rows))
    prior = min(max((ones or 0) / n if n else 0.5, 1e-4), 1 - 1e-4)

    def learn(batches: Iterator[pa.RecordBatch]) -> int:
        rows = sorted((d, t or "", y) for b in batches for d, y, t in zip(*(c.to_pylist() for c in b.columns)))
        texts, y = pa.array([t for _, t, _ in rows], pa.string()), np.array([y for *_, y in rows], dtype=np.float64)
        if 0 < y.sum() < len(y):
            # every second row of each label
            by_label = [np.flatnonzero(y == c) for c in (0, 1)]
            halves = [np.sort(np.concatenate([own[k::2] for own in by_label])) for k in (0, 1)]
            x = np.zeros((len(rows), 3))
            if min(map(len, by_label)) > 1:
                for a, b in (halves, halves[::-1]):
                    x[b] = inputs(Evidence(fit_model(texts.take(pa.array(a)), y[a])), texts.take(pa.array(b)))
                    K.give_back()
            model = fit_model(texts, y)
            if min(map(len, by_label)) == 1:
                x = inputs(Evidence(model), texts)
            model.t["calibration"] = calibrate(x, y, prior)
            put(uri, model.dump())
        else:
            put(uri, b"")
        return len(rows)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = learn(batches)
        K.give_back()  # when nothing of the training is held any more
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    # at most 2 * max_rows ids are broadcast, and as many texts meet in one task
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST)
    found = found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # one row an id, so the bound holds; aggregated before the shuffle
    if not found.repartition(1).mapInArrow(fit, "n long").collect():  # no task ran: no rows
        put(uri, b"")
    return uri


def score(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``score double``: the probability of label 1."""
    rest = docs.drop("score")
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = get(model)
        own = Model.load(raw) if raw else None
        evidence = Evidence(own) if own else None
        for batch in batches:
            for part in K.slices(batch, text):
                p = np.zeros(part.num_rows)
                if own is not None:
                    mean, scale, w = np.split(own.t["calibration"], [3, 6])
                    margin = (inputs(evidence, part.column(text)) - mean) / scale @ w[:3] + w[3]
                    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], [f.name for f in schema.fields])

    return spread(rest).mapInArrow(run, schema)
