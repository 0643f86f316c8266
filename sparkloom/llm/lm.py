"""Language-model scoring with an Elias-Fano n-gram trie.

Order 3, interpolated absolute discounting. Level 1 is the vocabulary; level 2 holds the bigrams u v, level 3 their children w. Levels 2 and 3 lie in shards by a
hash of u, or of u v for the frequent u, so a word that a third of all n-grams share is spread over all shards. In a shard

* level 2 is one Elias-Fano sequence of the codes ``u * (V + 2) + v``, with a quantised probability and a quantised back-off mass for each entry;
* level 3 is one Elias-Fano sequence, in which the children of entry c take values from ``base[c]`` on. ``base`` is monotone and an Elias-Fano
  sequence itself. A child w of u v is stored by its place among the successors of v (context-relative: rank within the shard of v w, and that
  shard), which is far below V for most v; its quantised probability lies beside.

Quantisation rounds probabilities and masses down (16 bits on a log scale), so no distribution exceeds one. ``cutoff`` is a cut-off for the
highest order: trigrams seen less often are counted but get no entry of their own, and their mass goes to the back-off. With 1, as in the query, all have one.

Everything is made in tasks: words and n-grams are counted in slices, packed by shard and shuffled; shards are written to the shared folder and memory-mapped by
the scoring tasks, which keep all texts in their partitions. Ids are dealt by classes of frequency, so common words have small ids and packed counts are
small. The driver sees one row a shard.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; each text ends with an end token. Defined results: null and empty texts are the end token alone; a
table without training rows gives every token the probability 1 / (V + 1) = 1; repeated rows all count and all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import elias_fano as EF
from . import kernels as K
from .shared import cut, get, get_array, new_folder, others, put, put_array, remove, shards_for, spread

#: Text of a slice when n-grams are counted.
COUNT_SLICE = 6 << 20
SCALE = 7000
#: Words that occur so often or more are frequent: a shard holds at most twice as many successors of any other word.
FREQUENT = 1 << 12
#: Parts of shards that a worker holds mapped at once.
KEEP_FILES = 6000
END = 0  # a hash that stands for the end token
_U = np.uint64


def quantise(p: np.ndarray) -> np.ndarray:
    """16-bit codes of probabilities, rounded down; 0 stands for one, 65535 for none."""
    with np.errstate(divide="ignore"):
        code = np.ceil(-np.log10(p) * SCALE - 1e-6)
    return np.where(p > 0, np.clip(code, 0, 65534), 65535).astype(np.uint16)


_VALUES = np.append(10.0 ** (-np.arange(65535) / SCALE), 0.0)


def dequantise(code: np.ndarray) -> np.ndarray:
    return _VALUES[code]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, the end tokens among them, and tokens per text."""
    words, counts = K.word_hashes(column)
    words[words == END] = 1
    out = np.full(len(words) + len(counts), END, _U)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(counts + 1) - 1] = False
    out[keep] = words
    return out, counts + 1


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes."""
    parts = []
    for a in arrays:
        width = a.dtype.itemsize
        raw = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, width).T).tobytes())
        parts += [np.array([len(a), width, len(raw)], "<u4").tobytes(), raw]
    return b"".join(parts)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width, size = (int(x) for x in np.frombuffer(data, "<u4", 3, at))
        raw = zstandard.ZstdDecompressor().decompress(data[at + 12 : at + 12 + size], max_output_size=max(n * width, 1))
        out.append(np.frombuffer(raw, np.uint8).reshape(width, n).T.copy().view(f"<u{width}").reshape(n))
        at += 12 + size
    return out


class Vocabulary:
    """Words by hash: ids and counts, in shards by the leading bits of the hash."""

    def __init__(self, folder: str, shards: int, size: int, total: int):
        self.folder, self.shift, self.size, self.total, self.open = folder, _U(64 - shards.bit_length() + 1), size, total, {}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (size + 1 for unknown words), counts, and back-off masses of the words as contexts."""
        ids, counts, gamma = np.full(len(hashes), self.size + 1, np.int64), np.zeros(len(hashes), np.int64), np.ones(len(hashes))
        order = np.argsort(hashes)
        ordered = hashes[order]
        which = (ordered >> self.shift).astype(np.int64)
        edges = np.flatnonzero(np.diff(which, prepend=-1, append=-1))
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            k = int(which[a])
            if k not in self.open:
                if len(self.open) >= KEEP_FILES:
                    self.open.clear()
                self.open[k] = [get_array(f"{self.folder}/{k}.{part}.npy") for part in ("hash", "id", "count")]
            known, id_, count = self.open[k]
            if not len(known):
                continue
            at = np.searchsorted(known, ordered[a:b])
            at[at == len(known)] = 0
            ok = known[at] == ordered[a:b]
            ids[order[a:b][ok]], counts[order[a:b][ok]] = id_[at[ok]], count[at[ok]]
        return ids, counts, gamma


def _classes(counts: np.ndarray) -> np.ndarray:
    """Classes of frequency, the commonest first."""
    return 63 - np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)


def build_vocabulary(docs: DataFrame) -> tuple[Vocabulary, tuple[int, int], int, int]:
    """Counts the training tokens; returns the vocabulary, how many words occur once and twice, the number of texts, and how many words are frequent."""
    spark, shards, folder = docs.sparkSession, shards_for(docs), new_folder(docs.sparkSession, "vocabulary")
    shift = _U(64 - shards.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text", COUNT_SLICE):
                found, index = K.distinct(tokens(part.column("text"))[0])
                n = np.bincount(index, minlength=len(found)).astype("<u4")
                order = np.argsort(found)
                found, n = found[order], n[order]
                ends = np.searchsorted((found >> shift).astype(np.int64), np.arange(shards + 1))
                used = [k for k in range(shards) if ends[k] < ends[k + 1]]
                packed = [_pack(found[ends[k] : ends[k + 1]], n[ends[k] : ends[k + 1]]) for k in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], ["k", "packed"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(k, []).append(_unpack(raw))
        for k, parts in own.items():
            hashes, index = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(index, np.concatenate([p[1] for p in parts]).astype(np.float64), minlength=len(hashes)).astype(np.int64)
            put_array(f"{folder}/{k}.hash.npy", hashes)
            put_array(f"{folder}/{k}.count.npy", n)
            ends = int(n[hashes == END].sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k]), pa.array([int(n.sum())]), pa.array([int((n == 1).sum())]), pa.array([int((n == 2).sum())]), pa.array([ends]), pa.array([np.bincount(_classes(n), minlength=64).tolist()])],
                ["k", "total", "once", "twice", "texts", "classes"],
            )

    schema = "k long, total long, once long, twice long, texts long, classes array<long>"
    rows = {r.k: r for r in docs.mapInArrow(count, "k int, packed binary").repartition(shards, "k").mapInArrow(merge, schema).collect()}
    by_class = np.array([rows[k].classes if k in rows else [0] * 64 for k in range(shards)], dtype=np.int64)
    flat = by_class.T.reshape(-1)
    base = (np.cumsum(flat) - flat).reshape(64, shards)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                if k in rows_set:
                    c = _classes(np.asarray(get_array(f"{folder}/{k}.count.npy")))
                    order = np.argsort(c, kind="stable")
                    ids = np.empty(len(c), np.int64)
                    ids[order] = np.arange(len(c)) - (np.cumsum(by_class[k]) - by_class[k])[c[order]] + base[c[order], k]
                else:
                    ids = np.zeros(0, np.int64)
                    put_array(f"{folder}/{k}.hash.npy", np.zeros(0, _U))
                    put_array(f"{folder}/{k}.count.npy", ids)
                put_array(f"{folder}/{k}.id.npy", ids)
            yield batch

    rows_set = set(rows)
    spark.range(shards).repartition(shards, "id").mapInArrow(number, "id long").count()
    size, total = int(flat.sum()), sum(r.total for r in rows.values())
    return Vocabulary(folder, shards, size, total), (sum(r.once for r in rows.values()), sum(r.twice for r in rows.values())), sum(r.texts for r in rows.values()), int(by_class[:, : _classes(np.array([FREQUENT]))[0] + 1].sum())


def _discount(once: int, twice: int) -> float:
    """The usual estimate of the absolute discount."""
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once + twice else 0.5


def _grams(column: pa.Array, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Tokens of texts as ids and as distinct bigrams.

    ``counts``: tokens of each text; ``index``: each token's place among the distinct ones and ``found_counts`` these ones' counts; ``codes``: the distinct bigrams
    ``u * width + v``, ascending, with ``u`` and ``v``; ``two``: the bigram that each token ends; ``at``: tokens that end a trigram, all but the first of each text.
    """
    words, counts = tokens(column)
    found, index = K.distinct(words)
    ids, n, _ = vocabulary.find(found)
    token, start, width = ids[index], K.row_starts(counts), vocabulary.size + 2
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[start[:-1][counts > 0]] = vocabulary.size  # the start of a text
    codes, two = K.distinct_in_order((before * width + token).astype(_U), width * width)
    u, v = np.divmod(codes.astype(np.int64), width)
    inner = np.ones(len(token), bool)
    inner[start[:-1]] = False
    return {"counts": counts, "found_counts": n, "index": index, "codes": codes, "u": u, "v": v, "two": two, "at": np.flatnonzero(inner)}


def _shard(codes: np.ndarray, facts: dict) -> np.ndarray:
    """Shards of bigrams: by the first word, whose successors then lie together; for the frequent words, which have the least ids, by both."""
    width = _U(facts["width"])
    head = codes // width
    by_both = (head < _U(facts["frequent"])) | (head == width - _U(2))
    return (K.mix(np.where(by_both, codes, head * width)) & _U(facts["shards"] - 1)).astype(np.int64)


def _by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Places by shard, in their order within each, and the ends of the shards. Sixteen bits are sorted by their digits."""
    order = np.argsort(shard.astype(np.uint16 if shards <= 1 << 16 else np.int64), kind="stable")
    return order, K.row_starts(np.bincount(shard, minlength=shards))


class Trie:
    """The levels of a trained model."""

    def __init__(self, facts: dict):
        self.__dict__.update(facts)
        self.files: dict[str, object] = {}

    def _room(self) -> None:
        if len(self.files) >= KEEP_FILES:
            self.files.clear()

    def sequence(self, k: int, name: str) -> EF.Sequence:
        key = f"{k}.{name}"
        if key not in self.files:
            self._room()
            self.files[key] = EF.load(f"{self.folder}/{key}")
        return self.files[key]

    def array(self, k: int, name: str) -> np.ndarray:
        key = f"{k}.{name}.npy"
        if key not in self.files:
            self._room()
            self.files[key] = get_array(f"{self.folder}/{key}")
        return self.files[key]

    def locate(self, codes: np.ndarray, leaves: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of ascending bigrams the shard, the place (-1: absent), the context-relative id as a successor of the first word; with ``leaves`` also the
        probability (absent: 0) and the mass left to shorter contexts (absent: 1)."""
        shard, place, rel = _shard(codes, self.__dict__), np.full(len(codes), -1, np.int64), np.zeros(len(codes), np.int64)
        p2, g3 = np.full(len(codes), 65535, np.uint16), np.zeros(len(codes), np.uint16)
        order, edges = _by_shard(shard, self.shards)
        width = _U(self.width)
        for k in range(self.shards):
            own = order[edges[k] : edges[k + 1]]
            if not len(own) or not self.sequence(k, "two").n:
                continue
            two = self.sequence(k, "two")
            i, hit = two.successor(codes[own])
            i, own = i[hit], own[hit]
            if not len(own):
                continue
            place[own] = i
            heads = codes[own] // width
            new = np.ones(len(heads), bool)
            new[1:] = heads[1:] != heads[:-1]
            rel[own] = (i - two.successor(heads[new] * width)[0][np.cumsum(new) - 1]) * self.shards + k
            if leaves:
                p2[own], g3[own] = self.array(k, "p2")[i], self.array(k, "g3")[i]
        return shard, place, rel, dequantise(p2), dequantise(g3)

    def children(self, shard: np.ndarray, place: np.ndarray, rel: np.ndarray) -> np.ndarray:
        """Probabilities of the children with those relative ids under located contexts; 0 where there is none."""
        out = np.full(len(shard), 65535, np.uint16)
        order, edges = _by_shard(shard, self.shards)
        for k in range(self.shards):
            own = order[edges[k] : edges[k + 1]]
            if not len(own):
                continue
            base, at = self.sequence(k, "base"), place[own]
            # contexts come up again and again: where their children begin and end is asked once
            asked, back = K.distinct_in_order(at, base.n + 1)
            asked = asked.astype(np.int64)
            first, last = base.access(asked), base.access(asked + 1)
            value = first[back] + rel[own].astype(_U)
            fits = np.flatnonzero(value < last[back])
            if len(fits):
                i, hit = self.sequence(k, "three").successor(value[fits])
                out[own[fits[hit]]] = self.array(k, "p3")[i[hit]]
        return dequantise(out)


_models: dict[str, tuple[Trie, Vocabulary]] = {}


def opened(model: dict) -> tuple[Trie, Vocabulary]:
    """The model's levels and words, which a worker keeps mapped from task to task."""
    if model["folder"] not in _models:
        _models.clear()
        _models[model["folder"]] = Trie(model), Vocabulary(*model["names"])
    return _models[model["folder"]]


def counted(values: np.ndarray, bound: int, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values below ``bound`` in ascending order, where each begins among the ordered ones, and their numbers or the sums of their weights."""
    ordered, order = K.in_order(values, bound)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    if weights is None:
        return ordered[first], first, np.diff(first, append=len(ordered)).astype("<u4")
    return ordered[first], first, np.add.reduceat(weights[order], first) if len(first) else weights


def train(docs: DataFrame, cutoff: int = 1) -> dict:
    """Trains on the texts of ``docs``; returns what :class:`Trie` and :class:`Vocabulary` are opened with."""
    spark = docs.sparkSession
    docs = spread(docs.select("text"))
    vocabulary, ones, texts, frequent = build_vocabulary(docs)
    shards, folder, width = shards_for(docs, 4 << 20, 32), new_folder(spark, "trie"), vocabulary.size + 2
    names = (vocabulary.folder, shards_for(docs), vocabulary.size, vocabulary.total)
    # the start of a text has the id after the last word's and is as frequent as the texts; its successors are dealt by themselves
    facts = {"folder": folder, "shards": shards, "width": width, "frequent": frequent, "texts": texts, "names": names, "pieces": max(1, -(-width // PIECE))}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(*names)
        for batch in batches:
            for part in K.slices(batch, "text", COUNT_SLICE):
                g = _grams(part.column("text"), own)
                two, at, codes = g["two"], g["at"], g["codes"]
                n2 = np.bincount(two, minlength=len(codes)).astype("<u4")
                order, ends = _by_shard(_shard(codes, facts), shards)
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                # trigrams by the rank of their context, then by their word
                three, _, n3 = counted((rank[two[at - 1]] * width + g["v"][two[at]]).astype(_U), len(order) * width)
                context, w = np.divmod(three, _U(width))
                kids = np.bincount(context.astype(np.int64), minlength=len(order)).astype("<u4")
                w = w.astype("<u4" if width < 1 << 32 else "<u8")
                kid_ends = K.row_starts(kids)[ends]
                used, packed = [], []
                for k in range(shards):
                    a, b, c, d = ends[k], ends[k + 1], kid_ends[k], kid_ends[k + 1]
                    if a < b:
                        used.append(k)
                        packed.append(_pack(np.diff(codes[order[a:b]], prepend=_U(0)), n2[order[a:b]], kids[a:b], w[c:d], n3[c:d]))
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], ["k", "packed"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns)):
                own.setdefault(k, []).append(raw)
        for k, raws in own.items():
            parts = [_unpack(raw) for raw in raws]
            codes = [np.cumsum(p[0]) for p in parts]
            every, index = K.distinct_in_order(np.concatenate(codes), width * width)
            n2 = np.bincount(index, np.concatenate([p[1] for p in parts]).astype(np.float64), minlength=len(every)).astype(np.int64)
            owner = np.repeat(index, np.concatenate([p[2] for p in parts]))
            w, n3 = np.concatenate([p[3] for p in parts]).astype(np.int64), np.concatenate([p[4] for p in parts]).astype(np.int64)
            del parts, codes, index
            three, _, n3 = counted((owner * width + w).astype(_U), max(len(every), 1) * width, n3)
            owner, w = (x.astype(np.int64) for x in np.divmod(three, _U(width)))
            keep = n3 >= cutoff
            EF.save(f"{folder}/{k}.two", every, width * width)
            put(f"{folder}/{k}.counts", _pack(n2, owner[keep], w[keep], n3[keep]))
            heads, n = np.unique(every // _U(width), return_counts=True)
            stats = [int((n2 == 1).sum()), int((n2 == 2).sum()), int((n3 == 1).sum()), int((n3 == 2).sum())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] + [None] * len(heads), pa.int32()), pa.array([stats] + [None] * len(heads), pa.list_(pa.int64())), pa.array(np.append(-1, heads.astype(np.int64))), pa.array(np.append(0, n).astype(np.int64))],
                ["k", "stats", "head", "n"],
            )

    made = docs.mapInArrow(count, "k int, packed binary").repartition(shards, "k").mapInArrow(merge, "k int, stats array<long>, head long, n long")
    made = cut(made, "bigrams")
    rows = made.filter("k is not null").select("k", "stats").collect()
    once2, twice2, once3, twice3 = (sum(r.stats[i] for r in rows) for i in range(4)) if rows else (0, 0, 0, 0)
    d1, d2, d3 = _discount(*ones), _discount(once2, twice2), _discount(once3, twice3)
    facts |= {"d1": d1, "d2": d2, "d3": d3}
    have = {r.k for r in rows}

    # counts of words as contexts, and their distinct followers, by id
    def by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                if k < 0:
                    continue
                ids, n = get_array(f"{names[0]}/{k}.id.npy"), get_array(f"{names[0]}/{k}.count.npy")
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(ids)), pa.array(np.asarray(n))], ["head", "c"])

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in batches:
            part, head, c, n = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            for k in np.unique(part).tolist():
                own.setdefault(k, []).append((head[part == k], c[part == k], n[part == k]))
        for k, parts in own.items():
            head, c, n = (np.concatenate(x) for x in zip(*parts))
            count, gamma = np.zeros(PIECE, np.int64), np.full(PIECE, 0, np.uint16)
            count[head - k * PIECE] = c
            gamma[head - k * PIECE] = np.where(n > 0, quantise(np.minimum(d2 * n / np.maximum(c, 1), 1.0)), 0)
            put_array(f"{folder}/word.{k}.c.npy", count)
            put_array(f"{folder}/word.{k}.gamma.npy", gamma)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64())], ["k"])

    followers = made.filter("k is null").groupBy("head").agg(F.sum("n").alias("n"))
    words = spark.range(names[1]).repartition(names[1], "id").mapInArrow(by_id, "head long, c long")
    words = words.unionByName(spark.createDataFrame([(vocabulary.size, texts)], "head long, c long"))
    table = words.join(followers, "head", "left").select((F.col("head") / PIECE).cast("int").cast("long").alias("part"), "head", "c", F.coalesce("n", F.lit(0)).alias("n"))
    table.repartition(facts["pieces"], "part").mapInArrow(piece, "k long").count()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(facts)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                if k not in have:
                    EF.save(f"{folder}/{k}.two", np.zeros(0, _U), 1)
                    EF.save(f"{folder}/{k}.base", np.zeros(1, _U), 1)
                    EF.save(f"{folder}/{k}.three", np.zeros(0, _U), 1)
                    for name in ("p2", "g3", "p3"):
                        put_array(f"{folder}/{k}.{name}.npy", np.zeros(0, np.uint16))
                    continue
                n2, owner, w, n3 = (x.astype(np.int64) for x in _unpack(get(f"{folder}/{k}.counts")))
                codes = trie.sequence(k, "two").access(np.arange(len(n2)))
                u, v = np.divmod(codes.astype(np.int64), width)
                c1, _ = word_facts(folder, u)
                put_array(f"{folder}/{k}.p2.npy", quantise((n2 - d2) / np.maximum(c1, 1)))
                kept = np.bincount(owner, n3 - d3, minlength=len(n2))
                put_array(f"{folder}/{k}.g3.npy", quantise(np.maximum(1 - kept / n2, 0)))
                tails, back = K.distinct_in_order((v[owner] * width + w).astype(_U), width * width)
                _, place, rel, *_ = trie.locate(tails, leaves=False)
                if (place < 0).any():
                    raise LookupError("a trigram's last bigram is missing: the input changed between two passes")
                rel = rel[back]
                del tails, back, place, codes, u, v
                top = int(rel.max(initial=0)) + 1
                both, order = K.in_order((owner * top + rel).astype(_U), max(len(n2), 1) * top)
                owner, rel, n3 = owner[order], rel[order], n3[order]
                del both, order
                room = np.zeros(len(n2), np.int64)
                np.maximum.at(room, owner, rel + 1)
                base = K.row_starts(room)
                EF.save(f"{folder}/{k}.base", base, int(base[-1]) + 1)
                EF.save(f"{folder}/{k}.three", base[owner] + rel, int(base[-1]) + 1)
                put_array(f"{folder}/{k}.p3.npy", quantise((n3 - d3) / n2[owner]))
            yield batch

    spark.range(shards).repartition(shards, "id").mapInArrow(finish, "id long").count()
    return facts


#: Words of a piece of the table of words by id.
PIECE = 1 << 18
_open: dict[str, np.ndarray] = {}


def word_facts(folder: str, ids: np.ndarray, gamma: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Counts and codes of the back-off masses of words by id."""
    if not any(k.startswith(folder) for k in _open):
        _open.clear()
    c, g = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.uint16)
    part = ids // PIECE
    for k in np.unique(part).tolist():
        own = np.flatnonzero(part == k)
        for name, out in (("c", c), ("gamma", g))[gamma:] if gamma else (("c", c),):
            uri = f"{folder}/word.{k}.{name}.npy"
            if uri not in _open:
                _open[uri] = get_array(uri)
            out[own] = _open[uri][ids[own] - k * PIECE]
    return c, g


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens, n_known, train_tokens long, base_score, score double``: log10 probabilities of the texts."""
    own = others(docs, "n_tokens", "n_known", "train_tokens", "base_score", "score")
    rest = docs.select(*own)
    zero = F.lit(0).cast("long")
    schema = rest.select("*", zero.alias("n_tokens"), zero.alias("n_known"), zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, vocabulary = opened(model)
        n, size = vocabulary.total, vocabulary.size
        for batch in batches:
            for part in K.slices(batch, text):
                g = _grams(part.column(text), vocabulary)
                c = g["found_counts"]
                base = np.log10((c + 1) / (n + size + 1))
                spare = model["d1"] * size / n / (size + 1) if n else 1.0
                p1 = np.where(c > 0, np.maximum(c - model["d1"], 0) / max(n, 1), 0) + spare
                # a bigram: its own probability and the mass that its first word leaves
                two, at = g["two"], g["at"]
                last_word = np.zeros(len(g["codes"]), np.int64)
                last_word[two] = g["index"]
                shard, place, rel, p2, left = trie.locate(g["codes"])
                leaves = np.ones(len(g["codes"]))
                known = np.flatnonzero(g["u"] <= size)
                if n:
                    leaves[known] = dequantise(word_facts(model["folder"], g["u"][known], True)[1])
                p2 += leaves * p1[last_word]
                # a trigram: the child of its context, and the mass that the context leaves
                p = p2[two]
                context, tail = two[at - 1], two[at]
                p3 = left[context] * p2[tail]
                look = np.flatnonzero((left[context] < 1) & (place[tail] >= 0))
                p3[look] += trie.children(shard[context[look]], place[context[look]], rel[tail[look]])
                p[at] = p3
                row = np.repeat(np.arange(len(g["counts"])), g["counts"])
                total = lambda x: np.bincount(row, x, minlength=len(g["counts"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in own),
                        pa.array(g["counts"].astype(np.int64)),
                        pa.array(total(c[g["index"]] > 0).astype(np.int64)),
                        pa.array(np.full(part.num_rows, n, np.int64)),
                        pa.array(total(base[g["index"]])),
                        pa.array(total(np.log10(np.minimum(p, 1.0)))),
                    ],
                    [f.name for f in schema.fields],
                )

    return spread(rest).mapInArrow(run, schema)


def forget(docs: DataFrame, model: dict) -> None:
    """Deletes a model's files."""
    for folder in (model["folder"], model["names"][0]):
        remove(docs.sparkSession, folder)
