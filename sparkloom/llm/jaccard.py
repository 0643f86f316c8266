"""Jaccard join on word n-grams, as a blocked sparse product of the document by n-gram incidence with itself.

Rows are documents' distinct sets of n-gram hashes (A-Z lower-cased, words by ASCII white space), columns are n-grams, dealt to blocks by hash. All sets are
ordered alike, common n-grams last (a sketch of fixed size counts them over the whole corpus), so only a set's first
``size - ceil(t * size) + 1`` n-grams need to enter the product: two sets of similarity t or more share one of these. A block's columns name the pairs
of rows with a common entry; bounds derived from the sizes and from the entry's places in both sets discard pairs that cannot
reach t; for the rest the two whole sets are intersected, 64 bits an n-gram, and compared in whole numbers.

``jaccard_join`` gives links' connected components, so there a pair whose documents a block has already joined by true links is not computed: a group of m
near copies costs about m overlaps a block, not m squared. Within a block, documents next to each other by size in a column are joined
first; in columns that still hold several components, all pairs outside the largest one are computed. No candidate is dropped, and no list is capped.
``all_links`` gives the links themselves: it computes every candidate pair, in a group of m near copies up to m squared.

Sets are written once to the shared folder (one file for each few thousand documents) and read where a block needs them; equal sets of one file enter
once. Only (n-gram, place, size) of the leading n-grams are shuffled, packed by file and block.

Defined results: null texts and texts without words have an empty set, linked with nothing; fewer than n words make one n-gram of the whole sequence; rows with one
doc_id are one node, whatever their texts; rows without doc_id have no component (null) and no links; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .shared import cut, get_array, new_folder, put_array, shards_for, size_hint, spread

#: N-grams of a file of sets, about: a few megabytes, so that what a task holds beside a slice of texts stays small.
FILE_ENTRIES = 500_000
#: Bits of a set's place within its file; the file's number stands before them.
ROW = 24
#: Files of sets that a worker holds mapped at once.
KEEP_FILES = 6000
#: Pairs that are tested against the bounds at once.
PAIRS = 1 << 20


def _sets(part: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    words, counts = K.word_hashes(part.column("text"))
    return K.shingle_sets(words, counts, n)


def _sketch(docs: DataFrame, n: int, bits: int) -> str:
    """How often n-grams occur, by the leading ``bits`` of their hash; returns the folder of its 16 pieces."""
    folder, piece = new_folder(docs.sparkSession, "sketch"), 1 << (bits - 4)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            for part in K.slices(batch, "text"):
                codes, _ = _sets(part, n)
                total += np.bincount((codes >> np.uint64(64 - bits)).astype(np.int64), minlength=len(total)).astype(np.uint32)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(16), pa.int32()), pa.array([zlib.compress(total[k * piece : (k + 1) * piece].tobytes(), 1) for k in range(16)])], ["k", "counts"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(k, np.zeros(piece, np.uint64))
                sums[k] += np.frombuffer(zlib.decompress(raw.as_py()), np.uint32)
        for k, total in sums.items():
            put_array(f"{folder}/{k}.npy", total)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([int(total.sum())], pa.int64())], ["k", "n"])

    made = docs.mapInArrow(count, "k int, counts binary").repartition(16, "k").mapInArrow(add, "k int, n long").collect()
    if not made:
        put_array(f"{folder}/levels.npy", np.zeros(1 << bits, np.uint8))
        return folder
    # the mean sets the scale of the levels; the sketch has a fixed size, so one task can hold it
    mean = max(1.0, sum(r.n for r in made) / (1 << bits))
    have = {r.k for r in made}

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        out = np.zeros(1 << bits, np.uint8)
        for k in have:
            c = np.asarray(get_array(f"{folder}/{k}.npy")).astype(np.float64)
            out[k * piece : (k + 1) * piece] = np.clip(np.ceil(np.log2(np.maximum(c, 1) / mean)), 0, 63)
        put_array(f"{folder}/levels.npy", out)
        yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], ["k"])

    docs.sparkSession.range(1).repartition(1).mapInArrow(level, "k int").collect()
    return folder


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    return size - (percent * size + 99) // 100 + 1


class _Files:
    """Sets by file number and row."""

    def __init__(self, folder: str):
        self.folder, self.open = folder, {}

    def file(self, k: int) -> tuple[np.ndarray, ...]:
        if k not in self.open:
            if len(self.open) >= KEEP_FILES:
                self.open.clear()
            self.open[k] = tuple(get_array(f"{self.folder}/{k}.{part}.npy") for part in ("keys", "start", "doc", "name"))
        return self.open[k]

    def of(self, places: np.ndarray, part: int) -> np.ndarray:
        """What stands for sets in one array of their files."""
        return np.array([self.file(w >> ROW)[part][w & ((1 << ROW) - 1)] for w in places.tolist()], dtype=np.int64)


class _Block:
    """The columns of one block: which of its documents are linked."""

    def __init__(self, files: _Files, percent: int):
        self.files, self.percent = files, percent

    def run(self, key: np.ndarray, where: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and their smallest linked doc_id within the block, for those that have one."""
        order = np.lexsort((where, size, key))
        key, where, place, size = key[order], where[order], place[order], size[order]
        first = np.flatnonzero(np.diff(key, prepend=~key[:1])) if len(key) else np.zeros(0, np.int64)
        length = np.diff(first, append=len(key))
        many = np.repeat(length > 1, length)
        key, where, place, size = key[many], where[many], place[many], size[many]
        length = length[length > 1]
        first = K.row_starts(length)[:-1]
        if not len(key):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.docs, doc = np.unique(where, return_inverse=True)
        self.size = np.zeros(len(self.docs), np.int64)
        self.size[doc] = size
        self.parent = np.arange(len(self.docs))
        self.tested = np.zeros(0, np.int64)
        self.doc, self.place = doc, place.astype(np.int64)
        # neighbours by size in each column
        near = np.ones(len(key), bool)
        near[first + length - 1] = False
        left = np.flatnonzero(near)
        self.test(left, left + 1)
        # columns that still hold several components
        rest = self.mixed(first, length)
        small = rest[length[rest] <= 64]
        for k in range(2, int(length[small].max(initial=0))):
            small = small[length[small] > k]
            left = K.ranges(first[small], length[small] - k)
            self.test(left, left + k)
        for c in rest[length[rest] > 64].tolist():
            at = np.arange(first[c], first[c] + length[c])
            root = self.roots()[doc[at]]
            names, index, counts = np.unique(root, return_inverse=True, return_counts=True)
            if len(names) == 1:
                continue
            few = np.flatnonzero(index != counts.argmax())
            step = max(1, PAIRS // len(at))
            for a in range(0, len(few), step):
                one = np.repeat(at[few[a : a + step]], len(at))
                two = np.tile(at, len(few[a : a + step]))
                self.test(np.minimum(one, two), np.maximum(one, two))
        root = self.roots()
        linked = np.flatnonzero(np.bincount(root, minlength=len(root))[root] > 1)
        ids = self.files.of(self.docs[linked], 2)
        best = np.full(len(root), np.iinfo(np.int64).max)
        np.minimum.at(best, root[linked], ids)
        return ids, best[root[linked]]

    def run_all(self, key: np.ndarray, where: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All linked pairs of the block by the sets' names, and whether their sets are equal."""
        order = np.lexsort((where, size, key))
        key, where, place, size = key[order], where[order], place[order], size[order]
        first = np.flatnonzero(np.diff(key, prepend=~key[:1])) if len(key) else np.zeros(0, np.int64)
        length = np.diff(first, append=len(key))
        self.docs, self.doc = np.unique(where, return_inverse=True)
        self.size = np.zeros(len(self.docs), np.int64)
        self.size[self.doc] = size
        self.place = place.astype(np.int64)
        held, n, codes = [], 0, np.zeros(0, np.int64)
        for k in range(1, int(length.max(initial=0))):
            own = length > k
            first, length = first[own], length[own]
            left = K.ranges(first, length - k)
            for a in range(0, len(left), PAIRS):
                held.append(self.candidates(left[a : a + PAIRS], left[a : a + PAIRS] + k))
                n += len(held[-1])
                if n > PAIRS:
                    codes, held, n = np.unique(np.concatenate([codes, *held])), [], 0
        x, y = np.divmod(np.unique(np.concatenate([codes, *held])), max(len(self.docs), 1))
        common = np.array([self.common(a, b) for a, b in zip(x.tolist(), y.tolist())], dtype=np.int64)
        near = 100 * common >= self.percent * (self.size[x] + self.size[y] - common)
        same = (common == self.size[x]) & (common == self.size[y])
        return self.files.of(self.docs[x[near]], 3), self.files.of(self.docs[y[near]], 3), same[near]

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def mixed(self, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        root = self.roots()[self.doc]
        return np.flatnonzero((np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)) & (length > 2))

    def candidates(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Codes of the pairs of documents of two entries of a column that the bounds allow."""
        da, db = self.doc[a], self.doc[b]
        na, nb = self.size[da], self.size[db]
        t = self.percent
        ok = (da != db) & (100 * np.minimum(na, nb) >= t * np.maximum(na, nb))
        # the entry is at best the first common one: what follows it bounds the overlap
        most = 1 + np.minimum(na - self.place[a], nb - self.place[b]) - 1
        ok &= (100 + t) * most >= t * (na + nb)
        return np.minimum(da[ok], db[ok]) * len(self.docs) + np.maximum(da[ok], db[ok])

    def test(self, left: np.ndarray, right: np.ndarray) -> None:
        """Joins the documents of two entries of a column where bounds allow it and the whole overlap suffices."""
        for k in range(0, len(left), PAIRS):
            code = self.candidates(left[k : k + PAIRS], right[k : k + PAIRS])
            root = self.roots()
            code = np.setdiff1d(code[root[code // len(self.docs)] != root[code % len(self.docs)]], self.tested)
            if not len(code):
                continue
            self.tested = np.union1d(self.tested, code)
            parent = self.parent

            def find(x: int, parent: np.ndarray = parent) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for c in code.tolist():
                x, y = divmod(c, len(self.docs))
                rx, ry = find(x), find(y)
                if rx != ry and self.linked(x, y):
                    parent[max(rx, ry)] = min(rx, ry)

    def set_of(self, d: int) -> np.ndarray:
        w = int(self.docs[d])
        keys, start, *_ = self.files.file(w >> ROW)
        row = w & ((1 << ROW) - 1)
        return keys[start[row] : start[row + 1]]

    def common(self, x: int, y: int) -> int:
        a, b = self.set_of(x), self.set_of(y)
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return int(np.count_nonzero(b[at] == a))

    def linked(self, x: int, y: int) -> bool:
        common = self.common(x, y)
        return 100 * common >= self.percent * (int(self.size[x]) + int(self.size[y]) - common)


def _product(docs: DataFrame, n: int, percent: int, every: bool) -> tuple[DataFrame, str]:
    """The blocks' rows and the folder of the sets. A row is a file's number, or a link: of doc_ids, or with ``every`` of names of sets (and whether they are equal)."""
    spark = docs.sparkSession
    docs = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    size = size_hint(docs)
    bits = min(24, max(18, (size // 512).bit_length()))
    sketch = _sketch(docs, n, bits)
    folder, blocks = new_folder(spark, "sets"), max(48, shards_for(docs, 16 << 20, 1))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        level = np.asarray(get_array(f"{sketch}/levels.npy"))
        # files are named by the attempt: a second one, whose rows may come in another order, never writes over what others hold rows of
        context = TaskContext.get()
        number, made = context.taskAttemptId() << 12, []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, counts, ids, has = (np.concatenate(x) for x in zip(*held))
            start = K.row_starts(counts)
            # equal sets: neighbours by a sum of their hashes and the size, compared whole; the smallest doc_id stands for them
            sums = np.zeros(len(counts), np.uint64)
            full = np.flatnonzero((counts > 0) & has)
            if len(full):
                sums[full] = np.add.reduceat(K.mix(keys.copy()), start[full])
            order = full[np.lexsort((ids[full], counts[full], sums[full]))]
            new = np.ones(len(order), bool)
            like = 1 + np.flatnonzero((sums[order[1:]] == sums[order[:-1]]) & (counts[order[1:]] == counts[order[:-1]]))
            if len(like):
                one, two = order[like - 1], order[like]
                same = keys[K.ranges(start[one], counts[one])] == keys[K.ranges(start[two], counts[two])]
                new[like] = ~np.logical_and.reduceat(same, K.row_starts(counts[one])[:-1])
            chief = order[new]
            rep = ids.copy()
            rep[order] = ids[chief][np.cumsum(new) - 1]
            n_chief, at = counts[chief], start[chief]
            put_array(f"{folder}/{number}.keys.npy", keys[K.ranges(at, n_chief)])
            put_array(f"{folder}/{number}.start.npy", K.row_starts(n_chief))
            put_array(f"{folder}/{number}.doc.npy", ids[chief])
            # what tells sets apart in links, the same in every attempt
            put_array(f"{folder}/{number}.name.npy", K.mix(sums[chief] ^ K.mix(ids[chief].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + n_chief.astype(np.uint64))).view(np.int64))
            made.append(number)
            put_array(f"{folder}/{number}.members.npy", np.stack([ids, rep, counts, has.astype(np.int64)]))
            length = _prefix(n_chief, percent)
            lead = K.mix(keys[K.ranges(at, length)].copy())
            row, place, many = np.repeat(np.arange(len(chief)), length), K.ranges(np.zeros_like(length), length), np.repeat(n_chief, length)
            block = (lead >> np.uint64(32)).astype(np.int64) % blocks
            order = np.argsort(block, kind="stable")
            ends = np.searchsorted(block[order], np.arange(blocks + 1))
            table = np.stack([(lead & np.uint64(0xFFFFFFFF)).astype("<u4"), row.astype("<u4"), place.astype("<u4"), many.astype("<u4")])[:, order]
            used = [k for k in range(blocks) if ends[k] < ends[k + 1]]
            packed = [zlib.compress(_narrow(table[:, ends[k] : ends[k + 1]]), 1) for k in used]
            return message(used, [number] * len(used), [None] * len(used), packed)

        def message(block: list, file: list, files: list, entries: list) -> pa.RecordBatch:
            columns = [pa.array(block, pa.int32()), pa.array(file, pa.int64()), pa.array(files, pa.list_(pa.int64())), pa.array(entries, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "file", "files", "entries"])

        total = 0
        for batch in batches:
            for part in K.slices(batch, "text"):
                codes, counts = _sets(part, n)
                # the order of all sets: the level, then the hash; the key is what stands for the n-gram from here on
                keys = level[(codes >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(58) | codes >> np.uint64(6)
                ends = K.row_starts(counts).tolist()
                for a, b in zip(ends, ends[1:]):
                    keys[a:b].sort()
                ids = part.column("doc_id")
                held.append((keys, counts, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)))
                total += len(keys)
                if total >= FILE_ENTRIES:
                    yield flush()
                    number, total = number + 1, 0
                    if len(made) >> 12:
                        raise ValueError("a partition of texts needs more than 4096 files: use more partitions")
                    held.clear()
                    K.give_back()
        if held:
            yield flush()
        # one message names all files of this attempt, so that files of two attempts are never taken together
        if made:
            yield message([context.partitionId() % blocks], [None], [made], [None])
        held.clear()
        K.give_back()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, own = _Files(folder), {}
        for batch in batches:
            for block, number, made, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if made is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.int64()), pa.nulls(len(made), pa.int64()), pa.nulls(len(made), pa.int64()), pa.nulls(len(made), pa.bool_())], names)
                else:
                    own.setdefault(block, []).append((number, raw))
        for entries in own.values():
            tables = [_wide(zlib.decompress(raw)) for _, raw in entries]
            where = np.concatenate([t[1].astype(np.int64) | number << ROW for t, (number, _) in zip(tables, entries)])
            key, _, place, many = np.concatenate(tables, axis=1)
            del tables
            if every:
                a, b, same = _Block(files, percent).run_all(key, where, place, many)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.array(same)], names)
                continue
            a, b = _Block(files, percent).run(key, where, place, many)
            keep = a != b
            yield pa.RecordBatch.from_arrays([pa.nulls(int(keep.sum()), pa.int64()), pa.array(a[keep]), pa.array(b[keep]), pa.nulls(int(keep.sum()), pa.bool_())], names)

    names = ["file", "a", "b", "same"]
    found = docs.mapInArrow(emit, "block int, file long, files array<long>, entries binary").repartition(blocks, "block").mapInArrow(join, "file long, a long, b long, same boolean")
    return cut(found, "links"), folder


def all_links(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``a, b long``: all links a < b between different sets, each named by the smallest doc_id that has it. Sets of one doc_id have no link with each other."""
    found, folder = _product(docs, n, percent, True)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                ids, own = (np.asarray(get_array(f"{folder}/{number}.{part}.npy")) for part in ("doc", "name"))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(ids, pa.int64())], ["place", "doc"])

    pairs = found.filter("file is null")
    equal = components(pairs.filter("same").select("a", "b")).select(F.col("id").alias("place"), "root")
    sets = found.filter("file is not null").select("file").mapInArrow(places, "place long, doc long").distinct()
    sets = cut(sets.join(equal, "place", "left").select("place", F.coalesce("root", "place").alias("root"), "doc"), "sets")
    name = sets.groupBy("root").agg(F.min("doc").alias("doc"))
    named = cut(sets.select("place", "root").join(name, "root").select("place", "doc"), "sets")
    ends = lambda c: named.select(F.col("place").alias(c), F.col("doc").alias(f"d{c}"))
    both = pairs.filter("not same").select("a", "b").join(ends("a"), "a").join(ends("b"), "b").filter("da != db")
    return both.select(F.least("da", "db").alias("a"), F.greatest("da", "db").alias("b")).distinct()


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles long, component_id``: one row for each row of ``docs``."""
    found, folder = _product(docs, n, percent, False)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                ids, rep, counts, has = get_array(f"{folder}/{number}.members.npy")
                none = has == 0
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=none), pa.array(rep, mask=none), pa.array(counts)], ["doc_id", "rep", "n_shingles"])

    # names are few, what they stand for is not: the number of tasks follows the input
    names = found.filter("file is not null").select("file").repartition(shards_for(docs, 64 << 20, docs.sparkSession.sparkContext.defaultParallelism), "file")
    every = names.mapInArrow(members, "doc_id long, rep long, n_shingles long")
    # a row that another stands for is linked to it: its doc_id may have rows with other sets
    stands = every.filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    groups = components(found.filter("file is null").select("a", "b").unionByName(stands)).select(F.col("id").alias("rep"), "root")
    return every.join(groups, "rep", "left").select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))


def _narrow(table: np.ndarray) -> bytes:
    """Columns (hash, row, place, size) sorted by row: hashes apart, the rest as bytes that compress."""
    head = np.array([table.shape[1]], "<u4")
    gaps = np.diff(table[1], prepend=np.uint32(0)).astype("<u4")
    rest = np.stack([gaps, table[2], table[3]]).astype("<u4")
    return head.tobytes() + table[0].astype("<u4").tobytes() + rest.view(np.uint8).reshape(3, -1, 4).transpose(0, 2, 1).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    lead = np.frombuffer(raw, "<u4", n, 4)
    rest = np.frombuffer(raw, np.uint8, 12 * n, 4 + 4 * n).reshape(3, 4, n).transpose(0, 2, 1).copy().view("<u4").reshape(3, n)
    return np.stack([lead, np.cumsum(rest[0], dtype=np.uint32), rest[1], rest[2]])


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 5], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
sets AS (SELECT doc_id, count(*) AS n, string_agg(sh, chr(10) ORDER BY sh) AS whole FROM s GROUP BY 1),
cls AS (SELECT min(doc_id) AS rep, whole, any_value(n) AS n FROM sets GROUP BY whole),
r AS (SELECT s.doc_id, s.sh, c.n FROM s JOIN cls c ON s.doc_id = c.rep),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y FROM r a JOIN r b ON a.sh = b.sh AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach AS (SELECT rep AS x, rep AS y FROM cls UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x),
comp AS (SELECT x, min(y) AS root FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(comp.root, w.doc_id) AS component_id
FROM w LEFT JOIN sets USING (doc_id) LEFT JOIN cls ON sets.whole = cls.whole LEFT JOIN comp ON comp.x = cls.rep
"""
