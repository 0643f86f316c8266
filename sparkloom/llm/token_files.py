"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

A file holds the documents of one range of doc_id, in ascending order. Layout, little-endian::

    magic "SLTOK1\\0\\0" | int64 documents, ids, distinct ids, bytes of control, bytes of data, bytes of document table
    | uint32 ids by rank | document table: int64 doc_id and int64 number of ids | control | data

Ids are replaced by their rank of frequency within the file (ties: the smaller id first), so the commonest 256 take one byte.
Each control byte holds the lengths (1 to 4 bytes, two bits each) of four codes; the data bytes follow apart. Decoding needs no loop over ids:
a 256-entry table gives the four lengths of a control byte, a running sum gives the codes' places, and
gathers put the bytes together.

Encoding runs chunk-wise: a chunk is a run of ASCII white space with the word after it, without the marks that end the word, which are a chunk of
their own. The byte-level pre-tokenizer always breaks there, so a text's ids are those of its chunks in order; chunks recur, and each worker
keeps the ids of those it has seen, by 64-bit hash, in a bounded table from task to task. Texts with white space beyond ASCII go to the
library whole, and so do all texts where the tokenizer's file is of another kind.

Ranges are cut by (doc_id, text hash, row), so a doc_id that a third of all rows share, null among them, fills many files.

Defined results: a null text is empty and gives the end id alone; repeated rows all stay (order: doc_id, then a hash of the text); rows without
doc_id come first; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .bpe import as_texts, load_tokenizer
from .shared import get, new_folder, put, shards_for

MAGIC = b"SLTOK2\0\0"
SLICE = 6 << 20
#: Chunks that a worker remembers at most (about 40 bytes each), or those of one slice; then it starts anew.
REMEMBER = 1_500_000
#: 1: ASCII white space; 2: marks that end a run of letters or digits; 3: ASCII letters and digits; 0: all else, the apostrophe among it.
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[[0x20, 9, 10, 11, 12, 13]] = 1
_KINDS[np.frombuffer(b',.;:!?)"', np.uint8)] = 2
_KINDS[0x30:0x3A] = _KINDS[0x41:0x5B] = _KINDS[0x61:0x7B] = 3
_EDGES = re.compile(r'[\s,.;:!?)"]')
#: UTF-8 of the white space beyond ASCII.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

#: Lengths of the four codes of each control byte.
LENGTHS = np.stack([((np.arange(256) >> (2 * k)) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of non-negative 32-bit values."""
    values = ranks.astype("<u4")
    length = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = length - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    keep = np.arange(4)[None, :] < length[:, None]
    return control, values.view(np.uint8).reshape(-1, 4)[keep]


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The values again, through the table of lengths."""
    length = LENGTHS[control].reshape(-1)[:n].astype(np.int64)
    at = K.row_starts(length)[:-1]
    data = np.concatenate([data, np.zeros(4, np.uint8)])
    out = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(length > k)
        if not len(more):
            break
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, nameless: int = 0) -> bytes:
    """A file of documents with ``counts`` ids each; the first ``nameless`` have no doc_id."""
    freq = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    used = np.flatnonzero(freq)
    by_rank = used[np.lexsort((used, -freq[used]))].astype("<u4")
    rank = np.zeros(len(freq), dtype=np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = pack(rank[ids])
    table = np.stack([doc_ids.astype("<i8"), counts.astype("<i8")], axis=1)
    head = np.array([len(doc_ids), nameless, len(ids), len(by_rank), len(control), len(data), table.nbytes], dtype="<i8")
    return b"".join([MAGIC, head.tobytes(), by_rank.tobytes(), table.tobytes(), control.tobytes(), data.tobytes()])


def parse_file(raw: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Document ids, numbers of ids, and all ids of a file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token-id file")
    docs, nameless, n, ranks, control, data, table = np.frombuffer(raw, "<i8", 7, 8).tolist()
    at = 64
    by_rank = np.frombuffer(raw, "<u4", ranks, at)
    rows = np.frombuffer(raw, "<i8", 2 * docs, at := at + 4 * ranks).reshape(-1, 2)
    codes = unpack(np.frombuffer(raw, np.uint8, control, at := at + table), np.frombuffer(raw, np.uint8, data, at + control), n)
    return pa.array(rows[:, 0], pa.int64(), mask=np.arange(docs) < nameless), rows[:, 1], by_rank[codes]


@lru_cache(maxsize=2)
def cuts_at_space(path: str) -> bool:
    """Whether the tokenizer's file is one whose tokens never cross the edges of chunks: byte-level with the usual pattern and no normaliser."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    pre = found.get("pre_tokenizer") or {}
    own = found.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    return bool(own) and not any(_EDGES.search(t["content"]) or t.get("lstrip") or t.get("rstrip") for t in found.get("added_tokens", ()))


class Chunks:
    """Ids of chunks that recur, in a table bounded by ``REMEMBER``: sorted hashes, and for each the place of its ids and their number."""

    def __init__(self, path: str):
        self.tokenizer, self.whole = load_tokenizer(path), not cuts_at_space(path)
        self.clear()

    def clear(self) -> None:
        self.hashes, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids one after another, and their numbers."""
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        return np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(n.sum())), n

    def find(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct chunks stand in ``flat``, and their numbers; new chunks are encoded first."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        at = np.searchsorted(self.hashes, ordered)
        known = np.zeros(len(ordered), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == ordered[inside]
        if not known.all():
            if len(self.hashes) + len(ordered) > REMEMBER and len(self.hashes):
                self.clear()
                return self.find(data, begin, length, hashes)
            new = order[~known]
            ids, n = self.encode(as_texts(data, np.stack([begin[new], length[new]])).to_pylist())
            room = self.used + len(ids)
            if room > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(room, np.int32)])
            self.flat[self.used : room] = ids
            places = at[~known]
            self.hashes = np.insert(self.hashes, places, ordered[~known])
            self.at = np.insert(self.at, places, self.used + K.row_starts(n)[:-1])
            self.n = np.insert(self.n, places, n)
            self.used = room
            at = np.searchsorted(self.hashes, ordered)
        back = np.empty(len(order), np.int64)
        back[order] = at
        return self.at[back], self.n[back]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and their numbers."""
        if self.whole:
            return self.encode(pc.fill_null(column, "").to_pylist())
        data, offsets = K.text_bytes(column)
        if not offsets[-1]:
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        kind = K.lookup(_KINDS, data[: offsets[-1]])
        opens = np.ones(len(kind), bool)
        # white space opens a chunk, and so does a mark after an ASCII letter or digit
        opens[1:] = ((kind[1:] == 1) & (kind[:-1] != 1)) | ((kind[1:] == 2) & (kind[:-1] == 3))
        opens[offsets[:-1][offsets[:-1] < len(kind)]] = True
        begin = np.flatnonzero(opens)
        length = np.diff(begin, append=len(kind))
        found, index = K.distinct(K.hash_spans(data, begin, length))
        place = np.zeros(len(found), dtype=np.int64)
        place[index[::-1]] = np.arange(len(index) - 1, -1, -1)
        at, n = self.find(data, begin[place], length[place], found)
        each = n[index]
        ids = self.flat[K.ranges(at[index], each)]
        bounds = K.row_starts(each)[np.searchsorted(begin, offsets)]
        wide = sorted({int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in _WIDE_SPACE.finditer(data.data)})
        if not wide:
            return ids, np.diff(bounds)
        flat, n = self.encode(column.take(pa.array(wide)).to_pylist())
        rows = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        for d, own in zip(wide, np.split(flat, np.cumsum(n)[:-1])):
            rows[d] = own
        return np.concatenate(rows), np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))


@lru_cache(maxsize=1)
def chunks_of(path: str) -> Chunks:
    """The worker's table, kept from task to task."""
    return Chunks(path)


def write(docs: DataFrame, path: str, end_id: int = 0, folder: str | None = None) -> tuple[str, list[tuple[int, int, int]]]:
    """Writes the files; returns their folder and, in order of doc_id, each file's number, documents and ids.

    Ranges of doc_id are dealt out by Spark's range partitioning (one shuffle of the texts); the list has one entry a file.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-ids")
    files = shards_for(docs, 12 << 20, spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunks, ids, counts, names, nameless = chunks_of(path), [], [], [], 0
        for batch in batches:
            for part in K.slices(batch, "text", SLICE):
                got, n = chunks.ids(part.column("text"))
                # the end id after each text
                out = np.full(len(got) + len(n), end_id, dtype=np.int32)
                keep = np.ones(len(out), dtype=bool)
                keep[np.cumsum(n + 1) - 1] = False
                out[keep] = got
                ids.append(out.astype(np.uint16 if out.max(initial=0) < 1 << 16 else np.uint32))
                counts.append(n + 1)
                nameless += part.column("doc_id").null_count
                names.append(part.column("doc_id").cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False))
        if names:
            k = TaskContext.get().partitionId()
            n = np.concatenate(counts)
            put(f"{folder}/{k:08d}.tok", file_bytes(np.concatenate(names), n, np.concatenate(ids), nameless))
            K.give_back()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([len(n)], pa.int64()), pa.array([int(n.sum())], pa.int64())], ["file", "docs", "ids"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_n"))
    dealt = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "_h", "_n").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h", F.col("text").asc_nulls_first())
    return folder, sorted(tuple(r) for r in dealt.select("doc_id", "text").mapInArrow(run, "file long, docs long, ids long").collect())


def read(spark: SparkSession, folder: str, files: list[tuple[int, int, int]], ids: bool = True) -> DataFrame:
    """The documents of the files: ``doc_id, start, n_tokens, ids_crc32``, and ``ids array<int>`` if asked for."""
    starts, rows = 0, []
    for k, _, n in files:
        rows.append((k, starts))
        starts += n
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, base in zip(*(c.to_pylist() for c in batch.columns)):
                names, counts, values = parse_file(get(f"{folder}/{k:08d}.tok"))
                first = K.row_starts(counts)
                raw = memoryview(values.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                columns = [names, pa.array(first[:-1] + base), pa.array(counts), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    files_df = spark.createDataFrame(rows, "file long, base long")
    return files_df.repartition(max(1, len(rows)), "file").mapInArrow(run, schema)
