"""BPE encoding and decoding through a table of distinct words.

White space never belongs to a token of a tokenizer that drops it, and neither its normaliser nor its pre-tokenizer looks
across white space. So a text's ids are the ids of its white-space separated words in order. The words are split in Spark
tasks, each distinct word of the corpus meets in one shard and is encoded once by the tokenizers library; the shards, sorted by the
words' 64-bit hashes, lie in the shared folder. A second pass joins the ids back by position: a task looks up the distinct
words of a slice in the memory-mapped shards, which keeps every text in its place and shuffles no text. Pieces come from the
vocabulary, whose size is the tokenizer's, by id. Two words with one hash are seen while a shard is written; the table is then
made again with another seed, so the join is exact.

Defined results: null text counts as empty (no ids, decoded to ``''``); repeated rows keep their rows; other columns pass
through, but the operator's own ``ids`` and ``decoded`` replace columns of those names; very long texts and words are handled whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .shared import get_array, new_folder, others, put_array, shards_for, spread


#: Shards that a worker holds mapped at once.
KEEP_FILES = 6000
#: Words that a task remembers to have sent, at most; then it may send some again.
REMEMBER = 1_000_000


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    """The library's tokenizer as it is in the file, without truncation and padding, in one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _words_of(column: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, distinct hashes, the place of a word for each, the index of each word's hash, and words per text."""
    data, offsets = K.text_bytes(column)
    starts, lengths, counts = K.spans(K.lookup(K.NOT_SPACE, data), offsets)
    found, index = K.distinct(K.hash_spans(data, starts, lengths, seed))
    place = np.zeros(len(found), dtype=np.int64)
    place[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    return data, found, np.stack([starts[place], lengths[place]]) if len(found) else np.zeros((2, 0), np.int64), index, counts


def as_texts(data: np.ndarray, where: np.ndarray) -> pa.Array:
    """The spans as Arrow strings."""
    starts, lengths = where
    flat = data[K.ranges(starts, lengths)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(K.row_starts(lengths)), pa.py_buffer(flat)).cast(pa.string())


class Table:
    """The shards of a word table, opened as they are needed."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shift, self.open = folder, np.uint64(64 - shards.bit_length() + 1), {}

    def shard(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if k not in self.open:
            if len(self.open) >= KEEP_FILES:
                self.open.clear()
            self.open[k] = tuple(get_array(f"{self.folder}/{k}.{part}.npy") for part in ("hash", "start", "ids"))
        return self.open[k]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after another, and their numbers."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        counts, parts = np.zeros(len(hashes), dtype=np.int64), []
        which = (ordered >> self.shift).astype(np.int64)
        edges = np.flatnonzero(np.diff(which, prepend=-1, append=-1))
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            keys, start, ids = self.shard(int(which[a]))
            at = np.searchsorted(keys, ordered[a:b])
            if at.max(initial=0) >= len(keys) or (keys[at] != ordered[a:b]).any():
                raise LookupError("a word is missing in the table: the input changed between two passes")
            n = start[at + 1] - start[at]
            counts[a:b] = n
            parts.append(ids[K.ranges(start[at], n)])
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        first = K.row_starts(counts)
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return flat[K.ranges(first[back], counts[back])], counts[back]


def word_table(docs: DataFrame, path: str, text: str = "text") -> tuple[str, int, int]:
    """Encodes each distinct word once; returns the table's folder, number of shards and seed."""
    spark, shards = docs.sparkSession, shards_for(docs, 4 << 20, 32)
    shift = 64 - shards.bit_length() + 1
    for seed in range(1, 9):
        folder = new_folder(spark, "words")

        def emit(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            sent = np.zeros(0, np.uint64)  # words that this task has sent already, ascending
            for batch in batches:
                for part in K.slices(batch, "text"):
                    data, found, where, _, _ = _words_of(part.column("text"), seed)
                    new = ~np.isin(found, sent)
                    found, where = found[new], where[:, new]
                    sent = np.sort(np.concatenate([sent, found] if len(sent) < REMEMBER else [found]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((found >> np.uint64(shift)).astype(np.int32)), pa.array(found.view(np.int64)), as_texts(data, where)], ["shard", "h", "word"]
                    )

        def write(batches: Iterator[pa.RecordBatch], folder: str = folder) -> Iterator[pa.RecordBatch]:
            tokenizer = load_tokenizer(path)
            shard, keys, sizes, ids, last, clash = None, [], [], [], (None, None), 0

            def flush() -> None:
                h = np.array(keys, dtype=np.int64).view(np.uint64)
                n = np.array(sizes, dtype=np.int64)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                order = np.argsort(h)
                put_array(f"{folder}/{shard}.hash.npy", h[order])
                put_array(f"{folder}/{shard}.start.npy", K.row_starts(n[order]))
                put_array(f"{folder}/{shard}.ids.npy", flat[K.ranges(K.row_starts(n)[:-1][order], n[order])])
                K.give_back()

            for batch in batches:
                new_h, new_w = [], []

                def encode() -> None:
                    coded = tokenizer.encode_batch_fast(new_w, add_special_tokens=False)
                    keys.extend(new_h)
                    for e in coded:
                        got = e.ids
                        sizes.append(len(got))
                        ids.append(np.array(got, dtype=np.int32))
                    new_h.clear(), new_w.clear()

                for k, h, w in zip(*(c.to_pylist() for c in batch.columns)):
                    if k != shard:
                        encode()
                        if shard is not None:
                            flush()
                        shard, keys, sizes, ids = k, [], [], []
                    if h == last[0] and w == last[1]:
                        continue
                    clash += h == last[0]
                    last = (h, w)
                    new_h.append(h), new_w.append(w)
                encode()
            if shard is not None:
                flush()
            yield pa.RecordBatch.from_arrays([pa.array([clash], pa.int64())], ["clash"])

        words = spread(docs.select(F.col(text).alias("text"))).mapInArrow(emit, "shard int, h long, word string")
        dealt = words.repartition(shards, "shard").sortWithinPartitions("shard", "h", "word")
        if not (dealt.mapInArrow(write, "clash long").agg(F.sum("clash").alias("n")).first().n or 0):
            return folder, shards, seed
    raise ValueError("eight seeds gave equal hashes to different words")


def check_kind(path: str, decoded: bool) -> None:
    """Raises unless the tokenizer drops white space and, to decode, its file names no decoder: only then do words stand for themselves."""
    tokenizer = load_tokenizer(path)
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    if ids(" Ab,\t\u00e9x \n\n 1b ") != [i for w in ("Ab,", "\u00e9x", "1b") for i in ids(w)]:
        raise ValueError("tokens of this tokenizer hold white space: encode the texts whole")
    if decoded and tokenizer.decoder is not None:
        raise ValueError("this tokenizer has a decoder of its own")


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids array<int>``, and with ``decoded string`` if asked for: the pieces of the ids joined by one space, as the
    library decodes where the tokenizer's file names no decoder."""
    check_kind(path, decoded)
    folder, shards, seed = word_table(docs, path, text)
    own = others(docs, "ids", "decoded")
    rest = docs.select(*own)
    schema = T.StructType([*rest.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    if decoded:
        schema = T.StructType([*schema.fields, T.StructField("decoded", T.StringType(), False)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(folder, shards)
        pieces = id_to_piece(load_tokenizer(path)) if decoded else None
        for batch in batches:
            for part in K.slices(batch, text, K.SLICE_BYTES // 2):
                _, found, _, index, counts = _words_of(part.column(text), seed)
                flat, n = table.find(found)
                first, each = K.row_starts(n), n[index]
                ids = flat[K.ranges(first[:-1][index], each)]
                ends = K.row_starts(each)[K.row_starts(counts)]
                if ends[-1] > 2**31 - 1:
                    raise ValueError("one slice has more ids than an Arrow list can hold")
                columns = [part.column(c) for c in own] + [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))]
                if decoded:
                    columns.append(decode_rows(ids, ends, pieces))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return spread(rest).mapInArrow(join, schema)


def id_to_piece(tokenizer) -> list[str]:
    """The pieces by id; the vocabulary bounds the list."""
    return [tokenizer.id_to_token(k) for k in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def decode_rows(ids: np.ndarray, ends: np.ndarray, pieces: list[str]) -> pa.Array:
    """Rows of ids as text."""
    named = pa.array(pieces).take(pa.array(ids))
    import pyarrow.compute as pc

    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), named), " ")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded string``; null ids give null."""
    schema = T.StructType([*encoded.drop("decoded").schema.fields, T.StructField("decoded", T.StringType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = id_to_piece(load_tokenizer(path))
        for batch in batches:
            rows = batch.column(ids)
            ends = K.row_starts(np.array([len(r) if r.is_valid else 0 for r in rows], dtype=np.int64))
            text = decode_rows(rows.flatten().to_numpy(zero_copy_only=False), ends, pieces)
            if rows.null_count:
                import pyarrow.compute as pc

                text = pc.if_else(rows.is_valid(), text, None)
            yield pa.RecordBatch.from_arrays([*batch.columns, text], [f.name for f in schema.fields])

    return encoded.drop("decoded").mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """Per document the number of ids and digests of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
