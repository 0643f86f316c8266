"""The folder that all executors share, and files in it.

``spark.checkpoint.dir`` names it. It is read from the session; only where it is unset and all tasks run in this process (tests, local runs) a folder is
made. Files go through pyarrow's file systems, so the folder may be local or remote; where it is a mounted path arrays are
memory-mapped, elsewhere they are read. All file names follow from the content's place (shard), writes go to another name
first and are renamed, so a task that runs twice leaves the same file.
"""

from __future__ import annotations

import io
import os
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..plans.cuts import cut, shared_dir

__all__ = ["bounded_batches", "cut", "get", "get_array", "new_folder", "others", "put", "put_array", "remove", "shards_for", "shared_dir", "size_hint", "spread"]


def new_folder(spark: SparkSession, kind: str) -> str:
    """A name for a new folder in the shared one."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bounds the rows of an Arrow batch for this session, unless it does so itself: texts are large. Queries and the pipeline's stages call it; operators
    leave the session's settings alone."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(rows))


def spread(df: DataFrame) -> DataFrame:
    """Deals out a table that is read in fewer partitions than there are cores (a single small file); larger ones, and what a shuffle deals out
    already, stay."""
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df  # asking for its partitions would run the shuffle
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns of other names; case does not matter, as it does not to Spark."""
    return [c for c in df.columns if c.lower() not in names]


def size_hint(df: DataFrame) -> int:
    """Bytes of the input as the optimizer knows them (file sizes), or of its rows where it does not; no scan of files."""
    found = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return found if found < 1 << 55 else 4096 * df.count()


def shards_for(df: DataFrame, each: int = 8 << 20, least: int = 16, most: int = 1 << 16) -> int:
    """A power of two: how many shards give each about ``each`` bytes of input. Beyond ``most`` shards grow instead, so that what one task sends to
    one shard stays worth a message."""
    return min(most, max(least, 1 << max(0, -(-size_hint(df) // each) - 1).bit_length()))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that is no longer needed."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _local(uri: str) -> str | None:
    m = re.match(r"file:/*(/.*)$", uri)
    return m[1] if m else uri if uri.startswith("/") else None


def put(uri: str, data: bytes) -> None:
    """Writes a file whole: never half of it under its name."""
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)


def get(uri: str) -> bytes:
    if path := _local(uri):
        with open(path, "rb") as f:
            return f.read()
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        return f.read()


def put_array(uri: str, array: np.ndarray) -> None:
    """An array file, without another copy of the array in memory where it is a mounted path."""
    array = np.ascontiguousarray(array)
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.lib.format.write_array(f, array, allow_pickle=False)
        os.replace(part, path)
        return
    out = io.BytesIO()
    np.save(out, array)
    put(uri, out.getvalue())


def get_array(uri: str) -> np.ndarray:
    """An array file: memory-mapped from a mounted path, otherwise read."""
    if path := _local(uri):
        array = np.load(path, mmap_mode="r").view(np.ndarray)
        return array if array.size else np.zeros(array.shape, array.dtype)
    return np.load(io.BytesIO(get(uri)))
