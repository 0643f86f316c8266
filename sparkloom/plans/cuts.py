"""Where plans are cut: tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset and all tasks run in this process, a folder of this process; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = _own_folder()
    return found.rstrip("/")


@lru_cache(maxsize=1)
def _own_folder() -> str:
    found = tempfile.mkdtemp(prefix="sparkloom-")
    atexit.register(shutil.rmtree, found, ignore_errors=True)
    return f"file://{found}"


def cut(df: DataFrame, kind: str = "cut") -> DataFrame:
    """The same rows, written there and read back."""
    path = f"{shared_dir(df.sparkSession)}/{kind}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
