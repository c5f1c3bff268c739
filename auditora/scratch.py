"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Paths written in each open block of passing(), the innermost last, and those of no block.
_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())
_kept: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a local folder only where it is unset on a local master."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_dir()


@cache
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="auditora-")


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared folder.  It goes with the innermost open block of passing(); with keep, with the one around it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    blocks = (_kept, *_blocks.get())
    blocks[max(0, len(blocks) - 1 - keep)].append(path)
    return path


def deleted(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when the block ends, but for those written with keep; nothing lazy may read them after it."""
    held: list[str] = []
    token = _blocks.set((*_blocks.get(), held))
    try:
        yield
    finally:
        _blocks.reset(token)
        deleted(spark, held)


def release(spark: SparkSession) -> None:
    """Deletes what the results of operators read; call it once all of them have been written or collected."""
    deleted(spark, _kept)
    _kept.clear()


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder, reread: a lost executor costs no recomputation before it."""
    return written_at(df, scratch_path(df.sparkSession, name, keep))


def written_at(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
