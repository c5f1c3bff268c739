"""Incremental bronze ingestion: new XML files, deduplicated by content, appended in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import bronze


def append_new(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends the contents of a stream of files (path, nome, tamanho, content) that a table does not hold yet, takes what is there and stops.

    The checkpoint remembers the files, the anti-join the contents."""
    bronze.ensure(rows.sparkSession, table)

    def append(batch: DataFrame, _: int) -> None:
        bronze.append_new(batch, table)

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """append_new for the XML files below a folder."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(folder)
    return append_new(files.select("path", F.element_at(F.split("path", "/"), -1).alias("nome"), F.col("length").alias("tamanho"), "content"), table, checkpoint)
