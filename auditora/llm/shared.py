"""Tables of the operators in the folder that driver and executors share: names, buckets and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import deleted, passing, release, scratch_path, shared_dir, written, written_at

__all__ = ["bucketed", "deleted", "free_name", "numbered", "passing", "release", "scratch_path", "shared_dir", "written", "written_at"]

BUCKET_BYTES = 128 << 20


def free_name(name: str, taken: list[str]) -> str:
    """name, with underscores behind it where the columns taken have it already."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def bucketed(df: DataFrame, keys: list[str], name: str, size: int, distinct: bool = False, keep: bool = False) -> DataFrame:
    """df, of about size bytes, as a table in the shared folder, in buckets by keys: joins on them do not shuffle it again.

    With distinct one row of each key stays.  The catalog entry that a bucketed write needs goes at once."""
    spark = df.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    path = scratch_path(spark, name, keep)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(buckets, *keys)
    dealt = dealt.dropDuplicates(keys) if distinct else dealt
    dealt.write.bucketBy(buckets, *keys).option("compression", "zstd").option("path", path).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def numbered(df: DataFrame, column: str, name: str, order: list[str] | None = None) -> DataFrame:
    """df with the numbers 1, 2, 3... of its rows, in ascending order of columns where given: sorted by ranges, so no task sees all rows.

    Rows are written with their place in their task; only the number of rows of each task comes to the driver."""
    spark, place = df.sparkSession, F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    # The low 33 bits of the id count the rows of a task, the others the tasks.
    parts = written(dealt.withColumns({"__task": F.shiftrightunsigned(place, 33), "__at": place.bitwiseAND((1 << 33) - 1)}), name, keep=True)
    before, total = [], 0
    for task, rows in sorted(tuple(r) for r in parts.groupBy("__task").agg(F.count("*")).collect()):
        before.append((task, total))
        total += rows
    starts = spark.createDataFrame(before, "__task long, __before long")
    return parts.join(F.broadcast(starts), "__task").withColumn(column, F.col("__before") + F.col("__at") + 1).drop("__task", "__at", "__before")
