"""Bronze archive of raw files by content hash, its index by patterns, and the partitioned export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import money_sum
from ..plans.schema import BRONZE, names
from ..scratch import passing, written
from .nfe import read_files

# The table of keys beside a bronze table, and how many digits of a hash name its folder there.
KEYS, KEY_DIGITS = "_chaves", 2
# As many paths as a task can hold beside its work: some hundred bytes each.
FEW_PATHS = 500_000


def first_paths(files: DataFrame) -> DataFrame:
    """sha256, path and copies: the first path of each content; only hashes and paths are shuffled."""
    hashed = files.select(F.sha2("content", 256).alias("sha256"), "path")
    return hashed.groupBy("sha256").agg(F.min("path").alias("path"), F.count("*").alias("copies"))


def _contents(files: DataFrame, chosen: DataFrame, few: int) -> DataFrame:
    """The files of chosen paths; up to few of them go to where the contents are, and contents are not shuffled, beyond that Spark joins both by path."""
    rows = files.join(F.broadcast(chosen) if chosen.count() <= few else chosen, "path")
    return rows.select("sha256", "nome", F.col("content").cast("string").alias("conteudo"), "tamanho", F.current_timestamp().cast("timestamp_ntz").alias("dh_ingestao"))


def new_files(files: DataFrame, stored: DataFrame, few: int = FEW_PATHS) -> DataFrame:
    """The first file by path of each content that is not stored yet; the chosen paths are written, so that their number is known."""
    chosen = first_paths(files).join(stored.select("sha256"), "sha256", "left_anti").select("sha256", "path")
    return _contents(files, written(chosen, "chosen-paths", keep=True), few)


def ensure(spark: SparkSession, table: str, schema: str = BRONZE) -> DataFrame:
    """The bronze table at a path, created empty where it is missing."""
    try:
        return spark.read.schema(schema).parquet(table)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        spark.createDataFrame([], schema).write.parquet(table)
        return spark.read.schema(schema).parquet(table)


def _by_bucket(keys: DataFrame) -> DataFrame:
    return keys.select("sha256", F.left("sha256", F.lit(KEY_DIGITS)).alias("balde"))


def stored_keys(spark: SparkSession, table: str) -> DataFrame:
    """sha256 and balde of the contents of a table, from a table of keys beside it, in folders by their first digits.

    Keys are written after contents, so a run that ended between both leaves some out: where the numbers of rows (from the files'
    footers) differ, what is missing is added first."""
    contents, keys = ensure(spark, table), ensure(spark, table + KEYS, "sha256 string, balde string")
    if contents.count() != keys.count():
        missing = contents.select("sha256").join(keys.select("sha256"), "sha256", "left_anti")
        _by_bucket(missing).write.mode("append").partitionBy("balde").parquet(table + KEYS)
        keys = spark.read.schema("sha256 string, balde string").parquet(table + KEYS)
    return keys


def append_new(files: DataFrame, table: str) -> int:
    """Appends the contents of files that a table does not hold yet; returns how many.

    Only the buckets of keys that the files' own hashes fall into are read."""
    spark, added = files.sparkSession, Observation()
    with passing(spark):
        hashed = written(first_paths(files).withColumn("balde", F.left("sha256", F.lit(KEY_DIGITS))), "hashed-files")
        # At most 16 to the KEY_DIGITS rows.
        buckets = [r.balde for r in hashed.select("balde").distinct().collect()]
        stored = stored_keys(spark, table).filter(F.col("balde").isin(buckets))
        chosen = written(hashed.join(stored, ["sha256", "balde"], "left_anti").select("sha256", "path"), "chosen-paths")
        _contents(files, chosen, FEW_PATHS).observe(added, F.count("*").alias("n")).select(*names(BRONZE)).write.mode("append").parquet(table)
        _by_bucket(chosen).write.mode("append").partitionBy("balde").parquet(table + KEYS)
    return added.get["n"]


def ingest(spark: SparkSession, folder: str, table: str) -> dict[str, int]:
    """Appends new contents of folder; running again adds nothing."""
    files = read_files(spark, folder)
    total, before = files.count(), ensure(spark, table).count()
    new = append_new(files, table)
    return {"novos": new, "repetidos": total - new, "total_bronze": before + new}


# What is looked up in the raw text of a note.
PATTERNS = {
    "chave_acesso": (r'Id="NFe([0-9]{44})"', "string"),
    "numero": (r"<nNF>([0-9]+)</nNF>", "int"),
    "cnpj_emit": (r"<CNPJ>([0-9]{14})</CNPJ>", "string"),
    "dt_emissao": (r"<dhEmi>([0-9-]{10})", "date"),
    "valor_total": (r"<vNF>([0-9.]+)</vNF>", "double"),
}


def index(bronze: DataFrame, patterns: dict[str, tuple[str, str]] | None = None, content: str = "conteudo") -> DataFrame:
    """bronze with the first match of each pattern; null where there is none or it does not convert."""
    found = {n: F.nullif(F.regexp_extract(content, f"(?s){p}", 1), F.lit("")).try_cast(kind) for n, (p, kind) in (patterns or PATTERNS).items()}
    return bronze.withColumns(found)


def undecoded(indexed: DataFrame) -> DataFrame:
    return indexed.filter("chave_acesso IS NULL OR dt_emissao IS NULL")


def export(indexed: DataFrame, target: str, day: str = "dt_emissao") -> None:
    """Dated rows as Parquet by year and month; only the partitions met are replaced.

    The hint lets Spark divide a month of many rows among tasks and join small ones."""
    rows = indexed.filter(F.col(day).isNotNull()).withColumns({"ano": F.year(day), "mes": F.month(day)})
    rows.hint("rebalance", "ano", "mes").write.partitionBy("ano", "mes").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)


def partitions(spark: SparkSession, target: str) -> DataFrame:
    """The partitions of an export and their rows, counted from the files' footers."""
    return spark.read.parquet(target).groupBy("ano", "mes").agg(F.count("*").alias("linhas"))


def export_stats(indexed: DataFrame, emitter: str = "cnpj_emit", day: str = "dt_emissao", value: str = "valor_total", target: str | None = None) -> DataFrame:
    """One row over all indexed rows, dated or not; with target also particoes, how many an export there holds."""
    stats = indexed.agg(F.count("*").alias("linhas"), F.countDistinct(emitter).alias("emitentes"), F.min(day).alias("primeira"), F.max(day).alias("ultima"), money_sum(value).alias("soma"))
    if target is None:
        return stats
    # One row on either side.
    return stats.crossJoin(F.broadcast(partitions(indexed.sparkSession, target).agg(F.count("*").alias("particoes"))))


def pruned_totals(spark: SparkSession, target: str, year: int, month: int, emitter: str = "cnpj_emit", value: str = "valor_total") -> DataFrame:
    """Totals by emitter of one month of an export: one partition is read, of two columns."""
    rows = spark.read.parquet(target).filter((F.col("ano") == year) & (F.col("mes") == month))
    return rows.groupBy(emitter).agg(money_sum(value).alias("total"))


def like_count(rows: DataFrame, pattern: str, content: str = "conteudo") -> DataFrame:
    return rows.filter(F.col(content).like(pattern)).agg(F.count("*").alias("n"))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("length")
    return files.agg(F.sum("length")).first()[0] or 0
