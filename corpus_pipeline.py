"""Corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, packing.

Each stage works on all rows its predecessor kept, written as Parquet in the
shared folder and reread.  Every stage but the last returns the columns of
documents.  Rows may lack text; ids may be null or repeat, and each row is then
a document of its own; extra columns pass through whatever their names; an empty
table goes through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditora.llm import langid, lines, mixing, ngram_join, packing
from auditora.llm.shared import deleted, free_name, passing, scratch_path, written_at

LEAST_SCORE = 0.5


def _marked(docs: DataFrame, mark: Column) -> DataFrame:
    """Each row whole, and its mark."""
    return docs.select(F.struct("*").alias("row"), mark.alias("mark"))


def _number(docs: DataFrame) -> Column:
    """Number of a row among those of equal mark, by its other columns; a map has no hash."""
    plain = [F.col("row")[c] for c, kind in docs.dtypes if "map<" not in kind]
    return F.row_number().over(W.partitionBy("mark").orderBy(F.xxhash64(*plain)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose main language is known and holds LEAST_SCORE of their letters.

    The model learns from the labelled rows whose ids leave a remainder other than 2."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = langid.train(docs.filter(~F.coalesce(held_out, F.lit(True))))
    found = docs.select(F.struct("*").alias("row"), langid.identify(F.col("text"), model).alias("found"))
    return found.filter((F.col("found.lang") != "und") & (F.col("found.score") >= LEAST_SCORE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of later copies of three-line windows; documents left without a word go."""
    removed = F.col(free_name("n_removed", docs.columns))
    out = lines.dedup_lines(docs).filter((removed == 0) | F.col("text").rlike(mixing.WORD))
    return out.withColumn("n_chars", F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: the one of the smallest id, null last.

    Of rows that repeat that id in the component one stays; rows without words are alone and all stay."""
    kept = ngram_join.first_marks(docs)
    # One key for the join and the numbers, so texts are shuffled once.
    joined = _marked(docs, ngram_join.row_mark()).join(kept, "mark").withColumn("number", _number(docs))
    return joined.filter(F.col("alone") | (F.col("number") == 1)).select("row.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; rows that repeat an id are taken each by itself.

    The mix takes rows of equal id, source and text alike but for one copy: the first of them have it."""
    taken = mixing.mix(docs).groupBy("mark").agg(F.sum("copies").alias("taken"), F.count("*").alias("rows"))
    joined = _marked(docs, mixing.row_mark()).join(taken, "mark").withColumn("number", _number(docs))
    copies = F.expr("taken div rows + int(number <= taken % rows)").cast("int")
    return joined.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of packing.WINDOW tokens, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

# The cube method's draws and the packer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage has read goes once it is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with passing(spark):
        for k, (name, stage) in enumerate(STAGES):
            before = path if k else None
            path = scratch_path(spark, f"pipeline-{name}", keep=k + 1 == len(STAGES))
            with passing(spark):
                docs = written_at(stage(spark, docs, sf_dir), path)
            if before:
                deleted(spark, [before])
    return docs
