"""Text normalisation, character n-grams, confidence bins and routing."""

from __future__ import annotations

import unicodedata
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Abbreviations of item descriptions.
ABBREVIATIONS = {"cx": "caixa", "un": "unidade", "pc": "peca", "kg": "quilograma", "ml": "mililitro", "cp": "comprimido", "pol": "polegadas", "tam": "tamanho", "mg": "miligrama"}
# Texts decomposed at a time: what a batch's steps hold beside it does not grow with the batch.
SLICE = 256


@cache
def _combining() -> str:
    """Pattern of the characters that combine with the one before, as ranges of code points."""
    points = [c for c in range(0x110000) if unicodedata.combining(chr(c))]
    starts = [c for c, before in zip(points, [-1, *points], strict=False) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -1], strict=True) if c != after - 1]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True)) + "]"


@F.arrow_udf(T.StringType())
def _plain(column: pa.Array) -> pa.Array:
    """Compatibility decomposition without combining marks, SLICE texts at a time; Spark has no built-in for it."""
    parts = [column.slice(at, SLICE) for at in range(0, max(len(column), 1), SLICE)]
    return pa.concat_arrays([pc.replace_substring_regex(pc.utf8_normalize(part, "NFKD"), _combining(), "") for part in parts])


def normalizar(text: Column, abbreviations: dict[str, str] = ABBREVIATIONS) -> Column:
    out = F.regexp_replace(_plain(F.lower(text)), r"[^a-z0-9\s]", " ")
    for short, long in abbreviations.items():
        out = F.regexp_replace(out, rf"\b{short}\b", long)
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def wb_words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def char_wb_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside words padded by a space on both sides; a shorter padded word counts once."""
    words = wb_words(text)

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.length(padded)

        def of_size(n: int) -> Column:
            # A lambda of two parameters would be given the index as the second.
            grams = F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))), lambda i: F.substring(padded, i, F.lit(n)))
            return F.when(size >= n, grams).otherwise(F.array(padded) if n == low else F.array().cast("array<string>"))

        return F.concat(*[of_size(n) for n in range(low, high + 1)])

    return F.flatten(F.transform(words, of_word))


def char_wb_counts(texts: DataFrame) -> DataFrame:
    """gram and n, its occurrences in all texts; cut from distinct words, which are counted first, as grams do not cross words."""
    words = texts.select(F.explode(F.split("text", r"\s+")).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return words.select("n", F.explode(char_wb_ngrams(F.col("word"))).alias("gram")).groupBy("gram").agg(F.sum("n").alias("n"))


def long_words(text: Column) -> Column:
    """Words of two characters or more."""
    return F.filter(F.split(text, r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 1)


def word_ngrams(text: Column) -> Column:
    """Words of two characters or more, and pairs of neighbours."""
    words = long_words(text)
    # Two slices side by side: an index into words inside a lambda would split the text again for each pair.
    shorter = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(words, F.zip_with(F.slice(words, F.lit(1), shorter), F.slice(words, F.lit(2), shorter), lambda a, b: F.concat_ws(" ", a, b)))


def faixa_confianca(confidence: Column) -> Column:
    """Calibration bin, closed on the right."""
    return F.when(confidence <= 0.5, "(-inf, 0.5]").when(confidence <= 0.7, "(0.5, 0.7]").when(confidence <= 0.9, "(0.7, 0.9]").otherwise("(0.9, inf]")


def rotear(confidence: Column) -> Column:
    return F.when(confidence > 0.90, "AUTO").when(confidence >= 0.70, "REVISAO").otherwise("ESPECIALISTA")
