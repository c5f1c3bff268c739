"""Silver layers and the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.schema import FACT_FROM_HEADER


def best_rows(df: DataFrame, key: tuple[str, ...], *order: Column) -> DataFrame:
    """One row of each key, the first in order; Spark limits the groups before and after the shuffle."""
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("__rn = 1").drop("__rn")


def silver_header(raw: DataFrame) -> DataFrame:
    """One row per access key: instant, day and month of issue, and whether the emitter is in the simple regime (null if unknown)."""
    tie = F.xxhash64(*[F.col(c) for c in raw.columns])
    rows = best_rows(raw, ("chave_acesso",), F.col("numero").asc_nulls_last(), tie)
    instant = F.col("dh_emissao").try_cast("timestamp_ntz")
    day = instant.cast("date")
    return rows.withColumns({"dt_emissao": day, "competencia": F.trunc(day, "month"), "is_simples": F.col("crt").isin("1", "2"), "dh_emissao": instant})


def silver_item(raw: DataFrame) -> DataFrame:
    tie = F.xxhash64(*[F.col(c) for c in raw.columns])
    return best_rows(raw, ("chave_acesso", "n_item"), F.col("vl_produto").desc_nulls_last(), "c_prod", "descricao", tie)


def fact(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Items with the columns of their headers, the CFOP group and the taxation code."""
    own = headers.select("chave_acesso", *FACT_FROM_HEADER)
    return items.join(own, "chave_acesso").withColumns({"grupo_cfop": F.left("cfop", F.lit(1)), "cod_tributacao": F.coalesce("csosn", "cst_icms")})
