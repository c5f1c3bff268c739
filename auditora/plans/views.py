"""The audit views by name in a session: layers first, then the views over them, then what reads those."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import audit
from .engine import scored

# Names of the layers and of the views.
LAYERS = ("silver_cabecalho_raw", "silver_cabecalho", "silver_item", "fct_item_fiscal")
CONSOLIDATED = "v_achados_sql"
PRIORITISED = "v_achados_priorizados"


def views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The views over the layers, by name."""
    raw, head, item, fact = (tables[name] for name in LAYERS)
    return {
        "v_gap_numeracao": audit.numbering_gaps(head),
        "v_duplicidade_chave": audit.duplicate_keys(raw),
        "v_duplicidade_numeracao": audit.duplicate_numbers(head),
        "v_duplicidade_economica": audit.economic_duplicates(head),
        "v_ncm_invalido": audit.invalid_ncm(fact),
        "v_cfop_uf_incoerente": audit.interstate_same_state(fact),
        "v_preco_outlier": audit.price_outliers(fact),
        "v_queda_faturamento": audit.revenue_drops(head),
        "v_total_divergente": audit.divergent_totals(head, item),
        "v_sem_emissao": audit.inactive_emitters(head),
    }


def register(spark: SparkSession, tables: Mapping[str, DataFrame], findings: DataFrame | None = None) -> list[str]:
    """Makes layers and views known by name, replacing those of before; with findings the prioritised ones too.  Returns the names in order."""
    made = {name: tables[name] for name in LAYERS} | views(tables)
    if findings is not None:
        made |= {"achados": findings, PRIORITISED: scored(findings)}
    for name, rows in made.items():
        rows.createOrReplaceTempView(name)
    parts = [f"SELECT '{rule}' AS regra, '{severity}' AS severidade, chave_acesso, cnpj_emit, CAST({value} AS DOUBLE) AS vl_base FROM {view}" for rule, severity, view, value in audit.CONSOLIDATED]
    spark.sql(" UNION ALL ".join(parts)).createOrReplaceTempView(CONSOLIDATED)
    return [*made, CONSOLIDATED]


def forget(spark: SparkSession, names: list[str]) -> None:
    """Drops views by name, the last first."""
    for name in reversed(names):
        spark.catalog.dropTempView(name)
