"""The queries behind a dashboard, over findings, scored findings and stage metrics."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .audit import money_sum


def available(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


LABEL_LENGTH, LIFE_SECONDS = 34, 300.0
# Numbers of 64 bits for the rules' numbers, 0 to 999.
RULE_WORDS = 16


class Results:
    """Collected results of small queries, each for a span of seconds; an older one is asked for again."""

    def __init__(self, life: float = LIFE_SECONDS, clock: Callable[[], float] = time.monotonic) -> None:
        self.life, self.clock = life, clock
        self.held: dict[str, tuple[float, list[Row]]] = {}

    def get(self, name: str, query: Callable[[], DataFrame]) -> list[Row]:
        now = self.clock()
        if name not in self.held or now - self.held[name][0] >= self.life:
            self.held = {k: v for k, v in self.held.items() if now - v[0] < self.life}
            self.held[name] = now, query().collect()
        return self.held[name][1]


def label(name: Column) -> Column:
    """A rule's name as a chart shows it."""
    return F.substring(name, 1, LABEL_LENGTH)


def impact_by_label(findings: DataFrame, severities: tuple[str, ...] | None = None, n: int = 10) -> DataFrame:
    """rotulo, severidade and impacto of the rules of highest impact, as a chart shows them."""
    return top_rules(findings, severities, n).select(label(F.col("nome_regra")).alias("rotulo"), "severidade", "impacto")


def _kept(findings: DataFrame, severities: tuple[str, ...] | None) -> DataFrame:
    return findings.filter(F.col("severidade").isin(*severities)) if severities else findings


def kpis(findings: DataFrame, severities: tuple[str, ...] | None = None) -> DataFrame:
    """One row: findings, clients, money at risk and rules.

    Counted by client first, the rules of a client as bits of their numbers (ids are R and three digits) in RULE_WORDS numbers, so a client
    costs few bytes, no row is doubled for a second distinct count, and what meets in the end is one row a task."""
    number = F.substring("id_regra", 2, 3).cast("int")
    bit = lambda k: F.when(F.floor(number / 64) == k, F.call_function("shiftleft", F.lit(1).cast("long"), number % 64))
    money = F.sum(F.col("impacto_rs").cast("decimal(18,6)")).alias("soma")
    words = [f"regras_{k}" for k in range(RULE_WORDS)]
    clients = _kept(findings, severities).groupBy("cnpj_emit").agg(F.count("*").alias("n"), money, *[F.bit_or(bit(k)).alias(w) for k, w in enumerate(words)])
    rules = sum((F.coalesce(F.bit_count(F.bit_or(w)), F.lit(0)) for w in words), F.lit(0)).cast("long")
    return clients.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("achados"), F.count("cnpj_emit").alias("clientes"), F.coalesce(F.sum("soma").cast("double"), F.lit(0.0)).alias("risco"), rules.alias("regras"))


def top_rules(findings: DataFrame, severities: tuple[str, ...] | None = None, n: int = 10) -> DataFrame:
    rows = _kept(findings, severities).groupBy("nome_regra", "severidade").agg(F.count("*").alias("qtd"), money_sum("impacto_rs").alias("impacto"))
    return rows.orderBy(F.desc_nulls_last("impacto"), "nome_regra", "severidade").limit(n)


def top_clients(findings: DataFrame, severities: tuple[str, ...] | None = None, n: int = 10) -> DataFrame:
    rows = _kept(findings, severities).groupBy("cnpj_emit").agg(F.count("*").alias("achados"), money_sum("impacto_rs").alias("risco"))
    return rows.orderBy(F.desc_nulls_last("risco"), "cnpj_emit").limit(n)


def clients(findings: DataFrame) -> DataFrame:
    return findings.select("cnpj_emit").distinct().orderBy("cnpj_emit")


def client_detail(scored: DataFrame, client: str, n: int = 300) -> DataFrame:
    rows = scored.filter(F.col("cnpj_emit") == client).select("id_regra", "nome_regra", "severidade", "chave_acesso", "n_item", F.col("impacto_rs").cast("decimal(18,2)").cast("double").alias("impacto"), "score")
    return rows.orderBy(F.desc_nulls_last("score"), "id_regra", F.asc_nulls_last("chave_acesso"), F.asc_nulls_last("n_item")).limit(n)


def pipeline_health(metrics: DataFrame) -> DataFrame:
    ms = lambda c: F.floor(c * 1000 + 0.5) / 1000
    rows = metrics.groupBy("etapa").agg(ms(F.avg(F.col("duracao_s").cast("decimal(18,6)")).cast("double")).alias("media_s"), ms(F.max("duracao_s")).alias("max_s"), F.count("*").alias("execucoes"), F.count_if(F.col("status") == "ERRO").alias("erros"))
    return rows.orderBy(F.desc_nulls_last("media_s"), "etapa")
